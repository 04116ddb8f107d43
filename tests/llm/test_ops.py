"""Each operator against a plain version on a small table of awkward rows, and on an empty one."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronogrid.llm import ann, byte_bpe, exact_dedup, language_id, lm_score, near_dedup, packing, quality, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(t):
    return re.sub("[A-Z]", lambda c: c[0].lower(), t or "")


def test_lm_score(spark, corpus, empty):
    from pyspark.sql import functions as F

    df, rows = corpus
    train = df.withColumn("train", F.col("doc_id") % 4 != 1)
    got = lm_score.lm_score(train).collect()
    toks = [(r[0], WORD.findall(lowered(r[1])) + [None]) for r in rows]
    c = Counter(w for i, t in toks if i % 4 != 1 for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((i, i % 4 == 1, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in toks)
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.lm_score(empty.withColumn("train", F.lit(True))).count() == 0
    nothing = lm_score.lm_score(df.withColumn("train", F.lit(False))).collect()
    assert len(nothing) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in nothing)


def lm_tokens(texts):
    raw = [t.encode() for t in texts]
    return lm_score.tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_lm_learns_from_every_training_document(spark):
    """The n-grams and skips of each document move their weights, whichever round it is dealt to."""
    from pyspark.sql import functions as F

    texts = [" ".join(f"t{i}w{j}" for j in range(6)) for i in range(60)]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("text", F.xxhash64("doc_id").alias("part"))
    train = train.unionAll(train).unionAll(train)
    model = lm_score.fit(train, lm_score.count_tokens(train))
    h, to, *_ = lm_tokens(texts)
    f = model.features(h, to)
    for level, node, _ in model.paths(h):
        assert model.w[level][model.places(f, level, node)].any(axis=2).all()


def test_lm_scores_by_hand(spark, corpus):
    """score, token by token, from the model's tables; unseen words by their letters."""
    from pyspark.sql import functions as F

    df, rows = corpus
    own = df.select("doc_id", (F.col("doc_id") % 4 == 1).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    learn = own.where("NOT held_out").select("text", F.xxhash64("doc_id").alias("part"))
    for cache in (lm_score.CACHE, 0):
        counted = lm_score.count_tokens(learn)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lm_score, "CACHE", cache)
            model = lm_score.fit(learn, counted)
        assert (len(model.cache) > 0) == (cache > 0)
        got = sorted((r.doc_id, round(r.score, 3)) for r in lm_score.apply(own, counted, model).collect())
        toks = [(r[0], [*WORD.findall(lowered(r[1])), None]) for r in rows]
        n = Counter(w for i, t in toks if i % 4 != 1 for w in t)
        pairs = Counter((a, b) for w in {w for w in n if w} for a, b in zip([256, *w.encode()], [*w.encode(), 256]))
        once = sum(v == 1 for v in n.values())
        assert abs(model.unseen - (once + 0.5) / (sum(n.values()) + 1)) < 1e-12
        assert {r.h for r in counted.where("pair").collect()} == {a * 257 + b for a, b in pairs}
        want = []
        for i, t in toks:
            h, to, *_ = lm_tokens([" ".join(w for w in t if w)])
            f, total = model.features(h, to), 0.0
            for k, w in enumerate(t):
                if not n[w]:
                    raw = (w or "").encode()
                    total += math.log10(model.unseen) + sum(model.spelled[a * 257 + b] for a, b in zip([256, *raw], [*raw, 256]))
                    continue
                p, node, code = 1 - model.unseen, 0, int(h[k]) & (2**64 - 1)
                for level in range(lm_score.LEVELS):
                    x = model.bias[level][node] + model.w[level][model.places(f[k : k + 1], level, np.array([node]))[0]].sum(axis=0)
                    branch = code >> (4 * level) & 15
                    p *= np.exp(x)[branch] / np.exp(x).sum()
                    node = node * 16 + branch
                total += math.log10(p * n[w] / model.leaf_n[node])
            want.append((i, total))
        assert all(i == j and abs(x - y) < 2e-3 * max(1, abs(y)) for (i, x), (j, y) in zip(got, sorted(want)))


def test_lm_chances_sum_to_one():
    rng = np.random.default_rng(0)
    m = lm_score.Weights(rng.integers(0, 90, 1 << 16).astype(float), 900, 9000, rng.integers(0, 50, 257 * 257))
    for w in m.w:
        w += rng.normal(size=w.shape).astype(np.float32)
    f = rng.integers(0, 1 << 62, (1, lm_score.FEATURES)).astype(np.uint64)
    p = np.ones(1)
    for level in range(lm_score.LEVELS):
        node = np.arange(len(p))
        p = (p[:, None] * m.chances(level, node, m.places(np.repeat(f, len(p), 0), level, node))).ravel()
    assert len(p) == 1 << 16 and abs(p.sum() - 1) < 1e-3
    assert np.allclose((10 ** m.spelled).reshape(257, 257).sum(axis=1), 1)
    h = rng.integers(-(1 << 62), 1 << 62, 1000)
    code = h.astype(np.uint64)
    assert (m.leaves(h) == sum(((code >> np.uint64(4 * k)) & np.uint64(15)).astype(int) << (12 - 4 * k) for k in range(4))).all()


def test_ann_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 48)).astype(np.float32)
    x[50:90] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 48), (1040, [float("nan")] * 48), (1060, [1.0, None] * 24), (1080, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    y = x.astype(float)
    for q in range(0, 400, 20):
        s = y @ y[q]
        order = [i for i in np.lexsort((np.arange(400), -np.round(s, 12))) if i != q][:20]
        assert got[q] == [(k + 1, i, round(float(s[i]), 9)) for k, i in enumerate(order)]
    assert set(got) == set(range(0, 400, 20))
    assert ann.nearest(df.where("false"), df.where("false")).count() == 0
    assert ann.nearest(df.where("vec_id < 5"), df.where("vec_id = 0")).count() == 4


def brute_nearest(rows, asked, k=20):
    """Sums in coordinate order; an id counts once, by its best pair of vectors."""
    best = defaultdict(dict)
    for q, u in asked:
        for i, v in rows:
            if i != q:
                x = float(np.cumsum(np.asarray(u, float) * np.asarray(v, float))[-1])
                best[q][i] = max(x, best[q].get(i, -np.inf))
    return {q: sorted((-s, i) for i, s in d.items())[:k] for q, d in best.items()}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_ann_over_many_cells(spark, kind):
    """Clustered vectors in cells of a few; ids with several vectors, on both sides; extra columns."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + 0.1 * rng.normal(size=(1500, 16))
    x = x.astype(np.float32) if kind == "float" else x
    rows = [(i % 1400, v.tolist()) for i, v in enumerate(x)] + [(3, x[3].tolist()), (77, x[3].tolist())]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, score int, id int")
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0])
    for cell, probes in ((100, None), (10_000, None), (100, 1000)):
        got = defaultdict(list)
        for r in ann.nearest(df, df.where("vec_id % 20 = 0"), cell=cell, probes=probes).orderBy("query_id", "rank").collect():
            got[r.query_id].append((-r.score, r.vec_id))
        assert set(got) == set(want)
        hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want]
        assert np.mean(hits) > 0.995 and all(dict((i, s) for s, i in want[q]).get(i, s) == s for q in want for s, i in got[q])
        assert all(len({i for _, i in g}) == len(g) == 20 for g in got.values())


def spans(texts, length=200):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        mark = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = True
        mark = mark[:-1]
        n = int(np.diff(np.concatenate([[0], mark.astype(int)])).clip(0).sum())
        out.append((len(b), int(mark.sum()), n, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~mark])).hexdigest()))
    return out


@pytest.mark.parametrize("held", [20_000, 1])
def test_suffix_dedup(spark, corpus, empty, monkeypatch, held):
    """By sorting an anchor's variants in a task, and by strings dealt over tasks."""
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    df, rows = corpus
    want = sorted((r[0], *s) for r, s in zip(rows, spans([(r[1] or "").encode() for r in rows])))
    assert sorted(tuple(r) for r in suffix_dedup.suffix_dedup(df).collect()) == want
    assert sum(w[2] for w in want) > 1000
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_dedup_where_hashes_collide(spark, corpus, monkeypatch):
    """Extensions that hashes overstate are found out and compared by bytes."""
    monkeypatch.setattr(suffix_dedup.Suffixes, "_equal", lambda self, x, y, n: np.ones(len(x), bool))
    rows = [(b"ab" * 60 + b"x" * 100 + bytes([97 + i % 3]) * 90) for i in range(7)]
    size = np.array([len(r) for r in rows])
    v, a, b = suffix_dedup.shared_strings(b"".join(rows), np.cumsum(size) - size, np.full(7, 100), size, np.zeros(7, np.int64), 200)
    got = {(int(i), k) for i, x, y in zip(v, a, b) for k in range(x, y + 1)}
    seen = Counter(r[k : k + 200] for r in rows for k in range(len(r) - 199))
    assert got == {(i, k) for i, r in enumerate(rows) for k in range(len(r) - 199) if seen[r[k : k + 200]] > 1 and 0 <= 100 - k <= 168}


def test_suffix_dedup_of_one_character(spark):
    """A megabyte of one character: every string of it repeats; its one variant's bytes are kept once."""
    import pyarrow as pa

    text = "a" * (1 << 20)
    got = suffix_dedup.suffix_dedup(spark.createDataFrame([(1, text), (2, "b" * 199 + "c"), (3, "xy" * 150)], "doc_id long, text string"))
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1 << 20, 1 << 20, 1, none), (2, 200, 0, 0, hashlib.sha256(b"b" * 199 + b"c").hexdigest()), (3, 300, 300, 1, none)]
    data = np.frombuffer(text[:70_000].encode(), np.uint8)
    h = np.unique(np.concatenate([x[4] for x in suffix_dedup.runs(data, np.array([0, len(data)]), 200)]))
    hs = pa.array([[{"h": int(x), "hot": False} for x in h]], pa.list_(pa.struct([("h", pa.int64()), ("hot", pa.bool_())])))
    batch = pa.RecordBatch.from_arrays([pa.array([b"k"], pa.binary()), pa.array([data.tobytes()], pa.binary()), hs], names=["key", "text", "hs"])
    assert sum(len(r["segment"]) for b in suffix_dedup._segments(200, False)([batch]) for r in b.to_pylist()) < 2000


def test_suffix_mergesort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    at, size = np.sort(rng.integers(0, 500, 90)), rng.integers(1, 90, 90)
    group = np.sort(rng.integers(0, 4, 90))
    order = suffix_dedup.Suffixes(data).mergesort(at, size, group)
    raw = data.tobytes()
    want = sorted(range(90), key=lambda i: (group[i], raw[at[i] : at[i] + size[i]], i))
    assert [raw[at[i] : at[i] + size[i]] for i in order] == [raw[at[i] : at[i] + size[i]] for i in want]
    assert (group[order] == group).all()


def test_many_variants_of_an_anchor():
    """Groups of one to a hundred variants against brute force, pairs that agree to either side included."""
    rng = np.random.default_rng(2)
    core = bytes(rng.integers(97, 123, 400).astype(np.uint8))
    segs, left, group = [], [], []
    for g, m in enumerate((100, 1, 30, 2)):
        for i in range(m):
            lo, hi = int(rng.integers(0, 169)), int(rng.integers(32, 200))
            noise = lambda n: bytes(rng.integers(97, 99, n).astype(np.uint8))
            before, after = core[200 - lo : 200], core[200 : 200 + hi]
            before = (noise(int(rng.integers(0, 30))) + before)[-168:]
            after = (after + noise(int(rng.integers(0, 30))))[:200]
            pad = 200 - len(before) - len(after)
            segs.append(before + after + (noise(pad) if pad > 0 else b""))
            left.append(len(before))
            group.append(g)
    size = np.array([len(s) for s in segs])
    v, a, b = suffix_dedup.shared_strings(b"".join(segs), np.cumsum(size) - size, np.array(left), size, np.array(group), 200)
    got = {(int(i), k) for i, x, y in zip(v, a, b) for k in range(x, y + 1)}
    # A string of another offset from the anchor is another string, whatever its bytes.
    seen = Counter((g, l - i, s[i : i + 200]) for g, l, s in zip(group, left, segs) for i in range(len(s) - 199))
    assert got == {(k, i) for k, (g, l, s) in enumerate(zip(group, left, segs)) for i in range(len(s) - 199) if 0 <= l - i <= 168 and seen[g, l - i, s[i : i + 200]] > 1}
    assert len(got) > 100


def test_suffix_dedup_over_the_tiles_of_a_long_text(spark):
    """A passage that a text of over 1 MiB has once in each of two tiles, and one that lies across the edge."""
    rng = np.random.default_rng(6)
    data = rng.integers(97, 123, suffix_dedup.TILE + 150_000).astype(np.uint8)
    edge, n = suffix_dedup.TILE, 300
    cuts = [(1000, edge + 90_000), (5000, edge - 120)]
    for a, b in cuts:
        data[b : b + n] = data[a : a + n]
        data[[b - 1, b + n]] = data[[a - 1, a + n]] ^ 32
    text = data.tobytes()
    gone = np.zeros(len(data), bool)
    for x in (x for c in cuts for x in c):
        gone[x : x + n] = True
    got = suffix_dedup.suffix_dedup(spark.createDataFrame([(1, text.decode())], "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, len(text), 4 * n, 4, hashlib.sha256(data[~gone].tobytes()).hexdigest())]


def test_exact_dedup(spark, corpus, empty):
    df, rows = corpus
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((-len(r[1] or ""), r[0]))
    for p in (1, 7):
        got = exact_dedup.exact_dedup(df, partitions=p).collect()
        assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
        want = {i: (min(g)[1], len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for _, i in g}
        assert all(want[r.doc_id] == (r.keep_id, r.group_size, r.text_sha256) for r in got)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_a_group_over_many_partitions(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.concat(F.lit("x"), "id")).alias("text"))
    got = exact_dedup.exact_dedup(df, partitions=9)
    row = got.where("group_size > 1").agg(F.count(F.lit(1)).alias("n"), F.min("group_size").alias("a"), F.max("group_size").alias("b"), F.max("keep_id").alias("k"), F.count_if("kept").alias("kept")).first()
    assert tuple(row) == (2000, 2000, 2000, 1, 1)


def test_toxicity(spark, empty):
    import random

    rng = random.Random(1)
    words = "the of and stone river lamp carried walking slowly evening market".split()
    bad = ["blorgface", "snurkling", "grobnik"]
    rows = []
    for i in range(400):
        t = rng.choices(words, k=20)
        if i % 4 == 0:
            w = rng.choice(bad)
            t[3] = w if i % 8 else w[:4] + "x" + w[4:]
        rows.append((i, " ".join(t), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.where("doc_id < 300").select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(df.drop("toxic"), model).collect()}
    held = [r for r in rows if r[0] >= 300]
    assert np.mean([got[i].predicted == y for i, _, y in held]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "g-r-o-b-n-i-k"), (4, "g r o b n i k")], "doc_id long, text string")
    s = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert 0 <= s[1] == s[2] < 0.3 and s[4] > s[1]
    assert toxicity.score(empty.select("doc_id", "text"), model).count() == 0
    clash = toxicity.score(odd.unionAll(odd).selectExpr("*", "'x' AS score", "'y' AS predicted", "1 AS y"), model).collect()
    assert sorted((r.doc_id, r.score, r.y) for r in clash) == sorted((i, v, 1) for i, v in s.items() for _ in (0, 1))
    assert toxicity.fit(df, df.where("toxic = 0")) is None and toxicity.fit(empty, df) is None


def test_toxicity_works_out_a_word_once(monkeypatch):
    """Tokens that differ in marks around them alone cost one kernel with each landmark, and long ones the greatest of their pieces."""
    pairs, plain = [], toxicity.subsequence_kernel
    marks = toxicity.Landmarks(["idiot", "stupid", "ass"], np.array([1.0, -0.5, 0.25]))
    monkeypatch.setattr(toxicity, "subsequence_kernel", lambda s, t, *a: pairs.append(len(s)) or plain(s, t, *a))
    marks.learn(["idiots"])
    once = sum(pairs)
    pairs.clear()
    long = "idiots" + "x" * 40
    marks.learn(["idiots,", "(idiots)", "idiots!", "idiots", "ass?", "?!", "lamp"])
    assert sum(pairs) == once
    assert marks.memo["idiots,"] == marks.memo["(idiots)"] == marks.memo["idiots"] > 0.5 and marks.memo["ass?"] == 0.25
    assert marks.memo["?!"] == marks.memo["lamp"] == 0
    marks.learn([long])
    assert abs(marks.memo[long] - max((marks.kernels(toxicity._pieces(long)) @ marks.weights).tolist())) < 1e-6


def test_toxicity_of_two_words_together(spark):
    """Words that are toxic side by side and not alone, as texts' labels say."""
    import random

    rng = random.Random(3)
    words = "the of and stone river lamp carried walking slowly evening market".split()
    rows = []
    for i in range(400):
        t = rng.choices(words, k=20)
        if i % 4 == 0:
            t[3:5] = ["grobnik", "snurkling"]
        elif i % 4 == 1 and i % 3 == 0:
            t[3] = "grobnik" if i % 24 == 9 else "snurkling"
        rows.append((i, " ".join(t), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(df.drop("toxic"), toxicity.fit(df, df)).collect()}
    assert min(got[i] for i, _, y in rows if y) > max(got[i] for i, _, y in rows if not y)


def test_kernels_with_landmarks_are_whole():
    """Each word meets itself, whatever letters it repeats; only pairs without a common subsequence have 0."""
    words = ["fuck", "cock", "piss", "boob", "kike", "ass", "no", "blorgface", "facefuck", "aaaa", "réêé", "x" * 20]
    marks = toxicity.Landmarks(words)
    others = ["fxuxcxk", "cockk", "p-i-s-s", "boobs", "asss", "ass", "on", "frog", "", "aaa", "wordblorg", "fca", "f" * 20]
    got = marks.kernels(words + others)
    codes = lambda w, p: toxicity._codes([w], p)
    for i, a in enumerate(words + others):
        for k, b in enumerate(words):
            n = [min(len(x), toxicity.ORDER) for x in (a, b)]
            v = lambda x, y: float(toxicity.subsequence_kernel(codes(x, -1), codes(y, -2), n[1])[0])
            want = v(a, b) / math.sqrt(v(a, a) * v(b, b)) if n[0] == n[1] else 0
            assert abs(got[i, k] - want) < 1e-5, (a, b)
    assert (np.diag(got) > 0.999).all() and marks.lift().shape == (len(words),) * 2
    assert toxicity._pieces("ass!") == ["ass"] and toxicity._pieces("?!") == []


def test_kernel_by_hand():
    codes = lambda w, p: toxicity._codes([w], p)
    d = 0.5
    assert abs(toxicity.subsequence_kernel(codes("cat", -1), codes("cat", -2), 2, d)[0] - (2 * d**4 + d**6)) < 1e-6
    assert abs(toxicity.subsequence_kernel(codes("cat", -1), codes("cart", -2), 2, d)[0] - (d**4 + d**7 + d**5)) < 1e-6


def test_byte_bpe(spark, corpus, empty):
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df, rows = corpus
    extra = ["  a  b ", "a\n b\r\nc", "\x00a b", "中文 🙂 ﬁ ▁a", "a" * 2000, "it's I'LL", "<|endoftext|> x", "a  b"]
    df = df.select("doc_id", "text").unionAll(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.bpe_digests(df).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, t in [(r[0], r[1] or "") for r in rows] + list(enumerate(extra, 100)):
        ids = enc.encode_ordinary(t)
        assert (i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode())) in got
    back = byte_bpe.decode_ids(byte_bpe.encode_documents(df)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert byte_bpe.bpe_digests(empty).count() == 0


def sets(t, k):
    w = WORD.findall(lowered(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_near_dedup(spark, corpus, empty):
    df, rows = corpus
    s = [(r[0], sets(r[1], 4)) for r in rows]
    parent = {i: i for i, _ in s}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in s:
        for j, b in s:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    want = sorted((i, len(a), root(i), root(i) == i) for i, a in s)
    assert sorted(tuple(r) for r in near_dedup.near_dedup(df, words=4).collect()) == want
    assert near_dedup.near_dedup(empty).count() == 0


def test_near_dedup_of_a_wide_family(spark):
    """Copies of one text that are often not near each other: every link has to be found."""
    import random

    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            w[rng.randrange(60)] = f"v{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    s = [sets(t, 4) for _, t in rows]
    parent = list(range(120))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(120):
        for j in range(i):
            if 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(df, words=4).collect()}
    assert got == {i: root(i) for i in range(120)}


def test_words_that_polynomials_confuse(spark):
    """A Thue-Morse word and its complement have equal hashes under any polynomial modulo 2 ** 64."""
    bits = [0]
    for _ in range(10):
        bits += [1 - b for b in bits]
    texts = ["".join("ab"[b ^ flip] for b in bits[:n]) + end for n in (1024, 512, 256) for flip in (0, 1) for end in ("", "zz")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_dedup(df, words=4).collect()} == {i: i for i in range(len(texts))}
    from chronogrid.llm.shingles import column_bytes, word_hashes
    import pyarrow as pa

    assert len(set(word_hashes(*column_bytes(pa.array(texts)))[0].tolist())) == len(texts)


def test_posterior_bound():
    assert [near_dedup.least_matches(k) for k in (32, 128)] == [11, 73]


def test_quality(spark, empty):
    import random

    rng = random.Random(4)
    good = lambda: " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(60)) + "."
    junk = lambda: " ".join(w + "###" for w in good().split())
    rows = [(i, junk() if i % 3 == 0 else good(), "en", f"host{i % 2}/a{i % 5}") for i in range(300)] + [(900, None, None, None), (901, "", "en", "host0"), (5, "again", "en", "host9"), (None, "x " * 9000, "en", "host9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 300, 2)] + [(2, None), (None, 0), (4, 0)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    got = {r.doc_id: r for r in found if r.source != "host9"}
    assert len(found) == 304 and all(got[i].accepted == (i % 3 != 0) for i in range(300))
    assert all(0 <= r.quality_score <= 1 for r in found)
    # Rates and posteriors against a plain version that starts from the same evidence.
    known = {i: max(q for j, q in [(i, int(i % 3 != 0)), (4, 0)] if j == i) for i in range(0, 300, 2)}
    site = lambda r: ((r.source or "").split("/")[0], "/".join(x for x in ((r.source or "").split("/")[-1] if r.source is not None else None, r.lang) if x is not None))
    paths, hosts = defaultdict(lambda: [0.0, 0]), defaultdict(lambda: [0.0, 0])
    for r in found:
        g = known.get(r.doc_id, 1 / (1 + math.exp(-r.evidence)))
        for table, key in ((paths, site(r)), (hosts, site(r)[0])):
            table[key][0] += g
            table[key][1] += 1
    base = (sum(g for g, _ in hosts.values()) + 1) / (len(found) + 2)

    def level(table):
        big = [(g, n) for g, n in table.values() if n >= 5]
        return quality.strength(sum(g for g, _ in big), sum(n for _, n in big), sum(g * g / n for g, n in big), len(big), sum(n * n for _, n in big))

    kh, kp = level(hosts), level(paths)
    for r in found:
        host = (hosts[site(r)[0]][0] + kh * base) / (hosts[site(r)[0]][1] + kh)
        path = (paths[site(r)][0] + kp * host) / (paths[site(r)][1] + kp)
        odds = r.evidence + quality.SITE_WEIGHT * (math.log(path / (1 - path)) - math.log(base / (1 - base)))
        assert abs(r.host_rate - host) < 1e-9 and abs(r.path_rate - path) < 1e-9 and abs(r.quality_score - 1 / (1 + math.exp(-odds))) < 1e-9
    assert quality.classify(docs.where("false"), labels.where("false")).count() == 0
    assert {r.accepted for r in quality.classify(docs, labels.where("false")).collect()} == {True}
    clash = docs.selectExpr("*", "1 AS accepted", "2 AS `host`", "3 AS odds", "4 AS `a.b`", "5 AS row")
    both = quality.classify(clash, labels).collect()
    assert sorted(r.quality_score for r in both) == sorted(r.quality_score for r in found) and {(r.host, r.odds, r["a.b"], r.row) for r in both} == {(2, 3, 4, 5)}


def test_quality_features_by_hand():
    import pyarrow as pa

    texts = ["", None, "Ab ab, 12 #!", "é é é"]
    b, w, at = quality.features(*quality.column_bytes(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        t = t or ""
        words, n = WORD.findall(lowered(t)), max(len(t), 1)
        k = max(len(words), 1)
        x = [sum(c in "#$%&*!|<>{}[]~^=+\\/@_" for c in t) / n * 4, sum("A" <= c <= "Z" for c in t) / n, sum("0" <= c <= "9" for c in t) / n * 2, sum(c in ".,;:?" for c in t) / k * 2, len(set(words)) / k, n / k / 24, math.log(n) / 14]
        assert b[i].tolist() == [min(int(v * quality.BINS), quality.BINS - 1) for v in x]
        assert at[i + 1] - at[i] == len(set(words))


def test_packing(spark, corpus, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    df, rows = corpus
    df = df.select("doc_id", "text").unionAll(spark.createDataFrame([(500, "word " * 5000), (501, "\x01 a\x01b \x1c c <|endoftext|>")], "doc_id long, text string"))
    texts = {r[0]: r[1] or "" for r in rows} | {500: "word " * 5000, 501: "\x01 a\x01b \x1c c <|endoftext|>"}
    got = packing.pack_documents(df).collect()
    parts, bins = defaultdict(list), defaultdict(list)
    for r in got:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        own = ids[r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and r.length == len(own) and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        parts[r.doc_id].append(r.piece)
        bins[r.sequence_id].append((r.offset, r.length))
    assert len(got) == len(rows) + 1 + -(-5001 // 2048) and set(parts) == set(texts)
    for b in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(b)])]
        assert [o for o, _ in sorted(b)] == ends[:-1] and ends[-1] <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def test_genetic_packing_beats_its_start():
    sizes = [7, 7, 7, 5, 5, 5, 5, 4, 4, 4, 3, 3, 3, 3] * 6
    bins = packing.evolve(sizes, 1, 10, generations=200)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 10 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 10) + 2


def test_language_id(spark, empty):
    docs = spark.createDataFrame([(i, "the river and the lamp were there" if i % 2 else "der fluss und die lampe waren dort", "en" if i % 2 else "de") for i in range(40)] + [(90, None, "en"), (91, "texts without label", None)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    ask = spark.createDataFrame([(1, "the lamps"), (2, "die flüsse"), (3, None), (4, " 12 !"), (5, ""), (6, "x" * 30000)], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(ask, model).collect()}
    assert got[1].lang_pred == "en" and got[2].lang_pred == "de" and got[6].lang_pred in ("en", "de")
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(ask, language_id.fit(empty)).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(empty.select("doc_id", "text"), model).count() == 0
    twice = ask.unionAll(ask).selectExpr("*", "'x' AS lang_pred", "7 AS score", "8 AS n")
    assert sorted((r.doc_id, r.lang_pred, r.score, r.n) for r in language_id.identify(twice, model).collect()) == sorted((i, r.lang_pred, r.score, 8) for i, r in got.items() for _ in (0, 1))


def test_language_id_by_hand(spark):
    """Posteriors against a plain version: known words, words known by n-grams of each length, and unknown ones."""
    rows = [(1, "la casa roja de casa"), (2, "el rio verde"), (3, "the red house"), (4, "a green river the house")]
    docs = spark.createDataFrame([(i, t, "es" if i < 3 else "en") for i, t in rows], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    grams = lambda w, n: [f"\x02{w}\x03"[i : i + n] for i in range(len(w) + 3 - n)]
    count = {x: {k: Counter() for k in range(5)} for x in ("en", "es")}
    for i, t in rows:
        for w in t.split():
            own = count["es" if i < 3 else "en"]
            own[0][w] += 1
            for k in range(1, 5):
                own[k].update(grams(w, k))
    chance = lambda x, k, g: math.log((count[x][k][g] + 0.5) / (sum(count[x][k].values()) + len(count[x][k]) + 1))
    known = lambda k, g: any(count[x][k][g] for x in count)
    for text in ("the house", "casas rojas", "zzz casa", "greenish qq", "ñ", "house casa the de"):
        total = {x: math.log(0.5) for x in count}
        for w in text.split():
            for x in count:
                if known(0, w):
                    total[x] += chance(x, 0, w)
                    continue
                for k in range(4, 0, -1):
                    if own := [g for g in grams(w, k) if known(k, g)]:
                        total[x] += language_id.BACKOFF * sum(chance(x, k, g) for g in own) / len(own)
                        break
        best = max(sorted(total), key=total.get)
        want = 1 / sum(math.exp(v - total[best]) for v in total.values())
        got = model.predict(text)
        assert got[0] == best and abs(got[1] - want) < 1e-5, text


def test_language_id_learns_rare_languages(spark):
    docs = spark.createDataFrame([(i, "the river and the lamp", "en") for i in range(600)] + [(1000 + i, "jõgi ja lamp olid seal", "et") for i in range(3)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, fit_rows=20)
    assert model.langs == ["en", "et"] and model.predict("jõgi olid")[0] == "et" and "the" in model.word
