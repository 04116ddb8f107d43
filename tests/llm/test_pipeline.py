"""run() against a plain version of each stage, and every stage over awkward rows."""

import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def shingles(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_exact(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
        if key not in best or (-len(r["text"]), r["doc_id"]) < (-len(best[key]["text"]), best[key]["doc_id"]):
            best[key] = r
    return list(best.values())


def plain_near(rows):
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    holds = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holds[g].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in holds[g] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [r for r in rows if root(r["doc_id"]) == r["doc_id"]]


def plain_cut(rows):
    raw = {r["doc_id"]: r["text"].encode() for r in rows}
    seen = Counter(b[i : i + 200] for b in raw.values() for i in range(len(b) - 199))
    out = {}
    for r in rows:
        b = raw[r["doc_id"]]
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                mark[i : i + 200] = True
        runs, at = [], 0
        while at < len(b):
            end = at
            while end < len(b) and mark[end] == mark[at]:
                end += 1
            if not mark[at]:
                runs.append(b[at:end].decode("utf-8", "ignore"))
            at = end
        keep = "".join(runs)
        if keep.strip() or not mark.any():
            out[r["doc_id"]] = keep
    return out


def test_stages_equal_the_plain_ones(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        done[name] = docs
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(done[n].columns == columns for n, _ in pipeline.STAGES[:-1])
    rows = {n: [r.asDict() for r in done[n].collect()] for n, _ in pipeline.STAGES}
    assert {r["doc_id"] for r in rows["exact_dedup"]} == {r["doc_id"] for r in plain_exact(rows["quality"])}
    assert {r["doc_id"] for r in rows["near_dedup"]} == {r["doc_id"] for r in plain_near(rows["exact_dedup"])}
    assert {r["doc_id"]: r["text"] for r in rows["suffix_dedup"]} == plain_cut(rows["near_dedup"])
    assert {r["doc_id"] for r in rows["packing"]} == {r["doc_id"] for r in rows["suffix_dedup"]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows["quality"]}
    assert np.mean([i in kept for i, q in labels.items() if q == 1]) > 0.97
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) < 0.3


#: Names that operators use for columns of their own, and those of their results.
NAMES = "accepted host_rate path_rate quality_score evidence host path odds key row number kept keep_id group_size text_sha256 group component_id n_shingles spans k copied found size __kept __spans __k __key __row __text __doc piece start length sequence_id offset ids_crc32 block salt hot n y a.b".split()


def test_stages_take_awkward_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "plain words here and there", "en", "s", 26), (3, "plain words here and there", "en", "s", 26), (None, "no id on this row at all", "en", "s", 23), (5, "wörd " * 400, "de", "s", 2000), (3, "plain words here and there again", "en", "s", 26), (9, "x" * 300_000, "en", "s", 300_000), (9, "y " * 150_000, None, None, 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    more = docs.selectExpr("*", *(f"{i} AS `{c}`" for i, c in enumerate(NAMES)))
    for name, stage in pipeline.STAGES:
        out = []
        for k, given in enumerate((docs, more)):
            stage(spark, given, SF).write.parquet(str(tmp_path / f"{name}{k}"))
            out.append(spark.read.parquet(str(tmp_path / f"{name}{k}")))
        if name != "packing":
            assert out[0].columns == docs.columns and out[1].columns == more.columns
            assert sorted(map(str, out[0].collect())) == sorted(map(str, out[1].select(docs.columns).collect()))
            assert out[1].select(*[f"`{c}`" for c in NAMES]).distinct().collect() in ([tuple(range(len(NAMES)))], [])
        if name == "quality":
            continue  # what it rejects here is its own affair
        docs, more = out
        if name == "exact_dedup":
            assert docs.count() == 7
        if name == "near_dedup":
            assert docs.count() == 7
    assert {r.doc_id for r in docs.collect()} >= {3, None}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
