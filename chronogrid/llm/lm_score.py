"""Language-model scoring by a hashed maximum-entropy model.

A token's class is a leaf of a tree of LEVELS softmaxes, each over WIDTH branches: the first branch comes
from a word's last two bytes, the others from its hash, so that 65,536 leaves tell tokens apart and the
history chooses among them.  Every softmax adds up weights found by hashing n-gram and skip features of the
history together with the node.  Within a leaf a token has its share of the leaf's training tokens.
A token that training doesn't have gets the Good-Turing mass of the unseen, spread over all spellings by a
letter-pair model.  So the chances of all tokens add up to 1 at most after any history:

    P(seen token | history) = (1 - unseen) * product of P(branch | node, history) * n(token) / n(leaf)
    P(unseen token) = unseen * product of P(letter | letter before)

Counts cover all training tokens and stay distributed.  Workers hold a bounded cache of frequent tokens'
counts; what a document has beyond it is joined, with the same result.  Weights are trained in rounds that
take every training document once: tasks update a copy on their share of the documents, and the changes
are averaged row by row.  The weight tables grow with the training tokens up to MOST_ROWS.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, crc_bucket, documents, stage
from .shingles import _LOWER, column_bytes, mix, word_hashes

_U = np.uint64
#: Most tokens in the workers' cache of counts, and the least count there; rounds, over which all training documents are dealt.
CACHE, CACHE_COUNT, ROUNDS, RATE = 1 << 18, 3, 3, 0.15
#: Levels of the tree and branches of a node.
LEVELS, WIDTH, BITS = 4, 16, 4
#: Rows of a level's weight table: one for each TOKENS_A_ROW training tokens, within bounds; features of a history.
TOKENS_A_ROW, LEAST_ROWS, MOST_ROWS, FEATURES = 16384, 1 << 13, 1 << 17, 3
#: Training tokens that a task takes at least, for each row of a table: what tasks send on stays a fraction of what they read.
TASK_TOKENS = 256
#: Bound of a weight, so that sums of FEATURES of them can't overflow.
MOST_WEIGHT = 10.0
#: Tokens of a gradient step, for each row of a table, and those scored at a time.
_STEP, _CHUNK = 1, 1 << 14
_LETTERS = 257
#: Fixed value: the closing token.
_END = _U(0x1F83D9ABFB41BD00) | _U(7)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, offsets by text, first bytes, ends, lower-case bytes) of each text's words and a closing token, which has no bytes.

    The low bits of a word's hash come from its last two bytes.
    """
    h, starts, ends, at = word_hashes(data, offsets)
    n, docs = len(h), len(offsets) - 1
    low = _LOWER[data]
    last = low[ends - 1].astype(_U) if n else np.zeros(0, _U)
    before = np.where(ends - starts >= 2, low[np.maximum(ends - 2, 0)], 0).astype(_U) if n else last
    own = (h & ~_U(WIDTH - 1)) | (mix(last * _U(257) + before) & _U(WIDTH - 1))
    out, first, end = np.empty(n + docs, _U), np.zeros(n + docs, np.int64), np.zeros(n + docs, np.int64)
    to = at + np.arange(docs + 1)
    words = np.arange(n) + np.repeat(np.arange(docs), np.diff(at))
    out[words], first[words], end[words] = own, starts, ends
    out[to[1:] - 1] = _END
    return out.view(np.int64), to, first, end, low


def letter_pairs(low: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Counts (letter before, letter) over words; 256 stands before the first letter and after the last."""
    some = end > first
    first, end = first[some], end[some]
    size = end - first
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    here = low[at].astype(np.int64)
    before = np.concatenate([[256], here[:-1]])[: len(here)]
    before[np.cumsum(size) - size] = 256
    pairs = np.bincount(before * _LETTERS + here, minlength=_LETTERS * _LETTERS)
    return pairs + np.bincount(low[end - 1].astype(np.int64) * _LETTERS + 256, minlength=_LETTERS * _LETTERS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n) of tokens, and as ``pair`` the letter pairs of each batch's distinct words."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = np.zeros(_LETTERS * _LETTERS, np.int64)

    def merged() -> tuple[np.ndarray, np.ndarray]:
        h, n = np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
        found, inverse = np.unique(h, return_inverse=True)
        return found, np.bincount(inverse, n, len(found)).astype(np.int64)

    def batch(h: np.ndarray, n: np.ndarray, pair: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), pair)), pa.array(h), pa.array(n)], names=["pair", "h", "n"])

    for part in by_bytes(batches, "text", 2 << 20):
        h, _, first, end, low = tokens(*column_bytes(part.column("text")))
        found, at, n = np.unique(h, return_index=True, return_counts=True)
        pairs += letter_pairs(low, first[at], end[at])
        held.append((found, n))
        if len(held) >= 8:
            held = [merged()]
            if len(held[0][0]) > 1_000_000:
                yield batch(*held.pop(), False)
    if held:
        yield batch(*merged(), False)
    some = np.flatnonzero(pairs)
    yield batch(some, pairs[some], True)


class Weights:
    """The model: leaves' counts, the weight tables, letter chances, and the cache of frequent tokens' counts."""

    def __init__(self, leaf_n: np.ndarray, once: int, types: int, pairs: np.ndarray, cache: np.ndarray | None = None, cache_n: np.ndarray | None = None):
        self.total, self.types = int(leaf_n.sum()), types
        self.unseen = (once + 0.5) / (self.total + 1)
        # By (first branch, second, ...): the low bits of a hash are the first branch.
        self.leaf_n = leaf_n.reshape((WIDTH,) * LEVELS).transpose().reshape(-1)
        mass = self.leaf_n + 0.05
        self.bias = []
        for level in range(LEVELS):
            own = mass.reshape(WIDTH**level, WIDTH, -1).sum(axis=2)
            self.bias.append(np.log(own / own.sum(axis=1, keepdims=True)).astype(np.float32))
        rows = 1 << max(0, math.ceil(math.log2(max(self.total, 1) / TOKENS_A_ROW)))
        self.rows = min(max(rows, LEAST_ROWS), MOST_ROWS)
        self.w = [np.zeros((self.rows, WIDTH), np.float32) for _ in range(LEVELS)]
        pairs = pairs.reshape(_LETTERS, _LETTERS) + 0.5
        self.spelled = np.log10(pairs / pairs.sum(axis=1, keepdims=True)).ravel()
        cache = np.zeros(0, np.int64) if cache is None else cache
        order = np.argsort(cache)
        self.cache, self.cache_n = cache[order], (np.zeros(0) if cache_n is None else cache_n)[order]

    def cached(self, h: np.ndarray) -> np.ndarray:
        """Place in the cache, or -1."""
        if not len(self.cache):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.cache, h), len(self.cache) - 1)
        return np.where(self.cache[at] == h, at, -1)

    def spell(self, low: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log10 chance of each word's spelling."""
        before = np.concatenate([[256], low[:-1]])[: len(low)].astype(np.int64)
        some = np.flatnonzero(end > first)
        before[first[some]] = 256
        total = np.concatenate([[0.0], np.cumsum(self.spelled[before * _LETTERS + low])])
        out = total[end] - total[first]
        last = np.full(len(first), 256)
        last[some] = low[end[some] - 1]
        return out + self.spelled[last * _LETTERS + 256]

    @staticmethod
    def features(h: np.ndarray, to: np.ndarray) -> np.ndarray:
        """(tokens, FEATURES) hashes of the last token, the last two, and the second last alone."""
        code = h.view(_U)
        place = np.arange(len(h)) - np.repeat(to[:-1], np.diff(to))
        back = [np.where(place >= k, np.concatenate([np.zeros(k, _U), code[:-k]])[: len(code)], _U(k)) for k in (1, 2)]
        with np.errstate(over="ignore"):
            one, two = (b * m for b, m in zip(back, (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))))
            return np.stack([mix(one), mix(one ^ (two + _U(1))), mix(two + _U(2))], axis=1)

    def paths(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, node, branch) along the tokens' paths."""
        node, code = np.zeros(len(h), np.int64), h.view(_U)
        for level in range(LEVELS):
            branch = ((code >> _U(BITS * level)) & _U(WIDTH - 1)).astype(np.int64)
            yield level, node, branch
            node = node * WIDTH + branch

    def leaves(self, h: np.ndarray) -> np.ndarray:
        *_, (_, node, branch) = self.paths(h)
        return node * WIDTH + branch

    def places(self, f: np.ndarray, level: int, node: np.ndarray) -> np.ndarray:
        """Rows of the level's table."""
        with np.errstate(over="ignore"):
            x = (f ^ (node.astype(_U) + _U(level << 32))[:, None]) * _U(0xD6E8FEB86659FD93)
        return ((x >> _U(40)) & _U(self.rows - 1)).astype(np.int64)

    def chances(self, level: int, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(tokens, WIDTH): P(branch | node, history)."""
        w, x = self.w[level], self.bias[level].take(node, axis=0)
        for k in range(FEATURES):
            x += w.take(rows[:, k], axis=0)
        np.exp(x, out=x)
        x /= (x @ np.ones(WIDTH, np.float32))[:, None]
        return x

    def tree_log10(self, h: np.ndarray, to: np.ndarray) -> np.ndarray:
        """log10 P(leaf | history) of every token."""
        f, out = self.features(h, to), np.zeros(len(h))
        for a in range(0, len(h), _CHUNK):
            b = min(a + _CHUNK, len(h))
            i = np.arange(b - a)
            for level, node, branch in self.paths(h[a:b]):
                out[a:b] += np.log10(self.chances(level, node, self.places(f[a:b], level, node))[i, branch])
        return out

    def learn(self, h: np.ndarray, to: np.ndarray, squares: list[np.ndarray], used: list[np.ndarray], rate: float) -> None:
        """Gradient steps on the tokens, scaled by each weight's own past (AdaGrad)."""
        f = self.features(h, to)
        chunk = max(_CHUNK, _STEP * self.rows)
        for a in range(0, len(h), chunk):
            part = f[a : a + chunk]
            i = np.arange(len(part))
            for level, node, branch in self.paths(h[a : a + chunk]):
                rows = self.places(part, level, node)
                g = self.chances(level, node, rows)
                g[i, branch] -= 1
                # Sums of the gradients by row, a branch at a time; rows that weren't used get 0 and stay.
                flat, g = rows.ravel(order="F"), g.T.astype(np.float64)
                step = np.array([np.bincount(flat, np.concatenate([own] * FEATURES), self.rows) for own in g]).T.astype(np.float32, order="C")
                squares[level] += step * step
                step *= np.float32(-rate)
                step /= np.sqrt(squares[level]) + np.float32(1)
                step += self.w[level]
                np.clip(step, -MOST_WEIGHT, MOST_WEIGHT, out=self.w[level])
                used[level] += np.bincount(flat, minlength=self.rows)


def _round(model, rate: float):
    schema = pa.schema([("level", pa.int32()), ("row", pa.int32()), ("used", pa.float64()), ("step", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = model.value
        own = object.__new__(Weights)
        own.__dict__ = dict(shared.__dict__)
        own.w = [w.copy() for w in shared.w]
        squares, used = [np.zeros(w.shape, np.float32) for w in own.w], [np.zeros(len(w)) for w in own.w]
        for part in by_bytes(batches, "text", 1 << 20):
            h, to, *_ = tokens(*column_bytes(part.column("text")))
            own.learn(h, to, squares, used, rate)
        for level, (w, was) in enumerate(zip(own.w, shared.w)):
            rows = np.flatnonzero(used[level])
            for a in range(0, len(rows), 8192):
                r = rows[a : a + 8192]
                step = (w[r] - was[r]) * used[level][r, None].astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), level, np.int32)), pa.array(r.astype(np.int32)), pa.array(used[level][r]), pa.ListArray.from_arrays(np.arange(len(r) + 1, dtype=np.int32) * WIDTH, step.ravel())], schema=schema)

    return run


def count_tokens(df: DataFrame) -> DataFrame:
    """(pair, h, n): how often each token, and with ``pair`` each pair of letters, occurs in the column ``text``; stored."""
    return stage(df.select("text").mapInArrow(_count, "pair boolean, h long, n long").groupBy("pair", "h").agg(F.sum("n").alias("n")), "counts")


def fit(train: DataFrame, counted: DataFrame) -> Weights:
    """The model of ``train`` (columns text, part: a hash that deals documents over the rounds)."""
    spark = train.sparkSession
    counts = counted.where("NOT pair")
    leaf_n, once, types = np.zeros(WIDTH**LEVELS), 0, 0
    for r in counts.groupBy(F.pmod("h", F.lit(WIDTH**LEVELS)).alias("b")).agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once"), F.count(F.lit(1)).alias("types")).toArrow().to_batches():
        b, n, o, t = (np.asarray(c) for c in r.columns)
        leaf_n[b] = n
        once, types = once + int(o.sum()), types + int(t.sum())
    pairs = np.zeros(_LETTERS * _LETTERS)
    for r in counted.where("pair").select("h", "n").toArrow().to_batches():
        pairs[np.asarray(r.column(0))] = np.asarray(r.column(1))
    # The cache is what occurs often enough for at most CACHE tokens to qualify: found on a histogram of about a thousand
    # rows, so that no task sends the driver more than its share.
    step = F.when(F.col("n") < 256, F.col("n")).otherwise(F.floor(F.log2("n") * 16) + 128)
    room, least = CACHE, None
    for r in sorted(counts.where(F.col("n") >= CACHE_COUNT).groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect(), key=lambda r: -r.b):
        room -= r.k
        if room < 0:
            break
        least = r.n
    top = (counts.where(F.col("n") >= least) if least else counts.where("false")).select("h", "n").toArrow()
    model = Weights(leaf_n, once, types, pairs, top.column("h").to_numpy().astype(np.int64), top.column("n").to_numpy().astype(np.float64))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(model.total / ROUNDS / (TASK_TOKENS * model.rows)))
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        part = train.where(F.pmod("part", F.lit(ROUNDS)) == k).select("text").coalesce(tasks)
        steps = part.mapInArrow(_round(shared, RATE), "level int, row int, used double, step array<float>")
        cells = [F.sum(F.col("step")[i]).cast("float").alias(f"s{i}") for i in range(WIDTH)]
        # Averages of the tasks' changes, weighted by use: at most LEVELS * MOST_ROWS rows.
        for b in steps.groupBy("level", "row").agg(F.sum("used").alias("used"), *cells).toArrow().to_batches():
            level, row, used, *change = (np.asarray(c) for c in b.columns)
            change = np.stack(change, axis=1) / used[:, None]
            for x in range(LEVELS):
                model.w[x][row[level == x]] += change[level == x].astype(np.float32)
        shared.unpersist()
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        seen_log = math.log10(1 - own.unseen)
        for part in by_bytes(batches, "text", 1 << 20):
            h, to, first, end, low = tokens(*column_bytes(part.column("text")))
            at = own.cached(h)
            head = at >= 0
            # What a token adds when it is seen, but for its own count.
            seen = own.tree_log10(h, to) + seen_log - np.log10(np.maximum(own.leaf_n[own.leaves(h)], 1))
            base, score = np.zeros(len(h)), np.zeros(len(h))
            base[head] = np.log10(own.cache_n[at[head]] + 0.5)
            score[head] = seen[head] + np.log10(own.cache_n[at[head]])
            rest = np.flatnonzero(~head)
            doc, rare = np.repeat(np.arange(len(to) - 1), np.diff(to))[rest], h[rest]
            order = np.lexsort((rare, doc))
            doc, rare, rest = doc[order], rare[order], rest[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])])) if len(doc) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(doc))).astype(np.int32)
            spelled = own.spell(low, first, end)[rest[new]].astype(np.float32)
            added = np.add.reduceat(seen[rest], new).astype(np.float32) if len(new) else np.zeros(0, np.float32)
            offsets = pa.array(np.searchsorted(doc[new], np.arange(len(to))).astype(np.int32))
            sums = [np.add.reduceat(x, to[:-1]) for x in (base, score, head.astype(np.int64))]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (rare[new], times, added, spelled)]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(to)), *(pa.array(s) for s in sums), *lists], names=["row", "doc_id", "held_out", "n_tokens", "base", "score", "known", "rare", "times", "seen", "spelled"])

    return run


def apply(own: DataFrame, counted: DataFrame, model: Weights) -> DataFrame:
    """Scores of ``own`` (doc_id, held_out, text) by the model and the counts that it was fitted on."""
    shared = own.sparkSession.sparkContext.broadcast(model)
    scored = own.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_score(shared), "row long, doc_id long, held_out boolean, n_tokens long, base double, score double, known long, rare array<bigint>, times array<int>, seen array<float>, spelled array<float>")
    scored = stage(scored, "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times", "seen", "spelled")).alias("x")).select("row", F.col("x.rare").alias("h"), "x.times", "x.seen", "x.spelled").join(counted.where("NOT pair").select("h", "n"), "h", "left")
    log = F.when(F.col("n").isNull(), F.col("times") * (F.lit(math.log10(model.unseen)) + F.col("spelled"))).otherwise(F.col("seen") + F.col("times") * F.log10("n"))
    tail = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_base"), F.sum(log).alias("tail_score"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scored.drop("rare", "times", "seen", "spelled").join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + zero("tail_known")).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail_base") - F.col("n_tokens") * F.log10(F.lit(model.total + 0.5 * (model.types + 1)))).alias("base_score"),
        (F.col("score") + zero("tail_score")).alias("score"),
    )


def lm_score(df: DataFrame, train: str = "train", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` names a boolean column: the rows to learn from.  Null and empty texts are the closing
    token alone; repeated rows repeat, and count as often in training; with nothing to learn from
    every token is an unseen one; an empty table gives an empty result; extra columns are not read.
    """
    own = df.select(F.col(doc_id).cast("long").alias("doc_id"), (~F.col(train)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    learn = own.where("NOT held_out").select("text", F.xxhash64("doc_id", F.length("text")).alias("part"))
    counted = count_tokens(learn)
    return apply(own, counted, fit(learn, counted))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lm_score(docs.withColumn("train", crc_bucket("doc_id", 5) != 1))
