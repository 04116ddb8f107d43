"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is a naive Bayes log-odds of binned text statistics and one of hashed words,
weighed by a logistic curve.  It is combined with the posteriors of its host and of the path under it.
Site rates are grouped sums over all documents: a labelled one counts by its label, any other by the
document classifier's probability.  Each level is shrunk toward the one above by a prior strength
estimated from the spread of the sites' own rates, so sparse sites follow the global prior.

The texts are read once for scores and never shuffled; what is grouped and joined are rows of a few numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, documents, spread_join, stage
from .shingles import column_bytes, word_hashes

#: Labelled documents the document classifier is fitted on, about (a hash sample of the labels where there are more);
#: equal-width bins of each statistic; buckets of hashed words.
FIT_ROWS, BINS, BUCKETS = 50_000, 12, 1 << 12
#: Bytes of text that a worker takes at a time.
SLICE = 1 << 19
#: Probability of good quality under which a document is rejected; how much a site can move a document's log-odds.
REJECT, SITE_WEIGHT = 0.4, 0.5
STATISTICS = ("symbols", "capitals", "digits", "stops", "distinct", "word_length", "length")
RESULT = ("evidence", "host_rate", "path_rate", "quality_score", "accepted")


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOLS, _STOPS = _class("#$%&*!|<>{}[]~^=+\\/@_"), _class(".,;:?")
_CAPITALS, _DIGITS = _class("".join(map(chr, range(65, 91)))), _class("0123456789")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the bin of every statistic (texts, statistics), and the buckets of its distinct words
    with the offsets by text."""

    def count(inside: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(inside)])[offsets]).astype(float)

    h, _, _, at = word_hashes(data, offsets)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])[: len(h)]
    h, owner = h[new], owner[new]
    distinct = np.searchsorted(owner, np.arange(len(at)))
    chars = np.maximum(count((data & 0xC0) != 0x80), 1)
    words = np.maximum(np.diff(at), 1)
    x = np.stack(
        [
            count(_SYMBOLS[data]) / chars * 4,
            count(_CAPITALS[data]) / chars,
            count(_DIGITS[data]) / chars * 2,
            count(_STOPS[data]) / words * 2,
            np.diff(distinct) / words,
            chars / words / 24,
            np.log(chars) / 14,
        ],
        axis=1,
    )
    return np.clip(np.floor(x * BINS), 0, BINS - 1).astype(np.int64), (h & np.uint64(BUCKETS - 1)).astype(np.int64), distinct


class Evidence:
    """Log-odds of good quality for every bin and word bucket, and the curve that weighs their two sums."""

    def __init__(self, prior: float, bins: np.ndarray, words: np.ndarray, curve: tuple[float, float, float] = (0.0, 0.0, 0.0)):
        self.prior, self.bins, self.words, self.curve = prior, bins, words, curve

    def sums(self, texts: pa.Array) -> np.ndarray:
        """(texts, 2): the sum over statistics and the mean over distinct words."""
        b, w, at = features(*column_bytes(texts))
        mean = np.diff(np.concatenate([[0.0], np.cumsum(self.words[w])])[at]) / np.maximum(np.diff(at), 1)
        return np.stack([self.bins[np.arange(len(STATISTICS)), b].sum(axis=1), mean], axis=1)

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        a, b, c = self.curve
        return self.sums(texts) @ np.array([a, b]) + c


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic weights of two sums and a constant, by Newton steps with a small ridge that keeps signs sound."""
    if not len(y):
        return 0.0, 0.0, 0.0
    design, w = np.column_stack([x, np.ones(len(x))]), np.zeros(3)
    ridge = np.diag([1.0, 1.0, 1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design + ridge, design.T @ (p - y) + ridge @ w)
        w = w - step / max(1.0, np.abs(step).max() / 2)
    return float(w[0]), float(w[1]), float(w[2])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label have each bin and each word bucket."""
    size = len(STATISTICS) * BINS + BUCKETS
    n = np.zeros((2, size), np.int64)
    for part in by_bytes(batches, "text", SLICE):
        y = np.asarray(part.column("y")).astype(np.int64)
        b, w, at = features(*column_bytes(part.column("text")))
        for k in range(len(STATISTICS)):
            np.add.at(n, (y, k * BINS + b[:, k]), 1)
        owner = np.repeat(np.arange(len(y)), np.diff(at))
        pairs = np.unique(owner * BUCKETS + w)  # a text counts once in a bucket
        np.add.at(n, (y[pairs // BUCKETS], len(STATISTICS) * BINS + pairs % BUCKETS), 1)
    i, j = np.nonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[i, j])], names=["y", "cell", "n"])


def _sums(model: Evidence):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", SLICE):
            x = model.sums(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["key", "y", "s", "w"])

    return run


def one_label(labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """(key, y) of each labelled id: 1 where any label is over 0; null labels and ids teach nothing."""
    return labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))


def fit(docs: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id", fit_rows: int = FIT_ROWS) -> Evidence:
    """A document classifier of ``docs`` and the labels ``known`` (key, y).

    About ``fit_rows`` labels at most are taken, before any text is looked at, and broadcast.  Half of their
    documents give the frequencies, the other half the curve.  Without either label there is no evidence but
    the prior.
    """
    share = min(1.0, fit_rows / max(known.count(), 1))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("key", F.lit("quality")), F.lit(1_000_000)) < int(share * 1_000_000))
    own = docs.select(F.col(doc_id).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), "key")
    own = stage(own.select("key", "y", "text"), "fit")
    half = F.pmod(F.xxhash64("key", F.lit("half")), F.lit(2))
    n = np.zeros((2, len(STATISTICS) * BINS + BUCKETS))
    for r in own.where(half == 0).select("y", "text").mapInArrow(_cells, "y int, cell int, n long").groupBy("y", "cell").agg(F.sum("n").alias("n")).collect():
        n[r.y, r.cell] = r.n
    total = n[:, :BINS].sum(axis=1)
    # Class-conditional rates, so that the share of good labels enters once, through the curve.
    bins = n[:, : len(STATISTICS) * BINS].reshape(2, len(STATISTICS), BINS)
    rate = np.log((bins + 0.5) / (total[:, None, None] + 0.5 * BINS))
    words = np.log((n[:, len(STATISTICS) * BINS :] + 1) / (total[:, None] + 2))
    model = Evidence(0.0, rate[1] - rate[0], words[1] - words[0])
    # One row an id, so that a bounded number comes to the driver however often documents repeat.
    rows = own.where(half == 1).mapInArrow(_sums(model), "key long, y int, s double, w double").groupBy("key").agg(F.min(F.struct("y", "s", "w")).alias("x")).select("x.*").toPandas()
    y = rows["y"].to_numpy(float)
    if min(total) == 0:
        good, all_ = total[1] + y.sum(), total.sum() + len(y)
        return Evidence(0.0, bins[0] * 0, words[0] * 0, (0.0, 0.0, math.log((good + 1) / (all_ - good + 1))))
    model.curve = _curve(rows[["s", "w"]].to_numpy(float), y)
    return model


def _strength(rates: DataFrame) -> float:
    """Prior strength of a level by the method of moments: mean (1 - mean) / between-site variance - 1."""
    r = rates.where("n >= 5").agg(F.sum("good").alias("g"), F.sum("n").alias("n"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("q"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2")).first()
    return strength(r.g, r.n, r.q, r.k, r.n2)


def strength(g: float | None, n: int | None, q: float | None, k: int, n2: float | None) -> float:
    """From sums over sites: good, n, good ** 2 / n, 1, n ** 2."""
    if not k or k < 2 or not n:
        return 100.0
    m = g / n
    within = m * (1 - m)
    between = (q - n * m * m - (k - 1) * within) / max(n - n2 / n, 1e-9)
    return min(max(within / between - 1, 2.0), 10_000.0) if between > 1e-12 else 10_000.0


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], text: str = "text", doc_id: str = "doc_id", host: Column | None = None, path: Column | None = None) -> DataFrame:
    """(row, evidence, host_rate, path_rate, quality_score, accepted): a row for each of ``docs``.

    ``row`` is a struct of the columns ``keep``, so that no name of theirs can clash.  Null text counts as
    empty, a null host or path as the site ''.
    """
    known = stage(one_label(labels), "labels")
    model = fit(docs, known, text, doc_id)
    shape = T.StructType([docs.schema[c] for c in keep])
    site = lambda c: F.coalesce(c.cast("string"), F.lit("")) if c is not None else F.lit("")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(doc_id).cast("long").alias("key"), site(host).alias("host"), site(path).alias("path"), *([] if text in keep else [F.col(text).cast("string").alias("text")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The text goes to a worker once, by itself or in its row.
            texts = batch.column("row").field(keep.index(text)) if text in keep else batch.column("text")
            whole = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "key", "host", "path")), texts], names=["row", "key", "host", "path", "text"])
            for part in by_bytes([whole], "text", SLICE):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "key", "host", "path")), pa.array(model.log_odds(part.column("text")))], names=["row", "key", "host", "path", "odds"])

    fields = [T.StructField("row", shape), T.StructField("key", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("odds", T.DoubleType())]
    scored = stage(own.mapInArrow(run, T.StructType(fields)), "scored")
    good = F.coalesce(F.col("y").cast("double"), 1 / (1 + F.exp(-F.col("odds"))))
    paths = stage(scored.select("key", "host", "path", "odds").join(known, "key", "left").groupBy("host", "path").agg(F.sum(good).alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = hosts.agg(F.coalesce(F.sum("good"), F.lit(0.0)).alias("g"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    base = (total.g + 1) / (total.n + 2)
    kh, kp = _strength(hosts), _strength(paths)
    rated = hosts.select("host", ((F.col("good") + kh * base) / (F.col("n") + kh)).alias("host_rate"))
    sites = paths.join(rated, "host").select("host", "path", "n", "host_rate", ((F.col("good") + kp * F.col("host_rate")) / (F.col("n") + kp)).alias("path_rate"))
    inside = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    moved = F.col("odds") + SITE_WEIGHT * (F.log(inside(F.col("path_rate")) / (1 - inside(F.col("path_rate")))) - F.lit(math.log(base / (1 - base))))
    out = spread_join(scored.withColumn("number", F.monotonically_increasing_id()), sites, ["host", "path"], total.n).withColumn("quality_score", 1 / (1 + F.exp(-moved)))
    return out.select("row", F.col("odds").alias("evidence"), "host_rate", "path_rate", "quality_score", (F.col("quality_score") >= REJECT).alias("accepted"))


def site_columns() -> tuple[Column, Column]:
    """Host and path of a document: its source up to a slash, and what follows with the language."""
    return F.substring_index("source", "/", 1), F.concat_ws("/", F.substring_index("source", "/", -1), F.col("lang"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with evidence (log-odds), host_rate, path_rate, quality_score (0 to 1) and accepted.

    Null texts count as empty ones, null sources and languages as ''; repeated rows each get the same
    scores and count as often in their sites; an empty table gives an empty result; with no labels every
    document has the prior's score.  An input column that is named like a result gives way to it.
    """
    kept = [c for c in docs.columns if c not in RESULT]
    host, path = site_columns()
    return judge(docs, labels, kept, host=host, path=path).select("row.*", *RESULT)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    host, path = site_columns()
    return judge(documents(spark, sf_dir), labels, ["doc_id"], host=host, path=path).select("row.doc_id", *RESULT)
