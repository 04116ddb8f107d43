"""MinHash near-dedup with sequential Bayesian verification.

Banded signatures name candidates.  A candidate pair's signatures are compared a batch at a time and
the pair is dropped as soon as the posterior chance that its similarity reaches the threshold is under
the miss probability; survivors are verified exactly on their full shingle sets.

Documents of one shingle set are a class and take part once.  In a bucket every class is compared
with the bucket's hubs, not with every other.  Once the components of those links are known, classes of
a bucket outside its main component meet more hubs, and what is apart even then is compared with every
class it shares a band with, in blocks of bounded size that send on nothing but links; so no pair of a
bucket that could still join two components is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, documents, give_back, spread_join, stage
from .components import components
from .shingles import column_bytes, shingle_sets

#: 32 bands of 4: a pair at similarity 0.8 shares no band with chance (1 - 0.8 ** 4) ** 32 < 5e-8.
BANDS, ROWS = 32, 4
#: Hashes compared at a time, and the chance of dropping a pair that is similar enough.
BATCH, MISS = 32, 1e-9
#: Orders in which bands choose their hubs.
_HUB_SALTS = (0x0, 0x2545F4914F6CDD1D)
_MORE_SALTS = (0x1B873593CC9E2D51, 0x38B34AE5A1E38B93, 0x4CF5AD432745937F)
#: Classes of a block in the last comparison.
BLOCK = 512
_NODE = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sig", pa.binary())])


@lru_cache(maxsize=1)
def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash signatures, 32 bits a hash, of the nonempty sets given by sorted values and offsets."""
    a, b = _hash_family()
    out = np.empty((len(at) - 1, len(a)), "<u4")
    with np.errstate(over="ignore"):
        for i in range(len(a)):
            out[:, i] = np.minimum.reduceat((values * a[i] + b[i]) >> np.uint64(32), at[:-1])
    return out


def _sets(part: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*column_bytes(part.column("__text")), words)


def _set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _nodes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "__text", 1 << 19):
            values, at = _sets(part, words)
            n = np.diff(at)
            some = np.flatnonzero(n)
            sig: list[bytes | None] = [None] * len(n)
            key: list[bytes | None] = [None] * len(n)
            if len(some):
                own = signatures(values, np.append(at[some], len(values)))
                for i, row in zip(some, own):
                    sig[i], key[i] = row.tobytes(), _set_key(values[at[i] : at[i + 1]])
            yield pa.RecordBatch.from_arrays([part.column("__doc"), part.column("__row"), pa.array(n), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], schema=_NODE)

    return run


def least_matches(n: int, percent: int = 80, miss: float = MISS) -> int:
    """The fewest agreeing hashes of ``n`` with which P(similarity >= threshold) isn't under ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail at s is the chance
    of at most m successes in n + 1 trials of chance s.
    """
    s, tail = percent / 100, 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n + 1


def _prune(percent: int):
    size = BANDS * ROWS
    cuts = [(k, least_matches(k, percent)) for k in range(BATCH, size + 1, BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(column_bytes(part.column(c))[0], "<u4").reshape(-1, size) for c in ("sa", "sb"))
                alive, agree = np.arange(len(x)), np.zeros(len(x), np.int64)
                for k, cut in cuts:
                    agree[alive] += (x[alive, k - BATCH : k] == y[alive, k - BATCH : k]).sum(axis=1)
                    alive = alive[agree[alive] >= cut]
                yield pa.RecordBatch.from_arrays([part.column("a").take(pa.array(alive)), part.column("b").take(pa.array(alive))], names=["a", "b"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("ga"), batch.column("gb"))):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both >= percent * (len(u) + len(v) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return run


def _blocks(percent: int):
    """Links between the classes of two blocks of a family that share a band and are of different components so far."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    size = BANDS * ROWS
    cuts = [(k, least_matches(k, percent)) for k in range(BATCH, size + 1, BATCH)]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list[int], list[int]] = ([], [])
        if left.num_rows and right.num_rows:
            a, b, ra, rb = left["cid"].to_numpy(), right["cid"].to_numpy(), left["root"].to_numpy(), right["root"].to_numpy()
            x, y = (np.frombuffer(b"".join(t["sig"].to_pylist()), "<u4").reshape(-1, size) for t in (left, right))
            u, v = ([np.frombuffer(g, np.uint64) for g in t["grams"].to_pylist()] for t in (left, right))
            bands = y.reshape(len(y), BANDS, ROWS)
            for i in range(len(a)):
                alive = np.flatnonzero((rb != ra[i]) & (bands == x[i].reshape(1, BANDS, ROWS)).all(axis=2).any(axis=1))
                agree = np.zeros(len(b), np.int64)
                for k, cut in cuts:
                    agree[alive] += (y[alive, k - BATCH : k] == x[i, k - BATCH : k]).sum(axis=1)
                    alive = alive[agree[alive] >= cut]
                for j in alive.tolist():
                    both = len(np.intersect1d(u[i], v[j], assume_unique=True))
                    if 100 * both >= percent * (len(u[i]) + len(v[j]) - both):
                        out[0].append(a[i])
                        out[1].append(b[j])
        give_back()
        return pa.table([pa.array(o, pa.int64()) for o in out], schema=schema)

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "__text", 1 << 19):
            values, at = _sets(part, words)
            cid, grams = [], []
            for i, (c, key) in enumerate(zip(part.column("cid").to_pylist(), part.column("key").to_pylist())):
                own = values[at[i] : at[i + 1]]
                if _set_key(own) == key:  # another row of that doc_id may have another text
                    cid.append(c)
                    grams.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(grams, pa.binary())], names=["cid", "grams"])

    return run


def near_dedup(df: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", row: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept; with ``row``, a long column, also row and group.

    Texts link when their ``words``-word shingle sets have a Jaccard similarity of ``percent`` % or
    more.  Null, empty and blank texts have no shingles and link with nothing; repeated rows are one
    class; component_id is the smallest non-null doc_id of the component; an empty table gives an
    empty result; extra columns are not read.  group numbers the components, null for texts without shingles.
    """
    own = df.select((F.col(row) if row else F.lit(None).cast("long")).alias("__row"), F.col(doc_id).cast("long").alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    nodes = stage(own.mapInArrow(_nodes(words), "doc_id long, row long, n_shingles long, key binary, sig binary"), "nodes")
    classes = nodes.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    in_bands = BANDS * classes.count()
    salts = F.array(*[F.lit(s) for s in _HUB_SALTS])
    bands = classes.select("cid", F.explode(F.array(*[F.struct(F.xxhash64(F.substring("sig", 1 + 4 * ROWS * b, 4 * ROWS), F.lit(b)).alias("bucket"), F.lit(b % len(_HUB_SALTS)).alias("kind")) for b in range(BANDS)])).alias("x")).select("cid", "x.bucket", "x.kind")
    hubs = bands.groupBy("bucket", "kind").agg(F.min(F.col("cid").bitwiseXOR(F.element_at(salts, F.col("kind") + 1))).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = hubs.select("bucket", "n", F.col("least").bitwiseXOR(F.element_at(salts, F.col("kind") + 1)).alias("hub"))
    members = stage(spread_join(bands.select("cid", "bucket"), hubs, ["bucket"], in_bands), "members")

    involved = members.select("cid").distinct()
    need = involved.join(classes.select("cid", "key", "rep"), "cid")
    grams = stage(own.join(need, F.col("__doc").eqNullSafe(F.col("rep"))).select("cid", "key", "__text").mapInArrow(_full_sets(words), "cid long, grams binary").dropDuplicates(["cid"]), "grams")

    def verified(pairs: DataFrame) -> DataFrame:
        sig = classes.select("cid", "sig")
        with_sigs = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
        alive = with_sigs.mapInArrow(_prune(percent), "a long, b long")
        return alive.join(grams.toDF("a", "ga"), "a").join(grams.toDF("b", "gb"), "b").mapInArrow(_confirm(percent), "a long, b long")

    first = members.where("cid <> hub").select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()
    links = stage(verified(first), "links")
    roots = stage(components(links), "roots")

    def mixed() -> DataFrame:
        """Members of buckets of several components, with their roots and their buckets' main components."""
        rooted = members.select("bucket", "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("bucket", "cid", F.coalesce("root", "cid").alias("root"))
        main = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket", "n", F.col("m.root").alias("main"))
        return stage(spread_join(rooted, main, ["bucket"], in_bands), "mixed")

    # What no hub has linked is compared with more members of its buckets' main components,
    now = mixed()
    more_hubs = now.where("root = main").groupBy("bucket").agg(F.array(*[F.min(F.col("cid").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)) for x in _MORE_SALTS]).alias("hubs"))
    again = now.where("root <> main").join(more_hubs, "bucket").select("cid", F.explode("hubs").alias("hub"))
    more = stage(verified(again.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()), "links")
    if not more.isEmpty():
        links = links.unionAll(more)
        roots = stage(components(links), "roots")
    # and what is still apart with every member of them, block by block.
    now = mixed()
    apart = now.where("root <> main").groupBy("bucket").agg(F.min("cid").alias("one"))
    family = components(now.select("bucket", "cid").join(apart, "bucket").select(F.col("cid").alias("a"), F.col("one").alias("b")))
    body = stage(now.groupBy("cid").agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("apart")).join(family.select(F.col("node").alias("cid"), F.col("root").alias("family")), "cid").join(classes.select("cid", "sig"), "cid").join(grams, "cid"), "family")
    size = body.groupBy("family").agg(F.max(F.lit(1)).alias("one"), (F.ceil(F.count(F.lit(1)) / BLOCK)).cast("long").alias("mb"), F.greatest(F.ceil(F.count_if("apart") / BLOCK), F.lit(1)).cast("long").alias("ib")).drop("one")
    dealt = body.join(size, "family")
    lone = dealt.where("apart").withColumn("ic", F.pmod(F.xxhash64("cid"), F.col("ib"))).withColumn("mc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)))
    all_ = dealt.withColumn("mc", F.pmod(F.xxhash64("cid"), F.col("mb"))).withColumn("ic", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ib") - 1)))
    take = ["family", "ic", "mc", "cid", "root", "sig", "grams"]
    last = stage(lone.select(take).toDF(*take).groupBy("family", "ic", "mc").cogroup(all_.select(take).toDF(*take).groupBy("family", "ic", "mc")).applyInArrow(_blocks(percent), "a long, b long"), "links")
    final = roots if last.isEmpty() else components(links.unionAll(last))
    labelled = classes.select("cid", "key", "rep").join(final.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = labelled.groupBy("root").agg(F.min("rep").alias("component"))
    by_key = labelled.join(least, "root").select("key", "component", F.col("root").alias("group"))
    out = nodes.select("doc_id", "row", "n_shingles", "key").join(by_key, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *(["row", "group"] if row else []))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), words=4)
