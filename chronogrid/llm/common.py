"""Shared plumbing: the scratch folder, whitespace classes, Arrow helpers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the contracts, as a Java and Python regex class.
WHITE = r"[\x20\x09-\x0D]"
_SCRATCH: dict[str, list[str]] = {}


@lru_cache(maxsize=8)
def _own_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="chronogrid-")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share; a folder of this machine only where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return named or _own_root(spark.sparkContext.applicationId)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage, fixes anything not deterministic, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(table: DataFrame) -> None:
    """Delete a table that ``stage`` made, once nothing reads it any more."""
    release(table.sparkSession, [table._scratch])


def made(spark: SparkSession) -> list[str]:
    """Scratch tables of this application that are still there."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch tables (all of this application's, by default); only once results that read them are written."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    own = _SCRATCH.get(spark.sparkContext.applicationId, [])
    for path in made(spark) if paths is None else paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)
        if path in own:
            own.remove(path)


#: A key is hot from one in HOT of all rows, so at most HOT keys are; salts that its rows are dealt over.
HOT, SALTS = 1000, 32


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``many`` joined with ``one``, which has one row a key and, as ``n``, how many of the ``total`` rows of ``many`` it meets.

    The rows of a hot key are dealt over SALTS tasks.  The list of hot keys, HOT at most, is broadcast.
    """
    hot = F.col("n") * HOT >= total
    salted = one.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("n")
    marked = many.join(F.broadcast(one.where(hot).select(*keys, F.lit(True).alias("hot"))), keys, "left")
    dealt = marked.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    return dealt.join(salted, [*keys, "salt"]).drop("salt")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def crc_bucket(column: str, mod: int):
    """crc32 of an id's decimal text, modulo ``mod``; null ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def crc_bucket_py(value: int | None, mod: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % mod


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that Python objects stay few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and several share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of at most ``limit`` bytes of ``column`` (one longer row goes alone).

    After the last one, memory that the task has freed is given back.
    """
    for batch in batches:
        at, n = 0, batch.num_rows
        if not n:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(size)
        while at < n:
            base = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, base + limit, side="right"))
            to = min(max(to, at + 1), at + rows, n)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def arrow_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pad(a: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([a, np.zeros(max(0, n - len(a)), a.dtype)])


def env_threads() -> None:
    """One BLAS thread in each Python worker; tasks are the parallelism."""
    for k in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(k, "1")
