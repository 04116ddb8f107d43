"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes (white space deleted), Spark's external sort
puts equals next to each other, and neighbouring rows are compared in full.  Partition and sort keys
go on below the content to the order of preference and a row's salt, so a group of copies of any
size spreads over as many partitions as its share of the rows; the runs that cross a partition's edge
are joined up afterwards from at most two rows per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, documents, shuffle_partitions, stage

#: Bytes of content that the splitters see; the driver's sample stays small however long the texts are.
SPLITTER_BYTES = 48
_OUT = pa.schema([("__doc", pa.int64()), ("__row", pa.int64()), ("__sha", pa.string()), ("__keep", pa.int64()), ("__first", pa.bool_()), ("__n", pa.int64()), ("__pid", pa.int32()), ("__edge", pa.bool_()), ("__cp", pa.int64())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition -> one row each with its run's keeper and length here.

    Only ids of the run at hand are held, never texts but the last.
    """
    pid = TaskContext.get().partitionId()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last, sha, keep, keep_cp, opened_first, any_run = None, None, None, None, True, False

    def close(edge: bool) -> pa.RecordBatch:
        docs = pa.concat_arrays([h[0] for h in held])
        rows = np.concatenate([h[1] for h in held])
        n = len(rows)
        first = np.zeros(n, bool)
        first[0] = True
        return pa.RecordBatch.from_arrays([docs, pa.array(rows), pa.array([sha] * n, pa.string()), pa.array([keep] * n, pa.int64()), pa.array(first), pa.array(np.full(n, n)), pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, edge)), pa.array(np.full(n, keep_cp))], schema=_OUT)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm, docs, cps, rows = (batch.column(k) for k in ("__norm", "__doc", "__cp", "__row"))
        rows = np.asarray(rows)
        same = np.asarray(pc.equal(norm.slice(1), norm.slice(0, n - 1))) if n > 1 else np.zeros(0, bool)
        starts = np.flatnonzero(np.concatenate([[last is None or norm[0].as_py() != last], ~same]))
        ready = []
        if not len(starts) or starts[0] > 0:
            to = starts[0] if len(starts) else n
            held.append((docs.slice(0, to), rows[:to]))
        for i, s in enumerate(starts):
            if held:
                ready.append(close(opened_first))
                opened_first = False
            held = []
            e = starts[i + 1] if i + 1 < len(starts) else n
            text = norm[s].as_py()
            sha, keep, keep_cp, any_run = hashlib.sha256(text).hexdigest(), docs[s].as_py(), cps[s].as_py(), True
            held.append((docs.slice(s, e - s), rows[s:e]))
        last = norm[n - 1].as_py()
        if ready:
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
    if any_run:
        yield close(True)


def exact_dedup(df: DataFrame, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None, row: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; with ``row``, a unique long column, that too.

    Texts are equal when identical after white space is deleted; the row with the most code points
    stays, ties to the smallest doc_id (nulls last), and among rows that repeat both exactly one stays.
    Null text counts as empty; an empty table gives an empty result; extra columns are ignored.
    """
    spark = df.sparkSession
    p = partitions or shuffle_partitions(spark)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).cast("long").alias("__doc"), F.regexp_replace(t, WHITE + "+", "").cast("binary").alias("__norm"), F.char_length(t).cast("long").alias("__cp"), (F.col(row) if row else F.monotonically_increasing_id()).alias("__row"))
    rows = rows.withColumn("__head", F.substring("__norm", 1, SPLITTER_BYTES)).withColumn("__hash", F.xxhash64("__norm"))
    order = [F.col("__head"), F.col("__hash")], [F.col("__cp").desc(), F.col("__doc").asc_nulls_last(), F.col("__row")]
    dealt = rows.repartitionByRange(p, *order[0], *order[1])
    # Within one hash the content itself comes before the preference, so that colliding texts stay apart.
    placed = dealt.sortWithinPartitions(*order[0], F.col("__norm"), *order[1]).drop("__head", "__hash")
    runs = stage(placed.mapInArrow(_runs, "__doc long, __row long, __sha string, __keep long, __first boolean, __n long, __pid int, __edge boolean, __cp long"), "exact")
    # At most two edge runs in each partition: their totals are a table of no more than 2 p rows.
    edges = runs.where("__edge AND __first").groupBy("__sha").agg(F.sum("__n").alias("__total"), F.min(F.struct(F.col("__pid"), F.col("__keep"), F.col("__row"))).alias("__best"))
    edges = edges.select(F.col("__sha").alias("__esha"), "__total", F.col("__best.__keep").alias("__best_keep"), F.col("__best.__row").alias("__best_row"))
    out = runs.join(F.broadcast(edges), (F.col("__sha") == F.col("__esha")) & F.col("__edge"), "left")
    return out.select(
        F.col("__doc").alias("doc_id"),
        F.when(F.col("__esha").isNull(), F.col("__keep")).otherwise(F.col("__best_keep")).alias("keep_id"),
        F.coalesce("__total", "__n").alias("group_size"),
        (F.col("__first") & (F.col("__esha").isNull() | (F.col("__row") == F.col("__best_row")))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
        *([F.col("__row").alias("row")] if row else []),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL_OP4 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS txt, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id FROM t
  WINDOW w AS (PARTITION BY norm ORDER BY length(txt) DESC, doc_id)
)
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY norm) AS group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""
