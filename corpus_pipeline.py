"""Corpus preparation, stage by stage; each stage's result is stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.llm import common, exact_dedup, near_dedup, packing, quality, suffix_dedup


def _numbered(docs: DataFrame) -> DataFrame:
    """(row, number, doc_id, text): a document as a struct, so that no name of its columns can clash, and a number
    of its own; stored, so that the number holds for every reader."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return common.stage(docs.select(row, F.monotonically_increasing_id().alias("number")), "numbered").select("row", "number", "row.doc_id", "row.text")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, fitted on the labels of the same folder.

    Null texts are judged as empty ones; repeated rows stay or go together; rows are neither merged nor changed;
    an empty table gives an empty one; columns of any other name are carried along.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    host, path = quality.site_columns()
    return quality.judge(docs, labels, docs.columns, host=host, path=path).where("accepted").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest, then the smallest doc_id; one row where rows repeat.

    Null and blank texts are equal; null ids come last; an empty table gives an empty one; columns of any other
    name are carried along.
    """
    rows = _numbered(docs)
    kept = exact_dedup.exact_dedup(rows.select("text", "doc_id", "number"), row="number").where("kept").select(F.col("row").alias("number"))
    return rows.select("row", "number").join(kept, "number", "left_semi").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest doc_id; five-word shingles.

    Texts without words are no copies and stay; of several rows of the smallest id one stays; null ids come last;
    an empty table gives an empty one; columns of any other name are carried along.
    """
    rows = _numbered(docs)
    found = near_dedup.near_dedup(rows.select("text", "doc_id", "number"), row="number")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = found.where("group IS NOT NULL").groupBy("group").agg(first.alias("x")).select(F.col("x.row").alias("number")).unionAll(found.where("group IS NULL").select(F.col("row").alias("number")))
    return rows.select("row", "number").join(kept, "number", "left_semi").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes and more that occur again; documents of which nothing is left go.

    A character of which a cut takes some bytes goes as a whole.  Null and short texts stay as they are; a row
    that repeats goes with its copies; an empty table gives an empty one; columns of any other name are carried along.
    """
    fields, length = docs.columns, 200
    at_text, size = fields.index("text"), fields.index("n_chars") if "n_chars" in fields else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                columns, spans = part.column("row").flatten(), part.column("spans").to_pylist()
                texts, keep = columns[at_text].to_pylist(), []
                for i, s in enumerate(spans):
                    if s:
                        raw = texts[i].encode()
                        edges = [0, *(x for c in suffix_dedup.merge_spans([(x["first"], x["last"]) for x in s], length) for x in c), len(raw)]
                        texts[i] = "".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], edges[1::2]))
                    if not s or texts[i].strip():
                        keep.append(i)
                columns[at_text] = pa.array(texts, pa.string())
                if size is not None:
                    columns[size] = pa.array([None if t is None else len(t) for t in texts], columns[size].type)
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in columns], names=fields)

    return suffix_dedup.mark_repeats(docs, fields, length).mapInArrow(run, docs.schema)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens.

    Null and empty texts are the closing id alone; repeated rows are packed each for itself; an empty table gives
    an empty result; other columns are not read.
    """
    return packing.pack_documents(docs)


_MADE: dict[str, list[str]] = {}


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage``, deleting first the scratch tables of the stage before, whose result has been written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        common.release(spark, _MADE.pop(app, []))
        before = set(common.made(spark))
        out = stage(spark, docs, sf_dir)
        _MADE[app] = [p for p in common.made(spark) if p not in before]
        return out

    return run


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", _tidy(drop_low_quality)),
    ("exact_dedup", _tidy(drop_exact_copies)),
    ("near_dedup", _tidy(drop_near_copies)),
    ("suffix_dedup", _tidy(cut_repeats)),
    ("packing", _tidy(pack_sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the documents of ``sf_dir``, each result but the last stored in the shared folder."""
    import uuid

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{common.scratch_root(spark)}/pipeline/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Suffix dedup and packing can't be stated in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None
