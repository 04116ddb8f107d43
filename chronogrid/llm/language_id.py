"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language; an unseen word falls back to its
character n-grams, the longest length of which any is known.  Counts come from labelled rows,
as grouped sums in Spark; all counts of the bounded sample are kept and travel to the workers as one broadcast.
Priors are the languages' shares of all labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, crc_bucket, documents

#: Labelled rows the model is fitted on, about (a hash sample in equal parts by language where there are more), which
#: bounds the model; longest n-gram; entries of a worker's memo of unseen words.
FIT_ROWS, LONGEST, MEMO = 6_000, 4, 200_000
#: Weight of an unseen word's n-gram evidence against a known word's.
BACKOFF = 0.4
_WORDS = re.compile(r"[^\W\d_]+").findall
_COUNT = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])


def _grams(word: str, n: int) -> list[str]:
    w = f"\x02{word}\x03"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for lang, own in words.items():
            grams: dict[int, Counter] = {k: Counter() for k in range(1, LONGEST + 1)}
            for w, n in own.items():
                for k in grams:
                    for g in _grams(w, k):
                        grams[k][g] += n
            for k, c in {0: own, **grams}.items():
                out += [(lang, k, g, n) for g, n in c.items()]
        words.clear()
        for at in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + 50_000]), _COUNT)], schema=_COUNT)

    for part in by_bytes(batches, "__text"):
        for lang, t in zip(part.column("__lang").to_pylist(), part.column("__text").to_pylist()):
            words.setdefault(lang, Counter()).update(_WORDS(t.lower()))
        if sum(map(len, words.values())) > 200_000:
            yield from flush()
    yield from flush()


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, rows: pa.Table, priors: dict[str, int]):
        """rows: (lang, size, gram, n), where size 0 is a word; priors: rows by language."""
        self.langs = sorted(priors)
        at = {x: i for i, x in enumerate(self.langs)}
        lang = np.array([at[x] for x in rows.column("lang").to_pylist()], np.int64)
        size, n = rows.column("size").to_numpy().astype(np.int64), rows.column("n").to_numpy().astype(float)
        place = np.empty(len(n), np.int64)
        self.word: dict[str, int] = {}
        self.gram: dict[str, int] = {}
        for i, (k, g) in enumerate(zip(size.tolist(), rows.column("gram").to_pylist())):
            own = self.gram if k else self.word
            if (x := own.get(g)) is None:
                x = own[g] = len(self.word) + len(self.gram)
            place[i] = x
        # By language and size: how many tokens and how many different ones, for add-a-half smoothing.
        tokens, types = np.zeros((LONGEST + 1, len(at))), np.zeros((LONGEST + 1, len(at)))
        np.add.at(tokens, (size, lang), n)
        np.add.at(types, (size, lang), 1)
        count, kind = np.zeros((len(self.word) + len(self.gram), len(at)), np.float32), np.zeros(len(self.word) + len(self.gram), np.int64)
        count[place, lang], kind[place] = n, size
        self.table = (np.log(count + 0.5) - np.log(tokens + types + 1.0)[kind]).astype(np.float32)
        self.prior = np.log(np.array([priors[x] for x in self.langs], float) / max(1, sum(priors.values())))
        self.memo: dict[str, int] = {}
        self.unseen = np.zeros((MEMO, len(at)))

    def _backoff(self, word: str) -> np.ndarray:
        for k in range(min(LONGEST, len(word) + 2), 0, -1):
            if known := [self.gram[g] for g in _grams(word, k) if g in self.gram]:
                return BACKOFF * self.table[known].mean(axis=0)
        return np.zeros(len(self.langs))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, set(text))) or not self.langs:
            return "und", 0.0
        found, seen_n, seen_at, new_n, new_at = Counter(_WORDS(text.lower())), [], [], [], []
        if len(self.memo) + len(found) > MEMO:
            self.memo.clear()
        direct = np.zeros(len(self.langs))
        for w, n in found.items():
            if (at := self.word.get(w)) is not None:
                seen_n.append(n)
                seen_at.append(at)
                continue
            if (at := self.memo.get(w)) is None:
                value, at = self._backoff(w), len(self.memo)
                if at >= MEMO:  # a text of more unseen words than the memo holds
                    direct += n * value
                    continue
                self.memo[w] = at
                self.unseen[at] = value
            new_n.append(n)
            new_at.append(at)
        total = self.prior + direct
        if seen_at:
            total += np.array(seen_n, float) @ self.table[seen_at]
        if new_at:
            total += np.array(new_n, float) @ self.unseen[new_at]
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled rows of ``df``; rows whose text or label is null teach nothing.

    Each language gets an equal part of ``fit_rows``, so that rare ones are learned as well.
    """
    usable = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("__lang"), F.col(text).alias("__text"), F.col(doc_id).alias("__id"))
    priors = {r[0]: r[1] for r in usable.groupBy("__lang").count().collect()}
    part = max(1, fit_rows // max(1, len(priors)))
    shares = df.sparkSession.createDataFrame([(x, int(min(1.0, part / n) * 1_000_000)) for x, n in priors.items()] or [("", 0)], "__lang string, __share long")
    own = usable.join(F.broadcast(shares), "__lang").where(F.pmod(F.xxhash64("__id", F.lit("fit")), F.lit(1_000_000)) < F.col("__share")).select("__lang", "__text")
    counts = own.mapInArrow(_count, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    return Model(counts.orderBy("lang", "size", "gram").toArrow(), priors)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, with lang_pred and score: the likeliest learned language and its posterior.

    Null texts and texts without a letter, or any where nothing was learned, are ``und`` with score 0;
    ties go to the language first by name; repeated rows each get the same; an empty table gives an empty
    result.  An input column that is named like a result gives way to it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name not in (text, "lang_pred", "score")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in by_bytes(batches, text):
            out = [own.predict(t) for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=[*names, "lang_pred", "score"])

    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.select(*[f"`{c}`" for c in names], text).mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs.where(crc_bucket("doc_id", 5) != 0))
    own = docs.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "text")
    return identify(own, model)
