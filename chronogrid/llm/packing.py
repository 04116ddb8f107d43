"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

A chromosome is a set of bins.  Crossover injects whole well-filled bins of one parent into another,
drops the bins that hold the same documents, and best-fits the displaced ones.  Items are dealt by
hash into blocks of bounded size; each block is evolved on several islands (tasks), whose elites
migrate round the ring between epochs; the best island's packing counts.
"""

from __future__ import annotations

import random
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import byte_map
from .common import by_bytes, documents, stage

#: Tokens of a sequence; items in a block on average; islands of each block; generations between migrations; chromosomes of an island; epochs after the first.
CAPACITY, BLOCK, ISLANDS, GENERATIONS, POPULATION, MIGRATIONS = 2048, 4096, 3, 6, 5, 1
#: Entries of each half of a worker's memo of encoded words; results don't depend on it.
MEMO = 300_000
#: Fixed value: the pattern of the vocabulary's pre-tokeniser.
_WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit integers, the words' own ids being remembered.

    The tokeniser never merges over white space, so a text's ids are its words' ids in order.
    """

    def __init__(self, path: str | None):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.model.encode_special_tokens = True
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.cut = regex.compile(_WORD_PARTS).findall
        self.to_chars = {b: ord(c) for b, c in enumerate(byte_map())}
        # What Python takes for white space and the tokeniser doesn't.
        self.odd = re.compile("[\x1c-\x1f]").search

    def _ids(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Plain words skip the tokeniser's pipeline: lower-cased and cut as its pre-tokeniser does, their parts go to its merges.

        Plain are Latin words in composed form, whose lower case doesn't depend on the place.
        """
        memo, parts, merge = self.memo, self.parts, self.model.model.tokenize
        if len(parts) > MEMO:
            parts.clear()
        for w in words:
            if not w.isascii() and (max(w) >= "\u0250" or "\u0130" in w or not is_normalized("NFC", w)):
                memo[w] = self._ids(w)
                continue
            out = b""
            for p in self.cut(w.lower()):
                raw = parts.get(p)
                if raw is None:
                    mapped = p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.to_chars)
                    raw = parts[p] = array("I", [t.id for t in merge(mapped)]).tobytes()
                out += raw
            memo[w] = out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        lists = [None if self.odd(t) else t.split() for t in texts]
        memo, older = self.memo, self.older
        known = [x for x in lists if x is not None]
        new = set(chain.from_iterable(known)).difference(memo)
        if len(memo) > MEMO:
            self.older, self.memo = older, memo = memo, {}
            new = set(chain.from_iterable(known))
        memo.update([(w, older[w]) for w in new if w in older])
        if new := list(new.difference(memo)):
            self._learn(new)
        for t, words in zip(texts, lists):
            yield self._ids(t) if words is None else b"".join(map(memo.__getitem__, words))


@lru_cache(maxsize=2)
def _encoder(path: str | None) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def pieces(df: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32: each document's ids and a closing 0, cut where longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for part in by_bytes(batches, "__text"):
            out = []
            for row, doc, ids in zip(part.column("row").to_pylist(), part.column("__doc").to_pylist(), encoder.encode(part.column("__text").to_pylist())):
                ids += b"\0\0\0\0"
                n = len(ids) // 4
                out += [(row, doc, i, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)])) for i, s in enumerate(range(0, n, capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECE_SCHEMA)], schema=_PIECE_SCHEMA)

    own = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return own.mapInArrow(run, _PIECES)


class _Bins:
    """Bins under construction; finds the fullest bin with room by the lowest set bit of a mask."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free, self.by_free, self.mask = capacity, [], [], {}, 0

    def _place(self, k: int) -> None:
        f = self.free[k]
        if f:
            self.by_free.setdefault(f, []).append(k)
            self.mask |= 1 << f

    def add(self, items: list[int], size: int) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - size)
        self._place(len(self.bins) - 1)

    def best_fit(self, item: int, size: int) -> None:
        m = self.mask >> size
        if not m:
            self.add([item], size)
            return
        f = (m & -m).bit_length() - 1 + size
        own = self.by_free[f]
        k = own.pop()
        if not own:
            self.mask &= ~(1 << f)
        self.bins[k].append(item)
        self.free[k] -= size
        self._place(k)


def _fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins as unevenly filled as can be."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _pack(order: list[int], sizes: list[int], capacity: int, start: list[tuple[list[int], int]] = ()) -> list[list[int]]:
    out = _Bins(capacity)
    for items, size in start:
        out.add(items, size)
    for i in order:
        out.best_fit(i, sizes[i])
    return out.bins


def _cross(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Whole well-filled bins of ``b`` enter ``a``; what they displace is placed again by best fit."""
    filled = [(x, s) for x in b if (s := sum(sizes[i] for i in x)) >= 0.98 * capacity]
    injected = [(list(x), s) for x, s in filled if rng.random() < 0.5]
    taken = {i for x, _ in injected for i in x}
    kept, loose = [], []
    for x in a:
        if taken.isdisjoint(x) and sum(sizes[i] for i in x) >= 0.9 * capacity:
            kept.append((list(x), sum(sizes[i] for i in x)))
        else:
            loose += [i for i in x if i not in taken]
    loose.sort(key=lambda i: (-sizes[i], rng.random()))
    return _pack(loose, sizes, capacity, injected + kept)


def evolve(sizes: list[int], seed: int, capacity: int = CAPACITY, migrant: list[list[int]] | None = None, own: list[list[int]] | None = None, generations: int = GENERATIONS, population: int = POPULATION) -> list[list[int]]:
    """The best bins an island finds; stops early where no packing can have fewer."""
    rng, least, n = random.Random(seed), -(-sum(sizes) // capacity), range(len(sizes))
    pool = [x for x in (own, migrant) if x]
    if not pool:
        pool.append(_pack(sorted(n, key=lambda i: -sizes[i]), sizes, capacity))
    best = min(pool, key=lambda x: _fitness(x, sizes, capacity))
    if len(best) == least:
        return best
    while len(pool) < population:
        spread = 1 + 0.1 * len(pool)
        pool.append(_pack(sorted(n, key=lambda i: -sizes[i] * rng.uniform(1, spread)), sizes, capacity))
    ranked = sorted(((_fitness(x, sizes, capacity), k, x) for k, x in enumerate(pool)), key=lambda x: x[:2])
    for g in range(generations):
        if ranked[0][0][0] == least:
            break
        a, b = rng.sample(ranked, 2)
        child = _cross(a[2], b[2], sizes, capacity, rng)
        ranked = sorted([*ranked, (_fitness(child, sizes, capacity), population + g, child)], key=lambda x: x[:2])[:population]
    return ranked[0][2]


_ISLAND = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("sizes", pa.binary()), ("bins", pa.binary()), ("n_bins", pa.int64())])


def _coded(bins: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, "<i4")
    for k, x in enumerate(bins):
        out[x] = k
    return out.tobytes()


def _decoded(raw: bytes | None) -> list[list[int]] | None:
    if raw is None:
        return None
    at = np.frombuffer(raw, "<i4")
    order = np.argsort(at, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)]


def _epoch(capacity: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                sizes = np.frombuffer(r["sizes"], "<i4").tolist()
                bins = evolve(sizes, r["block"] * 1000 + r["island"] * 10 + number, capacity, _decoded(r.get("migrant")), _decoded(r.get("bins")))
                out.append((r["block"], r["island"], r["sizes"], _coded(bins, len(sizes)), len(bins)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ISLAND)], schema=_ISLAND)

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, migrations: int = MIGRATIONS) -> DataFrame:
    """``items`` (of ``pieces``, already stored) with sequence_id and offset.

    Full pieces are sequences of their own.  A block never holds much over ``block`` items, so a
    task's memory doesn't grow with the corpus.
    """
    spark = items.sparkSession
    loose = items.where(F.col("length") < capacity)
    blocks = max(1, -(-loose.count() // block))
    keyed = loose.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
    bodies = keyed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("row", "piece", "length"))).alias("items"))
    # Lengths as one binary: what travels between islands is 4 bytes an item and elite.
    sizes = bodies.select("block", F.transform("items", lambda x: x["length"].cast("int")).alias("sizes"))

    def to_binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array([np.array(x, "<i4").tobytes() for x in b.column("sizes").to_pylist()], pa.binary())], names=["block", "sizes"])

    schema = "block long, island int, sizes binary, bins binary, n_bins long"
    packed = sizes.mapInArrow(to_binary, "block long, sizes binary")
    state = packed.select("block", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), "sizes").repartition("block", "island").mapInArrow(_epoch(capacity, 0), schema)
    for k in range(1, migrations + 1):
        state = stage(state, "islands")
        elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("bins").alias("migrant"))
        state = state.join(elite, ["block", "island"]).mapInArrow(_epoch(capacity, k), schema)
    best = state.groupBy("block").agg(F.min_by(F.struct("sizes", "bins"), F.struct("n_bins", "island")).alias("b")).select("block", "b.*")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blk, sz, bn in zip(*(b.column(k).to_pylist() for k in ("block", "sizes", "bins"))):
                size, at = np.frombuffer(sz, "<i4").astype(np.int64), np.frombuffer(bn, "<i4").astype(np.int64)
                order = np.argsort(at, kind="stable")
                ends = np.cumsum(size[order])
                first = np.concatenate([[0], np.flatnonzero(np.diff(at[order])) + 1])
                base = np.repeat((ends - size[order])[first], np.diff(np.append(first, len(at))))
                offset = np.empty(len(at), np.int64)
                offset[order] = ends - size[order] - base
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), blk)), pa.array(np.arange(len(at), dtype=np.int32)), pa.array((blk << 24) + at), pa.array(offset)], names=["block", "pos", "sequence_id", "offset"])

    where = best.mapInArrow(place, "block long, pos int, sequence_id long, offset long")
    listed = bodies.select("block", F.posexplode("items").alias("pos", "item")).select("block", "pos", F.col("item.row").alias("row"), F.col("item.piece").alias("piece"))
    found = listed.join(where, ["block", "pos"]).select("row", "piece", "sequence_id", "offset")
    full = items.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return loose.join(found, ["row", "piece"]).select(*items.columns, "sequence_id", "offset").unionByName(full)


def pack_documents(df: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the closing id alone; repeated rows are packed each for itself; an
    empty table gives an empty result; extra columns are not read.
    """
    items = stage(pieces(df, vocabulary, capacity, text, doc_id), "pieces")
    return pack(items, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
