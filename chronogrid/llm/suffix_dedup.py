"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that starts elsewhere too.

Every such string holds the leftmost least hash of its 32-byte grams at the same place wherever it
occurs, so strings are dealt by that anchor and equal ones meet.  Consecutive strings of one anchor
are a run.  Runs whose anchor is seen once are settled without moving text; runs of equal bytes
are one variant, whose bytes travel once a batch.  The variants of an anchor are sorted by the suffixes that
begin at it, and by the reversed prefixes that end there: prefix polynomial hashes and binary search find
common extensions, so that a comparison in the mergesort takes logarithmic time, and every extension of
neighbours is verified byte by byte.  A string that begins o bytes before the anchor is shared by the
variants that lie together in both orders, as far as neighbours agree on o bytes to the left and the rest to
the right; so no pairs are formed, however many variants an anchor has.

An anchor of more than HELD occurrences isn't given to one task: its strings are counted one by one, by their
128-bit cryptographic digests.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, documents, drop, stage
from .shingles import BASE, column_bytes, mix, powers

_U = np.uint64
#: Bytes of a gram; occurrences of one anchor that one task may hold.
GRAM, HELD = 32, 20_000
#: String starts handled at a time, however long a text is; bytes of variants sorted at a time.
TILE, SORT_BYTES = 1 << 19, 1 << 20


def _prefix(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[_U(0)], np.cumsum((data.astype(_U) + _U(1)) * powers(len(data) + 1)[: len(data)], dtype=_U)])


def _hash(pre: np.ndarray, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((pre[at + n] - pre[at]) * powers(len(pre), pow(BASE, -1, 1 << 64))[at])


def _tiles(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Ranges of bytes that hold about TILE string starts and whole strings."""
    at, end = 0, int(offsets[-1])
    while at < end:
        to = min(end, at + TILE)
        yield at, min(end, to + length - 1)
        at = to


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first start, last start, anchor, anchor's hash) of the runs, a tile at a time; places in ``data``."""
    width = length - GRAM + 1
    for lo, hi in _tiles(offsets, length):
        part = data[lo:hi]
        if len(part) < length:
            continue
        n = len(part) - GRAM + 1
        grams = _hash(_prefix(part), np.arange(n), GRAM)
        least = (grams & ~_U((1 << 24) - 1)) | np.arange(n, dtype=_U)
        done = 1
        while done * 2 <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
        starts = np.arange(len(least))
        text = np.searchsorted(offsets, starts + lo, side="right") - 1
        starts = starts[starts + lo + length <= offsets[text + 1]]
        if not len(starts):
            continue
        anchor = (least[starts] & _U((1 << 24) - 1)).astype(np.int64)
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        a, b, p = starts[first], starts[last], anchor[first]
        yield text[a], a + lo, b + lo, p + lo, grams[p].view(np.int64)


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", TILE):
            data, offsets = column_bytes(part.column("text"))
            owner = np.asarray(part.column("owner"))
            # Over all tiles, so that what a long text repeats in another tile counts; a run that a tile's edge cuts has one anchor.
            tiles = [(text, p, h) for text, _, _, p, h in runs(data, offsets, length)]
            if not tiles:
                continue
            text, p, h = map(np.concatenate, zip(*tiles))
            own = np.concatenate([[True], p[1:] != p[:-1]])
            h, o = h[own], owner[text[own]]
            order = np.lexsort((o, h))
            h, o = h[order], o[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
            often = np.diff(np.append(first, len(h))) > 1
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(o[first]), pa.array(often)], names=["h", "owner", "often"])

    return run


_SEGMENT = pa.schema([("variant", pa.binary()), ("h", pa.int64()), ("left", pa.int32()), ("segment", pa.binary()), ("strings", pa.list_(pa.binary())), ("keys", pa.list_(pa.binary())), ("ats", pa.list_(pa.int64()))])


def _digest(x: bytes, key: int = 0) -> bytes:
    return hashlib.blake2b(x, digest_size=16, key=key.to_bytes(4, "little")).digest()


def _segments(length: int, texts: bool):
    """A row for each variant of a batch: its bytes, or the digests of its strings where the anchor is hot, and its places.

    With ``texts`` also a row for each text: its bytes as segment and its key, without a variant.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", TILE):
            data, offsets = column_bytes(part.column("text"))
            keys = part.column("key").to_pylist()
            if texts:
                n = len(keys)
                none = lambda k: pa.nulls(n, _SEGMENT.field(k).type)
                own = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32), part.column("key"))
                yield pa.RecordBatch.from_arrays([none("variant"), none("h"), none("left"), part.column("text"), none("strings"), own, none("ats")], schema=_SEGMENT)
            flat = part.column("hs").flatten()
            wanted, at = np.unique(np.asarray(flat.field(0)), return_index=True)
            hot = np.asarray(flat.field(1))[at]
            raw = data.tobytes()
            for text, a, b, p, h in runs(data, offsets, length):
                place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                keep = np.flatnonzero(wanted[place] == h)
                found: dict[bytes, tuple[int, list[bytes], list[int]]] = {}
                for i, x, y, left in zip(keep.tolist(), a[keep].tolist(), b[keep].tolist(), (p - a)[keep].tolist()):
                    own = found.setdefault(_digest(raw[x : y + length], left), (i, [], []))
                    own[1].append(keys[text[i]])
                    own[2].append(x - int(offsets[text[i]]))
                for lo in range(0, len(found), 4096):
                    some = list(found.items())[lo : lo + 4096]
                    at = np.array([x[0] for _, x in some])
                    many = hot[place[at]]
                    body = [raw[a[i] : b[i] + length] for i in at.tolist()]
                    strings = [[_digest(s[k : k + length]) for k in range(len(s) - length + 1)] if m else None for s, m in zip(body, many)]
                    body = [None if m else s for s, m in zip(body, many)]
                    yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in some], pa.binary()), pa.array(h[at]), pa.array((p - a)[at].astype(np.int32)), pa.array(body, pa.binary()), pa.array(strings, pa.list_(pa.binary())), pa.array([x[1] for _, x in some], pa.list_(pa.binary())), pa.array([x[2] for _, x in some], pa.list_(pa.int64()))], schema=_SEGMENT)

    return run


class Suffixes:
    """Suffixes of one buffer, compared through prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data, self.pre, self.up = data, _prefix(data), powers(len(data) + 1)

    def _equal(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.pre[x + n] - self.pre[x]) * self.up[y] == (self.pre[y + n] - self.pre[y]) * self.up[x]

    def ahead(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest n <= most with data[x : x + n] == data[y : y + n]."""
        lo, hi = np.zeros(len(x), np.int64), np.asarray(most, np.int64).copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self._equal(x, y, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
        """data[x : x + nx] < data[y : y + ny]."""
        n = self.ahead(x, y, np.minimum(nx, ny))
        end = (n == nx) | (n == ny)
        top = len(self.data) - 1
        return np.where(end, nx < ny, self.data[np.minimum(x + n, top)] < self.data[np.minimum(y + n, top)])

    def mergesort(self, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within their groups, which lie together; all merges of a width are made at once."""
        n = len(at)
        order = np.arange(n)
        begin = np.searchsorted(group, group, side="left")
        end = np.searchsorted(group, group, side="right")
        place = np.arange(n) - begin
        width, widest = 1, int((end - begin).max(initial=1))
        while width < widest:
            half = place // width
            lo = np.minimum(begin + (half ^ 1) * width, end)
            hi = np.minimum(lo + width, end)
            from_lo = lo.copy()
            right = half % 2 == 1
            while (open_ := lo < hi).any():
                i = np.flatnonzero(open_)
                mid = (lo[i] + hi[i]) >> 1
                me, other = order[i], order[mid]
                less = self.before(at[other], size[other], at[me], size[me])
                # Of equals, those of the left half come first.
                tie = ~less & right[i] & ~self.before(at[me], size[me], at[other], size[other])
                ahead = less | tie
                lo[i] = np.where(ahead, mid + 1, lo[i])
                hi[i] = np.where(ahead, hi[i], mid)
            to = begin + (half // 2) * 2 * width + place % width + (lo - from_lo)
            merged = np.empty(n, np.int64)
            merged[to] = order
            order = merged
            width *= 2
        return order


def _sorted(data: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[at : at + size] within their groups, and how far each agrees with the next (0 at a group's end)."""
    sfx = Suffixes(data)
    order = sfx.mergesort(at, size, group)
    x, n, g = at[order], size[order], group[order]
    near = sfx.ahead(x[:-1], x[1:], np.minimum(n[:-1], n[1:]))
    raw = data.tobytes()
    same = g[:-1] == g[1:]
    for k in np.flatnonzero(same & (near > 0)).tolist():
        u, v, m = int(x[k]), int(x[k + 1]), int(near[k])
        if raw[u : u + m] != raw[v : v + m]:
            return _plainly_sorted(raw, at, size, group)  # hashes have collided
    return order, np.append(np.where(same, near, 0), 0)


def _plainly_sorted(raw: bytes, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _sorted, by comparing bytes."""
    suffix = [raw[a : a + n] for a, n in zip(at.tolist(), size.tolist())]
    order = sorted(range(len(at)), key=lambda i: (group[i], suffix[i]))
    near = np.zeros(len(at), np.int64)
    for k, (i, j) in enumerate(zip(order, order[1:])):
        if group[i] == group[j]:
            near[k] = len(os.path.commonprefix([suffix[i], suffix[j]]))
    return np.array(order, np.int64), near


def shared_strings(raw: bytes, base: np.ndarray, left: np.ndarray, size: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variant, first start, last start), relative to the variant's begin, of strings that another variant of its group has too.

    Variant i is raw[base : base + size] with its anchor ``left`` bytes in; those of a group lie together.
    """
    data = np.frombuffer(raw, np.uint8)
    anchor, right, n = base + left, size - left, len(base)
    order_r, near_r = _sorted(data, anchor, right, group)
    order_l, near_l = _sorted(data[::-1], len(data) - anchor, left, group)
    new = lambda order: np.concatenate([[True], group[order][1:] != group[order][:-1]])
    new_r, new_l = new(order_r), new(order_l)
    hit = np.zeros((n, length - GRAM + 1), bool)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(length - GRAM + 1):
        own = np.flatnonzero((left >= o) & (right >= length - o))
        if len(own) < 2:
            continue
        class_r[order_r] = np.cumsum(new_r | np.concatenate([[True], near_r[:-1] < length - o]))
        class_l[order_l] = np.cumsum(new_l | np.concatenate([[True], near_l[:-1] < o]) if o else new_l)
        both = class_r[own] * (n + 1) + class_l[own]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        hit[own[by[1:][same]], o] = True
        hit[own[by[:-1][same]], o] = True
    # Starts run against o: the string that begins o bytes before the anchor starts at left - o.
    edge = np.diff(np.pad(hit[:, ::-1], ((0, 0), (1, 1))).astype(np.int8), axis=1)
    v, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    top = length - GRAM
    return v, left[v] - (top - a), left[v] - (top - b + 1)


def _compare(length: int):
    schema = pa.schema([("variant", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])

    def solve(rows: list[list]) -> pa.RecordBatch | None:
        """rows: [h, variant, left, segment, n], distinct variants of whole anchors in order of h."""
        found = [(r[1], 0, len(r[3]) - length) for r in rows if r[4] > 1]
        h = np.array([r[0] for r in rows], np.int64)
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        many = np.flatnonzero((np.bincount(group)[group] > 1))
        if len(many):
            part = [rows[i] for i in many.tolist()]
            size = np.array([len(r[3]) for r in part], np.int64)
            v, a, b = shared_strings(b"".join(r[3] for r in part), np.cumsum(size) - size, np.array([r[2] for r in part], np.int64), size, group[many], length)
            found += [(part[i][1], x, y) for i, x, y in zip(v.tolist(), a.tolist(), b.tolist()) if part[i][4] == 1]
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        weight = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("h", "variant", "left", "segment", "n"))):
                if held and held[-1][1] == row[1]:
                    held[-1][4] += row[4]
                    continue
                if weight > SORT_BYTES and held[-1][0] != row[0]:
                    if (out := solve(held)) is not None:
                        yield out
                    held, weight = [], 0
                held.append(list(row))
                weight += len(row[3])
        if held and (out := solve(held)) is not None:
            yield out

    return run


def _keyed(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, text as bytes, key): key is the first 16 bytes of the text's sha256."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.withColumn("key", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))


def repeated_spans(df: DataFrame, length: int = 200, text: str = "text", doc_id: str = "doc_id", texts: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(spans, classes, segments): spans (key, spans array<struct<first, last>>) of string starts by distinct text,
    classes (key, copies) of texts of ``length`` bytes and more; with ``texts`` segments have the texts with shared anchors."""
    rows = _keyed(df, text, doc_id).where(F.octet_length("text") >= length)
    classes = stage(rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "texts")
    anchors = rows.select(F.xxhash64("key").alias("owner"), "text").mapInArrow(_anchors(length), "h long, owner long, often boolean")
    anchors = stage(anchors, "anchors")
    shared = anchors.groupBy("h").agg(F.min("owner").alias("x"), F.max("owner").alias("y"), F.max("often").alias("often"), F.count(F.lit(1)).alias("c")).where("x <> y OR often").select("h", (F.col("c") > HELD).alias("hot"))
    hit = anchors.select("h", "owner").join(shared, "h").groupBy("owner").agg(F.collect_set(F.struct("h", "hot")).alias("hs"))
    need = classes.select("key", "rep", F.xxhash64("key").alias("owner")).join(hit, "owner").select(F.col("key").alias("k"), "rep", "hs")
    # By id as well, so that the copies of one text don't meet in one task.
    found = rows.join(need, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", "text", "hs")
    segments = stage(found.mapInArrow(_segments(length, texts), "variant binary, h long, left int, segment binary, strings array<binary>, keys array<binary>, ats array<long>"), "segments")
    drop(anchors)
    own = segments.where(F.col("variant").isNotNull())
    n = F.size("keys").cast("long").alias("n")
    cold = own.where("segment IS NOT NULL").select("h", "variant", "left", "segment", n).repartition("h").sortWithinPartitions("h", "variant").mapInArrow(_compare(length), "variant binary, first int, last int")
    strings = own.where("strings IS NOT NULL").select("variant", n, F.posexplode("strings").alias("first", "digest"))
    twice = strings.groupBy("digest").agg(F.sum("n").alias("c")).where("c > 1").select("digest")
    hot = strings.join(twice, "digest").select("variant", "first", F.col("first").alias("last")).distinct()
    where = cold.unionByName(hot).groupBy("variant").agg(F.collect_list(F.struct("first", "last")).alias("hits"))
    placed = own.select("variant", "keys", "ats").join(where, "variant").select(F.explode(F.arrays_zip("keys", "ats")).alias("p"), "hits")
    spans = placed.select(F.col("p.keys").alias("key"), F.transform("hits", lambda x: F.struct((F.col("p.ats") + x["first"]).alias("first"), (F.col("p.ats") + x["last"]).alias("last"))).alias("s")).groupBy("key").agg(F.flatten(F.collect_list("s")).alias("spans"))
    return spans, classes.select("key", "copies"), segments


def merge_spans(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Byte ranges [from, to) that strings starting in the inclusive ranges cover; touching ranges join."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def mark_repeats(df: DataFrame, keep: list[str], length: int = 200, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, spans): each input row as a struct of the columns ``keep``, and array<struct<first, last>> of the starts of
    repeated strings, null where there is none.

    A text that occurs again as a whole is repeated throughout.
    """
    spans, classes, _ = repeated_spans(df, length, text, doc_id)
    shape = "array<struct<first:bigint,last:bigint>>"
    copied = classes.where("copies > 1").select(F.col("key").alias("k"), F.lit(True).alias("copied"), F.lit(None).cast(shape).alias("found"))
    single = spans.join(classes.where("copies = 1"), "key", "left_semi").select(F.col("key").alias("k"), F.lit(False).alias("copied"), F.col("spans").alias("found"))
    value = F.coalesce(F.col(text), F.lit(""))
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.substring(F.unhex(F.sha2(value.cast("binary"), 256)), 1, 16).alias("key"), F.octet_length(value).alias("size"))
    out = keyed.join(copied.unionByName(single), F.col("key") == F.col("k"), "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("size") - length).cast("long").alias("last")))
    return out.select("row", F.when(F.col("copied"), whole).otherwise(F.col("found")).alias("spans"))


def _cut(length: int):
    """(key, n_removed, n_spans, kept_sha256) of texts with the spans of their repeated strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text"):
            gone, k, sha = [], [], []
            for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                cut = merge_spans([(x["first"], x["last"]) for x in s], length)
                gone.append(sum(b - a for a, b in cut))
                k.append(len(cut))
                edges = [0, *(x for c in cut for x in c), len(t)]
                sha.append(hashlib.sha256(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(gone, pa.int64()), pa.array(k, pa.int64()), pa.array(sha, pa.string())], names=["key", "n_removed", "n_spans", "kept_sha256"])

    return run


def suffix_dedup(df: DataFrame, length: int = 200, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes; texts under ``length`` bytes lose none; repeated rows count as
    copies of each other; an empty table gives an empty result; extra columns are not read.
    """
    spans, classes, segments = repeated_spans(df, length, text, doc_id, texts=True)
    # Texts are cut where they are, in the table of those with shared anchors: what is joined to all rows is a few numbers.
    texts = segments.where("variant IS NULL").select(F.element_at("keys", 1).alias("key"), F.col("segment").alias("text"))
    cut = texts.join(classes.where("copies = 1").select("key"), "key", "left_semi").join(spans, "key").select("key", "text", "spans").mapInArrow(_cut(length), "key binary, n_removed long, n_spans long, kept_sha256 string")
    copied = classes.where("copies > 1").select("key", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    known = cut.unionByName(copied).select(F.col("key").alias("k"), F.col("n_removed").alias("gone"), "n_spans", "kept_sha256")
    value = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(value).cast("long").alias("n_bytes"), F.sha2(value, 256).alias("sha"))
    out = rows.withColumn("key", F.substring(F.unhex("sha"), 1, 16)).join(known, F.col("key") == F.col("k"), "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("k").isNull(), 0).otherwise(F.coalesce("gone", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))
