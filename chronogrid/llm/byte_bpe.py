"""Byte-level BPE by a sentencepiece model written straight from a rank vocabulary.

Each byte is mapped to a printable character, each vocabulary entry becomes a piece whose score is
its negative rank, and normalisation is the identity; the model then merges in rank order.  Text is
cut into pre-tokens first and each is encoded on its own; decoding maps ids back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, documents

#: Entries of each half of a worker's memo of encoded chunks; when one is full the older goes, results don't depend on it.
MEMO = 250_000
#: White space other than space and line feed, as Unicode has it; ASCII first.
_RARE_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def byte_map() -> list[str]:
    """A printable character for each byte: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | int | float | bool) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in rank order; ranks have to be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranked = sorted((int(r), base64.b64decode(b)) for b, r in pairs)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks are not contiguous")
    return [b for _, b in ranked]


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece ModelProto of a rank vocabulary; the unknown piece takes the next free id."""
    # Field numbers and enum values of sentencepiece_model.proto.
    pieces, trainer, normalizer, normal, unknown, bpe = 1, 2, 3, 1, 2, 2
    chars = byte_map()
    out = [_field(pieces, _field(1, "".join(chars[b] for b in t).encode()) + _field(2, -float(rank)) + _field(3, normal)) for rank, t in enumerate(tokens)]
    out.append(_field(pieces, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    n = len(tokens)
    out.append(_field(trainer, _field(3, bpe) + _field(4, n + 1) + _field(40, n) + b"".join(_field(k, (1 << 64) - 1) for k in (41, 42, 43))))
    out.append(_field(normalizer, _field(1, b"identity") + _field(3, False) + _field(4, False) + _field(5, False)))
    return b"".join(out)


class Codec:
    """Encodes as the rank vocabulary's own library would, and decodes."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens, self.decimal = tokens, [str(i) for i in range(len(tokens) + 1)]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.split = regex.compile(pattern).findall
        self.to_chars = {b: ord(c) for b, c in enumerate(byte_map())}
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.memo: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}
        self.parts: dict[str, tuple[int, str, bytes]] = {}

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        out, wait = [], []
        for p in pieces:
            raw = p.encode("utf-8", "replace")
            at = self.whole.get(raw)
            out.append([at] if at is not None else None)
            if at is None:
                wait.append(raw.decode("latin-1").translate(self.to_chars))
        ready = iter(self.model.encode(wait, num_threads=1) if wait else ())
        return [x if x is not None else next(ready) for x in out]

    @staticmethod
    def knotted(text: str) -> bool:
        """Whether white space other than single line breaks and single spaces may stand in the nonempty ``text``."""
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            return True
        return any(w in text for w in (_RARE_SPACE[:8] if text.isascii() else _RARE_SPACE))

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        # Where single spaces stand between other characters, no pre-token reaches over a space from its left.
        return self.split(text) if "\0" in text or self.knotted(text) else text.replace(" ", "\0 ").split("\0")

    def _learn(self, lists: list[list[str]]) -> dict[str, tuple[int, str, bytes]]:
        """The memo, with every chunk of ``lists`` in it: number of ids, ids in decimal, their bytes (nothing the garbage collector has to follow)."""
        memo, older = self.memo, self.older
        new = set(chain.from_iterable(lists)).difference(memo)
        if len(memo) > MEMO:
            self.older, self.memo = older, memo = memo, {}
            new = set(chain.from_iterable(lists))
        memo.update([(c, older[c]) for c in new if c in older])
        if new := list(new.difference(memo)):
            if len(self.parts) > MEMO:
                self.parts.clear()
            known = self.parts
            cut = [self.split(c) for c in new]
            wait = list(set(chain.from_iterable(cut)).difference(known))
            for p, x in zip(wait, self._encode_pieces(wait)):
                known[p] = len(x), " ".join(map(self.decimal.__getitem__, x)), self.decode(x)
            for c, own in zip(new, cut):
                if len(own) == 1:
                    memo[c] = known[own[0]]
                else:
                    n, ids, raw = zip(*map(known.__getitem__, own))
                    memo[c] = sum(n), " ".join(ids), b"".join(raw)
        return memo

    def encode(self, text: str) -> list[int]:
        chunks = self._chunks(text)
        memo = self._learn([chunks])
        return [int(i) for c in chunks for i in memo[c][1].split()]

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Of each text: how many ids, and the sha256 of the ids in decimal and of the bytes they decode to."""
        lists = [self._chunks(t) for t in texts]
        memo = self._learn(lists).__getitem__
        for chunks in lists:
            n, ids, raw = zip(*map(memo, chunks)) if chunks else ((), (), ())
            yield sum(n), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(b"".join(raw)).hexdigest()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(path: str | None) -> Codec:
    import public_tokenizers

    return Codec(read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def encode_documents(df: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """The input with ``ids array<int>``; null text has no ids."""
    inner = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            for part in by_bytes([batch], text):
                ids = pa.array([codec.encode(t or "") for t in part.column(text).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])

    from pyspark.sql import types as T

    return df.mapInArrow(run, T.StructType([*inner.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode_ids(df: DataFrame, vocabulary: str | None = None, ids: str = "ids") -> DataFrame:
    """The input with ``decoded binary``, the bytes of its ids."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            out = pa.array([None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())]))


def bpe_digests(df: DataFrame, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each whole text.

    One narrow pass.  Null and empty texts have no tokens and the digests of nothing; repeated rows
    repeat; an empty table gives an empty result; extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for part in by_bytes(batches, "__text"):
            n, a, b = zip(*codec.digests(part.column("__text").to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column("__doc"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], schema=_OUT)

    own = df.select(F.col(doc_id).cast("long").alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))
