"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks.

The kernel of two words sums their common subsequences of ORDER characters, each weighted by DECAY to
the length it spans in both, so gaps and inserted characters lower a match and don't end it.  A shorter
word's one subsequence is the whole word, so it matches itself alone.  Landmarks
are words that labels mark; kernels with them are taken to feature space by the inverse square root of
the landmarks' own kernel matrix.  The features of a window of words are the sum of its words'; a linear
SVM learns the labels of texts from each text's worst window, which is chosen anew in every round, first by
a machine trained on marked words.  A text is as toxic as its worst window, through a sigmoid.
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

from .common import by_bytes, crc_bucket, documents, stage

#: Labelled rows the model is fitted on, about (a hash sample where there are more); landmarks; plain words that the
#: machine is trained on; entries of a worker's memo of words.
FIT_ROWS, LANDMARKS, WORDS, MEMO = 20_000, 128, 20_000, 600_000
#: Length and gap decay of subsequences; characters of a word compared at a time, and of the overlap between two such pieces.
ORDER, DECAY, PIECE, OVERLAP = 4, 0.8, 20, 12
#: Words that are compared with the landmarks at once, and pairs of words in one array.
SLICE, PAIRS = 8192, 512
#: Words of the windows that are tried; rounds of choosing windows and training on them.
WINDOWS, ROUNDS = (1, 2, 4, 8), 3
#: Score from which a text counts as toxic.
THRESHOLD = 0.3
_SINGLES = re.compile(r"(?<!\S)(?:\S[\x20\x09-\x0D]+){2,}\S(?!\S)")
_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¡¿"


def subsequence_kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Kernel values of pairs of words, as rows of character codes; what pads differs in ``s`` and ``t``.

    A subsequence of span a .. b counts decay ** (b - a + 1) in each word.  With decay ** -(i + j) put on the first
    pair of characters and decay ** (i + j + 2) on the last, the sums in between are plain: for each further
    character a running sum over both words of the matches times the sums before them.
    """
    pairs, n = s.shape
    m = t.shape[1]
    match = (np.ascontiguousarray(s.T)[:, None, :] == np.ascontiguousarray(t.T)[None, :, :]).astype(np.float32)
    span = (np.float32(decay) ** (np.arange(n)[:, None] + np.arange(m)).astype(np.float32))[:, :, None]
    sums, now = match / span, np.zeros((n, m, pairs), np.float32)
    for _ in range(order - 1):
        for i in range(1, n):
            sums[i] += sums[i - 1]
        for j in range(1, m):
            sums[:, j] += sums[:, j - 1]
        now[1:, 1:] = sums[:-1, :-1]
        now *= match
        sums, now = now, sums
        now[0], now[:, 0] = 0, 0
    sums *= span * np.float32(decay * decay)
    return sums.sum(axis=(0, 1))


def _codes(words: list[str], pad: int) -> np.ndarray:
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.full((len(words), int(size.max(initial=1))), pad, np.int32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _pieces(token: str) -> list[str]:
    w = token.strip(_STRIP)
    if len(w) <= PIECE:
        return [w] if w else []
    return [w[i : i + PIECE] for i in range(0, len(w) - OVERLAP, PIECE - OVERLAP)]


def tokens(text: str) -> set[str]:
    """Lower-case words; a run of single characters apart also counts as one word."""
    low = text.lower()
    return set(low.split()) | {"".join(x.split()) for x in _SINGLES.findall(low)}


def ordered(text: str) -> list[str]:
    """As tokens, in the text's order and as often as there; runs of single characters last."""
    low = text.lower()
    words = low.split()
    # Such a run is three words of one character in a row at least: else the slower search finds nothing.
    single = np.fromiter(map(len, words), np.int64, len(words)) == 1
    if (single[2:] & single[1:-1] & single[:-2]).any():
        words += ["".join(x.split()) for x in _SINGLES.findall(low)]
    return words


class Landmarks:
    """Kernels with the landmarks, remembered by word."""

    def __init__(self, words: list[str], weights: np.ndarray | None = None, bias: float = 0.0, windows: tuple[int, ...] = WINDOWS):
        self.words, self.windows = words, windows
        self.codes = _codes(words, -2)
        self.size = np.array([len(w) for w in words], np.int64)
        self.short = {w: k for k, w in enumerate(words) if len(w) < ORDER}
        self.own = np.array([self._self(w) for w in words], np.float32)
        # By character of any landmark, after a row of none: a bit for each place in each landmark.
        self.letters = np.unique(self.codes[self.codes >= 0])
        kind = np.uint16 if self.size.max(initial=0) <= 16 else np.uint32
        self.places = np.zeros((len(self.letters) + 1, len(words)), kind)
        for k, i in zip(*np.nonzero(self.codes >= 0)):
            self.places[np.searchsorted(self.letters, self.codes[k, i]) + 1, k] |= kind(1 << i)
        #: What was asked for lately, and what was before that.
        self.memo: dict[str, float] = {}
        self.older: dict[str, float] = {}
        self.weights, self.bias = weights, bias

    @staticmethod
    def _self(word: str) -> float:
        return float(subsequence_kernel(_codes([word], -1), _codes([word], -2))[0])

    def _related(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, landmark) of the pairs with a common subsequence of ORDER characters; words from the longest on.

        Bits of ``row`` that turn 0 are steps of the longest common subsequence: one addition a character.
        """
        at = np.minimum(np.searchsorted(self.letters, codes), max(len(self.letters) - 1, 0))
        at = np.where(self.letters[at] == codes, at + 1, 0) if len(self.letters) else np.zeros_like(codes)
        kind = self.places.dtype.type
        row = np.full((len(codes), len(self.words)), np.iinfo(kind).max, kind)
        for i in range(codes.shape[1]):
            n = int((size > i).sum())
            here = self.places[at[:n, i]]
            row[:n] = (row[:n] + (row[:n] & here)) | (row[:n] & ~here)
        full = ((np.uint64(1) << self.size.astype(np.uint64)) - np.uint64(1)).astype(kind)
        return np.nonzero(np.bitwise_count(~row & full) >= ORDER)

    def _shared(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word, landmark, normalised kernel) of the pairs that have a subsequence in common, some thousands of words at a time."""
        short = [(i, k) for i, w in enumerate(words) if (k := self.short.get(w)) is not None]
        if short:
            i, k = np.array(short, np.int64).T
            yield i, k, np.ones(len(short), np.float32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        long = np.flatnonzero(length >= ORDER)
        long = long[np.argsort(-length[long], kind="stable")]
        for start in range(0, len(long), SLICE):
            part = long[start : start + SLICE]
            size, codes = length[part], _codes([words[i] for i in part], -1)
            found = [self._related(codes[a : a + 1024, : size[a]], size[a : a + 1024]) for a in range(0, len(part), 1024)]
            w, k = np.concatenate([x + 1024 * n for n, (x, _) in enumerate(found)]), np.concatenate([x for _, x in found])
            own = np.zeros(len(part), np.float32)
            some = np.flatnonzero(np.bincount(w, minlength=len(part)))
            for a in range(0, len(some), PAIRS):
                c = codes[some[a : a + PAIRS], : size[some[a]]]
                own[some[a : a + PAIRS]] = subsequence_kernel(c, np.where(c == -1, -2, c))
            # Pairs of like lengths together, so that little is padding.
            order = np.argsort((self.size[k] - size[w] * 64).astype(np.int16), kind="stable")
            w, k = w[order], k[order]
            value = np.empty(len(w), np.float32)
            for a in range(0, len(w), PAIRS):
                p, l = w[a : a + PAIRS], k[a : a + PAIRS]
                value[a : a + PAIRS] = subsequence_kernel(codes[p, : size[p].max()], self.codes[l, : self.size[l].max()])
            yield part[w], k, value / np.maximum(np.sqrt(own[w] * self.own[k]), 1e-30)

    def kernels(self, words: list[str]) -> np.ndarray:
        """(words, landmarks) normalised kernels; 0 only where no subsequence is common."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        for w, k, v in self._shared(words):
            out[w, k] = v
        return out

    def learn(self, new: list[str]) -> None:
        """Put tokens' values into the memo, each its greatest piece's; 0 for those that share nothing with a landmark.

        Tokens often differ in marks around them alone: each piece's value is worked out once.
        """
        at: dict[str, int] = {}
        owner, place = [], []
        for i, t in enumerate(new):
            for p in _pieces(t):
                owner.append(i)
                place.append(at.setdefault(p, len(at)))
        value = np.zeros(len(at))
        for w, k, v in self._shared(list(at)):
            value += np.bincount(w, v * self.weights[k], len(at))
        best = np.full(len(new), -np.inf)
        np.maximum.at(best, np.array(owner, np.int64), value[np.array(place, np.int64)])
        self.memo.update(zip(new, np.where(np.isneginf(best), 0.0, best).tolist()))

    def _worst(self, texts: list[str]) -> list[tuple[float, list[str]]]:
        """Value and tokens of the window of each text whose sum is greatest; none where no sum is over 0."""
        lists = [ordered(t) for t in texts]
        if len(self.memo) > MEMO // 2:
            self.memo, self.older = {}, self.memo
        new = set().union(*lists).difference(self.memo)
        known = {t: self.older[t] for t in new.intersection(self.older)}
        self.memo.update(known)
        if new := list(new.difference(known)):
            self.learn(new)
        look = self.memo.__getitem__
        out: list[tuple[float, list[str]]] = []
        for words in lists:
            sums = np.zeros(len(words) + 1)
            np.cumsum(np.fromiter(map(look, words), np.float64, len(words)), out=sums[1:])
            best, at, size = 0.0, 0, 0
            for n in self.windows:
                if n <= len(words):
                    own = sums[n:] - sums[:-n]
                    i = int(own.argmax())
                    if own[i] > best:
                        best, at, size = float(own[i]), i, n
            out.append((best, words[at : at + size]))
        return out

    def margins(self, texts: list[str]) -> np.ndarray:
        """The margin of each text's worst window."""
        return np.array([v for v, _ in self._worst(texts)], np.float64) + self.bias

    def worst(self, texts: list[str]) -> np.ndarray:
        """(texts, landmarks) kernels of each text's worst window."""
        windows = [w for _, w in self._worst(texts)]
        cut = [(t, p) for t in set().union(*windows) for p in _pieces(t)]
        values = self.kernels([p for _, p in cut])
        best: dict[str, tuple[float, int]] = {}
        for i, ((t, _), v) in enumerate(zip(cut, (values @ self.weights).tolist())):
            if t not in best or v > best[t][0]:
                best[t] = v, i
        out = np.zeros((len(texts), len(self.words)), np.float32)
        for i, w in enumerate(windows):
            for t in w:
                if t in best:
                    out[i] += values[best[t][1]]
        return out

    def lift(self) -> np.ndarray:
        """Inverse square root of the landmarks' kernel matrix: the Nyström map."""
        own = self.kernels(self.words).astype(np.float64)
        own = (own + own.T) / 2
        values, vectors = np.linalg.eigh(own)
        keep = values > 1e-3
        return vectors[:, keep] / np.sqrt(values[keep]) @ vectors[:, keep].T


class Model:
    """Landmarks, word weights over the kernels with them, and the sigmoid of a text's margin."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0, windows: tuple[int, ...] = WINDOWS):
        self.windows = windows
        self.landmarks, self.weights, self.bias, self.slope, self.offset = landmarks, weights, bias, slope, offset

    def words(self) -> Landmarks:
        """The landmarks and what is remembered of words; a worker's tasks share them."""
        if not hasattr(self, "_words"):
            self._words = Landmarks(self.landmarks, self.weights, self.bias, self.windows)
        return self._words

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_words"}

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def train_svm(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 1e-4, steps: int = 3000) -> tuple[np.ndarray, float]:
    """Linear SVM by full subgradient steps on the class-balanced hinge loss, each row counted ``times``."""
    # Rows that share nothing with any landmark are alike: one for each label stands for all of them.
    some = x.any(axis=1)
    rest = [np.flatnonzero(~some & (y > 0)), np.flatnonzero(~some & (y <= 0))]
    take = np.concatenate([np.flatnonzero(some), *(r[:1] for r in rest)])
    times = np.concatenate([times[some], *(times[r].sum(keepdims=True)[: len(r)] for r in rest)])
    x, y = x[take].astype(np.float32), y[take]
    sign = np.where(y > 0, 1.0, -1.0).astype(np.float32)
    weight = times * np.where(y > 0, 0.5 / max(1e-9, times[y > 0].sum()), 0.5 / max(1e-9, times[y <= 0].sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    total, total_b, kept = np.zeros_like(w), 0.0, 0
    for t in range(steps):
        wrong = sign * (x @ w.astype(np.float32) + np.float32(b)) < 1
        g = (weight * wrong * sign).astype(np.float32)
        rate = 4.0 / np.sqrt(t + 1)
        w = w * (1 - rate * penalty) + rate * (g @ x)
        b += rate * g.sum()
        if t >= steps // 2:
            total, total_b, kept = total + w, total_b + b, kept + 1
    return total / max(kept, 1), total_b / max(kept, 1)


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins and labels, by Newton steps with smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, v = p - goal, np.maximum(p * (1 - p), 1e-6)
        g = np.array([(d * margin).sum(), d.sum()])
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(w, n if y else 0, 0 if y else n) for y, c in found.items() for w, n in c.items()]
        for c in found.values():
            c.clear()
        if rows:
            w, a, b = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["word", "bad", "fine"])

    for part in by_bytes(batches, "text"):
        for y, t in zip(part.column("y").to_pylist(), part.column("text").to_pylist()):
            found[y].update({p for w in tokens(t) for p in _pieces(w)})
        if len(found[0]) + len(found[1]) > 200_000:
            yield from flush()
    yield from flush()


def _windows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = model.value.words()
        for part in by_bytes(batches, "text", 1 << 20):
            x = here.worst(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())], names=["y", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Model | None:
    """A model of the texts of ``docs`` that ``labels`` marks; None where either label is missing.

    Null labels and ids teach nothing; an id is toxic where any of its labels says so.  About ``fit_rows`` labelled
    ids at most are taken, before any text is looked at, and broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    share = min(1.0, fit_rows / max(known.count(), 1))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("key", F.lit("toxic")), F.lit(1_000_000)) < int(share * 1_000_000))
    own = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), "key").select("key", "y", "text")
    # Read several times below: the bounded sample is joined and stored once.
    own = stage(own, "labelled")
    totals = {r.y: r["count"] for r in own.groupBy("y").count().collect()}
    if len(totals) < 2:
        return None
    counts = own.select("y", "text").mapInArrow(_word_counts, "word string, bad long, fine long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    counts = counts.persist()
    bad, fine = F.col("bad"), F.col("fine")
    odds = F.log((bad + 0.5) / ((fine + 0.5) * F.lit(totals[1] / totals[0])))
    marked = counts.where((bad >= 3) & (odds > 1.5)).orderBy((bad * odds).desc(), "word").limit(WORDS // 10).select("word", "bad").collect()
    plain = [r.word for r in counts.where((fine >= 5) & (odds < 0.5)).orderBy(F.xxhash64("word"), "word").limit(WORDS).collect()]
    counts.unpersist()
    if not marked:
        return None
    words = [r.word for r in marked]
    marks = Landmarks(words[:landmarks])
    x = marks.kernels(words + plain)
    near = np.concatenate([np.ones(len(words), bool), x[len(words) :].any(axis=1)])
    lift = marks.lift()
    y = np.concatenate([np.ones(len(words)), np.zeros(len(plain))])[near]
    w, b = train_svm(x[near] @ lift, y, np.concatenate([[r.bad for r in marked], np.ones(len(plain))])[near])
    model = Model(marks.words, lift @ w, b)
    for _ in range(ROUNDS):
        rows = own.select("y", "text").mapInArrow(_windows(own.sparkSession.sparkContext.broadcast(model)), "y int, x array<float>").toArrow()
        y = rows.column("y").to_numpy()
        x = np.concatenate([np.asarray(c.flatten()) for c in rows.column("x").chunks]).reshape(len(y), -1)
        w, b = train_svm(x @ lift, y, np.ones(len(y)), steps=1000)
        model = Model(marks.words, lift @ w, b)
    shared = own.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = shared.value.words()
        for part in by_bytes(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(here.margins(part.column("text").to_pylist()))], names=["y", "x"])

    rows = own.select("y", "text").mapInArrow(run, "y int, x double").toArrow()
    return Model(marks.words, model.weights, model.bias, *_sigmoid(rows.column("x").to_numpy(), rows.column("y").to_numpy()))


def score(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` without its text, with score and predicted.

    Null and empty texts get the score of a text without any match; without a model every score is 0; repeated
    rows each get the same; an empty table gives an empty result.  An input column that is named like a result
    gives way to it.
    """
    fields = [f for f in df.schema.fields if f.name not in (text, "score", "predicted")]
    names = [f.name for f in fields]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        marks = own.words() if own else None
        for part in by_bytes(batches, text, 2 << 20):
            texts = [t or "" for t in part.column(text).to_pylist()]
            p = own.score(marks.margins(texts)) if own else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(p.astype(np.float64)), pa.array((p >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"])

    return df.select(*[f"`{c}`" for c in names], text).mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(crc_bucket("doc_id", 4) != 2)
    model = fit(docs, labels)
    return score(docs.select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "text"), model)
