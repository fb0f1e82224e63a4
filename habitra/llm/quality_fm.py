"""Operator 9: a quality classifier, a factorisation machine over hashed words, structure and metadata.

A text's features are its words hashed in ``buckets`` (square roots of their
shares, so the vector has length one), the values of the ``metadata`` columns
that the fit names, hashed in ``META_BUCKETS`` (numbers by their power of two, all
else by its text; a null or NaN has none), and statistics of its structure.  A
factorisation machine adds weights of features and of all their pairs; pairs
come from low-rank vectors in linear time: half of (sum of v x)^2 - sum of
(v x)^2.  It is fitted on the driver over a sample of labelled rows, whose
bound ``max_rows`` is a parameter; scoring is a map over all rows, no shuffle.

Cases: a null or empty text has zero words and the statistics of an empty text,
and gets a score like any other; rows without a label, or with one other than 0
or 1, don't train; labels of one doc_id that disagree each count; without
labelled rows of both kinds every score is 0.5; a null doc_id stays null and is
not held out; an empty table gives an empty result.  A metadata column that is
missing when texts are scored is an error.  Other columns of the input are never
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habitra.llm.common import map_batches, release, small_batches, strings, text_of

BUCKETS = 2048
META_BUCKETS = 64
RANK = 8
#: Labelled rows that the fit uses at most.
MAX_ROWS = 3000
#: A score from which a text counts as good.
THRESHOLD = 0.7
N_STATS = 14
_CLASS = np.full(256, 7, np.uint8)  # of a byte: lower, upper, digit, blank, line end, symbol, punctuation, other
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 3, 4
_CLASS[list(b"#*$%&|<>@^~\\{}[]=+_")], _CLASS[list(b".,;:!?\"'()-/`")] = 5, 6


def statistics(text: str, words: list[bytes]) -> list[float]:
    """Structure of a text: shares of kinds of characters, word lengths, repeated words and lines, size."""
    raw = text.encode()
    n, m = max(len(raw), 1), max(len(words), 1)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / n
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(words, words[1:], words[2:]))
    again = sum(a == b for a, b in zip(words, words[1:]))
    letters = max(kinds[0] + kinds[1], 1e-9)
    return [
        kinds[1] / letters, kinds[2], kinds[5], kinds[6], kinds[7], 10 * kinds[4],
        sum(map(len, words)) / m / 10, len(set(words)) / m, 1 - len(set(pairs)) / max(len(pairs), 1), again / m,
        1 - len(set(lines)) / max(len(lines), 1), np.log1p(len(words)) / 10, np.log1p(len(lines)) / 5, max(map(len, words), default=0) ** 0.5 / 10,
    ]


def fields(df: DataFrame, metadata: Sequence[str]) -> Column:
    """An array of what the metadata columns of a row say: the column's name, and its value as it is hashed."""
    said = []
    for name in metadata:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType
        value = F.concat(F.lit(f"{name}="), c.cast("string"))
        if isinstance(kind, T.NumericType):
            number = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            power = F.floor(F.log2(1 + F.when(F.abs(number) > 1e300, 1e300).otherwise(F.abs(number)))).cast("string")
            value = F.concat(F.lit(f"{name}:"), F.when(number < 0, "-").otherwise(""), power)
        said.append(value)
    return F.array_compact(F.array(*said)) if said else F.array().cast("array<string>")


class Features:
    """Feature rows of texts: ``buckets`` hashed words, hashed metadata if there is any, then the statistics; words' buckets are kept by worker."""

    def __init__(self, buckets: int = BUCKETS, metadata: Sequence[str] = ()):
        self.buckets, self.metadata = buckets, metadata
        self.bucket: dict[bytes, int] = {}

    def rows(self, texts: list[str], said: list[list[str]] | None = None) -> np.ndarray:
        x = np.zeros((len(texts), self.buckets + META_BUCKETS * bool(self.metadata) + N_STATS), np.float32)
        for i, values in enumerate(said or [] if self.metadata else []):
            for v in values:
                x[i, self.buckets + xxhash.xxh3_64_intdigest(v.encode()) % META_BUCKETS] += len(self.metadata) ** -0.5
        for i, t in enumerate(texts):
            raw = t.encode().split()
            x[i, -N_STATS:] = statistics(t, raw)
            words = t.encode().lower().split()
            if not words:
                continue
            try:
                ids = [self.bucket[w] for w in words]
            except KeyError:
                if len(self.bucket) > 100_000:
                    self.bucket.clear()
                for w in set(words).difference(self.bucket):
                    self.bucket[w] = xxhash.xxh3_64_intdigest(w) % self.buckets
                ids = [self.bucket[w] for w in words]
            x[i, : self.buckets] = np.sqrt(np.bincount(ids, minlength=self.buckets) / len(words))
        return x


@dataclass
class FactorisationMachine:
    """Weights of a fitted machine; ``mean`` and ``scale`` standardise the statistics, ``metadata`` names the columns it reads."""

    bias: float
    linear: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    metadata: tuple[str, ...] = ()

    def features(self) -> Features:
        return Features(self.linear.shape[0] - N_STATS - META_BUCKETS * bool(self.metadata), self.metadata)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        x[:, -N_STATS:] = np.clip((x[:, -N_STATS:] - self.mean) / self.scale, -4, 4) / 2
        return x

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, in time linear in the features."""
        x = self._standard(x)
        s = x @ self.vectors
        pairs = 0.5 * ((s * s).sum(1) - (x * x) @ (self.vectors * self.vectors).sum(1))
        return 1 / (1 + np.exp(-np.clip(self.bias + x @ self.linear + pairs, -30, 30).astype(np.float64)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rank: int = RANK, steps: int = 160, rate: float = 0.03, decay: float = 2e-4, seed: int = 7) -> FactorisationMachine:
        """Adam on the mean log loss over all given rows, each class with half the weight; the same rows in the same order give the same machine."""
        fm = cls(0.0, np.zeros(x.shape[1], np.float32), np.random.default_rng(seed).normal(0, 0.03, (x.shape[1], rank)).astype(np.float32), x[:, -N_STATS:].mean(0) if len(x) else np.zeros(N_STATS), (x[:, -N_STATS:].std(0) if len(x) else np.ones(N_STATS)) + 1e-3)
        if not len(y) or y.min() == y.max():
            fm.vectors[:] = 0
            return fm
        z = fm._standard(x)
        zz = z * z
        weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()).astype(np.float32)
        params = [np.zeros(1, np.float32), fm.linear, fm.vectors]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for step in range(1, steps + 1):
            b, w, v = params
            s = z @ v
            out = b + z @ w + 0.5 * ((s * s).sum(1) - zz @ (v * v).sum(1))
            g = (1 / (1 + np.exp(-out)) - y) * weight
            grads = [np.array([g.sum()], np.float32), z.T @ g + decay * w, z.T @ (g[:, None] * s) - v * (zz.T @ g)[:, None] + decay * v]
            for p, (m1, m2), d in zip(params, moments, grads):
                m1 += 0.1 * (d - m1)
                m2 += 0.001 * (d * d - m2)
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        fm.bias = float(params[0][0])
        return fm


def is_held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id's text leaves the held-out remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, buckets: int, id_col: str = "doc_id", text_col: str = "text", metadata: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled rows outside the held-out fold, chosen by hashes of their ids."""
    key = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    chosen = key.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    few = F.broadcast(chosen)  # at most max_rows rows of two numbers
    texts = text_of(docs, id_col, text_col, fields(docs, metadata).alias("fields")).join(few, "doc_id")

    def make():
        features = Features(buckets, metadata)
        return lambda b: {"doc_id": b.column("doc_id"), "label": b.column("label"), "x": [r.astype("<f2").tobytes() for r in features.rows(strings(b, "text"), b.column("fields").to_pylist())]}

    rows = map_batches(texts, make, "doc_id long, label int, x binary", rows=200).orderBy("doc_id", "label", "x").limit(max_rows).toPandas()
    if not len(rows):
        return np.zeros((0, buckets + META_BUCKETS * bool(metadata) + N_STATS), np.float32), np.zeros(0, np.float32)
    return np.stack([np.frombuffer(x, "<f2") for x in rows["x"]]).astype(np.float32), rows["label"].to_numpy(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", metadata: Sequence[str] = ()) -> FactorisationMachine:
    """A machine fitted on the labelled rows that aren't held out, over the texts and the ``metadata`` columns of ``docs``."""
    machine = FactorisationMachine.fit(*training_rows(docs, labels, label_col, max_rows, buckets, id_col, text_col, metadata))
    machine.metadata = tuple(metadata)
    return machine


def score(df: DataFrame, machine: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) of every whole text."""
    sent = df.sparkSession.sparkContext.broadcast(machine)  # buckets * (rank + 1) numbers

    def make():
        features = sent.value.features()
        return lambda b: {"doc_id": b.column("doc_id"), "score": sent.value.score(features.rows(strings(b, "text"), b.column("fields").to_pylist()))}

    return map_batches(text_of(df, id_col, text_col, fields(df, machine.metadata).alias("fields")), make, "doc_id long, score double", rows=500)


def keep(df: DataFrame, machine: FactorisationMachine, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text scores ``threshold`` or more."""
    sent = df.sparkSession.sparkContext.broadcast(machine)
    small_batches(df.sparkSession)
    width = len(df.columns)

    def run(batches):
        features = sent.value.features()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                good = sent.value.score(features.rows(strings(part, text_col), part.column(width).to_pylist())) >= threshold
                yield part.select(range(width)).filter(pa.array(good))
        del features
        release()

    free = "_" * (1 + max(map(len, df.columns)))  # a name that no column has
    return df.withColumn(free, fields(df, machine.metadata)).mapInArrow(run, df.schema)
