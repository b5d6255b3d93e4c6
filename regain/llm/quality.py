"""Quality by a factorisation machine: linear weights and low-rank pairwise interactions among hashed words,
structure statistics and metadata, scored in linear time by the sum-of-squares identity."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import table

# at most this many labelled rows are used for fitting, those with the smallest hash of their id
TRAIN_ROWS = 10_000
WORD_SLOTS = 1 << 16
RANK = 6
EPOCHS, BATCH = 6, 64
CUTOFF = 0.3
FOLD = 5

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digit", "bang", "pipe", "hash_dollar", "percent_amp", "star",
    "other_symbol", "blank", "lines_per_word", "distinct_words", "repeated_lines", "sentence_ends", "wide", "declared",
)
_GROUPS = (
    ("upper", range(65, 91)), ("digit", range(48, 58)), ("bang", b"!"), ("pipe", b"|"), ("hash_dollar", b"#$"),
    ("percent_amp", b"%&"), ("star", b"*"), ("other_symbol", b"+/<=>@[\\]^_`{}~"), ("blank", b" \t\n\r"),
    ("wide", range(128, 256)),
)


class WordSlots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 2_000_000:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % WORD_SLOTS
        return value


def describe(text: str, declared: int | None, slots: WordSlots) -> tuple[np.ndarray, list[float]]:
    """Distinct word slots of the whole text, and its statistics in the order of ``STATISTICS``."""
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    share = {name: float(counts[list(codes)].sum()) / n for name, codes in _GROUPS}
    words = text.lower().split()
    distinct = set(words)
    lines = text.split("\n")
    m = max(len(words), 1)
    values = share | {
        "log_chars": math.log1p(len(text)), "log_words": math.log1p(len(words)), "word_length": len(text) / m,
        "lines_per_word": len(lines) / m, "distinct_words": len(distinct) / m,
        "repeated_lines": 1 - len(set(lines)) / len(lines),
        "sentence_ends": float(counts[46] + counts[63]) / m,
        "declared": math.log1p(max(declared, 0)) if declared is not None else math.log1p(len(text)),
    }
    return np.unique(np.fromiter(map(slots.__getitem__, distinct), np.int64, len(distinct))), [values[s] for s in STATISTICS]


@dataclass
class Machine:
    """``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; statistics come after the word slots."""

    mean: np.ndarray
    scale: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def inputs(self, words: list[np.ndarray], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat feature numbers, their values, and where each row begins."""
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        own = np.arange(WORD_SLOTS, WORD_SLOTS + stats.shape[1])
        ids = [part for row in words for part in (row, own)]
        values = [part for row, zi in zip(words, z) for part in (np.full(len(row), 1 / math.sqrt(max(len(row), 1))), zi)]
        sizes = [len(row) + len(own) for row in words]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        return np.concatenate(ids), np.concatenate(values), starts

    def raw(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vx = self.v[ids] * x[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        linear = np.add.reduceat(self.w[ids] * x, starts)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, words: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
        if not words:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.inputs(words, stats))[0], -30, 30)))


def fit(words: list[np.ndarray], stats: np.ndarray, y: np.ndarray, seed: int = 1) -> Machine:
    """Adaptive gradient steps on log loss, with weight decay. Without both classes the score is constant."""
    k = len(STATISTICS)
    size = WORD_SLOTS + k
    dice = np.random.default_rng(seed)
    mean = stats.mean(axis=0) if len(stats) else np.zeros(k)
    scale = stats.std(axis=0) + 1e-3 if len(stats) else np.ones(k)
    prior = (y.sum() + 1) / (len(y) + 2)
    machine = Machine(mean, scale, float(np.log(prior / (1 - prior))), np.zeros(size), dice.normal(0, 0.02, (size, RANK)))
    if not len(y) or y.min() == y.max():
        machine.v[:] = 0
        return machine
    g0, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    rate, decay = 0.08, 1e-4
    for _ in range(EPOCHS):
        order = dice.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at : at + BATCH]
            ids, x, starts = machine.inputs([words[i] for i in pick], stats[pick])
            out, sums = machine.raw(ids, x, starts)
            error = 1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[pick]
            owner = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(ids))))
            e = error[owner] * x / len(pick)
            grad_v = e[:, None] * (sums[owner] - machine.v[ids] * x[:, None])
            touched, place = np.unique(ids, return_inverse=True)
            dw = np.bincount(place, weights=e, minlength=len(touched)) + decay * machine.w[touched]
            dv = np.stack([np.bincount(place, weights=grad_v[:, f], minlength=len(touched)) for f in range(RANK)], axis=1)
            dv += decay * machine.v[touched]
            d0 = error.mean()
            g0 += d0 * d0
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            machine.w0 -= rate * d0 / math.sqrt(g0)
            machine.w[touched] -= rate * dw / np.sqrt(gw[touched])
            machine.v[touched] -= rate * dv / np.sqrt(gv[touched])
    return machine


def is_held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLD == 0


def _inputs(docs: DataFrame, key: str, text: str) -> DataFrame:
    declared = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), declared.alias("declared"),
        is_held_out(key).alias("held_out"),
    )


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> Machine:
    """Fit on at most ``limit`` labelled documents that are not held out."""
    known = labels.filter(F.col("quality").isNotNull() & F.col(key).isNotNull() & ~is_held_out(key))
    sample = known.select(key, F.col("quality").cast("int").alias("quality"))
    sample = sample.orderBy(F.xxhash64(key), key, "quality").limit(limit).withColumnRenamed(key, "key")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = WordSlots()
        for batch in batches:
            found = [describe(t, d, slots) for t, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.tolist() for w, _ in found], pa.list_(pa.int32())),
                 pa.array([s for _, s in found], pa.list_(pa.float64())), batch.column(3)],
                ["key", "words", "stats", "quality"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = _inputs(docs, key, text).join(sample, "key").select("key", "text", "declared", "quality").mapInArrow(
        featurise, f"key {kind}, words array<int>, stats array<double>, quality int"
    ).toArrow()
    data = rows.sort_by([("key", "ascending"), ("quality", "ascending")]).to_pydict()
    stats = np.array(data["stats"], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit([np.array(w, dtype=np.int64) for w in data["words"]], stats, np.array(data["quality"], dtype=float))


def score(docs: DataFrame, machine: Machine, cutoff: float = CUTOFF, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, held_out, score, predicted``. No shuffle.

    Whole texts are read. NULL and empty texts are scored by their statistics; a missing or NULL ``n_chars``
    counts as the text's length; repeated rows score alike; other columns are not read; an empty table gives
    an empty table. The model has a fixed size and goes to the executors with the function.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = WordSlots()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [describe(t, d, slots) for t, d in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                scores = machine.score([w for w, _ in found], np.array([s for _, s in found]).reshape(len(found), -1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(3), pa.array(scores, pa.float64()),
                     pa.array((scores >= cutoff).astype(np.int32), pa.int32())],
                    [key, "held_out", "score", "predicted"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return _inputs(docs, key, text).mapInArrow(apply, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
