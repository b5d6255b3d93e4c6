"""Helpers shared by the operators: reading tables, words, shingle hashes, scratch tables."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.plans.store import scratch_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_list(text: Column) -> Column:
    """The words of a text, in order; an empty array for a NULL, empty or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITE)
    return F.filter(parts, lambda w: w != "")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """The table with those of its columns renamed that an operator uses names of, and the new names by the old ones."""
    renamed: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in names:
            renamed[c] = unused(df, f"{c}_given")
            df = df.withColumnRenamed(c, renamed[c])
    return df, renamed


def unshielded(df: DataFrame, renamed: dict[str, str]) -> DataFrame:
    back = {new: old for old, new in renamed.items()}
    return df.toDF(*[back.get(c, c) for c in df.columns])


class Workspace:
    """Written tables of one operator run, in the folder all executors share.

    ``keep`` writes a frame and reads it back, which cuts its lineage: a lost executor never repeats
    finished work. ``drop`` deletes a table that no later step reads, ``close`` all of them. What is left goes when the
    driver's Python ends, since a result may read it until then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._close_quietly)

    def close(self) -> None:
        self.delete(self.root)

    def _close_quietly(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone
            self.close()

    def path(self, name: str = "") -> str:
        return f"{self.root}/{name or uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._workspace_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self.delete(df._workspace_path)

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


Keep = Callable[[DataFrame], DataFrame]

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of a well-known public generator)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hash of a word, worked out once per task; the memory is emptied when it grows large."""

    def __init__(self, limit: int = 2_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, in text order; fewer words count as one run."""
    if not len(words):
        return words
    k = min(size, len(words))
    h = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = mix64(h + words[i : len(words) - k + 1 + i])
    return h


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of ``shingle_runs``, ascending."""
    return np.unique(shingle_runs(words, size))


# hashes of all words of a batch at once: a polynomial over a random value of each byte, from a word's first byte on
_CHUNK = 1 << 17
_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]  # A-Z count as a-z


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE, _CHUNK + 1), _powers(pow(_BASE, -1, 1 << 64), _CHUNK + 1)


def text_pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``bytes, ends`` of the texts of a column without NULLs, about ``_PIECE`` bytes at a time, whole texts each."""
    raw = column.cast(pa.binary())
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
    if not len(raw):
        return
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(raw):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _PIECE, side="right")) - 1)
        yield data[ends[at] : ends[to]], (ends[at + 1 : to + 1] - ends[at]).astype(np.int64)
        at = to


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z as a-z) of some texts, in order, and where each text's words end."""
    inside = ~_BLANK[data]
    cut = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    cut[ends] = True
    cut[0] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
    first = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.append(inside[1:], False) if len(data) else inside
    last = np.flatnonzero(inside & (~after | cut[1:])) + 1
    out = np.empty(len(first), dtype=np.uint64)
    at = 0
    while at < len(first):
        begin = first[at]
        to = max(at + 1, int(np.searchsorted(last, begin + _CHUNK, side="right")))
        size = last[to - 1] - begin
        up, down = (_UP, _DOWN) if size <= _CHUNK else (_powers(_BASE, size), _DOWN)  # a word longer than a chunk, alone
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data[begin : begin + size]] * up[:size], out=total[1:])
        a, b = first[at:to] - begin, last[at:to] - begin
        out[at:to] = mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        at = to
    return out, np.searchsorted(first, ends)


def text_runs(words: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, in order, and where each text's runs end; a text of fewer words is one run."""
    begins = np.concatenate([[0], ends[:-1]])
    count = ends - begins
    value = np.zeros(len(words), dtype=np.uint64)
    used = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) >= size:
        full = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            full = mix64(full + words[i : len(words) - size + 1 + i])
        value[: len(full)] = full
    long, short = count >= size, (count > 0) & (count < size)
    np.add.at(used, begins[long], 1)
    np.add.at(used, ends[long] - size + 1, -1)
    use = np.cumsum(used[:-1]) > 0
    if short.any():
        at, n = begins[short], count[short]
        h = n.astype(np.uint64)
        for i in range(size - 1):
            some = n > i
            h[some] = mix64(h[some] + words[at[some] + i])
        value[at], use[at] = h, True
    return value[use], np.cumsum(np.where(long, count - size + 1, short))


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the distinct hashes of its runs, ascending."""
    for data, ends in text_pieces(column):
        runs, run_ends = text_runs(*word_hashes(data, ends), size)
        begin = 0
        for end in run_ends.tolist():
            own = runs[begin:end]
            own.sort()
            fresh = np.ones(len(own), dtype=bool)
            fresh[1:] = own[1:] != own[:-1]
            yield own[fresh]
            begin = end
