"""URL verdicts: host and path rules first, then a character language-model ratio.

Two smoothed Markov models of variable order, one of URLs the rules accept and one of URLs they reject, score the
rest. A symbol is predicted from up to three symbols before it; orders are blended by how often and how
variously a context was seen. The verdict is the difference of the two log-likelihoods per symbol against
a cut that is calibrated on URLs left out of the counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import ascii_lower, table

# (host, beginning of the path, verdict); a rule holds for the host and everything below it
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
ALLOW, BLOCK = "allow", "block"

# symbols of a URL; 0 stands before it, 1 after it, 2 for every other character
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789./-_%:@~+=&"
SIZE = len(SYMBOLS) + 3
ORDER = 3
FOLDS = 5
BINS, BIN_RANGE = 512, 4.0

_CODES = np.full(256, 2, dtype=np.int64)
for _i, _c in enumerate(SYMBOLS):
    _CODES[ord(_c)] = _i + 3


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; and what follows up
    to ``?`` or ``#``. Both are empty where there is no ``://`` or no URL."""
    known = F.coalesce(url, F.lit(""))
    found = F.when(F.contains(known, F.lit("://")), known).otherwise("")
    host = F.regexp_extract(found, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(found, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; of two of one length the first in the list. NULL where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for where, begin, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == where) | F.endswith(host, F.lit(f".{where}"))) & F.startswith(path, F.lit(begin))
        rule = F.when(fits, F.lit(where + begin)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def symbols(text: str) -> np.ndarray:
    """Symbol numbers of a URL between its begin and end marks."""
    codes = _CODES[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    return np.concatenate([np.zeros(ORDER, np.int64), codes, [1]])


def grams(texts: list[str], order: int) -> np.ndarray:
    """Codes of every symbol with the ``order`` symbols before it, over all texts."""
    out = []
    for text in texts:
        s = symbols(text)
        code = np.zeros(len(s) - ORDER, dtype=np.int64)
        for back in range(order, -1, -1):
            code = code * SIZE + s[ORDER - back : len(s) - back]
        out.append(code)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


@dataclass
class Model:
    """Counts of every order: the codes that were seen, ascending, with their counts. A flat array of the counts of all
    ``SIZE ** (order + 1)`` codes is taken too."""

    counts: list[np.ndarray | tuple[np.ndarray, np.ndarray]]

    def tables(self) -> list[tuple[np.ndarray, ...]]:
        """Of every order the codes with their counts, and the contexts with their totals and kinds of symbols."""
        out = []
        for counts in self.counts:
            codes, times = counts if isinstance(counts, tuple) else (np.flatnonzero(counts), counts[counts > 0])
            contexts, first, kinds = np.unique(codes // SIZE, return_index=True, return_counts=True)
            totals = np.add.reduceat(times, first) if len(first) else times
            out.append((codes, times, contexts, totals, kinds))
        return out


def _counted(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The values of some keys, which are ascending; 0 for a key that is missing."""
    if not len(keys):
        return [np.zeros(len(wanted), dtype=np.int64) for _ in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return [np.where(known, v[at], 0) for v in values]


def log_likelihood(s: np.ndarray, tables: list) -> np.ndarray:
    """Natural log probability of each symbol after the begin marks, orders blended from the lowest up."""
    p = np.full(len(s) - ORDER, 1.0 / SIZE)
    for order, (codes, times, contexts, totals, kinds) in enumerate(tables):
        context = np.zeros(len(s) - ORDER, dtype=np.int64)
        for back in range(order, 0, -1):
            context = context * SIZE + s[ORDER - back : len(s) - back]
        seen, various = _counted(contexts, context, totals, kinds)
        (here,) = _counted(codes, context * SIZE + s[ORDER:], times)
        p = np.where(seen > 0, (here + various * p) / np.maximum(seen + various, 1), p)
    return np.log(p)


def ratio(text: str, good: list, bad: list) -> float:
    """Log-likelihood difference per symbol: above 0 where the URL reads more like the accepted ones."""
    s = symbols(text)
    return float((log_likelihood(s, good) - log_likelihood(s, bad)).mean())


def fold_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % FOLDS


def count_grams(ruled: DataFrame) -> tuple[Model, Model, Model, Model]:
    """Counts over all URLs with a rule: accepted and rejected, without the left-out fold, then with it.

    Tasks send the grams they saw with their counts, and only grams that were seen are kept.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[int, int], list[str]] = {}
            for text, verdict in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups.setdefault((int(verdict == ALLOW), int(fold_of(text) == 0)), []).append(text)
            for (good, left_out), texts in groups.items():
                for order in range(ORDER + 1):
                    codes, times = np.unique(grams(texts, order), return_counts=True)
                    n = len(codes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, v, dtype=np.int32)) for v in (good, left_out, order)] + [pa.array(codes), pa.array(times)],
                        ["good", "left_out", "gram_order", "code", "times"],
                    )

    rows = ruled.select("address", "verdict").mapInArrow(
        count, "good int, left_out int, gram_order int, code long, times long"
    ).groupBy("good", "left_out", "gram_order", "code").agg(F.sum("times").alias("times")).toArrow()
    good, left_out, order, code, times = (rows.column(i).to_numpy() for i in range(5))

    def model(which: int, folds: tuple[int, ...]) -> Model:
        seen = []
        for k in range(ORDER + 1):
            use = (good == which) & np.isin(left_out, folds) & (order == k)
            codes, at = np.unique(code[use], return_inverse=True)
            seen.append((codes, np.bincount(at, weights=times[use], minlength=len(codes)).astype(np.int64)))
        return Model(seen)

    return model(1, (0,)), model(0, (0,)), model(1, (0, 1)), model(0, (0, 1))


def calibrated_cut(ruled: DataFrame, good: Model, bad: Model) -> float:
    """The cut that tells left-out accepted URLs from rejected ones best (mean of both shares). 0 where a class is
    missing; of equally good cuts the middle one."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, b = good.tables(), bad.tables()
        bins = np.zeros((2, BINS), dtype=np.int64)
        for batch in batches:
            for text, verdict in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if fold_of(text) == 0:
                    at = int((ratio(text, g, b) + BIN_RANGE) / (2 * BIN_RANGE) * BINS)
                    bins[int(verdict == ALLOW), min(max(at, 0), BINS - 1)] += 1
        kind, at = np.nonzero(bins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(bins[kind, at])], ["good", "bin", "times"]
        )

    rows = ruled.select("address", "verdict").mapInArrow(histogram, "good int, bin int, times long")
    rows = rows.groupBy("good", "bin").agg(F.sum("times").alias("times")).toArrow()
    bins = np.zeros((2, BINS))
    kind, at, times = (rows.column(i).to_numpy() for i in range(3))
    bins[kind, at] = times
    if not bins.sum(axis=1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(bins, axis=1)], axis=1) / bins.sum(axis=1, keepdims=True)
    quality = below[0] + 1 - below[1]  # rejected below the cut, accepted not
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    return float(best[len(best) // 2] / BINS * 2 * BIN_RANGE - BIN_RANGE)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: ``key, host, path, rule, verdict, ratio``. No shuffle of pages.

    The longest rule decides; ``rule`` is NULL where the models do, and ``ratio`` their log-likelihood difference per
    symbol. Without URLs of both verdicts among the ruled ones, the models say 0 and allow. NULL URLs and such
    without ``://`` have an empty host and path and are judged like any other; repeated rows are judged
    alike and count as often as they occur; other columns are not read; an empty table gives an empty table.
    """
    host, path = parts(F.col(url))
    split = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = split.withColumns({"rule": rule, "verdict": verdict, "address": F.concat("host", "path")})
    ruled = split.filter(F.col("verdict").isNotNull())
    some_good, some_bad, good, bad = count_grams(ruled)
    both = bool(len(good.counts[0][0]) and len(bad.counts[0][0]))
    cut = calibrated_cut(ruled, some_good, some_bad) if both else 0.0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, b = good.tables(), bad.tables()
        for batch in batches:
            values = [ratio(a, g, b) if both else 0.0 for a in batch.column(5).to_pylist()]
            said = [v or (ALLOW if x >= cut else BLOCK) for v, x in zip(batch.column(4).to_pylist(), values)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(said, pa.string()), pa.array(values, pa.float64())],
                [key, "host", "path", "rule", "verdict", "ratio"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return split.mapInArrow(score, f"`{key}` {kind}, host string, path string, rule string, verdict string, ratio double")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
