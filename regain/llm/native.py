"""Word shingles with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regain.llm.common import WHITE

BLANKS = " \t\n\x0b\x0c\r"
NO_LONGS = "array<bigint>"


def trimmed_words(text: Column, between: str = WHITE) -> Column:
    """The words of a text; an empty array where there are none."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{between}|{between}$", "") if between != WHITE else F.btrim(
        F.coalesce(text, F.lit("")), F.lit(BLANKS)
    )
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, between))


def with_shingles(df: DataFrame, words: str, out: str, size: int) -> DataFrame:
    """Adds ``out``: the hash of every run of ``size`` words, in text order; fewer words make one run.

    Every word is hashed once; a run's hash is the hash of its words' hashes.
    """
    hashes = f"_{out}_words"
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(hashes)
    runs = F.transform(
        F.sequence(F.lit(1), n - (size - 1)),
        lambda i: F.xxhash64(*[F.element_at(hashes, i + k) for k in range(size)]),
    )
    short = F.array(F.aggregate(hashes, F.lit(0).cast("bigint"), lambda acc, h: F.xxhash64(acc, h)))
    found = F.when(n >= size, runs).when(n > 0, short).otherwise(F.array().cast(NO_LONGS))
    return df.withColumn(out, found).drop(hashes)
