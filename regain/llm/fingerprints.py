"""Document fingerprints: threshold-scaled sketches, built from DataFrame functions only.

A sketch keeps every five-word shingle hash below a fixed fraction of the hash range, so sketches of
parts merge, and shares of one sketch in another estimate containment however unequal the documents are. Where no
hash is that low, the smallest one stands in, so a text with words never has an empty sketch; it goes when the sketch
is merged with one that has lower hashes, so a merged sketch is that of both documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regain.llm.common import Workspace, ascii_lower, table
from regain.llm.native import NO_LONGS, trimmed_words, with_shingles
from regain.operators.ranking import row_numbers

SHINGLE = 5
FRACTION = 8  # one hash in so many is kept
RANGES, ROWS_PER_RANGE = 512, 2048


def highest(fraction: int) -> int:
    """Hashes below this one, of signed 64 bits, are the lowest of so many."""
    return -(1 << 63) + (1 << 64) // fraction


def with_sketch(df: DataFrame, text: str, out: str, fraction: int = FRACTION, size: int = SHINGLE) -> DataFrame:
    """Adds ``out``: the sorted sketch of a whole text; empty where the text has no words."""
    words, runs = f"_{out}_text", f"_{out}_runs"
    df = df.withColumn(words, trimmed_words(ascii_lower(F.col(text))))
    df = with_shingles(df, words, runs, size).drop(words)
    low = F.filter(runs, lambda h: h < F.lit(highest(fraction)))
    least = F.when(F.size(runs) > 0, F.array(F.array_min(runs))).otherwise(F.array().cast(NO_LONGS))
    return df.withColumn(out, F.array_sort(F.array_union(low, least))).drop(runs)


def merged(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """The sketch of two documents taken together."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < F.lit(highest(fraction)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a`` found in ``b``; 1 where ``a`` is empty."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two empty sketches are alike."""
    union = F.size(a) + F.size(b) - F.size(F.array_intersect(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def as_text(sketch: Column) -> Column:
    """The hashes in hexadecimal, 16 digits each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_range(docs: DataFrame, key: str, ranges: int = RANGES, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``_part``: which range of the ascending key a row lies in; ranges have about equal rows.

    At most ``ranges`` bounds come from quantiles; with more rows each range is cut evenly into further parts.
    """
    rows = docs.count()
    ranges = max(1, min(ranges, rows // rows_per_range))
    bounds = docs.approxQuantile(key, [i / ranges for i in range(ranges + 1)], 0.2 / ranges) if rows else []
    bounds = sorted({int(b) for b in bounds}) or [0]
    cuts = F.array(*[F.lit(b) for b in bounds])
    place = F.size(F.filter(cuts, lambda b: b <= F.col(key)))
    pieces = max(1, rows // (ranges * rows_per_range))
    docs = docs.withColumn("_place", F.coalesce(place, F.lit(0)))
    if pieces == 1:
        return docs.withColumnRenamed("_place", "_part")
    low = F.get(cuts, F.col("_place") - 1)
    high = F.get(cuts, F.col("_place"))
    inside = F.coalesce(F.floor((F.col(key) - low) / (high - low) * pieces), F.lit(0))
    part = F.col("_place") * pieces + F.least(inside, F.lit(pieces - 1))
    return docs.withColumn("_part", part).drop("_place")


def with_next(docs: DataFrame, work: Workspace, key: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``next_text``: the text of the row that follows by ascending key (ties by text), round in a ring;
    and ``next_<c>`` for each column of ``extra``, NULL in the last row of a range.

    One shuffle of the texts, by range of the key. Only the first row of each range is looked up beside it.
    """
    if isinstance(docs.schema[key].dataType, T.NumericType):
        ranged = with_range(docs, key)
    else:  # ids that are no numbers get some, in their order
        known = docs.select(key).filter(F.col(key).isNotNull()).distinct()
        numbers = row_numbers(known, [], [F.col(key)], "_number", work.keep)
        ranged = with_range(docs.join(numbers, key, "left"), "_number").drop("_number")
    heads = work.keep(
        ranged.groupBy("_part").agg(F.min(key).alias("_head"), (F.count("*") - F.count(key)).alias("_nulls"))
    )
    # NULL keys sort first
    heads = heads.select("_part", F.when(F.col("_nulls") == 0, F.col("_head")).alias("_head"))
    ring = Window.orderBy("_part")
    following = heads.select(
        "_part",
        F.coalesce(F.lead("_part").over(ring), F.first("_part").over(ring)).alias("_next_part"),
    )
    firsts = (
        ranged.select(F.col(key).alias("_key"), F.col("_part").alias("_in"), "text")
        .join(heads, (F.col("_in") == F.col("_part")) & F.col("_key").eqNullSafe(F.col("_head")))
        .groupBy("_in").agg(F.min("text").alias("_first_text"))
    )
    after = following.join(firsts, F.col("_next_part") == F.col("_in")).select("_part", "_first_text")
    order = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_first(), F.col("text").asc())
    rows = ranged.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", *extra)})
    return (
        rows.join(after, "_part", "left")
        .withColumn("next_text", F.coalesce("next_text", "_first_text"))
        .drop("_part", "_first_text")
    )


def fingerprint_edits(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of an edited text, and how alike they are.

    The edited text has its last half (rounded down) replaced by as much of the next document's beginning.
    NULL and empty texts have no characters, the empty fingerprint, and an edited text that is empty; equal
    texts have equal fingerprints; rows with one key follow each other by text; a single document follows
    itself; other columns are not read; an empty table gives an empty table.
    """
    base = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(with_sketch(base, "text", "sketch"), work, "_id", ("sketch",))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("bigint"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    # only the last row of a range still needs its neighbour's sketch
    missing = F.when(F.col("next_sketch").isNull(), F.col("next_text"))
    rows = with_sketch(rows.withColumn("_missing", missing), "_missing", "_found").withColumn(
        "next_sketch", F.coalesce("next_sketch", "_found")
    )
    rows = with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        F.col("_id").alias(key), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"), Workspace(spark, "op9"))
