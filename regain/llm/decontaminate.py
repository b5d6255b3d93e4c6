"""Benchmark decontamination, built from DataFrame functions only.

Windows as long as a benchmark item are placed where a document has one of the item's shingles, and at its end. That is
enough: moving a window right past a shingle that is not the item's loses nothing. Windows of equal content are looked
at once. They are fingerprinted by SimHash, a shingle having a bounded number of votes. Fingerprints within the radius
have a block in which they differ by one bit at most (there are more than half as many blocks as the radius counts), so
items are listed under every value one bit from theirs and windows look up their own. Pairs within the radius are
verified by the exact similarity of their weighted shingles.

A pair that is similar enough can still lie beyond the radius, which is rare. With ``exact`` every window of a document
also meets every item whose shingles the document holds to the share a similar window must hold; then nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import Workspace, table, unused
from regain.llm.native import trimmed_words, with_shingles

SHINGLE = 5
SIMILAR_PCT = 80
PARTS = 4  # of 64 bits
RADIUS = 63  # of 256 bits: over four standard deviations beyond the mean distance at the least similarity
BLOCK_BITS = 8
BLOCKS = PARTS * 64 // BLOCK_BITS
NEAR_BITS = 1  # a block of two fingerprints within the radius differs by so many bits at most
VOTES = 2  # of a shingle that occurs more often
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
# item shingles are sent to every executor up to so many (8 bytes each), and joined by a shuffle beyond it
MAX_BROADCAST_SHINGLES = 1_000_000
FINGERPRINT = [f"fp{i}" for i in range(PARTS)]


def simhash64(hashes: str) -> Column:
    """64 majority bits over the hashes; a shingle that occurs twice counts twice."""
    n = F.size(hashes)

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda acc, h: acc + F.call_function("getbit", h, b))
        return F.when(ones * 2 > n, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", bit(b), b)),
    )


def with_simhash(df: DataFrame, hashes: str) -> DataFrame:
    """Adds ``fp0`` to ``fp3``: a fingerprint of 256 bits. A shingle has at most ``VOTES`` votes."""
    df = df.withColumn("_sorted", F.array_sort(hashes))
    before = F.expr(f"filter(_sorted, (h, i) -> i < {VOTES} OR h <> element_at(_sorted, greatest(1, i + 1 - {VOTES})))")
    df = df.withColumn("_votes0", before)

    def again(seed: int) -> Column:
        return F.transform("_votes0", lambda h: F.xxhash64(h, F.lit(seed)))

    df = df.withColumns({f"_votes{i}": again(i) for i in range(1, PARTS)})
    names = [f"_votes{i}" for i in range(PARTS)]
    return df.withColumns({fp: simhash64(v) for fp, v in zip(FINGERPRINT, names)}).drop("_sorted", *names)


def blocks() -> Column:
    """Generates ``block`` and ``bits``, the block numbers of a fingerprint and the bits there."""
    last, mask = 64 // BLOCK_BITS - 1, (1 << BLOCK_BITS) - 1
    parts = [f"transform(sequence(0, {last}), i -> shiftrightunsigned({fp}, i * {BLOCK_BITS}) & {mask})" for fp in FINGERPRINT]
    return F.posexplode(F.expr(f"flatten(array({', '.join(parts)}))")).alias("block", "bits")


def one_bit_away(bits: str) -> Column:
    """Generates the bits of a block and every value that differs from them in one bit."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(BLOCK_BITS)])
    return F.explode(F.transform(flips, lambda flip: F.col(bits).bitwiseXOR(flip))).alias(bits)


def numbered(hashes: Column) -> Column:
    """The hashes with their occurrence number: a set whose overlaps are overlaps of weights."""
    ordered = F.array_sort(hashes)
    return F.transform(ordered, lambda h, i: F.xxhash64(h, i - F.array_position(ordered, h)))


def leaks(
    docs: DataFrame, items: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text", exact: bool = False
) -> DataFrame:
    """``key, item_id, start, n_words, similarity``: the best window of each document for each item it repeats,
    where shared weight is at least 80 % of joint weight. Documents without such a window have no row. A window whose
    fingerprint is beyond the radius is not found, unless ``exact``.

    Words are runs of letters and digits, lower-cased. Items without words match nothing; items of fewer than
    five words are one shingle of their length. A document shorter than an item is one window. NULL and empty
    texts match nothing; rows that repeat a key, or an item's id, are judged by their own text and reported once, a NULL
    key or id as well; other columns are not read; empty tables give an empty result.
    """
    known = items.select("item_id", F.xxhash64("text").alias("item_row"), trimmed_words(F.lower("text"), BETWEEN_WORDS).alias("words")).filter(F.size("words") > 0)
    known = known.withColumn("n_words", F.size("words")).withColumn("k", F.least(F.lit(SHINGLE), F.col("n_words")))
    sizes = [r["k"] for r in known.select("k").distinct().orderBy("k").collect()]  # five values at most
    texts = docs.select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    found = None
    for k in sizes:
        part = _leaks_of_size(texts, with_shingles(known.filter(F.col("k") == k), "words", "shingles", k), k, work, exact)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
        empty = f"`{key}` {kind}, item_id {item_kind}, start int, n_words int, similarity double"
        return docs.sparkSession.createDataFrame([], empty)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n_words")).alias("best")
    return found.groupBy("doc", "item_id").agg(best).select(
        F.col("doc").alias(key), "item_id", (-F.col("best.s")).alias("start"), "best.n_words", "best.similarity"
    )


def _shingled(texts: DataFrame, k: int) -> DataFrame:
    return with_shingles(texts.withColumn("words", trimmed_words(F.lower("text"), BETWEEN_WORDS)), "words", "shingles", k)


def _held_items(spots: DataFrame, known: DataFrame) -> DataFrame:
    """``doc, row, item_id, item_row, n_words``: items of whose shingles a document holds enough for a similar window. What is
    shared is at most what it holds, and the joint weight is at least the item's."""
    item = ["item_id", "item_row", "n_words"]
    weights = known.select(*item, F.size("shingles").alias("size"), F.explode("shingles").alias("h"))
    weights = weights.groupBy(*item, "size", "h").agg(F.count("*").alias("weight"))
    held = spots.select("doc", "row", "h").distinct().join(weights, "h")
    held = held.groupBy("doc", "row", *item, "size").agg(F.sum("weight").alias("held"))
    return held.filter(F.col("held") * 100 >= F.col("size") * SIMILAR_PCT).select("doc", "row", *item)


def _leaks_of_size(texts: DataFrame, known: DataFrame, k: int, work: Workspace, exact: bool) -> DataFrame:
    known = work.keep(with_simhash(known.drop("words").dropDuplicates(["item_id", "item_row"]), "shingles"))
    places = work.keep(known.select("n_words", F.explode("shingles").alias("h")).distinct())
    wanted = work.keep(places.select(F.col("h").alias("wanted")).distinct())
    if wanted.count() <= MAX_BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    # "outer", or else a filter on the array's size would be pushed below and work the hashes out again
    spots = _shingled(texts, k).select("doc", "row", F.size("words").alias("doc_words"), F.posexplode_outer("shingles").alias("pos", "h"))
    spots = work.keep(spots.join(wanted, F.col("h") == F.col("wanted"), "left_semi"))
    whole = work.keep(_held_items(spots, known))
    # a document that holds too little of every item of a length needs no window of it
    kinds = whole.select(F.col("doc").alias("d"), F.col("row").alias("r"), "n_words").distinct()
    hits = spots.join(kinds, F.col("doc").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r"))).join(places, ["h", "n_words"])
    per_doc = work.keep(_starts(hits, k).groupBy("doc", "row").agg(F.collect_list(F.struct("n_words", "starts")).alias("windows")))
    per_doc = per_doc.select(F.col("doc").alias("d"), F.col("row").alias("r"), "windows")
    # joined before the shingles are worked out again, which few documents need
    here = texts.join(per_doc, F.col("doc").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
    cut = _shingled(here, k).select("doc", "row", "shingles", F.explode("windows").alias("w")).select(
        "doc", "row", "shingles", "w.n_words", F.explode("w.starts").alias("start")
    )
    cut = cut.withColumn("shingles", F.slice("shingles", F.col("start") + 1, F.greatest(F.lit(1), F.col("n_words") - (k - 1))))
    # windows of equal content (128 bits of it) are one
    content = ["n_words", "m1", "m2"]
    cut = work.keep(cut.withColumns({"m1": F.xxhash64("shingles"), "m2": F.xxhash64(F.lit(k), "shingles")}))
    marked = cut.groupBy(*content).agg(F.first("shingles").alias("shingles"))
    marked = work.keep(with_simhash(marked, "shingles"))
    pairs = _near(marked, known, content)
    if exact:
        held = whole.select(F.col("doc").alias("d"), F.col("row").alias("r"), F.col("n_words").alias("w"), "item_id", "item_row")
        same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")) & (F.col("n_words") == F.col("w"))
        pairs = pairs.union(cut.drop("shingles").join(held, same).select(*content, "item_id", "item_row")).distinct()
    of_item = known.select(F.col("item_id").alias("i"), F.col("item_row").alias("r"), numbered(F.col("shingles")).alias("theirs"))
    of_window = marked.select(*content, numbered(F.col("shingles")).alias("ours"))
    verified = pairs.join(of_item, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_row") == F.col("r"))).join(of_window, content)
    shared = F.size(F.array_intersect("ours", "theirs"))
    verified = verified.withColumn("shared", shared).withColumn("joint", F.size("ours") + F.size("theirs") - F.col("shared"))
    verified = verified.filter(F.col("shared") * 100 >= F.col("joint") * SIMILAR_PCT).select(
        *content, "item_id", (F.col("shared") / F.col("joint")).alias("similarity")
    )
    return cut.select("doc", "start", *content).join(work.keep(verified), content).select(
        "doc", "item_id", "start", "n_words", "similarity"
    )


def _starts(hits: DataFrame, k: int) -> DataFrame:
    """``doc, row, n_words, starts``: where windows of each length begin. Of the places of items' shingles those stay that
    have enough such places in their window: a similar window shares as many as 80 % of an item."""
    size = F.greatest(F.lit(1), F.col("n_words") - (k - 1))
    least = F.ceil(size * SIMILAR_PCT / 100).cast("int")
    last = F.greatest(F.lit(0), F.col("doc_words") - F.col("n_words"))
    placed = hits.groupBy("doc", "row", "n_words", "doc_words").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    placed = placed.withColumns({"size": size, "least": least, "last": last})
    inside = "filter(places, (p, i) -> p < last AND get(places, i + least - 1) < p + size)"
    at_end = "if(size(filter(places, p -> p >= last)) >= least, array(last), array())"
    return placed.select("doc", "row", "n_words", F.expr(f"concat({inside}, {at_end})").alias("starts")).filter(F.size("starts") > 0)


def _near(windows: DataFrame, items: DataFrame, content: list[str]) -> DataFrame:
    """``content, item_id, item_row`` of the windows and items of one length whose fingerprints are within the radius."""
    own = windows.select(*content, *FINGERPRINT, blocks())
    theirs = [F.col(fp).alias(f"item_{fp}") for fp in FINGERPRINT]
    listed = items.select("item_id", "item_row", "n_words", *FINGERPRINT, blocks()).select(
        "item_id", "item_row", "n_words", *theirs, "block", one_bit_away("bits")
    )
    apart = sum((F.bit_count(F.col(fp).bitwiseXOR(F.col(f"item_{fp}"))) for fp in FINGERPRINT), F.lit(0))
    return own.join(listed, ["n_words", "block", "bits"]).filter(apart <= RADIUS).select(*content, "item_id", "item_row").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, work: Workspace, key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that repeat a benchmark item; every column of the others as it is."""
    name = unused(docs, "_leak")
    bad = work.keep(leaks(docs, items, work, key).select(F.col(key).alias(name)).distinct())
    return docs.join(bad, F.col(key).eqNullSafe(F.col(name)), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op7"))
