"""Exact Jaccard self-join on word n-grams: the document by n-gram matrix times its transpose, in blocks.

Columns are put in one global order, rare n-grams by hash first and common ones last. Two sets that
are similar enough must meet in the first few columns of both (the block whose size the set size gives),
so only that block is multiplied. Overlap counts of the block are added up per pair, and a pair goes where
the count, even with everything outside the block, cannot reach the bound its sizes give. What is left is
counted on the whole sets.

Columns that very many documents share even so belong to groups of near copies. Such a column's members are
first compared with one central document, round by round, until few pairs lie in different components. Of
those pairs only the ones are made whose places in the column leave room for enough shared n-grams.

All links of a document are counted afterwards: they lie inside its component, whose whole sets are multiplied
chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import Workspace, table, text_pieces, text_runs, text_sets, unused, word_hashes
from regain.llm.components import components

SHINGLE = 5
SIMILAR_PCT = 80
# columns with more documents than this are not multiplied out: few of their pairs are made
LONG_COLUMN = 32
# pairs of long columns, for each entry of the block: so few are left at once to the product, and so many only if a
# round of comparing with central documents hardly brings them down (they are looked at there, but few are made)
FEW_PAIRS, MOST_PAIRS = 1, 256
# n-grams put last: those that open so many blocks; the bound doubles until their number fits. Any choice of
# n-grams put last gives the same result, so this changes the work only.
COMMON, MAX_COMMON = 8, 1 << 17
NEAR = 32  # n-grams on either side
# ids are sent to every executor up to so many (8 bytes each), and joined by a shuffle beyond it
MAX_BROADCAST_IDS = 1_000_000
# a component is cut into chunks of about so many sets and so many n-grams, each multiplied with each
LINK_CHUNK, CHUNK_GRAMS = 512, 1 << 20
CELLS = 1 << 23  # of the matrix that is multiplied at once


def block_size(n: int) -> int:
    """Columns of a set of ``n`` that a similar set must share at least one of."""
    return n - -(-n * SIMILAR_PCT // 100) + 1


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _id_type(docs: DataFrame) -> str:
    return docs.schema["id"].dataType.simpleString()


def _arrays(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = _signed(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def common_ngrams(texts: DataFrame, work: Workspace) -> np.ndarray:
    """Hashes of n-grams that many documents share, at most ``MAX_COMMON`` of them, ascending.

    First those that open many blocks; then, since what many documents share is passages, those that are often
    found near them, wherever their hash puts them.
    """

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [s[: block_size(len(s))] if len(s) else s for s in text_sets(batch.column(1), SHINGLE)]
            yield pa.RecordBatch.from_arrays([_arrays(blocks)], ["grams"])

    first = _many(texts, opening, MAX_COMMON // 4, work)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data, ends in text_pieces(batch.column(1)):
                runs, ends = text_runs(*word_hashes(data, ends), SHINGLE)
                begins = np.concatenate([[0], ends[:-1]])
                at = np.flatnonzero(_member(first, runs))
                text = np.searchsorted(ends, at, side="right")
                marks = np.zeros(len(runs) + 1, dtype=np.int64)
                np.add.at(marks, np.maximum(at - NEAR, begins[text]), 1)
                np.add.at(marks, np.minimum(at + NEAR + 1, ends[text]), -1)
                near = np.cumsum(marks[:-1]) > 0
                found += [np.unique(runs[a:b][near[a:b]]) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([_arrays(found)], ["grams"])

    return np.union1d(first, _many(texts, beside, MAX_COMMON - len(first), work)) if len(first) else first


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def _many(texts: DataFrame, grams, limit: int, work: Workspace) -> np.ndarray:
    """The n-grams that ``grams`` gives for at least ``COMMON`` documents; the bound doubles until ``limit`` is kept."""
    counts = texts.mapInArrow(grams, "grams array<long>").select(F.explode("grams").alias("h")).groupBy("h").count()
    many = work.keep(counts.filter(F.col("count") >= COMMON))
    step = F.floor(F.log2(F.col("count") / COMMON))
    steps = many.groupBy(step.alias("step")).count().collect()  # 60 rows at most
    least = 0
    while sum(r["count"] for r in steps if r["step"] >= least) > limit:
        least += 1
    found = many.filter(step >= least).select("h").toArrow()
    work.drop(many)
    return np.sort(found.column("h").to_numpy().view(np.uint64))


def block_sets(texts: DataFrame, common: np.ndarray) -> DataFrame:
    """``id, n, s1, s2, block``: set size, 128-bit signature of the set, and its first columns."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, marks, blocks = [], [], []
            for s in text_sets(batch.column(1), SHINGLE):
                sizes.append(len(s))
                marks.append(xxhash.xxh3_128_digest(s.tobytes()))
                last = _member(common, s)
                s = np.concatenate([s[~last], s[last]])
                blocks.append(s[: block_size(len(s))] if len(s) else s)
            halves = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), _arrays(blocks)],
                ["id", "n", "s1", "s2", "block"],
            )

    return texts.mapInArrow(cut, f"id {_id_type(texts)}, n long, s1 long, s2 long, block array<long>")


def whole_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, grams``: the whole sets of some documents."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _arrays(list(text_sets(batch.column(1), SHINGLE)))], ["id", "grams"])

    wanted = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    return texts.join(wanted, "id", "left_semi").mapInArrow(collect, f"id {_id_type(texts)}, grams array<long>")


def similar_sizes(n: str, m: str) -> Column:
    return (F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR_PCT) & (F.col(n) > 0)


def enough_shared(shared: Column, n: Column, m: Column) -> Column:
    """Whether sets of ``n`` and ``m`` that share so many are similar: ``shared >= pct * (n + m - shared)``."""
    return shared * (100 + SIMILAR_PCT) >= (n + m) * SIMILAR_PCT


def verified(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    left = grams.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = grams.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    joint = F.size("ga") + F.size("gb") - F.col("shared")
    return both.withColumn("shared", shared).filter(F.col("shared") * 100 >= joint * SIMILAR_PCT).select("a", "b")


def _labelled(rows: DataFrame, column: str, labels: DataFrame, out: str) -> DataFrame:
    named = labels.select(F.col("id").alias("_id"), F.col("component").alias("_c"))
    return rows.join(named, F.col(column) == F.col("_id"), "left").withColumn(out, F.coalesce("_c", column)).drop("_id", "_c")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    return _labelled(_labelled(pairs, "a", labels, "ca"), "b", labels, "cb").filter("ca <> cb").drop("ca", "cb")


def links(sets: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """Links ``a, b`` between different sets that join up exactly the components of all links.

    ``sets`` has one row per distinct set: ``id, n, block``.
    """
    entries = sets.select("id", "n", F.posexplode("block").alias("place", "h"))
    columns = entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    entries = work.keep(entries.join(columns, "h"))
    long = entries.filter(F.col("df") > LONG_COLUMN)
    in_long = work.keep(long.groupBy("id").agg(F.count("*").alias("long")))
    rest, found = _central_links(long.drop("df"), in_long, entries.count(), texts, work)
    labels = components(found, work)

    # the product of the block over short columns, for pairs in different components, and the bound
    here = _labelled(entries.filter(F.col("df") <= LONG_COLUMN), "id", labels, "c").join(in_long, "id", "left")
    a = here.select("h", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "c", "long")])
    b = here.select("h", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "c", "long")])
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("c_a") != F.col("c_b")) & similar_sizes("n_a", "n_b")
    key = ["id_a", "id_b", "n_a", "n_b", "long_a", "long_b"]
    overlaps = a.join(b, "h").filter(apart).groupBy(*key).agg(F.count("*").alias("overlap"))
    outside = F.ceil(F.greatest("n_a", "n_b") * SIMILAR_PCT / 100) - 1  # columns after the block
    in_both = F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    possible = enough_shared(F.col("overlap") + in_both + outside, F.col("n_a"), F.col("n_b"))
    likely = overlaps.filter(possible).select(
        F.col("id_a").alias("a"), F.col("id_b").alias("b"), (F.col("overlap") / F.least("n_a", "n_b")).alias("share")
    )
    likely = likely.union(_long_pairs(rest, labels).select("a", "b", F.lit(0.0)))
    likely = work.keep(likely.groupBy("a", "b").agg(F.max("share").alias("share")))
    grams = _grams_of(likely, texts, work)

    # each document's likeliest partner first, then pairs that are still apart
    first = likely.groupBy("a").agg(F.max_by("b", F.struct("share", "b")).alias("b")).union(
        likely.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a")).select("a", "b")
    )
    first = work.keep(first.distinct())
    found = work.keep(found.union(verified(first, grams)))
    rest = likely.join(first, ["a", "b"], "left_anti")
    return work.keep(found.union(verified(_apart(rest, components(found, work)), grams)))


def _grams_of(pairs: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    ids = work.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    return work.keep(whole_sets(texts, ids))


def _central_links(
    rest: DataFrame, in_long: DataFrame, entries: int, texts: DataFrame, work: Workspace
) -> tuple[DataFrame, DataFrame]:
    """Links found by comparing the members of long columns with a few of them, twice as many each round, until few pairs
    of long columns lie in different components; and the members not yet compared with all others."""
    rest = work.keep(rest)
    before, centres = float("inf"), 1
    found = work.keep(rest.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0))
    while True:
        here = work.keep(_labelled(rest, "id", components(found, work), "c"))
        sizes = here.groupBy("h", "c").agg(F.count("*").alias("k"))
        apart = sizes.groupBy("h").agg(((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("apart"))
        apart = work.keep(apart.filter("apart > 0"))
        rest = here.join(apart, "h", "left_semi").select(*rest.columns)
        left = apart.agg(F.sum("apart")).first()[0] or 0
        if left <= FEW_PAIRS * entries or (left <= MOST_PAIRS * entries and left > 0.8 * before):
            return rest, found
        before = left
        # of the members dealt to a centre, and of those of the smallest component, the one that shares most with others
        members = here.join(apart, "h", "left_semi").join(sizes, ["h", "c"]).join(in_long, "id")
        central = F.min_by(F.struct("id", "n", "c"), F.struct("k", -F.col("long"), "id")).alias("m")
        dealt = F.pmod(F.xxhash64("id", F.lit(centres)), F.lit(centres)).alias("centre")
        central = work.keep(members.groupBy("h", dealt).agg(central).select(
            "h", F.col("m.id").alias("b"), F.col("m.n").alias("nb"), F.col("m.c").alias("cb")
        ))
        one = here.select("h", F.col("id").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"))
        pairs = one.join(central, "h").filter((F.col("ca") != F.col("cb")) & similar_sizes("na", "nb"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = work.keep(pairs)
        found = work.keep(found.union(verified(pairs, _grams_of(pairs, texts, work))))
        centres *= 2
        rest = work.keep(rest.join(central.select("h", F.col("b").alias("id")), ["h", "id"], "left_anti").select(*rest.columns))


def _long_pairs(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of long columns that may link and lie in different components.

    The first column two sets share has none they share before it, so what they can share is what follows it in the
    smaller rest. Members of a column's largest component are not paired with each other.
    """
    here = _labelled(rest, "id", labels, "c")
    largest = here.groupBy("h", "c").agg(F.count("*").alias("k")).groupBy("h").agg(F.max_by("c", F.struct("k", "c")).alias("main"))
    here = here.join(largest, "h").withColumn("outer", F.col("c") != F.col("main"))
    a = here.filter("outer").select("h", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "place", "c")])
    b = here.select("h", "outer", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "c")])
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    once = ~F.col("outer") | (F.col("id_a") < F.col("id_b"))
    pairs = a.join(b, "h").filter(
        (F.col("c_a") != F.col("c_b")) & once & similar_sizes("n_a", "n_b") & enough_shared(room, F.col("n_a"), F.col("n_b"))
    )
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def _overlaps(sets: list[np.ndarray], left: int, cross: bool) -> np.ndarray:
    """How many n-grams each of the first ``left`` sets shares with each other one (``cross``) or among themselves."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number, several = np.cumsum(df > 1) - 1, df[at] > 1
    row, at = row[several], number[at[several]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    columns = int((df > 1).sum())
    width = max(1, min(columns, CELLS // len(sets)))
    out = np.zeros((left, len(sets) - left if cross else left), dtype=np.int64)
    for begin in range(0, columns, width):
        here = slice(*np.searchsorted(at, [begin, begin + width]))
        cells = np.zeros((len(sets), width), dtype=np.float32)
        cells[row[here], at[here] - begin] = 1
        out += (cells[:left] @ (cells[left:] if cross else cells).T).astype(np.int64)
    return out


def _links_of_chunks(key: tuple, group: pa.Table) -> pa.Table:
    """``s1, s2, links``: rows each set of two chunks links with in the other chunk, or in one chunk with itself."""
    cross = key[1].as_py() != key[2].as_py()
    kind = group.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
    first = group.column("chunk").to_numpy() == key[1].as_py()
    weight = group.column("rows").to_numpy()
    lists = group.column("grams").combine_chunks()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    sets = np.split(lists.flatten().to_numpy(), ends[:-1])
    order = np.lexsort([~first, kind])
    links = np.zeros(len(kind), dtype=np.int64)
    for rows in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        left = int(first[rows].sum()) if cross else len(rows)
        if left == 0 or len(rows) - left == 0 and (cross or left == 1):
            continue
        shared = _overlaps([sets[r] for r in rows], left, cross)
        a, b = rows[:left], rows[left:] if cross else rows
        sizes = np.array([len(sets[r]) for r in rows])
        joint = sizes[:left, None] + (sizes[left:] if cross else sizes)[None] - shared
        near = shared * 100 >= joint * SIMILAR_PCT
        if cross:
            links[b] += near.T @ weight[a]
        else:
            np.fill_diagonal(near, False)
        links[a] += near @ weight[b]
    return pa.table({"s1": group.column("s1"), "s2": group.column("s2"), "links": links})


def link_counts(classes: DataFrame, labels: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """``s1, s2, links``: the rows with another set that each distinct set links with.

    ``classes`` has one row per distinct set: ``s1, s2, n, rep, rows``. Sets are multiplied chunk by chunk, so no row
    is made per pair: a component of ``k`` sets is sent ``k / LINK_CHUNK`` times.
    """
    named = work.keep(_labelled(classes, "rep", labels, "component"))
    sizes = named.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("grams")).filter("k > 1")
    chunks = F.ceil(F.greatest(F.col("k") / LINK_CHUNK, F.col("grams") / CHUNK_GRAMS))
    sizes = work.keep(sizes.select("component", "grams", chunks.alias("chunks")))
    small = sizes.filter("chunks = 1").agg(F.sum("grams")).first()[0] or 0
    wanted = named.join(sizes.drop("grams"), "component").select(F.col("rep").alias("id"), "s1", "s2", "rows", "component", "chunks")
    wanted = work.keep(wanted)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sets = list(text_sets(batch.column(1), SHINGLE))
            halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(halves[:, 0]), pa.array(halves[:, 1]), _arrays(sets)], ["id", "s1", "s2", "grams"]
            )

    ids = wanted.select("id").distinct()
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    sets = texts.join(ids, "id", "left_semi").mapInArrow(collect, f"id {_id_type(texts)}, s1 long, s2 long, grams array<long>")
    sets = sets.join(wanted, ["id", "s1", "s2"]).dropDuplicates(["id", "s1", "s2"])  # rows with one id and one text
    # components of one chunk share tasks' groups, about CHUNK_GRAMS in each
    mark = F.xxhash64("component")
    group = F.when(F.col("chunks") == 1, F.pmod(mark, F.lit(small // CHUNK_GRAMS + 1))).otherwise(mark)
    chunk = F.pmod(F.xxhash64("s1", "s2"), F.col("chunks"))
    dealt = sets.withColumns({"group": group, "chunk": chunk}).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select(
        "group", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk",
        "component", "s1", "s2", "rows", "grams",
    )
    counted = dealt.groupBy("group", "low", "high").applyInArrow(_links_of_chunks, "s1 long, s2 long, links long")
    return work.keep(counted.groupBy("s1", "s2").agg(F.sum("links").alias("links")))


def _joined_up(docs: DataFrame, work: Workspace, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Texts, sets of all rows, distinct sets and the component of every id that links."""
    base = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sets = work.keep(block_sets(base, common_ngrams(base, work)))
    full = sets.filter((F.col("n") > 0) & F.col("id").isNotNull())
    classes = work.keep(full.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("rows")))
    members = full.select("id", "s1", "s2", "n").join(classes.filter("rows > 1"), ["s1", "s2", "n"]).select("id", "rep")
    members = work.keep(members)
    copies = members.filter("id <> rep").distinct()
    one_each = full.select("id", "n", "block").join(copies.select("id"), "id", "left_anti")
    # an id with several rows: each of its sets, and ties between them
    several = work.keep(full.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").select("id"))
    again = full.join(several, "id", "left_semi").select("id", "n", "block").dropDuplicates(["id", "n", "block"])
    one_each = one_each.join(several, "id", "left_anti").union(again)
    ties = members.join(several, "id", "left_semi").filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = links(one_each, base.filter(F.col("id").isNotNull()), work)
    labels = components(found.union(ties), work)
    named = _labelled(copies.join(several, "id", "left_anti"), "rep", labels, "component").select("id", "component")
    named = work.keep(named.union(labels))
    return base, sets, classes, named


def similar_documents(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, n_shingles, component_id``.

    Two documents link when at least 80 % of their joint distinct five-word shingles are shared; the component
    id is the smallest id that links lead to. A text of fewer than five words is one shingle; NULL, empty
    and blank texts have none and link with nothing. Equal sets are compared once. Rows with one id are one
    document: what links to any of them joins them all. Rows with a NULL id link with nothing and have a
    NULL component. Other columns are not read; an empty table gives an empty table.
    """
    _, sets, _, named = _joined_up(docs, work, key, text)
    out = sets.select(F.col("id"), "n").join(named, "id", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def linked_documents(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``similar_documents`` with ``n_links``: how many other documents a document links with, by its own text.

    Equal texts link with each other and count one by one. Every row with an id counts, also where rows repeat an
    id; rows without words or with a NULL id have no links.
    """
    base, sets, classes, named = _joined_up(docs, work, key, text)
    counts = link_counts(classes, named, base.filter(F.col("id").isNotNull()), work)
    totals = classes.join(counts, ["s1", "s2"], "left").select(
        "s1", "s2", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links")
    )
    totals = work.keep(totals.filter("n_links > 0"))
    out = sets.select("id", "n", "s1", "s2").join(totals, ["s1", "s2"], "left").join(named, "id", "left")
    linked = F.when(F.col("id").isNull() | (F.col("n") == 0), 0).otherwise(F.coalesce("n_links", F.lit(0)))
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        linked.cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, work: Workspace, key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; every column as it is."""
    gone = similar_documents(docs, work, key).filter(F.col("component_id") != F.col(key))
    name = unused(docs, "_gone")
    gone = work.keep(gone.select(F.col(key).alias(name)).distinct())
    return docs.join(gone, F.col(key) == F.col(name), "left_anti")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"), Workspace(spark, "op3"))


# all pairs that share a shingle, then reachability by recursion over the links
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i : array_to_string(words[i:i+4], ' '))) END AS grams
  FROM w
), g AS (
  SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
), c AS (
  SELECT gram FROM g GROUP BY gram HAVING count(*) > 1
), h AS (
  SELECT * FROM g SEMI JOIN c USING (gram)
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM h AS a JOIN h AS b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT a AS id, a AS reached FROM e
  UNION
  SELECT r.id, e.b FROM r JOIN e ON r.reached = e.a
)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(reached) FROM r WHERE r.id = s.doc_id), doc_id)) AS component_id,
       (SELECT count(*) FROM e WHERE e.a = s.doc_id) AS n_links
FROM s
"""
