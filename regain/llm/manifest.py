"""Merkle manifest of a table: a digest per row, one per language and one for everything, with inclusion proofs.

A level of a tree is one aggregate. Nodes are numbered within their group, eight consecutive ones have one parent,
and conditional aggregates spread a parent's children into eight columns (its slots). All columns in a row, hashed,
are the parent; all but the own slot are a node's siblings. Proofs go down the same levels: every row takes the path
of the row above it and puts its own siblings in front, so no node is sent to more than its eight children.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import Workspace, ascii_lower, table
from regain.operators.ranking import row_numbers

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"
TAMPERED_EVERY = 3


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts in a row; NULL parts add nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def encoded(column: Column) -> Column:
    """A value with its UTF-8 length in front, so that no two rows read the same; ``-`` for NULL."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return digest(*[encoded(fields[name]) for name in FIELDS])


@dataclass(frozen=True)
class Tree:
    """Trees over the rows of one table, one per ``group``.

    ``levels`` has one frame per level, from the leaves up: the group, ``n`` nodes of it at this level, the ``parent``
    that a row is, and its children in ``digest_0`` to ``digest_7``. ``tops`` has the group and its ``top``.
    """

    group: list[str]
    levels: list[DataFrame]
    tops: DataFrame


def _slots(name: str) -> list[str]:
    return [f"{name}_{k}" for k in range(FANOUT)]


def _parent_digest() -> Column:
    """What a level's row hashes to; a node alone in its group is not hashed again."""
    return F.when(F.col("n") == 1, F.col("digest_0")).otherwise(digest(*map(F.col, _slots("digest"))))


def _pivot(nodes: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    slot = F.col("pos") % FANOUT
    spread = [F.max(F.when(slot == k, F.col(c))).alias(f"{c}_{k}") for c in carried for k in range(FANOUT)]
    return nodes.groupBy(*group, F.floor(F.col("pos") / FANOUT).alias("parent")).agg(*spread)


def tree(nodes: DataFrame, group: list[str], work: Workspace, carried: tuple[str, ...] = ()) -> Tree:
    """Hash ``nodes`` (group, ``pos`` from 0, ``digest``, and what the leaves carry) up to one node per group."""
    counts = work.keep(nodes.groupBy(*group).agg(F.count("*").alias("n")))
    left = counts.agg(F.max("n")).first()[0] or 0
    levels = [work.keep(_pivot(nodes, group, ["digest", *carried]).join(counts, group))]
    while (left := -(-left // FANOUT)) > 1:
        below = levels[-1].filter(F.col("n") > FANOUT)
        fewer = F.floor((F.col("n") + (FANOUT - 1)) / FANOUT).alias("n")
        nodes = below.select(*group, fewer, F.col("parent").alias("pos"), _parent_digest().alias("digest"))
        levels.append(work.keep(_pivot(nodes, [*group, "n"], ["digest"])))
    tops = None
    for level in levels:
        ended = level.filter(F.col("n") <= FANOUT).select(*group, _parent_digest().alias("top"))
        tops = ended if tops is None else tops.unionByName(ended)
    return Tree(group, levels, work.keep(tops))


def _step(children: Column, slot: Column) -> Column:
    """The siblings on either side of a slot."""
    before = F.concat_ws("", F.slice(children, F.lit(1), slot))
    return F.struct(before.alias("before"), F.concat_ws("", F.slice(children, slot + 2, F.lit(FANOUT))).alias("after"))


def paths(grown: Tree, tops: DataFrame, work: Workspace) -> DataFrame:
    """The lowest level with the ``path`` from each of its rows (as a node) to the root.

    ``tops`` has, per group, the path from the group's top on and any other columns, which every row gets as well.
    """
    further = [c for c in tops.columns if c not in grown.group]
    rest = [c for c in further if c != "path"]
    above = None
    for depth, level in reversed(list(enumerate(grown.levels))):
        own = [c for c in level.columns if c not in grown.group]
        found = level.filter(F.col("n") <= FANOUT).join(tops, grown.group).select(*grown.group, *own, *further)
        if above is not None:
            over = above.select(
                *grown.group, F.col("parent").alias("_over"), F.array(*_slots("digest")).alias("_children"), *further
            ).withColumnRenamed("path", "_path")
            here = level.filter(F.col("n") > FANOUT).withColumn("_over", F.floor(F.col("parent") / FANOUT))
            here = here.join(over, [*grown.group, "_over"])
            step = _step(F.col("_children"), (F.col("parent") % FANOUT).cast("int"))
            here = here.withColumn("path", F.concat(F.array(step), F.col("_path")))
            found = found.unionByName(here.select(*grown.group, *own, *rest, "path"))
        above = work.keep(found) if depth else found
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a node's digest and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(s["before"], acc, s["after"]))


def _leaves_with_paths(grown: Tree, tops: DataFrame, carried: list[str], work: Workspace) -> DataFrame:
    lowest = paths(grown, tops, work)
    children = F.array(*_slots("digest"))
    steps = [F.when(F.col("n") > 1, F.array(_step(children, F.lit(k)))).otherwise(F.array().cast(PATH)) for k in range(FANOUT)]
    rows = [
        F.struct(*[F.col(f"{c}_{k}").alias(c) for c in ("digest", *carried)], F.concat(steps[k], "path").alias("path"))
        for k in range(FANOUT)
    ]
    further = [c for c in tops.columns if c != "path"]
    return lowest.select(*further, F.explode(F.array(*rows)).alias("_row")).select(*further, "_row.*").filter("digest IS NOT NULL")


def leaves(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``id, none, lang, digest, tampered``: every row's leaf, and the leaf of its tampered row where it was tampered with."""
    fields = {name: F.col(key if name == "doc_id" else name) for name in FIELDS}
    changed = leaf_digest(fields | {"text": ascii_lower(fields["text"])})
    hit = F.crc32(F.col(key).cast("string")) % TAMPERED_EVERY == 0
    return docs.select(
        F.col(key).alias("id"), F.col("lang").isNull().alias("none"), F.coalesce("lang", F.lit("")).alias("lang"),
        leaf_digest(fields).alias("digest"), F.when(hit, changed).alias("tampered"),
    )


def manifest(docs: DataFrame, work: Workspace, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of the row's id, source, language, ``n_chars`` and text. Leaves of a language stand by id (NULL
    last, equal ids by leaf; rows that are wholly equal have equal leaves and one proof each). Languages stand in order of
    their bytes, NULL, a language of its own, first. ``folded_root`` folds the leaf of what is there now with the
    siblings of what was recorded: rows whose id's CRC-32 is divisible by 3 have their text lower-cased (A-Z), the others
    are as recorded. A NULL id is not tampered with, nor is a NULL text, and a text without A-Z stays as it is and
    verifies. Empty texts are texts; other columns are not read; an empty table gives an empty table.
    """
    group = ["none", "lang"]
    rows = work.keep(leaves(docs, key))
    order = [F.col("id").asc_nulls_last(), F.col("digest")]
    placed = row_numbers(rows, group, order, "place", work.keep).withColumn("pos", F.col("place") - 1)
    by_lang = tree(placed, group, work, ("id", "tampered"))

    langs = by_lang.tops.select("none", "lang", F.col("top").alias("digest"))
    langs = row_numbers(langs, [], [F.col("none").desc(), F.col("lang")], "place", work.keep)
    over = tree(langs.withColumns({"pos": F.col("place") - 1, "all": F.lit(0)}), ["all"], work, ("none", "lang"))
    root = over.tops.select("all", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    tops = _leaves_with_paths(over, root, ["none", "lang"], work).select(
        "none", "lang", F.col("digest").alias("subroot"), "root", "path"
    )
    found = _leaves_with_paths(by_lang, work.keep(tops), ["id", "tampered"], work)
    siblings = F.flatten(F.transform("path", lambda s: F.array(s["before"], s["after"])))
    return found.select(
        F.col("id").alias(key), F.col("digest").alias("leaf"), "subroot", "root", digest(siblings).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), Workspace(spark, "op12"))


# Levels by recursion, a node's run as a list; CRC-32 bit by bit from its polynomial.
OP12_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
         list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c : ascii(c)::UBIGINT)),
           lambda a, b : list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i : 0::UBIGINT)),
             lambda x, y : CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)) AS crc
  FROM documents
), l AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295::UBIGINT) % 3 = 0 THEN sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) END AS bad
  FROM f
), p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM l
), t AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM p
  UNION ALL
  SELECT lang, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY lang, level, pos // 8, n
), s AS (
  SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY level, pos // 8, n
), runs AS (
  SELECT lang, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL
), w AS (
  SELECT p.doc_id, p.leaf, p.bad, p.pos AS spot, p.lang, s.height, s.pos AS top_at, s.subroot, 0 AS level,
         '' AS proof, coalesce(p.bad, p.leaf) AS folded, (SELECT h FROM u WHERE n = 1) AS root,
         s.height + (SELECT max(level) FROM u) AS steps
  FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT doc_id, leaf, bad, spot // 8, lang, height, top_at, subroot, level + 1,
         proof || array_to_string(hs[1:slot], '') || array_to_string(hs[slot + 2:], ''),
         sha256(array_to_string(hs[1:slot], '') || folded || array_to_string(hs[slot + 2:], '')), root, steps
  FROM (
    SELECT x.*, x.spot % 8 AS slot, runs.hs FROM (SELECT * FROM w WHERE level < height) AS x
    JOIN runs ON x.lang IS NOT DISTINCT FROM runs.lang AND runs.level = x.level AND runs.run = x.spot // 8
    UNION ALL
    SELECT x.*, (x.top_at >> (3 * (x.level - x.height))) % 8 AS slot, top_runs.hs
    FROM (SELECT * FROM w WHERE level >= height AND level < steps) AS x
    JOIN top_runs ON top_runs.level = x.level - x.height AND top_runs.run = x.top_at >> (3 * (x.level - x.height + 1))
  )
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM w WHERE level = steps
"""
