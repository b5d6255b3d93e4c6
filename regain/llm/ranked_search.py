"""Ranked lexical search by NRA (no random access): the best documents of each item, with exact integer scores.

Documents are indexed once, restricted to the terms of the items; the index is written and stays where it lies. Every
task cuts its documents into shards and sorts a shard's entries by term and impact. An item reads the lists of
its terms from the top, ever deeper. What was read of a document is its lower bound; every list where it has not been
seen adds, at most, the impact that comes next there, which gives the upper bound. Reading ends when every document
that can still reach the item's best ones, ties included, has a lower bound equal to its upper one. The best of a
shard set the bar for the task's next shard, and the best of all tasks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regain.llm.common import Workspace, table

TOP = 10
# items are taken in blocks of about so many (item, term) rows; a block's terms are sent to every task
BLOCK_TERMS = 1 << 18
# documents and index entries of a shard
SHARD_DOCS, SHARD_ENTRIES = 4096, 1 << 21
FIRST_READ = 32  # entries of each list; every further read is as deep as all before it
SCALE, STEEPNESS, FLAT = 1_000_000_000, 8, 75  # of the scoring formula

# letters and digits of ASCII (A-Z lower-cased) and every byte above it stay, all others part terms
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() and b < 0x80 and not 0x41 <= b <= 0x5A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM_BYTES).split()


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item, term, times``: a row repeated whole counts once, texts that share an id are one item."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in batches:
            at, words, times = [], [], []
            for k, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                for word, n in Counter(terms_of(raw)).items():
                    at.append(k)
                    words.append(word)
                    times.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(words, pa.binary()), pa.array(times, pa.int64())],
                ["item", "term", "times"],
            )

    kind = items.schema[item].dataType.simpleString()
    rows = items.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    return rows.mapInArrow(count, f"item {kind}, term binary, times long").groupBy("item", "term").agg(F.sum("times").alias("times"))


def term_index(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``id, n, terms, times`` of the documents with any term: all its terms counted, those of the vocabulary listed."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, ends, terms, times = [], [], [0], [], []
            for k, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms_of(raw)
                if not words:
                    continue
                known = [t for t in map(vocabulary.get, words) if t is not None]
                own, count = np.unique(np.array(known, dtype=np.int32), return_counts=True)
                at.append(k)
                sizes.append(len(words))
                terms.append(own)
                times.append(count)
                ends.append(ends[-1] + len(own))
            ends = pa.array(ends, pa.int32())
            terms, times = (np.concatenate(x) if x else np.zeros(0) for x in (terms, times))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64))),
                ],
                ["id", "n", "terms", "times"],
            )

    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInArrow(scan, f"id {kind}, n long, terms array<int>, times array<long>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 * N + 2) / (2 * df + 1))) of every term."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


@dataclass(frozen=True)
class Query:
    """One item: the terms by number, and how often each occurs."""

    terms: np.ndarray
    times: np.ndarray


@dataclass(frozen=True)
class Lists:
    """Impact-sorted lists of one shard: entry i is (``doc[i]``, ``impact[i]``); term t has those from ``begin[t]`` on."""

    docs: int
    doc: np.ndarray
    impact: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, times: np.ndarray, weight: np.ndarray, n_docs: int, words: int) -> Lists:
        """Of documents of ``sizes`` words whose entries end at ``ends``."""
        if int(sizes.max(initial=0)) * n_docs * FLAT >= 1 << 62:
            longer = np.array([FLAT * int(s) * n_docs // words for s in sizes], dtype=np.int64)
        else:
            longer = FLAT * sizes * n_docs // words
        m = 100 - FLAT + longer
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        impact = weight[terms] * ((SCALE * times) // (1000 * times + STEEPNESS * m[doc]))
        order = np.lexsort((-impact, terms))
        begin = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        return cls(len(sizes), doc[order], impact[order], begin)


def best_of(lists: Lists, query: Query, top: int, bar: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``top`` best, by score and then number, leaving out scores under ``bar``."""
    begin = lists.begin[query.terms]
    length = lists.begin[query.terms + 1] - begin
    some = length > 0
    begin, length, times = begin[some], length[some], query.times[some]
    lower = np.zeros(lists.docs, dtype=np.int64)
    read_doc, read_term = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, FIRST_READ
    while True:
        take = np.clip(length - depth, 0, step)
        term = np.repeat(np.arange(len(take)), take)
        entry = np.arange(len(term)) + np.repeat(begin + depth - np.cumsum(take) + take, take)
        doc = lists.doc[entry]
        np.add.at(lower, doc, lists.impact[entry] * times[term])
        read_doc, read_term = np.concatenate([read_doc, doc]), np.concatenate([read_term, term])
        depth += step
        step = depth
        unread = length > depth
        heads = np.zeros(len(length), dtype=np.int64)  # the most that an unseen document can get from each list
        heads[unread] = lists.impact[begin[unread] + depth] * times[unread]
        upper = lower + heads.sum()
        np.subtract.at(upper, read_doc, heads[read_term])
        if lists.docs > top:
            bar = max(bar, int(np.partition(lower, lists.docs - top)[lists.docs - top]))
        if not ((upper >= bar) & (upper > lower)).any():
            break
    found = np.flatnonzero(lower >= bar)
    found = found[np.lexsort((found, -lower[found]))][:top]
    return found, lower[found]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole batches, cut into pieces of bounded documents and entries, sorted by id (NULL last)."""
    waiting, docs, entries = [], 0, 0

    def shard() -> pa.Table:
        found = pa.Table.from_batches(waiting).combine_chunks()
        return found.take(pc.sort_indices(found, sort_keys=[("id", "ascending")]))

    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            room = min(SHARD_DOCS - docs, int(np.searchsorted(ends[at:], before + SHARD_ENTRIES - entries, side="right")))
            if room <= 0 and not docs:
                room = 1  # a document alone, whatever its size
            if room > 0:
                piece = batch.slice(at, room)
                waiting.append(piece)
                at += piece.num_rows
                docs += piece.num_rows
                entries += int(ends[at - 1] - before)
            if at < batch.num_rows:
                yield shard()
                waiting, docs, entries = [], 0, 0
    if waiting:
        yield shard()


def _scored(index: DataFrame, queries: list[Query], weight: np.ndarray, n_docs: int, words: int, top: int) -> DataFrame:
    """``query, id, score``: the best of every task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in queries]
        for shard in _shards(batches):
            ids = shard.column("id").to_pylist()
            terms, times = (shard.column(c).combine_chunks() for c in ("terms", "times"))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))])
            lists = Lists.of(
                shard.column("n").to_numpy(), ends, terms.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy(),
                weight, n_docs, words,
            )
            for k, query in enumerate(queries):
                bar = best[k][-1][0] if len(best[k]) == top else 1
                found, scores = best_of(lists, query, top, bar)
                if len(found):
                    best[k] += [(s, ids[d]) for d, s in zip(found.tolist(), scores.tolist())]
                    best[k].sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    del best[k][top:]
        rows = [(k, key, score) for k, own in enumerate(best) for score, key in own]
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], ["query", "id", "score"]
            )

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(index.schema["id"].dataType)
    name = index.schema["id"].dataType.simpleString()
    found = index.mapInArrow(search, f"query int, id {name}, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    # many tasks' best are thinned out before an item's meet in one place
    found = found.withColumn("part", F.spark_partition_id() % 64)
    for place in (["query", "part"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*place).orderBy(*order))).filter(F.col("rank") <= top)
    return found.select("query", "rank", "id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, work: Workspace, key: str = "doc_id", item: str = "item_id", text: str = "text", top: int = TOP
) -> DataFrame:
    """``item, rank, key, score``: for each item the ``top`` documents with the highest score above 0.

    Terms are runs of ASCII letters (lower-cased), digits and characters beyond ASCII, in whole texts. NULL and empty
    texts have none; they do not count as documents, and such items have no rows. Equal scores stand by id, NULL last.
    Rows that repeat an id are documents of their own; items that share an id are one item with all their terms, a
    repeated row counting once. Other columns are not read; an empty table gives an empty result.
    """
    asked = work.keep(item_terms(items, item, text))
    blocks = max(1, -(-asked.count() // BLOCK_TERMS))
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"`{item}` {kinds[1]}, rank int, `{key}` {kinds[0]}, score long")
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "term").toArrow().to_pylist()
        vocabulary = {term: k for k, term in enumerate(sorted({r["term"] for r in rows}))}
        names = list(dict.fromkeys(r["item"] for r in rows))
        own: dict = {name: ([], []) for name in names}
        for r in rows:
            own[r["item"]][0].append(vocabulary[r["term"]])
            own[r["item"]][1].append(r["times"])
        queries = [Query(np.array(own[n][0], dtype=np.int64), np.array(own[n][1], dtype=np.int64)) for n in names]
        index = work.keep(term_index(docs, vocabulary, key, text))
        size = index.agg(F.count("*"), F.sum("n")).first()
        if not size[0] or not names:
            continue
        df = np.zeros(len(vocabulary), dtype=np.int64)
        counts = index.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # a row per term of the block
        df[counts.column("t").to_numpy()] = counts.column("count").to_numpy()
        found = _scored(index, queries, weights(size[0], df), size[0], size[1], top)
        named = docs.sparkSession.createDataFrame([(k, n) for k, n in enumerate(names)], f"query int, `{item}` {kinds[1]}")
        out = out.unionByName(found.join(named, "query").select(item, "rank", F.col("id").alias(key), "score"))
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op13"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), n AS (
  SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), a AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d SEMI JOIN q USING (term) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, a GROUP BY term, docs
), s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), a GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
