"""Removal of long repeated strings by suffix arrays over shards.

Every string of ``LENGTH`` bytes has an anchor, a short byte run chosen by content alone (the smallest hash
in the string), so equal strings have equal anchors at the same place. Strings are dealt to shards by
anchor; a string that repeats nowhere else never leaves its document. A stretch of strings with one anchor
is a segment. Of equal segments (128 bits of their content) only the first goes on. The different segments of an
anchor go to its shard, where a suffix array is induced and permuted common prefixes tell which strings are equal.

Where an anchor has very many different segments, each is cut in two by the place of the anchor in its strings. The
strings of one half share more than the anchor: the bytes that all of them cover, wherever they begin. Those are the
half's own anchor, by which it is dealt anew; halves whose anchor occurs once are done with, equal halves become one, and
what is still too much for a shard is halved again. So every string is settled in a shard of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regain.llm.common import Workspace, mix64, shielded, table, unshielded
from regain.llm.suffix_array import permuted_common_prefixes, suffix_array
from regain.operators.ranking import row_numbers

LENGTH = 100
GRAM = 48  # bytes of an anchor: long enough that few repeat by chance
WINDOW = LENGTH - GRAM + 1  # anchors a string can choose from
BLOCK_BYTES = 1 << 17
# segments of an anchor that has more different ones than this are halved, and each half gets an anchor of its own
HOT_SEGMENTS = 512
SHARD_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))  # of the bytes


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE, BLOCK_BYTES + 1), _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES + 1)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at every place: a polynomial, from the difference of two running sums."""
    up, down = (_UP, _DOWN) if len(raw) < len(_UP) else (_powers(_BASE, len(raw)), _powers(pow(_BASE, -1, 1 << 64), len(raw)))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    values = _VALUES[raw]
    values *= up[: len(raw)]
    np.cumsum(values, out=total[1:])
    out = total[GRAM:] - total[:-GRAM]
    out *= down[: len(out)]
    return mix64(out)


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values."""
    n, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def segments(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of segments of some texts: ``block, owner, first string, strings, anchor hash, place in the block, place of
    the anchor in the first string``.

    Each string of ``LENGTH`` bytes lies in one segment. A text longer than a block is taken in blocks that
    overlap by a string, which may cut a segment in two.
    """
    waiting: list[tuple[int, int, bytes]] = []
    size = 0
    step = BLOCK_BYTES - LENGTH + 1
    for owner, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, step):
            piece = text[at : at + BLOCK_BYTES] if len(text) > BLOCK_BYTES else text
            if size + len(piece) > BLOCK_BYTES and waiting:
                yield _block(waiting)
                waiting, size = [], 0
            waiting.append((owner, at, piece))
            size += len(piece)
    if waiting:
        yield _block(waiting)


def _block(parts: list[tuple[int, int, bytes]]):
    block = b"".join(p for _, _, p in parts)
    raw = np.frombuffer(block, np.uint8)
    hashes = gram_hashes(raw)
    place_bits = np.uint64(20)
    keyed = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (least_in_window(keyed, WINDOW) & np.uint64((1 << 20) - 1)).astype(np.int64)
    lengths = np.array([len(p) for _, _, p in parts])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    change = np.ones(len(anchors), dtype=bool)
    change[1:] = anchors[1:] != anchors[:-1]
    change[begins] = True
    beyond = begins + lengths - LENGTH + 1  # behind the last string of a part
    change[beyond[beyond < len(anchors)]] = True
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(anchors)))
    part = np.searchsorted(begins, first, side="right") - 1
    keep = first < beyond[part]
    first, count, part = first[keep], count[keep], part[keep]
    owner = np.array([o for o, _, _ in parts])[part]
    start = first - begins[part] + np.array([a for _, a, _ in parts])[part]
    return block, owner, start, count, hashes[anchors[first]].view(np.int64), first, anchors[first] - first


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def with_order(docs: DataFrame, work: Workspace, key: str, text: str) -> tuple[DataFrame, bool]:
    """The rows with ``_ord``, a number that ascends with the key, and whether rows may share one.

    Unique whole numbers are their own order. Else different rows are numbered by key, of any type with an order (NULL
    last), then text; rows equal in both share a number and so are treated alike.
    """
    docs = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    repeated = docs.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count()
    if not repeated and isinstance(docs.schema[key].dataType, T.IntegralType):
        return docs.withColumn("_ord", F.col(key).cast("bigint")), False
    marked = docs.withColumn("_mark", F.xxhash64(text))
    rows = marked.select(F.col(key).alias("_key"), F.col("_mark").alias("_m")).distinct()
    order = [F.col("_key").asc_nulls_last(), F.col("_m")]
    numbers = work.keep(row_numbers(rows, [], order, "_ord", work.keep))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_mark") == F.col("_m"))
    return marked.join(numbers, same).drop("_key", "_m", "_mark"), True


def ordered_spans(docs: DataFrame, work: Workspace, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows with ``_ord``, and the spans to remove by ``_ord``. Rows that share a number are judged once."""
    rows, shared = with_order(docs, work, key, text)
    texts = rows.select("_ord", F.col(text).alias("text"))
    return rows, removed_spans(texts.dropDuplicates(["_ord"]) if shared else texts, work)


def repeated_places(texts: DataFrame) -> DataFrame:
    """``_ord, start`` of the segments whose anchor occurs more than once."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, h, _, _ in segments(_texts(batch, 1)):
                yield pa.RecordBatch.from_arrays([pa.array(h)], ["h"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = batch.column(0).to_numpy(zero_copy_only=False)
            for _, owner, start, _, h, _, _ in segments(_texts(batch, 1)):
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(orders[owner]), pa.array(start)], ["h", "_ord", "start"])

    again = texts.mapInArrow(anchors, "h long").groupBy("h").count().filter("count > 1").select("h")
    return texts.mapInArrow(places, "h long, _ord long, start long").join(again, "h", "left_semi").select("_ord", "start")


SEGMENT = "h long, d1 long, d2 long, _ord long, start long, strings long, place long, bytes binary"
_NAMES = ["h", "d1", "d2", "_ord", "start", "strings", "place", "bytes"]


def _segment_rows(h, orders, starts, strings, places, parts: list[bytes]) -> pa.RecordBatch:
    import xxhash

    marks = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), np.int64).reshape(-1, 2)
    columns = [h, marks[:, 0], marks[:, 1], orders, starts, strings, places]
    return pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.array(parts, pa.binary())], _NAMES)


def cut_segments(listed: DataFrame) -> DataFrame:
    """``h, d1, d2, _ord, start, strings, place, bytes``: the segments whose anchors are repeated."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = batch.column(0).to_numpy(zero_copy_only=False)
            wanted = batch.column(2).to_pylist()
            wanted = [np.sort(np.array(w, dtype=np.int64)) for w in wanted]
            for block, owner, start, count, h, first, place in segments(_texts(batch, 1)):
                repeated = np.zeros(len(start), dtype=bool)
                for o in np.unique(owner):
                    own = np.flatnonzero(owner == o)
                    at = np.searchsorted(wanted[o], start[own])
                    at[at == len(wanted[o])] = 0
                    repeated[own] = wanted[o][at] == start[own]
                use = np.flatnonzero(repeated)
                parts = [block[a : b + LENGTH - 1] for a, b in zip(first[use].tolist(), (first + count)[use].tolist())]
                yield _segment_rows(h[use], orders[owner[use]], start[use], count[use], place[use], parts)

    return listed.select("_ord", "text", "starts").mapInArrow(cut, SEGMENT)


def halved(found: DataFrame, width: int) -> DataFrame:
    """The segments cut where the anchor's place in their strings passes a multiple of ``width``.

    All strings of a cut whose anchor is at ``low`` to ``low + width - 1`` cover the bytes from ``low`` before the anchor
    on, ``LENGTH - width + 1`` of them: these are its new anchor. With a width of 1 that is the string itself.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            orders, starts, strings, places = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3))
            rows, parts = [], []
            for o, s, n, place, part in zip(orders.tolist(), starts.tolist(), strings.tolist(), places.tolist(), batch.column(4).to_pylist()):
                for low in range((place - n + 1) // width * width, place + 1, width):
                    j, k = max(0, place - low - width + 1), min(n - 1, place - low)  # strings of this cut
                    core = place - low
                    h = xxhash.xxh3_64_intdigest(part[core : core + LENGTH - width + 1], low)
                    rows.append((h, o, s + j, k - j + 1, place - j))
                    parts.append(part[j : k + LENGTH])
            if rows:
                h, o, s, n, place = zip(*rows)
                yield _segment_rows(np.array(h, dtype=np.uint64).view(np.int64), np.array(o), np.array(s), np.array(n), np.array(place), parts)

    return found.select("_ord", "start", "strings", "place", "bytes").mapInArrow(cut, SEGMENT)


def equal_strings(parts: list[bytes]) -> np.ndarray:
    """Places (in the parts joined with one byte between them) of strings that also begin earlier."""
    text = b"\xff".join(parts)
    symbols = np.empty(len(text) + 1, dtype=np.int64)
    symbols[:-1] = np.frombuffer(text, np.uint8)
    symbols[:-1] += 1
    symbols[-1] = 0
    array = suffix_array(symbols, 257, LENGTH)[1:]
    is_start = np.zeros(len(text), dtype=bool)
    at = 0
    for part in parts:
        is_start[at : at + len(part) - LENGTH + 1] = True
        at += len(part) + 1
    array = array[is_start[array]]
    common = permuted_common_prefixes(text, array, LENGTH)[array]
    group = np.cumsum(common < LENGTH) - 1
    if not len(array):
        return array
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    earliest = np.minimum.reduceat(array, heads)
    return np.sort(array[array != earliest[group]])


def shard_spans(shards: DataFrame) -> DataFrame:
    """``_ord, begin, end`` of bytes covered by repeated strings. An anchor's segments lie in one partition."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        got = got.sort_by([("h", "ascending"), ("_ord", "ascending"), ("start", "ascending")])
        h, orders, starts = (got.column(c).to_numpy() for c in ("h", "_ord", "start"))
        parts = got.column("bytes").to_pylist()
        ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h))
        sizes = np.cumsum([len(p) + 1 for p in parts])
        begin = 0
        while begin < len(h):  # whole anchors, up to a shard's bytes
            limit = (sizes[begin - 1] if begin else 0) + SHARD_BYTES
            k = np.searchsorted(ends, begin, side="right")
            fits = ends[k:][sizes[ends[k:] - 1] <= limit]
            end = int(fits[-1]) if len(fits) else int(ends[k])
            yield _solve_shard(parts[begin:end], orders[begin:end], starts[begin:end])
            begin = end

    return shards.select("h", "_ord", "start", "bytes").mapInArrow(solve, "_ord long, begin long, end long")


def _solve_shard(parts: list[bytes], orders: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Segments come by anchor; the suffix array runs over them in order of document and place."""
    order = np.lexsort((starts, orders))
    parts, orders, starts = [parts[i] for i in order], orders[order], starts[order]
    late = equal_strings(parts)
    offsets = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]])
    part = np.searchsorted(offsets, late, side="right") - 1
    place = starts[part] + late - offsets[part]
    fresh = np.ones(len(late), dtype=bool)
    fresh[1:] = (part[1:] != part[:-1]) | (late[1:] - late[:-1] > LENGTH)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:] - 1, len(late) - 1) if len(late) else first
    return pa.RecordBatch.from_arrays(
        [pa.array(orders[part[first]]), pa.array(place[first]), pa.array(place[last] + LENGTH)], ["_ord", "begin", "end"]
    )


def removed_spans(texts: DataFrame, work: Workspace) -> DataFrame:
    """``_ord, begin, end``: spans (they may overlap) of bytes covered by a string that begins earlier, too."""
    places = work.keep(repeated_places(texts))
    lists = work.keep(places.groupBy("_ord").agg(F.collect_list("start").alias("starts")))
    found = work.keep(cut_segments(texts.join(lists, "_ord")))
    work.drop(places, lists)
    spans, width = None, WINDOW
    while True:
        part, hot = _settled(found, work)
        spans = part if spans is None else spans.unionByName(part)
        if width == 1 or not hot.limit(1).count():
            work.drop(hot)
            return spans
        width = -(-width // 2)
        found = work.keep(halved(hot, width))
        work.drop(hot)


def _settled(found: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Spans of the segments that equal an earlier one and of those settled in shards; and the segments, one of each
    content, whose anchor has too many different ones for a shard. ``found`` is deleted as soon as it has been read."""
    key = ["h", "d1", "d2", "strings"]
    narrow = found.drop("bytes")
    earliest = F.min(F.struct("_ord", "start"))
    classes = work.keep(narrow.groupBy(*key).agg(earliest.alias("e"), F.count("*").alias("k")))
    late = narrow.join(classes.filter("k > 1"), key).filter(F.struct("_ord", "start") != F.col("e"))
    spans = late.select("_ord", F.col("start").alias("begin"), (F.col("start") + F.col("strings") + (LENGTH - 1)).alias("end"))
    kinds = classes.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    one_each = classes.join(kinds, "h").select("h", "kinds", F.col("e._ord").alias("_ord"), F.col("e.start").alias("start"))
    spans = work.keep(spans)
    apart = work.keep(found.select("h", "_ord", "start", "strings", "place", "bytes").join(one_each, ["h", "_ord", "start"]))
    work.drop(found, classes)
    cold = apart.filter(F.col("kinds") <= HOT_SEGMENTS)
    total = cold.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = cold.repartition(max(8, 2 * total // SHARD_BYTES), "h")
    spans = spans.unionByName(work.keep(shard_spans(shards)))
    hot = work.keep(apart.filter(F.col("kinds") > HOT_SEGMENTS).drop("h", "kinds"))
    work.drop(apart)
    return spans, hot


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))
    return out


def span_lists(column: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """The (begin, end) of each row, none for a NULL, without a dictionary for each."""
    begins, ends = (column.values.field(name).to_pylist() for name in ("begin", "end"))
    offsets = column.offsets.to_pylist()
    for a, b, known in zip(offsets, offsets[1:], column.is_valid().to_pylist()):
        yield list(zip(begins[a:b], ends[a:b])) if known else []


def cut_out(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for begin, end in runs:
        kept.append(text[at:begin])
        at = end
    kept.append(text[at:])
    return b"".join(kept)


def with_spans(texts: DataFrame, spans: DataFrame, work: Workspace) -> DataFrame:
    """The rows of ``texts`` with ``_spans``, an array of (begin, end), NULL where nothing is removed."""
    lists = work.keep(spans.groupBy("_ord").agg(F.collect_list(F.struct("begin", "end")).alias("_spans")))
    return texts.join(lists, "_ord", "left")


def removals(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte covered by a string of 100 bytes that also begins earlier (smaller id, or earlier in the
    document) counts as removed; strings are judged on the input. NULL and empty texts have no bytes; texts under
    100 bytes lose none; rows with one id are ordered by their text, equal rows are treated alike, and a NULL id
    comes last; other columns are not read; an empty table gives an empty table.
    """
    base, spans = ordered_spans(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), work, "id", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, found in zip(_texts(batch, 1), span_lists(batch.column(2))):
                runs = merge_spans(found)
                kept = cut_out(raw, runs)
                rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return with_spans(base, spans, work).select("id", "text", "_spans").mapInArrow(
        describe, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, work: Workspace, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text``; rows stay, also those left empty.

    A cut never splits a character: the rest of a character that is only partly repeated stays. ``n_chars``, where
    the table has it, is set to the new length; every other column and a NULL text stay as they are, whatever their names.
    """
    given, renamed = shielded(docs, ("_ord", "_null", "_spans", "_mark", "_key", "_m"))
    out = _without_repeats(given, work, renamed.get(key, key), renamed.get(text, text))
    return unshielded(out, renamed)


def _without_repeats(docs: DataFrame, work: Workspace, key: str, text: str) -> DataFrame:
    names = docs.columns
    marked, spans = ordered_spans(docs.withColumn("_null", F.col(text).isNull()), work, key, text)

    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for raw, some in zip(texts.cast(pa.binary()).to_pylist(), span_lists(found)):
            runs = []
            for begin, end in merge_spans(some):
                while begin < end and raw[begin] & 0xC0 == 0x80:
                    begin += 1
                while end > begin and end < len(raw) and raw[end] & 0xC0 == 0x80:
                    end -= 1
                runs.append((begin, end))
            out.append(cut_out(raw, runs).decode())
        return pa.array(out, pa.string())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = batch.schema.get_field_index(text), batch.column(batch.num_columns - 1)
            columns = list(batch.columns[:-1])
            columns[at] = cut(columns[at], found)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    joined = with_spans(marked, spans, work).select(*names, "_null", "_spans")
    schema = joined.drop("_spans").schema
    out = joined.mapInArrow(apply, schema)
    out = out.withColumn(text, F.when(~F.col("_null"), F.col(text))).drop("_null")
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length(text).cast(kind), F.col("n_chars")))
    return out


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents"), Workspace(spark, "op8"))


# every string of 100 bytes by its digest; spans are runs of late strings that touch
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), w AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d)
), l AS (
  SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1
), m AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM l)
), s AS (
  SELECT doc_id, run, min(p) AS b, max(p) + 100 AS e FROM m GROUP BY doc_id, run
), k AS (
  SELECT s.doc_id, run, b, e, substr(h, 2 * lag(e, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY run) + 1,
         2 * (b - lag(e, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY run))) AS kept
  FROM s JOIN d USING (doc_id)
), g AS (
  SELECT doc_id, sum(e - b) AS removed, count(*) AS spans, max(e) AS last, string_agg(kept, '' ORDER BY run) AS kept FROM k GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(g.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(g.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(g.kept, '') || substr(d.h, 2 * coalesce(g.last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
