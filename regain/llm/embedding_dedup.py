"""Near-duplicate vectors by product quantisation: coarse inverted lists, residual codes, exact cosine rerank.

Coarse centroids and one codebook per subspace are fitted on a bounded sample; every distinct vector is indexed: it
belongs to the list of its nearest centroid and carries the codes of its residual. A pair within the limit lies no
further from the plane between its two centroids than the limit's chord, so a vector probes the lists whose planes lie
within that chord, the nearest ``PROBES`` of them. A list's members and those who probe it meet in cells of bounded size.
In a cell, look-up tables give every product with the coded members; what the quantisation error (known per member and
subspace) leaves possible is compared exactly. Cells return counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import Workspace, table
from regain.llm.components import components

SIMILAR = 0.9
PROBES = 16
# numbers of the sample the index is fitted on (about 32,768 vectors of 64)
SAMPLE_VALUES = 1 << 21
MAX_LISTS = 4096
SUBSPACE, CODES = 8, 256
CELL = 8192  # members, and probing vectors, of a cell
AT_ONCE = 1 << 21  # entries of a product held at once


def usable(vector: Column) -> Column:
    """Not NULL or empty, every component finite, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length, scaled to length 1, in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of k groups; a group that runs empty starts again at a vector of the sample."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([_nearest(x[i : i + 8192], centres) for i in range(0, len(x), 8192)])
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.choice(len(x), k)])
    return centres


@dataclass(frozen=True)
class Quantiser:
    """``centres`` of the lists, ``books`` with the codewords of each subspace, ``parts`` with its components."""

    centres: np.ndarray
    books: list[np.ndarray]
    parts: list[slice]
    probes: int

    @classmethod
    def fit(cls, sample: np.ndarray, n: int, probes: int = PROBES) -> Quantiser:
        """For ``n`` vectors: about sqrt(n) lists, and never more than the sample can tell apart."""
        rng = np.random.default_rng(11)
        lists = int(min(MAX_LISTS, max(1, round(n**0.5)), max(1, len(sample) // 8)))
        centres = _means(sample, lists, 8, rng)
        residual = (sample - centres[_nearest(sample, centres)])[:8192]
        width = sample.shape[1]
        edges = list(range(0, width, SUBSPACE)) + [width]
        parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
        books = [_means(np.ascontiguousarray(residual[:, p]), min(CODES, len(residual)), 6, rng) for p in parts]
        return cls(centres, books, parts, probes)

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each vector's own list, and those it probes (its own among them)."""
        square = (self.centres * self.centres).sum(axis=1)
        far = square - 2 * x @ self.centres.T
        own = np.argmin(far, axis=1)
        between = np.sqrt(np.maximum(square[own][:, None] + square - 2 * self.centres[own] @ self.centres.T, 1e-30))
        plane = (far - far[np.arange(len(x)), own][:, None]) / (2 * between)  # distance from the plane between
        plane[np.arange(len(x)), own] = -1
        chord = (2 - 2 * SIMILAR) ** 0.5 + 1e-9
        first = np.argsort(plane, axis=1, kind="stable")[:, : self.probes]
        return own, [f[plane[i, f] <= chord].astype(np.int32) for i, f in enumerate(first)]

    def codes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        residual = x - self.centres[own]
        return np.stack([_nearest(residual[:, p], b) for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)

    def decoded(self, codes: np.ndarray, own: int) -> np.ndarray:
        return self.centres[own] + np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], axis=1)

    def possible(self, q: np.ndarray, codes: np.ndarray, own: int, error: np.ndarray) -> np.ndarray:
        """Which products of ``q`` with the coded members can reach the limit: table look-ups plus what the codes miss."""
        at_most = np.repeat((q @ self.centres[own])[:, None], len(codes), axis=1)
        for k, (p, b) in enumerate(zip(self.parts, self.books)):
            at_most += (q[:, p] @ b.T)[:, codes[:, k]]
        length = np.stack([np.sqrt((q[:, p] ** 2).sum(axis=1)) for p in self.parts], axis=1)
        return at_most + length @ error.T >= SIMILAR - 1e-9


def _roots(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    return parent


def _join_up(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The forest after joining every a with its b; roots point to themselves, and everything to its root."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        parent = parent.copy()
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _roots(parent)


def _cell(model: Quantiser, group: pa.Table) -> pa.Table:
    """``rep, links, root``: per vector of a cell the rows it links with here, and where the forest puts it."""
    group = group.combine_chunks()
    member = group.column("member").to_numpy(zero_copy_only=False)
    m, q = np.flatnonzero(member), np.flatnonzero(~member)
    rep = group.column("rep").combine_chunks()
    empty = pa.table({"rep": rep.slice(0, 0), "links": pa.array([], pa.int64()), "root": rep.slice(0, 0)})
    if not len(m) or not len(q):
        return empty
    x, rows = _rows(group.column("vector").combine_chunks()), group.column("rows").to_numpy()
    own, here = group.column("own").to_numpy(), int(group.column("list")[0].as_py())
    coded = group.column("code").combine_chunks().take(pa.array(m)).to_pylist()
    codes = np.frombuffer(b"".join(coded), dtype=np.uint8).reshape(len(m), -1)
    off = x[m] - model.decoded(codes, here)
    error = np.stack([np.sqrt((off[:, p] ** 2).sum(axis=1)) for p in model.parts], axis=1)
    probed = group.column("probes").combine_chunks().take(pa.array(m))
    probe_of = np.repeat(np.arange(len(m)), pc.list_value_length(probed).to_numpy(zero_copy_only=False))
    probe = probed.flatten().to_numpy(zero_copy_only=False)
    node = pc.dictionary_encode(rep).indices.to_numpy(zero_copy_only=False)  # a vector may be member and probe at once
    parent = np.arange(node.max() + 1)
    links = np.zeros(len(rep), dtype=np.int64)
    q = q[np.argsort(own[q], kind="stable")]
    step = max(1, AT_ONCE // len(m))
    for i in range(0, len(q), step):
        part = q[i : i + step]
        near = model.possible(x[part], codes, here, error)
        r, c = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(r):
            continue
        part, some = part[r], m[c]
        near = near[np.ix_(r, c)] & (x[part] @ x[some].T >= SIMILAR) & (node[part][:, None] != node[some])
        # a pair whose member probes the other's list is found there, too: then each finds the other once
        back = np.zeros(near.shape, dtype=bool)
        for kind in np.unique(own[part]):
            theirs = np.zeros(len(m), dtype=bool)
            theirs[probe_of[probe == kind]] = True
            back[own[part] == kind] = theirs[c]
        links[part] += near @ rows[some]
        links[some] += (near & ~back).T @ rows[part]
        left = near
        while left.any():
            at = np.flatnonzero(left.any(axis=1))
            parent = _join_up(parent, node[part[at]], node[some[left[at].argmax(axis=1)]])
            left = left & (parent[node[part]][:, None] != parent[node[some]])
    # nodes are numbered by first appearance: a root is a vector of the cell
    first = np.full(len(parent), -1)
    first[node[::-1]] = np.arange(len(node))[::-1]
    linked = np.flatnonzero(np.bincount(node, weights=links, minlength=len(parent))[node] + (parent[node] != node) > 0)
    return pa.table({
        "rep": rep.take(pa.array(linked)), "links": pa.array(links[linked]), "root": rep.take(pa.array(first[parent[node[linked]]])),
    })


def _indexed(classes: DataFrame, model: Quantiser) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column(2))
            own, probes = model.lists_of(x)
            codes = pa.array([c.tobytes() for c in model.codes(x, own)], pa.binary())
            ends = np.concatenate([[0], np.cumsum([len(p) for p in probes])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(probes)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), lists, codes], ["rep", "rows", "vector", "own", "probes", "code"]
            )

    kind = classes.schema["rep"].dataType.simpleString()
    vector = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(assign, f"rep {kind}, rows long, vector {vector}, own int, probes array<int>, code binary")


def _linked(classes: DataFrame, n: int, width: int, work: Workspace, probes: int) -> DataFrame:
    """``rep, links, root`` from all cells over vectors of one length (``rep, rows, vector``)."""
    share = min(1.0, SAMPLE_VALUES / width / n)
    chosen = classes.filter(F.shiftrightunsigned(F.xxhash64("vector"), 33) < int(share * (1 << 31)))
    sample = chosen.select("vector").toArrow().column("vector").combine_chunks()
    if not len(sample):
        sample = classes.select("vector").limit(1).toArrow().column("vector").combine_chunks()
    model = Quantiser.fit(_rows(sample), n, probes)
    index = work.keep(_indexed(classes.select("rep", "rows", "vector"), model))
    probing = index.withColumn("list", F.explode("probes"))
    counts = index.groupBy(F.col("own").alias("list")).agg(F.count("*").alias("m")).join(
        probing.groupBy("list").agg(F.count("*").alias("q")), "list"
    )
    grid = counts.select(  # MAX_LISTS rows at most
        "list", F.ceil(F.col("m") / CELL).alias("m_cells"), F.ceil(F.col("q") / CELL).alias("q_cells")
    )
    grid = F.broadcast(work.keep(grid))

    def dealt(rows: DataFrame, member: bool) -> DataFrame:
        own, other = ("m", "q") if member else ("q", "m")
        rows = rows.join(grid, "list").withColumn(f"{own}_cell", F.pmod(F.xxhash64("rep"), F.col(f"{own}_cells")))
        rows = rows.withColumn(f"{other}_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_cells") - 1)))
        asked = [F.when(F.lit(member), F.col(c)).alias(c) for c in ("probes", "code")]  # of members only
        return rows.select("list", "m_cell", "q_cell", F.lit(member).alias("member"), "rep", "rows", "vector", "own", *asked)

    both = dealt(index.withColumn("list", F.col("own")), True).unionByName(dealt(probing, False))
    kind = classes.schema["rep"].dataType.simpleString()
    return work.keep(
        both.groupBy("list", "m_cell", "q_cell").applyInArrow(lambda group: _cell(model, group), f"rep {kind}, links long, root {kind}")
    )


def similar_vectors(
    vectors: DataFrame, work: Workspace, key: str = "vec_id", vector: str = "embedding", probes: int = PROBES
) -> DataFrame:
    """One row per row: ``key, n_links, component_id, kept``.

    Vectors of one length link where their cosine in double precision is at least 0.9: none below it, and of those above
    it all that meet in a probed list. Equal vectors are indexed once and link with each other. NULL, empty and zero
    vectors, and those with a NULL, NaN or infinite component, link with nothing. The component id is the smallest id
    that links lead to, ``kept`` marks it. Rows that repeat an id are vectors of their own that share a component. Rows
    with a NULL id link with nothing, have a NULL component and are not kept. Other columns are not read; an empty table
    gives an empty table.
    """
    base = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    if base.schema["vector"].dataType.simpleString() not in ("array<float>", "array<double>"):
        base = base.withColumn("vector", F.col("vector").cast("array<double>"))
    good = F.col("id").isNotNull() & usable(F.col("vector"))
    # 128 bits of the vector, NULL where it links with nothing
    marked = base.select(
        "id", "vector", *[F.when(good, F.xxhash64("vector", F.lit(seed))).alias(f"s{seed}") for seed in (1, 2)]
    )
    classes = work.keep(
        marked.filter("s1 IS NOT NULL").groupBy("s1", "s2").agg(
            F.min("id").alias("rep"), F.count("*").alias("rows"), F.first("vector").alias("vector")
        ).withColumn("width", F.size("vector"))
    )
    widths = classes.groupBy("width").count().filter("count > 1").collect()  # one row per length
    kind = vectors.schema[key].dataType.simpleString()
    found = vectors.sparkSession.createDataFrame([], f"rep {kind}, links long, root {kind}")
    for r in sorted(widths):
        found = found.unionByName(_linked(classes.filter(F.col("width") == r["width"]), r["count"], r["width"], work, probes))
    named = marked.select("id", "s1", "s2")
    several = named.filter("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").select("id")
    ties = named.join(several, "id", "left_semi").join(classes.select("s1", "s2", "rep"), ["s1", "s2"])
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(ties.select("id", "rep"))
    labels = components(edges.distinct(), work)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    totals = work.keep(
        classes.select("s1", "s2", "rep", "rows").join(links, "rep", "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "s1", "s2", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    out = named.join(totals, ["s1", "s2"], "left")
    out = out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"), Workspace(spark, "op11"))


# all pairs; then reachability by recursion over the links
OP11_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), g AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
), u AS (
  SELECT vec_id, e, norm FROM g WHERE norm > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), r AS (
  SELECT a AS id, a AS reached FROM p
  UNION
  SELECT r.id, p.b FROM r JOIN p ON r.reached = p.a
), c AS (
  SELECT id, min(reached) AS component FROM r GROUP BY id
), n AS (
  SELECT a AS id, count(*) AS links FROM p GROUP BY a
)
SELECT vec_id, coalesce(links, 0)::BIGINT AS n_links, least(vec_id, coalesce(component, vec_id)) AS component_id,
       least(vec_id, coalesce(component, vec_id)) = vec_id AS kept
FROM v LEFT JOIN c ON vec_id = c.id LEFT JOIN n ON vec_id = n.id
"""
