"""Toxicity by a classifier chain: one linear model per category, each fed the probabilities of the earlier ones.

The models are fitted on a bounded sample of labelled rows; a later model is trained with probabilities
its predecessors gave out of fold, so it sees what it will see when scoring.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import WordHashes, shingle_hashes, table

# at most this many labelled rows are used for fitting, those with the smallest hash of their id
TRAIN_ROWS = 12_000
HASH_SIZE = 1 << 22
FOLDS = 4
RIDGE = 1.0
MIN_DOCS, MIN_Z, MAX_FEATURES = 4, 4.0, 256
CUTOFF = 0.5

# Words that name the narrower categories of a labelled row. The last category is the label.
INSULT_WORDS = ("clown", "idiot", "loser", "moron", "stupid")
CONTEMPT_WORDS = ("disgusting", "pathetic", "scum", "trash", "worthless")
CATEGORIES = ("insult", "contempt", "toxic")

_WORD = re.compile(r"[^\W_]+")


REMEMBERED = 1 << 17  # strings of a task whose feature is remembered, some 20 MB


class FeatureIds(dict):
    """Hashed feature of a string, remembered within a task; the memory is emptied when it grows large."""

    def __init__(self, kind: bytes):
        super().__init__()
        self.kind = kind

    def __missing__(self, text: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[text] = zlib.crc32(self.kind + text.encode("utf-8", "replace")) % HASH_SIZE
        return value


def feature_set(text: str, word_ids: FeatureIds, stem_ids: FeatureIds) -> set[int]:
    """Hashed words and word beginnings (four characters) of the whole text."""
    words = set(_WORD.findall(text.lower()))
    found = set(map(word_ids.__getitem__, words))
    found.update(map(stem_ids.__getitem__, {w[:4] for w in words}))
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept, which is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(x.shape[1], dtype=np.float64)
    for _ in range(steps):
        p = sigmoid(x @ weights)
        gradient = x.T @ (p - y) + penalty * weights
        curve = (x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-4:
            break
    return weights


def chosen_features(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Features whose share of documents differs clearly between the classes, the clearest first."""
    if not rows or not y.any() or y.all():
        return np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids, place = np.unique(np.concatenate(rows), return_inverse=True)
    hit = np.bincount(place[y[owner] > 0], minlength=len(ids))
    seen = np.bincount(place, minlength=len(ids))
    share = (seen + 1) / (len(rows) + 2)
    positives = y.sum()
    z = (hit - positives * share) / np.sqrt(positives * share * (1 - share) + 1e-9)
    strong = np.flatnonzero((seen >= MIN_DOCS) & (np.abs(z) >= MIN_Z))
    strong = strong[np.lexsort((ids[strong], -np.abs(z[strong])))][:MAX_FEATURES]
    return ids[strong]


def matrix(rows: Sequence[np.ndarray], features: np.ndarray) -> np.ndarray:
    """Document by chosen feature, 0 or 1."""
    out = np.zeros((len(rows), len(features)), dtype=np.float32)
    order = np.argsort(features, kind="stable")
    ordered = features[order]
    for i, row in enumerate(rows):
        if len(features):
            at = np.searchsorted(ordered, row)
            at[at == len(ordered)] = 0
            out[i, order[at[ordered[at] == row]]] = 1.0
    return out


@dataclass
class Chain:
    """Per category: the chosen features and their weights, the weights of earlier probabilities, the intercept."""

    categories: tuple[str, ...]
    features: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    passed: list[np.ndarray] = field(default_factory=list)
    bias: list[float] = field(default_factory=list)

    def probabilities(self, found: set[int], tables: list[dict[int, float]]) -> list[float]:
        earlier: list[float] = []
        for k, lookup in enumerate(tables):
            score = self.bias[k] + sum(lookup[f] for f in found & lookup.keys())
            score += sum(w * p for w, p in zip(self.passed[k], earlier))
            earlier.append(float(sigmoid(np.float64(score))))
        return earlier

    def tables(self) -> list[dict[int, float]]:
        return [dict(zip(f.tolist(), w.tolist())) for f, w in zip(self.features, self.weights)]


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, categories: Sequence[str]) -> Chain:
    """``labels`` has a column per category, in chain order. A category without both classes gets a constant."""
    chain = Chain(tuple(categories))
    earlier = np.zeros((len(rows), 0))
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        features = chosen_features(rows, y)
        if not len(rows) or not y.any() or y.all():
            share = float(y.mean()) if len(rows) else 0.0
            weights = np.append(np.zeros(len(features) + earlier.shape[1]), -30.0 if share < 0.5 else 30.0)
            out_of_fold = np.full(len(rows), share)
        else:
            x = np.hstack([matrix(rows, features), earlier])
            out_of_fold = np.empty(len(rows))
            for fold in range(FOLDS):
                test = folds == fold
                train = ~test
                if not test.any():
                    continue
                if not y[train].any() or y[train].all():
                    out_of_fold[test] = y[train].mean() if train.any() else y.mean()
                    continue
                inside = np.flatnonzero(train)
                own = chosen_features([rows[i] for i in inside], y[train])  # chosen without the fold, too
                columns = np.append(np.flatnonzero(np.isin(features, own)), np.arange(len(features), x.shape[1]))
                fold_weights = fit_logistic(x[np.ix_(train, columns)], y[train])
                out_of_fold[test] = sigmoid(x[np.ix_(test, columns)] @ fold_weights[:-1] + fold_weights[-1])
            weights = fit_logistic(x, y)
        n = len(features)
        chain.features.append(features)
        chain.weights.append(weights[:n])
        chain.passed.append(weights[n:-1])
        chain.bias.append(float(weights[-1]))
        earlier = np.hstack([earlier, out_of_fold[:, None]])
    return chain


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(text).rlike(r"(?U)\b(" + "|".join(words) + r")\b"), F.lit(False))


def category_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, insult, contempt, toxic``: the label, and which narrower category a toxic row shows."""
    one = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = texts.join(one, "doc_id")
    is_toxic = F.col("toxic") == 1
    return both.select(
        "doc_id", "text",
        (is_toxic & contains_any(F.col("text"), INSULT_WORDS)).cast("int").alias("insult"),
        (is_toxic & contains_any(F.col("text"), CONTEMPT_WORDS)).cast("int").alias("contempt"),
        is_toxic.cast("int").alias("toxic"),
    )


def training_rows(labelled: DataFrame, categories: Sequence[str]) -> pa.Table:
    """Hashed features of the labelled rows, and the smallest shingle hash, which near copies mostly share."""
    names = list(categories)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, stem_ids, hashes = FeatureIds(b"w"), FeatureIds(b"s"), WordHashes()
        for batch in batches:
            found, nearest = [], []
            for text in batch.column(1).to_pylist():
                found.append(sorted(feature_set(text, word_ids, stem_ids)))
                runs = shingle_hashes(hashes.of(text.encode().lower().split()), 5)
                nearest.append(int(runs[0]) >> 1 if len(runs) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(nearest, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 *[batch.column(2 + k).cast(pa.int32()) for k in range(len(names))]],
                ["doc_id", "nearest", "found", *names],
            )

    schema = "doc_id long, nearest long, found array<int>, " + ", ".join(f"`{n}` int" for n in names)
    return labelled.select("doc_id", "text", *names).mapInArrow(featurise, schema).toArrow()


def list_rows(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column as one array per row, all views of one block of memory."""
    chunk = column.combine_chunks()
    chunk = pa.concat_arrays(chunk.chunks) if isinstance(chunk, pa.ChunkedArray) else chunk
    flat, ends = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS, categories: Sequence[str] = CATEGORIES) -> Chain:
    """Fit the chain on at most ``limit`` labelled documents; without any, it flags nothing."""
    one = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "toxic")
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id", F.desc("toxic")).limit(limit)
    got = training_rows(category_labels(docs, sample), categories)
    got = got.sort_by([("doc_id", "ascending"), ("nearest", "ascending")]).combine_chunks()
    marks = np.stack([got.column(c).to_numpy() for c in categories], axis=1).astype(float)
    # near copies of one text with one label count once
    seen = np.stack([got.column("nearest").to_numpy(), marks[:, -1].astype(np.int64)], axis=1)
    use = np.sort(np.unique(seen, axis=0, return_index=True)[1])
    got, marks = got.take(pa.array(use)), marks[use]
    rows = list_rows(got.column("found"))
    folds = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in got.column("doc_id").to_pylist()], dtype=int)
    return fit_chain(rows, marks, folds, categories)


def score(docs: DataFrame, chain: Chain, cutoff: float = CUTOFF, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, a probability per category ``p_<category>``, and ``is_toxic`` (the last
    category's probability is at least ``cutoff``).

    Whole texts are read. NULL and empty texts get the models' intercepts; repeated rows score alike; other
    columns are not read; an empty table gives an empty table. The model is small: at most ``MAX_FEATURES``
    weights per category go to the executors.
    """
    names = [f"p_{c}" for c in chain.categories]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, stem_ids, tables = FeatureIds(b"w"), FeatureIds(b"s"), chain.tables()
        for batch in batches:
            out = [chain.probabilities(feature_set(t or "", word_ids, stem_ids), tables) for t in batch.column(1).to_pylist()]
            columns = [pa.array([p[k] for p in out], pa.float64()) for k in range(len(names))]
            toxic = pa.array([p[-1] >= cutoff for p in out], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, toxic], [key, *names, "is_toxic"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"`{n}` double" for n in names) + ", is_toxic boolean"
    return docs.select(key, text).mapInArrow(apply, schema)


def without_toxic(docs: DataFrame, chain: Chain, cutoff: float = CUTOFF, text: str = "text") -> DataFrame:
    """``docs`` without the rows the chain rejects; every column of the others as it is."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, stem_ids, tables = FeatureIds(b"w"), FeatureIds(b"s"), chain.tables()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            fine = [chain.probabilities(feature_set(t or "", word_ids, stem_ids), tables)[-1] < cutoff for t in texts]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels))
