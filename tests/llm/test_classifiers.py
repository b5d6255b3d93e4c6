import random
import zlib

import numpy as np
import pytest

from regain.llm import quality, toxicity

WORDS = [f"w{i}x" for i in range(200)]


def text_of(rng, extra=()):
    words = rng.choices(WORDS, k=rng.randrange(20, 80))
    for e in extra:
        words.insert(rng.randrange(len(words)), e)
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled(docs_of, spark):
    rng = random.Random(5)
    rows, labels = [], []
    for key in range(600):
        toxic = key % 6 == 0
        extra = rng.sample(["idiot", "trash", "vorgel", "Vorgelix", "moron!"], k=rng.randrange(1, 4)) if toxic else ()
        good = key % 3 != 0
        text = text_of(rng, extra)
        rows.append((key, text if good else " ".join(f"{w}***" for w in text.split())))
        labels.append((key, int(good), int(toxic)))
    labels += [(9999, None, None), (None, 1, 1), (5, None, None)]
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(docs_of, labelled):
    docs, labels = labelled
    chain = toxicity.train(docs, labels.filter("doc_id % 4 <> 1 AND doc_id IS NOT NULL OR doc_id IS NULL"))
    scored = toxicity.score(docs, chain).join(labels.filter("toxic IS NOT NULL"), "doc_id").filter("doc_id % 4 = 1").collect()
    right = [r["is_toxic"] == bool(r["toxic"]) for r in scored]
    assert len(right) == 150 and sum(right) / len(right) > 0.97
    assert chain.categories == ("insult", "contempt", "toxic")
    assert [len(p) for p in chain.passed] == [0, 1, 2]  # earlier probabilities feed later models


def test_whole_texts_count(docs_of, labelled):
    chain = toxicity.train(*labelled)
    rows = [(1, "fine " * 60000 + "idiot vorgel trash"), (2, "fine " * 60000), (3, None), (4, ""), (2, "fine"), (None, "idiot moron vorgel")]
    got = toxicity.score(docs_of(rows), chain).collect()
    assert {r[0] for r in got if r["is_toxic"]} == {1, None} and len(got) == 6
    kept = toxicity.without_toxic(docs_of(rows), chain)
    assert kept.columns == docs_of(rows).columns and sorted(r[0] for r in kept.collect()) == [2, 2, 3, 4]
    assert toxicity.score(docs_of([]), chain).count() == 0


def test_without_labels_nothing_is_toxic(docs_of, labelled):
    docs, labels = labelled
    chain = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, chain).filter("is_toxic").count() == 0


def test_later_models_see_out_of_fold_probabilities():
    """With the first category equal to the second, the second learns to lean on the first's probability."""
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.5).astype(float)
    rows = [np.array([7 if v else 8, 100 + i % 40]) for i, v in enumerate(y)]
    chain = toxicity.fit_chain(rows, np.stack([y, y], axis=1), np.arange(400) % toxicity.FOLDS, ["a", "b"])
    assert chain.passed[1][0] > 0.5
    p = chain.probabilities({7}, chain.tables())
    assert p[0] > 0.9 and p[1] > 0.9


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    scored = quality.score(docs, quality.train(docs, labels)).join(labels.filter("quality IS NOT NULL"), "doc_id").collect()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [r["predicted"] == r["quality"] for r in scored if r["held_out"]]
    assert len(out) > 80 and sum(out) / len(out) > 0.97


def test_quality_learns_nothing_from_held_out_labels(docs_of, labelled):
    docs, labels = labelled
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic"
    )
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert a.w0 == b.w0 and np.array_equal(a.v, b.v)


def test_quality_edge_cases(docs_of, labelled):
    docs, labels = labelled
    machine = quality.train(docs, labels)
    got = quality.score(docs_of([(1, None), (2, ""), (3, "x " * 200000), (None, "a"), (2, "")]), machine).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs_of([]), machine).count() == 0
    constant = quality.train(docs, labels.limit(0))
    assert {round(r["score"], 9) for r in quality.score(docs.limit(20), constant).collect()} == {0.5}
    bare = docs.select("doc_id", "text")  # no n_chars column
    assert quality.score(bare.limit(3), machine).count() == 3


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    k = len(quality.STATISTICS)
    machine = quality.Machine(
        np.zeros(k), np.ones(k), 0.1, rng.normal(size=quality.WORD_SLOTS + k), rng.normal(size=(quality.WORD_SLOTS + k, 3))
    )
    ids, x, starts = machine.inputs([np.array([4, 9, 77])], rng.normal(size=(1, k)))
    pairs = sum(
        machine.v[ids[i]] @ machine.v[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i + 1, len(ids))
    )
    assert machine.raw(ids, x, starts)[0][0] == pytest.approx(0.1 + machine.w[ids] @ x + pairs)
