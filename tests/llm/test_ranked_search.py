import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from regain.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in TERM.findall(text or "")]


def brute(rows, items, top=10):
    docs = [(key, Counter(terms(text)), len(terms(text))) for key, text in rows]
    docs = [d for d in docs if d[2]]
    n_docs, words = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, own, _ in docs for t in own)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for key, own, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // words
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 8 * m))
                for t, k in wanted.items() if t in own
            )
            if score > 0:
                scores.append((-score, key is None, key))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, key, -s) for k, (s, _, key) in enumerate(scores[:top])]
    return sorted(out, key=str)


def run(spark, work, docs, items, **kw):
    asked = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    out = ranked_search.ranked(docs, asked, work, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=str)


def case(seed, docs=500):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "漢字", "x-y", "don't", "A1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(k * 7 % 1009, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for k in range(docs)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 25)))) for i in range(25)]
    return rows, items


def test_against_brute_force(docs_of, spark, work):
    rows, items = case(1)
    rows += [(5000, None), (5001, ""), (5002, " ... "), (None, rows[0][1]), (None, None)] + [(6000 + i, rows[3][1]) for i in range(15)]
    rows += [(7000, "filler " * 40_000 + rows[5][1])]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "w0 w0 w0"), (104, rows[3][1])]
    assert run(spark, work, docs_of(rows), items) == brute(rows, items)


def test_small_shards_and_several_blocks(docs_of, spark, work, monkeypatch):
    rows, items = case(2)
    for name, value in (("SHARD_DOCS", 17), ("SHARD_ENTRIES", 90), ("FIRST_READ", 2), ("BLOCK_TERMS", 60)):
        monkeypatch.setattr(ranked_search, name, value)
    assert run(spark, work, docs_of(rows).repartition(5), items) == brute(rows, items)


def test_ties_are_broken_by_id(docs_of, spark, work):
    rows = [(k, "same words here") for k in range(40, 0, -1)] + [(50, "other")] * 3
    got = run(spark, work, docs_of(rows).repartition(7), [(1, "words"), (2, "other")])
    assert [r[2] for r in sorted(got, key=lambda r: (r[0], r[1])) if r[0] == 1] == list(range(1, 11))
    assert [r[1:3] for r in got if r[0] == 2] == [(1, 50), (2, 50), (3, 50)]


def test_items_that_share_an_id_and_repeated_rows(docs_of, spark, work):
    rows, items = case(3, 80)
    items = items[:4] + [items[0], items[0], (items[1][0], "w1 w2 w3"), (None, "w4 w5")]
    assert run(spark, work, docs_of(rows), items) == brute(rows, items)


def test_empty_tables(docs_of, spark, work):
    assert run(spark, work, docs_of([]), [(1, "a")]) == []
    assert run(spark, work, docs_of([(1, "a")]), []) == []
    assert run(spark, work, docs_of([(1, None)]), [(1, "a")]) == []


def test_a_term_in_every_document_scores_nothing_when_there_are_many(docs_of, spark, work):
    rows = [(k, "every") for k in range(700)]
    assert run(spark, work, docs_of(rows), [(1, "every")]) == []


@pytest.mark.parametrize("seed", range(6))
def test_reading_stops_early_and_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    docs, terms = 3000, 6
    parts = [(t, d, int(i)) for t in range(terms) for d in rng.choice(docs, rng.integers(50, 2500), replace=False) for i in [rng.zipf(1.5) % 10**6 + 1]]
    parts.sort(key=lambda p: (p[0], -p[2]))
    lists = ranked_search.Lists(
        docs, np.array([p[1] for p in parts]), np.array([p[2] for p in parts]), np.searchsorted([p[0] for p in parts], np.arange(terms + 1))
    )
    query = ranked_search.Query(np.arange(terms), rng.integers(1, 4, terms))
    total = np.zeros(docs, dtype=np.int64)
    for t, d, i in parts:
        total[d] += i * query.times[t]
    order = np.lexsort((np.arange(docs), -total))[:10]
    found, scores = ranked_search.best_of(lists, query, 10)
    assert found.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    # with a bar only what reaches it is left
    bar = int(total[order[4]])
    found, scores = ranked_search.best_of(lists, query, 10, bar)
    assert found.tolist() == [d for d in order.tolist() if total[d] >= bar] and (scores >= bar).all()
