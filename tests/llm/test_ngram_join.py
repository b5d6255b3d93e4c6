import random
import re

import numpy as np
import pytest

from regain.llm import ngram_join
from regain.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(d, grams(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((d, len(s), find(d)) for d, s in sets)


def run(df, work):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(df, work).collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


def corpus(seed, groups=6, copies=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = "this very line is found in nearly every one of the texts".split()
    rows, key = [], 0
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([8, 30, 120]))
        for _ in range(copies):
            text = edited(rng, base, rng.choice([0, 1, 1, 2, 4]))
            if rng.random() < 0.4:
                text += "\n" + " ".join(line) if rng.random() < 0.5 else "  "
            rows.append((key := key + rng.randrange(1, 9), text.upper() if rng.random() < 0.2 else text))
    for _ in range(40):
        rows.append((key := key + 1, " ".join(rng.choices(vocabulary, k=10) + line)))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(docs_of, work):
    rows = corpus(1)
    assert run(docs_of(rows), work) == brute(rows)


@pytest.mark.parametrize("most", [0.2, 256])
def test_long_columns_and_common_ngrams(docs_of, work, monkeypatch, most):
    """The ways for very common n-grams and large groups, forced on a small table, lose no link."""
    monkeypatch.setattr(ngram_join, "LONG_COLUMN", 3)
    monkeypatch.setattr(ngram_join, "FEW_PAIRS", 0.1)
    monkeypatch.setattr(ngram_join, "MOST_PAIRS", most)
    monkeypatch.setattr(ngram_join, "COMMON", 3)
    rows = corpus(2, groups=4, copies=25)
    assert run(docs_of(rows), work) == brute(rows)


def test_edge_cases(docs_of, work):
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (3, "ONE  two"), (9, "one two"), (10, "É a b"), (11, "é a b"),
        (12, "long " * 20000), (13, "long " * 15000),
    ]
    assert run(docs_of(rows), work) == brute(rows)
    assert run(docs_of([]), work) == []


def test_repeated_and_null_ids(docs_of, work):
    a, b = "a b c d e f g", "p q r s t u v"
    got = ngram_join.similar_documents(docs_of([(1, a), (2, a), (2, b), (4, b), (None, a), (4, b)]), work).collect()
    assert sorted((r[0], r[2]) for r in got if r[0] is not None) == [(1, 1), (2, 1), (2, 1), (4, 1), (4, 1)]
    assert [r[2] for r in got if r[0] is None] == [None]


def test_one_of_each(docs_of, work):
    df = docs_of([(4, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, "a b c d e f")])
    kept = ngram_join.one_of_each(df, work)
    assert kept.columns == df.columns
    assert sorted(r[0] or 0 for r in kept.collect()) == [0, 2, 3]


def test_components(spark, work):
    links = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 9), (6, 6)] + [(i, i + 1) for i in range(20, 60)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long"), work).collect()}
    assert got[5] == got[2] == 2 and got[8] == got[9] == 7 and {got[i] for i in range(20, 61)} == {20}


def test_block_size_is_enough():
    for n in range(1, 200):
        for shared in range(-(-n * 80 // 100), n + 1):  # at least this much of a set is shared with a similar one
            assert n - shared < ngram_join.block_size(n)
    assert np.all([ngram_join.block_size(n) <= n for n in range(1, 100)])


def brute_links(rows):
    sets = [grams(t) for _, t in rows]
    return sorted(
        (d, sum(bool(x and y) and i != j and 100 * len(x & y) >= 80 * len(x | y) for j, y in enumerate(sets)))
        for i, ((d, _), x) in enumerate(zip(rows, sets))
    )


@pytest.mark.parametrize("chunk", [512, 4])
def test_every_link_is_counted(docs_of, work, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "LINK_CHUNK", chunk)
    rows = corpus(3, groups=4, copies=25)
    rows += [(9000 + i, t) for i, t in enumerate([None, "", "one two", "ONE two", *["a b c d e f g"] * 3])]
    got = ngram_join.linked_documents(docs_of(rows), work).collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in got) == brute_links(rows)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)


def test_links_of_repeated_and_null_ids(docs_of, work):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(1, a), (2, a), (2, b), (4, b), (None, a), (4, b), (5, a + " h"), (5, a + " h")]
    got = ngram_join.linked_documents(docs_of(rows), work).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"]) for r in got) == [(0, 0), (1, 1), (2, 1), (2, 2), (4, 2), (4, 2), (5, 1), (5, 1)]
    assert ngram_join.linked_documents(docs_of([]), work).collect() == []
