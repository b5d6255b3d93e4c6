import hashlib
from collections import defaultdict

import pytest

from regain.llm import mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """By sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def brute(rows):
    sized = [(d, s, len((t or "").split()), int(hashlib.md5(f"mix-1|{'' if d is None else d}|{t or ''}".encode()).hexdigest()[:15], 16)) for d, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n, _ in sized:
        sizes[s] += n
    goal = targets(dict(sizes))
    out = []
    for d, s, n, h in sized:
        rounds = int(goal[s] // sizes[s]) if sizes[s] else 0
        rest = goal[s] - rounds * sizes[s]
        upto = sum(m for _, o, m, g in sized if o == s and g <= h)
        here = sum(m for _, o, m, g in sized if o == s and g == h)
        out.append((d, n, sizes[s], round(goal[s], 6), n * (rounds + (2 * upto - here <= 2 * rest))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in df.collect()), key=str)


def test_against_brute_force(docs_of, work):
    rows = [(i, "w " * (i * 37 % 101), ["b", "a", None, "ü", "Z"][i % 7 % 5]) for i in range(160)]
    rows += [(7, None, "a"), (8, "", "b"), (5, "w " * 84, "a"), (5, "w " * 84, "a"), (None, "x y z", "empty")]
    df = docs_of(rows)
    got = result(mixing.mix(df, work))
    assert got == brute(rows)
    assert result(mixing.mix(df.repartition(5), work)) == got


def test_whole_rows_and_empty(docs_of, work):
    df = docs_of([(1, "a b c", "s"), (2, "d e", "t")])
    full = mixing.mix(df, work, whole_rows=True)
    assert set(full.columns) == set(df.columns) | {"size", "source_size", "target", "taken"}
    assert {r["doc_id"]: r["size"] for r in full.collect()} == {1: 3, 2: 2}
    assert mixing.mix(docs_of([]), work).count() == 0


@pytest.mark.parametrize("texts", [["", None], ["a"]])
def test_sources_without_words(docs_of, work, texts):
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    assert result(mixing.mix(docs_of(rows), work)) == brute(rows)
