import numpy as np
import pytest

from regain.llm import embedding_dedup

KIND = "vec_id long, embedding array<float>, n_links string, label int"


def brute(rows, limit=0.9):
    """Links counted over all pairs, and components by walking them."""
    usable = {}
    for k, (key, v) in enumerate(rows):
        x = None if v is None or any(c is None for c in v) else np.array(np.float32(v), dtype=np.float64)
        if key is not None and x is not None and len(x) and np.isfinite(x).all() and x.any():
            usable[k] = x / np.sqrt((x * x).sum())
    near = {k: [j for j, y in usable.items() if j != k and len(y) == len(x) and x @ y >= limit] for k, x in usable.items()}
    ids = {}
    for k, (key, _) in enumerate(rows):
        ids.setdefault(key, []).append(k)
    component = {}
    for k, (key, _) in enumerate(rows):
        if key is None or k not in usable:
            component[k] = key
            continue
        seen, todo = {k}, [k]
        while todo:
            here = todo.pop()
            for j in [*near[here], *[j for j in ids[rows[here][0]] if j in usable]]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component[k] = min(rows[j][0] for j in seen)
    out = [(key, len(near.get(k, ())), component[k], key is not None and component[k] == key) for k, (key, _) in enumerate(rows)]
    return sorted(out, key=str)


def run(spark, work, rows, kind=KIND, **kw):
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], kind)
    out = embedding_dedup.similar_vectors(df, work, **kw)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def moved(rng, x, cosine):
    u = rng.normal(size=len(x))
    u -= (u @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + (1 - cosine**2) ** 0.5 * u / np.linalg.norm(u)


def case(seed, n=400, width=32):
    rng = np.random.default_rng(seed)
    rows = []
    for key in range(n):
        if key % 3 or not rows:
            v = rng.normal(size=width)
        else:
            v = moved(rng, np.array(rows[rng.integers(len(rows))][1]), rng.choice([0.88, 0.895, 0.91, 0.95, 0.999, 1.0])) * rng.choice([1, 7])
        rows.append((int(key * 5 % 1009), [float(np.float32(c)) for c in v]))
    chain = rng.normal(size=width)
    for key in range(2000, 2008):  # links lead on, though its ends are far apart
        rows.append((key, [float(np.float32(c)) for c in chain]))
        chain = moved(rng, chain, 0.92)
    return rows


def test_against_brute_force(spark, work):
    rows = case(1)
    rows += [(3000 + i, rows[0][1]) for i in range(30)] + [(4000 + i, rows[2][1]) for i in range(3)]
    assert run(spark, work, rows) == brute(rows)


def test_whole_cells_and_cells_of_a_few_vectors(spark, work, monkeypatch):
    rows = case(2)
    center = np.array(rows[5][1])
    rng = np.random.default_rng(3)
    rows += [(5000 + i, [float(np.float32(c)) for c in moved(rng, center, 0.99)]) for i in range(150)]
    want = brute(rows)
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    monkeypatch.setattr(embedding_dedup, "AT_ONCE", 300)
    assert run(spark, work, rows) == want


def test_vectors_that_link_with_nothing(spark, work):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 0.0, 2.0], [1.0, 0.0, 2.0, 0.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [None, 1.0, 1.0]), (7, a), (8, a),
        (9, b), (None, a), (None, None), (10, [-0.0, -0.0, 0.0]), (11, [1e-30, 0.0, 2e-30]), (12, [1.0, 0.01, 2.0]), (13, [-1.0, 0.0, -2.0]),
    ]
    got = run(spark, work, rows)
    assert got == brute(rows)
    assert [r for r in got if r[0] in (7, 8, 9)] == [(7, 3, 7, True), (8, 3, 7, False), (9, 0, 9, True)]


def test_rows_that_share_an_id(spark, work):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [-1.0, 0.1]
    rows = [(5, a), (5, b), (2, a), (7, b), (9, c), (5, a)]
    got = run(spark, work, rows)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] != 9} == {2}


def test_empty_and_single(spark, work):
    assert run(spark, work, []) == []
    assert run(spark, work, [(4, [1.0, 2.0])]) == [(4, 0, 4, True)]
    wide = "vec_id string, embedding array<double>, kept string, label int"
    assert run(spark, work, [("b", [1.0, 2.0]), ("a", [2.0, 4.0])], wide) == [("a", 1, "a", True), ("b", 1, "a", False)]


@pytest.mark.parametrize("probes", [2, embedding_dedup.PROBES])
def test_recall(probes):
    """Of pairs just over the limit, nine in ten meet in a probed list, with few probes as well; none is lost to the codes."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6000, 64))
    far = np.array([moved(rng, x, c) for x, c in zip(base[:1500], rng.uniform(0.9, 0.93, 1500))])
    x = np.vstack([base, far])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = embedding_dedup.Quantiser.fit(x, len(x), probes)
    own, lists = model.lists_of(x)
    pairs = [(i, 6000 + i) for i in range(1500) if x[i] @ x[6000 + i] >= 0.9]
    met = [own[b] in lists[a] or own[a] in lists[b] for a, b in pairs]
    assert len(pairs) > 1400 and np.mean(met) >= (0.999 if probes > 2 else 0.9)
    codes = model.codes(x, own)
    for a, b in pairs[:300]:
        off = x[b] - model.decoded(codes[b : b + 1], own[b])[0]
        error = np.array([[np.linalg.norm(off[p]) for p in model.parts]])
        assert model.possible(x[a : a + 1], codes[b : b + 1], own[b], error)[0, 0]
