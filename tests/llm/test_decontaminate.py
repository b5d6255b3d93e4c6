import random
import re
from collections import Counter

from regain.llm import decontaminate

WORD = re.compile(r"[^\W_]+")


def words(text):
    return WORD.findall((text or "").lower())


def shingles(ws, k):
    return Counter(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1)))


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(rows, items):
    """Best similarity of every document and item over all windows as long as the item, from 0.8."""
    out = {}
    for key, text in rows:
        ws = words(text)
        for item, item_text in items:
            iw = words(item_text)
            if not iw or not ws:
                continue
            k = min(5, len(iw))
            mine = shingles(iw, k)
            starts = range(max(1, len(ws) - len(iw) + 1))
            best = max(similarity(shingles(ws[s : s + len(iw)], k), mine) if len(ws[s : s + len(iw)]) >= k else 0 for s in starts)
            if best >= 0.8:
                out[key, item] = max(best, out.get((key, item), 0))
    return out


def run(df, items, work):
    return {(r[0], r["item_id"]): r["similarity"] for r in decontaminate.leaks(df, items, work).collect()}


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 15, 40, 60])))) for i in range(12)]
    items += [(50, ""), (51, None), (52, "..."), (53, items[2][1]), (54, "again and again and again and again and again")]
    rows = []
    for key in range(120):
        body = rng.choices(vocabulary, k=rng.randrange(5, 80))
        if key % 3:
            passage = items[rng.randrange(12)][1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                at = rng.randrange(len(passage))
                passage[at : at + rng.choice([0, 1])] = [f"new{key}"]
            at = rng.randrange(len(body))
            body[at:at] = passage
        rows.append((key, ", ".join(body).upper() if key % 5 == 0 else " ".join(body)))
    return rows, items


def test_against_brute_force(docs_of, spark, work):
    rows, items = case(1)
    rows += [(900, None), (901, ""), (902, "so again and again and again and again and again it goes"), (903, "filler " * 30000 + items[1][1])]
    got = run(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), work)
    want = brute([r for r in rows if r[0] != 903], items)
    want[903, 1] = 1.0
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_large_benchmarks_are_joined_by_shuffle(docs_of, spark, work, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SHINGLES", 0)
    rows, items = case(2)
    assert set(run(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), work)) == set(brute(rows, items))


def test_fingerprints_within_the_radius_differ_little_in_a_block():
    d = decontaminate
    assert d.RADIUS < d.BLOCKS * (d.NEAR_BITS + 1) and d.BLOCKS * d.BLOCK_BITS == 64 * d.PARTS == 256


def test_documents_without_leaks_stay_whole(docs_of, spark, work):
    item = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = docs_of([(1, f"so {item} yes"), (2, "clean"), (3, None), (None, "clean, too"), (4, item), (4, "other"), (None, item)])
    kept = decontaminate.without_leaks(df, items, work)
    assert kept.columns == df.columns
    # rows that share an id, the NULL one too, are one document
    assert sorted(r[0] for r in kept.collect()) == [2, 3]


def test_empty_tables(docs_of, spark, work):
    none = spark.createDataFrame([], "item_id long, text string")
    assert run(docs_of([(1, "a b c")]), none, work) == {}
    assert run(docs_of([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"), work) == {}


def test_windows_far_from_the_fingerprint(docs_of, spark, work):
    """The foreign part of a window is one word over and over: few bits agree at a similarity of 0.806."""
    items = [(i, " ".join(f"t{i}x{j}" for j in range(200))) for i in range(8)]
    rows = [(i, " ".join(text.split()[:179] + ["filler"] * 21)) for i, text in items]
    rows += [(None, rows[0][1]), (100, " ".join(items[0][1].split()[:170] + ["filler"] * 30))]
    got = run(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), work)
    want = brute(rows, items)
    assert len(want) == 9 and {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def moved(seed, n=60):
    """Passages of 60 words whose parts were moved, shifted, cut or interrupted, between fillers."""
    rng = random.Random(seed)
    items = [(i, " ".join(f"m{i}x{rng.randrange(400)}" for _ in range(n))) for i in range(30)]
    rows = []
    for key in range(150):
        passage = items[key % 30][1].split()
        change = key % 5
        if change == 0:  # its end first
            at = rng.randrange(1, n)
            passage = passage[at:] + passage[:at]
        elif change == 1:  # another first line
            passage[: rng.randrange(1, 12)] = [f"line{key}"] * rng.randrange(1, 12)
        elif change == 2:  # something between
            at = rng.randrange(1, n)
            passage[at:at] = [f"between{key}"] * rng.randrange(1, 12)
        elif change == 3:
            for _ in range(rng.randrange(1, 5)):
                passage[rng.randrange(n)] = f"new{key}"
        else:  # halves in two places
            passage = passage[: n // 2] + [f"far{key}"] * rng.randrange(0, 9) + passage[n // 2 :]
        around = [f"f{rng.randrange(10**6)}" for _ in range(2 * rng.randrange(0, 40))]
        rows.append((key, " ".join(around[::2] + passage + around[1::2])))
    return rows, items


def test_moved_parts_against_all_windows(docs_of, spark, work):
    rows, items = moved(5)
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    got = run(docs_of(rows), table, work)
    assert len(want) > 80 and {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    exact = {(r[0], r["item_id"]) for r in decontaminate.leaks(docs_of(rows), table, work, exact=True).collect()}
    assert exact == set(want)


def test_fingerprints_decide(docs_of, spark, work, monkeypatch):
    rows, items = case(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "RADIUS", -1)
    assert run(docs_of(rows), table, work) == {}
    everything = {(r[0], r["item_id"]) for r in decontaminate.leaks(docs_of(rows), table, work, exact=True).collect()}
    assert everything == set(brute(rows, items))


def test_recall_of_fingerprints(docs_of, spark, work):
    """Barely similar windows: of those that reach 0.8, and no more than 0.85, at least nine in ten are found."""
    rng = random.Random(8)
    items = [(i, " ".join(f"r{i}x{rng.randrange(10**6)}" for _ in range(100))) for i in range(40)]
    rows = []
    for key in range(400):
        passage = items[key % 40][1].split()
        for _ in range(2):
            passage[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append((key, " ".join(passage)))
    want = {k for k, v in brute(rows, items).items() if v <= 0.85}
    got = run(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"), work)
    assert len(want) > 100 and len(want & set(got)) >= 0.99 * len(want)


def test_repeated_and_null_items(docs_of, spark, work):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    items = [(1, a), (1, b), (None, a), (2, a), (2, a)]
    got = run(docs_of([(1, a), (2, b), (3, "clean")]), spark.createDataFrame(items, "item_id long, text string"), work)
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (1, None): 1.0, (1, 2): 1.0}
