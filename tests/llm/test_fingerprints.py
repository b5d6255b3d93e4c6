import hashlib

import xxhash

from regain.llm import fingerprints as fp

LIMIT = -(1 << 63) + (1 << 64) // fp.FRACTION


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chain(seed, hashes):
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h % (1 << 64)).to_bytes(8, "little"), seed=seed % (1 << 64))
    return signed(seed)


def sketch(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w.decode()) for w in (text or "").encode().split()]
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words]
    if not hashes:
        return set()
    runs = {chain(42, hashes[i : i + 5]) for i in range(len(hashes) - 4)}
    if not runs:
        acc = 0
        for h in hashes:
            acc = chain(42, [acc, h])
        runs = {acc}
    return {h for h in runs if h < LIMIT} | {min(runs)}


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = [sketch(text), sketch(edited), sketch(following)]
        shown = ["".join(f"{h % (1 << 64):016X}" for h in sorted(s)) for s in prints]
        out.append((
            key, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown[0], shown[1],
            round(likeness(prints[0], prints[1]), 9), round(likeness(prints[0], prints[2]), 9),
        ))
    return sorted(out, key=str)


def run(df, work):
    rows = fp.fingerprint_edits(df, work).collect()
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=str)


def test_sample_against_brute_force(sample, work, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    monkeypatch.setattr(fp, "with_range", lambda df, key: RANGES(df, key, 4, 10))  # many small ranges
    assert run(sample, work) == brute(rows)


RANGES = fp.with_range


def test_edge_cases(docs_of, work):
    rows = [(5, None), (9, ""), (7, "éa b"), (2, "A b c d e f g " * 40), (30, "a b c d e f g " * 40), (31, " \n"), (40, "x " * 30000)]
    assert run(docs_of(rows), work) == brute(rows)
    assert run(docs_of([(1, "alone in the table it is")]), work) == brute([(1, "alone in the table it is")])
    assert run(docs_of([]), work) == []


def test_repeated_and_null_ids(docs_of, work):
    rows = [(3, "b c"), (3, "a"), (3, "b c"), (None, "z z z"), (8, None)]
    assert run(docs_of(rows), work) == brute(rows)


def test_ranges_ascend_and_cover(spark):
    df = fp.with_range(spark.range(0, 5000, 7).union(spark.range(10**12, 10**12 + 300)), "id", 8, 20)
    parts = [r["_part"] for r in df.orderBy("id").collect()]
    assert parts == sorted(parts) and len(set(parts)) > 8


def test_sketches_merge_and_estimate_containment(spark):
    base = " ".join(f"w{i}" for i in range(4000))
    part = " ".join(f"w{i}" for i in range(1000, 1400))
    df = spark.createDataFrame([(base, part)], "base string, part string")
    df = fp.with_sketch(fp.with_sketch(df, "base", "a"), "part", "b")
    row = df.select(
        fp.containment(df.b, df.a).alias("in_base"), fp.containment(df.a, df.b).alias("in_part"),
        (fp.merged(df.a, df.b) == df.a).alias("absorbed"),
    ).first()
    assert row["in_base"] == 1.0 and 0.04 < row["in_part"] < 0.2 and row["absorbed"]


def test_a_merged_sketch_is_that_of_both(spark):
    """Small texts, whose sketch may be the stand-in for a low hash, merged with each other and with long ones."""
    texts = [" ".join(f"s{k}x{i}" for i in range(n)) for k, n in enumerate([1, 3, 5, 6, 7, 9, 12, 20, 300] * 6)]
    pairs = [(a, b) for a in texts[:20] for b in texts[20:]]
    df = fp.with_sketch(fp.with_sketch(spark.createDataFrame(pairs, "a string, b string"), "a", "sa"), "b", "sb")
    stand_ins = 0
    for r in df.select("a", "b", fp.merged(df.sa, df.sb).alias("both")).collect():
        a, b = sketch(r["a"]), sketch(r["b"])
        low = {h for h in a | b if h < LIMIT}
        assert r["both"] == sorted(low or {min(a | b)})
        stand_ins += bool(low) and low != a | b
    assert stand_ins > 50


def test_ids_of_any_type_with_an_order(spark, work):
    rows = [("b", "one two three four five six"), ("a", "seven eight"), (None, "nine"), ("c", None)]
    got = fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id string, text string"), work).collect()
    numbered = [({"a": 1, "b": 2, "c": 3, None: None}[k], t) for k, t in rows]
    want = {r[0]: r[1:5] for r in brute(numbered)}
    assert {r["doc_id"]: tuple(r)[1:5] for r in got} == {k: want[{"a": 1, "b": 2, "c": 3, None: None}[k]] for k, _ in rows}
