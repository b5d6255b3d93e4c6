import hashlib
import random
import zlib

from regain.llm import manifest

KIND = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    doc_id, _, lang, source, n = row
    return sha(*map(field, (doc_id, source, lang, n, text)))


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The top of a list of nodes, and for each the steps (siblings before, siblings after) to it."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, k in zip(paths, at):
            run = k // 8 * 8
            path.append(("".join(level[run:k]), "".join(level[k + 1 : run + 8])))
        level = [sha(*level[k : k + 8]) for k in range(0, len(level), 8)]
        at = [k // 8 for k in at]
    return level[0], paths


def brute(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang, own in langs.items():
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r, r[1])))
        tops[lang] = tree([leaf(r, r[1]) for r in own])
    root, above = tree([tops[x][0] for x in order])
    out = []
    for lang, own in langs.items():
        for row, path in zip(own, tops[lang][1]):
            path = path + above[order.index(lang)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            now = leaf(row, lower(row[1]) if hit else row[1])
            for before, after in path:
                now = sha(before, now, after)
            out.append((row[0], leaf(row, row[1]), tops[lang][0], root, sha(*[b + a for b, a in path]), now, now == root))
    return sorted(out, key=str)


def run(spark, work, rows):
    out = manifest.manifest(spark.createDataFrame([(*r, "x", 1) for r in rows], KIND), work)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


def case(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = "".join(rng.choices("abcXYZ é漢\n", k=rng.randrange(0, 30)))
            rows.append((rng.randrange(10**6), rng.choice([text, None, ""]) if rng.random() < 0.2 else text, lang, rng.choice(["s1", "ü", None]), rng.choice([None, len(text)])))
    return rows


def test_against_brute_force(spark, work):
    rows = case(1, {"en": 530, "de": 64, "fr": 9, "es": 8, None: 3, "": 1, "é": 2, "z": 1})
    got = run(spark, work, rows)
    assert got == brute(rows)
    # only texts that tampering changes fail
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0 and lower(r[1]) != r[1]}
    assert {r[0] for r in got if not r[6]} == changed and len(changed) > 50


def test_small_and_empty_tables(spark, work):
    assert run(spark, work, []) == []
    one = [(7, "Text", "en", "s", 4)]
    assert run(spark, work, one) == brute(one)
    for n in (2, 8, 9):
        rows = case(n, {"en": n})
        assert run(spark, work, rows) == brute(rows)


def test_null_and_repeated_ids(spark, work):
    rows = [(None, "ABC", "en", "s", 3), (None, None, "en", None, None), (5, "x", "en", "s", 1), (5, "x", "en", "s", 1), (5, "Y", "en", "s", 1)] * 3
    assert run(spark, work, rows) == brute(rows)


def test_values_do_not_run_into_each_other(spark, work):
    a = run(spark, work, [(1, "b", "en", "a", 1)])[0][1]
    b = run(spark, work, [(1, "", "en", "ab", 1)])[0][1]
    c = run(spark, work, [(1, None, "en", "-", None)])[0][1]
    d = run(spark, work, [(1, "-", "en", None, None)])[0][1]
    assert len({a, b, c, d}) == 4


def test_long_texts(spark, work):
    rows = [(1, "Aé" * 200_000, "en", "s", 1), (2, "b", "en", "s", 1)]
    assert run(spark, work, rows) == brute(rows)
