import hashlib
import random

import numpy as np
import pytest

from regain.llm import suffix_array, suffix_dedup


def array_of(text: bytes) -> list[int]:
    symbols = np.concatenate([np.frombuffer(text, np.uint8).astype(np.int64) + 1, [0]])
    return suffix_array.suffix_array(symbols, 257).tolist()


@pytest.mark.parametrize("small", [512, 2])  # bucket by bucket, and element by element
def test_suffix_array(small, monkeypatch):
    monkeypatch.setattr(suffix_array, "SMALL_ALPHABET", small)
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(40))) for _ in range(80)]
    texts += [bytes(rng.choices(b"abcd\xff", k=60)) for _ in range(40)] + [b"", b"a" * 90, b"abc" * 30]
    for text in texts:
        assert array_of(text) == sorted(range(len(text) + 1), key=lambda i: text[i:])


def test_repeats_are_not_induced_element_by_element(monkeypatch):
    """Names that repeat made a smaller text, whose suffixes were induced one by one in Python."""
    monkeypatch.setattr(suffix_array, "_induce_one_by_one", None)
    rng = random.Random(5)
    words = [bytes(rng.choices(b"abcdefgh", k=rng.randrange(3, 30))) for _ in range(12)]
    for _ in range(20):
        text = b" ".join(rng.choices(words, k=60))
        every = sorted(range(len(text) + 1), key=lambda i: text[i:])
        assert array_of(text) == every
        symbols = np.concatenate([np.frombuffer(text, np.uint8).astype(np.int64) + 1, [0]])
        some = suffix_array.suffix_array(symbols, 257, 20).tolist()
        assert sorted(some) == sorted(every) and [text[i : i + 20] for i in some] == [text[i : i + 20] for i in every]


def test_anchors_depend_on_their_bytes_only(monkeypatch):
    rng = np.random.default_rng(7)
    a, b = (rng.integers(0, 256, n).astype(np.uint8) for n in (700, 400))
    whole, part = suffix_dedup.gram_hashes(np.concatenate([b, a])), suffix_dedup.gram_hashes(a)
    assert np.array_equal(whole[400:], part) and len(np.unique(part)) == len(part) == 700 - suffix_dedup.GRAM + 1
    monkeypatch.setattr(suffix_dedup, "_UP", suffix_dedup._UP[:100])  # a block longer than the powers at hand
    assert np.array_equal(suffix_dedup.gram_hashes(a), part)


def test_common_prefixes():
    text = b"banana bandana banana bandana!"
    array = np.array(array_of(text)[1:])
    got = suffix_array.permuted_common_prefixes(text, array, 11)
    for a, b in zip(array, array[1:]):
        x, y = text[a:], text[b:]
        same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert got[b] == min(same, 11)


def brute(rows):
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            piece = raw[p : p + 100]
            if piece in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(piece)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(df, work):
    return sorted(tuple(r) for r in suffix_dedup.removals(df, work).collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"{rng.randrange(9999):x}é"[: rng.randrange(2, 7)] for _ in range(400)]
    passages = [" ".join(rng.choices(words, k=rng.choice([15, 25, 60]))) for _ in range(6)]
    rows = []
    for key in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        if rng.random() < 0.2:
            parts += parts[:2]
        rows.append((key * 3, "\n".join(parts)))
    return rows + [(901, rows[4][1]), (902, rows[4][1]), (903, rows[5][1] + "!")]


def test_against_brute_force(docs_of, work):
    rows = corpus(1)
    assert run(docs_of(rows), work) == brute(rows)


def test_hot_anchors_and_blocks(docs_of, work, monkeypatch):
    """The ways for hot anchors, long texts and many shards, forced on a small table."""
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", 3)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 400)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    rows = corpus(2)
    assert run(docs_of(rows), work) == brute(rows)


def test_a_passage_between_texts_that_all_differ(docs_of, work, monkeypatch):
    """One anchor with a segment of its own in every document: halved until shards can take it, without a row per string."""
    made = []
    halved = suffix_dedup.halved
    monkeypatch.setattr(suffix_dedup, "halved", lambda found, width: made.append((width, found.count())) or halved(found, width))
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", 20)
    rng = random.Random(9)
    rows = []
    for passage in ("p" * 30 + "q" * 30, "".join(rng.choices("rstuv", k=70)), "".join(rng.choices("wxyz", k=99)), "".join(rng.choices("hijk", k=130))):
        for key in range(60):
            a, b = ("".join(rng.choices("abcdefg", k=rng.randrange(20, 160))) for _ in range(2))
            rows.append((len(rows), a + passage + b))
    rows += [(1000 + k, rows[k * 7][1][5:]) for k in range(20)]
    assert run(docs_of(rows), work) == brute(rows)
    assert [w for w, _ in made][:2] == [27, 14] and all(n < 20 * len(rows) for _, n in made)


def test_edge_cases(docs_of, work):
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 250), (5, "ab" * 300), (6, "a" * 100), (7, "xy" * 100000), (8, "é" * 120)]
    assert run(docs_of(rows), work) == brute(rows)
    assert run(docs_of([]), work) == []


def test_repeated_and_null_ids(docs_of, work):
    text, other = "0123456789" * 12, "abcdefghijklmnop" * 9
    rows = [(1, text), (2, other), (2, text), (1, text), (None, other)]
    got = suffix_dedup.removals(docs_of(rows), work).collect()
    # rows equal in id and text are one document; a NULL id comes after all others
    assert sorted((r[0] or 99, r[1] - r[2]) for r in got) == [(1, 10), (1, 10), (2, 0), (2, 16), (99, 0)]


def test_texts_are_cut_at_characters(docs_of, work):
    shared = "ééé" + "s" * 100 + "üüü"
    df = docs_of([(1, "ê" + shared + "ö"), (2, "ë" + shared + "ä"), (3, None), (4, "short")])
    out = {r["doc_id"]: r for r in suffix_dedup.without_repeats(df, work).collect()}
    assert out[1]["text"] == "ê" + shared + "ö" and out[2]["text"] == "ëä"
    assert out[2]["n_chars"] == 2 and out[3]["text"] is None and out[4]["n_chars"] == 5
    assert suffix_dedup.without_repeats(df, work).columns == df.columns


def test_ids_of_any_type_with_an_order(spark, work):
    rows = [(k, t) for k, t in corpus(4, 30)]
    names = {k: f"id-{k:05d}" for k, _ in rows}
    df = spark.createDataFrame([(names[k], t) for k, t in rows], "doc_id string, text string")
    assert run(df, work) == [(names[r[0]], *r[1:]) for r in brute(rows)]
