import random

import numpy as np
import pyarrow as pa

from regain.llm import common


def words_of(texts):
    return [w for t in texts for w in t.encode().lower().split()]


def hashed(texts):
    values, ends = [], []
    for data, cut in common.text_pieces(pa.array(texts, pa.string())):
        h, e = common.word_hashes(data, cut)
        ends += (e + len(values)).tolist()
        values += h.tolist()
    return values, ends


def case(seed):
    rng = random.Random(seed)
    blanks = [" ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c "]
    texts = []
    for _ in range(300):
        words = ["".join(rng.choices("abABé \U0001f600", k=rng.randrange(1, 4))) for _ in range(rng.randrange(0, 12))]
        texts.append(rng.choice(["", " "]) + "".join(w + rng.choice(blanks) for w in words)[: rng.choice([None, -1])])
    return texts


def test_words_are_told_apart_wherever_they_stand(monkeypatch):
    texts = case(1) + ["", " ", "x" * 400, "y " * 3, "A" * 3000 + " b"]
    for piece, chunk in ((1 << 20, 1 << 17), (64, 16)):
        monkeypatch.setattr(common, "_PIECE", piece)
        monkeypatch.setattr(common, "_CHUNK", chunk)
        monkeypatch.setattr(common, "_UP", common._powers(common._BASE, chunk + 1))
        monkeypatch.setattr(common, "_DOWN", common._powers(pow(common._BASE, -1, 1 << 64), chunk + 1))
        values, ends = hashed(texts)
        want = words_of(texts)
        assert len(values) == len(want) == ends[-1]
        assert ends == np.cumsum([len(t.encode().split()) for t in texts]).tolist()
        of = {}
        for w, v in zip(want, values):
            assert of.setdefault(w, v) == v
        assert len(set(of.values())) == len(of)


def distinct_runs(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_slices_of_arrow_columns():
    texts = case(2)
    got = [len(s) for s in common.text_sets(pa.array(texts, pa.string()).slice(17, 100), 5)]
    assert got == [len(distinct_runs(t)) for t in texts[17:117]]


def test_sets_are_those_of_the_words():
    texts = case(3) * 2
    sets = list(common.text_sets(pa.array(texts, pa.string()), 5))
    brute = [distinct_runs(t) for t in texts]
    for a, x in zip(sets, brute):
        assert len(a) == len(x) and (np.diff(a.view(np.uint64)) > 0).all()
    for i in range(0, 200, 3):
        for j in range(1, 200, 7):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute[i] & brute[j])
