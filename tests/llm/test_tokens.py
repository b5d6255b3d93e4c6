import public_tokenizers
import pytest

from regain.llm import tokens


def counts(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect()}


def test_counts_of_the_sample_match_the_library(spark, sample):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=tokens.piece_model())
    got = counts(tokens.token_counts(sample, tokens.piece_model))
    for r in sample.collect():
        n = len(pieces.encode(r["text"]))
        assert got[r["doc_id"]] == (len(r["text"].encode()), n, n > 4096)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cuts_never_change_a_count(name, sample, monkeypatch):
    lengths, drop_space, cuttable = tokens.load_encoder(public_tokenizers.path(name))
    texts = [r["text"] for r in sample.limit(60).collect()]
    texts += ["  two  spaces   here ", "a <s> b <|endoftext|> c", "x" * 500, "tab\there 　 wide", "", " "]
    whole = [lengths([t])[0] for t in texts]
    assert cuttable
    monkeypatch.setattr(tokens, "PIECE_CHARS", 40)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 300)
    assert tokens.count_batch(texts, lengths, drop_space, cuttable) == whole


def test_edge_cases(docs_of):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "no id"), (4, "word " * 30000)]
    got = [(r[0], r[1], r[2], r[3]) for r in tokens.token_counts(docs_of(rows), tokens.piece_model).collect()]
    assert sorted(got, key=str)[0][0] == 1
    by = {r[0]: r[1:] for r in got}
    assert by[1] == by[2] == (0, 0, False)
    assert len(got) == 6 and by[4][2] is True and by[None][1] > 0
    assert tokens.token_counts(docs_of([]), tokens.piece_model).count() == 0


def test_unknown_vocabulary():
    with pytest.raises(ValueError):
        tokens.load_encoder("words.txt")
