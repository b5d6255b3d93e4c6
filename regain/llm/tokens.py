"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are encoded in batches of about equal bytes. A long text is cut where no token can span the
cut, so its pieces' counts add up to the count of the whole, and no encode call grows with a text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm.common import table

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16
TOKEN_LIMIT = 4096

# a single space between an ordinary character and an ASCII letter or digit: every supported
# vocabulary begins a new unit here (checked for the piece vocabulary when it is loaded)
_SAFE = re.compile(r"(?<=[0-9A-Za-z.,;:!?]) (?=[0-9A-Za-z])")


def split_safely(text: str, size: int, drop_space: bool) -> Iterator[str]:
    """Cut ``text`` into pieces of ``size`` characters or a little more, at safe boundaries only."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end() if drop_space else cut.start()
    yield text[start:]


def load_encoder(model: str) -> tuple[Callable[[list[str]], list[int]], bool, bool]:
    """(lengths of a batch of texts, the space at a cut is implied by the encoder, texts may be cut)."""
    if model.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        marked = (pieces.id_to_piece(i) for i in range(pieces.get_piece_size()))
        # no piece runs over the start of a word, and a space is exactly what opens every text
        cuttable = not any(re.search("[^▁]▁", p) for p in marked) and (
            pieces.encode("a a", out_type=str) == pieces.encode("a", out_type=str) * 2
        )
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], True, cuttable
    if model.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(model)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return (
            lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)],
            False, True,
        )
    raise ValueError(f"no encoder for {model}")


def count_batch(texts: list[str], lengths: Callable, drop_space: bool, cuttable: bool) -> list[int]:
    """Token counts of whole texts, by encode calls of about ``BATCH_BYTES`` each."""
    totals = [0] * len(texts)
    owners: list[int] = []
    pieces: list[str] = []
    waiting = 0

    def flush() -> None:
        nonlocal waiting
        for owner, n in zip(owners, lengths(pieces)):
            totals[owner] += n
        owners.clear()
        pieces.clear()
        waiting = 0

    for row, text in enumerate(texts):
        for piece in split_safely(text, PIECE_CHARS, drop_space) if cuttable else (text,):
            owners.append(row)
            pieces.append(piece)
            waiting += len(piece.encode())
            if waiting >= BATCH_BYTES:
                flush()
    if pieces:
        flush()
    return totals


def token_counts(
    docs: DataFrame, model: str | Callable[[], str], limit: int = TOKEN_LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``key, n_bytes, n_tokens, over_limit``. No shuffle.

    ``model`` is the vocabulary file's path, or a function that finds it on the executor.
    NULL and empty texts count 0 bytes and 0 tokens; repeated rows and NULL keys stay as they are; other
    columns of ``docs`` are not read, so their names cannot clash; an empty table gives an empty table.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, drop_space, cuttable = load_encoder(model() if callable(model) else model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = count_batch(texts, lengths, drop_space, cuttable)
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                [key, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text")).mapInArrow(
        count, f"`{key}` {key_type}, n_bytes long, n_tokens long, over_limit boolean"
    )


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), piece_model)
