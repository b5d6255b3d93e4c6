"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from regain.llm.decontaminate import op7_decontaminate
from regain.llm.embedding_dedup import OP11_SQL, op11_embedding_dedup
from regain.llm.fingerprints import op9_fingerprints
from regain.llm.manifest import OP12_SQL, op12_merkle_manifest
from regain.llm.mixing import OP4_SQL, op4_mix_sources
from regain.llm.ngram_join import OP3_SQL, op3_ngram_join
from regain.llm.quality import op10_quality
from regain.llm.ranked_search import OP13_SQL, op13_ranked_search
from regain.llm.suffix_dedup import OP8_SQL, op8_suffix_dedup
from regain.llm.tokens import op1_token_counts
from regain.llm.toxicity import op2_toxicity
from regain.llm.url_filter import op6_url_filter
from regain.llm.warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_quality": op10_quality,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op3_ngram_join": OP3_SQL,
    "op4_mix_sources": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op11_embedding_dedup": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
