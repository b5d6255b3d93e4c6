import os

import corpus_pipeline as pipeline
import test_decontaminate
import test_mixing
import test_ngram_join
import test_suffix_dedup  # noqa: F401  (its corpus is the model for the texts below)

from regain.llm import toxicity
from regain.llm.common import table

SF = "/root/testdata/sf0.001"


def cut(rows):
    """Repeated strings of 100 bytes go, but no part of a character."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        raw = text.encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(raw[p : p + 100])
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out[key] = "".join(kept)
    return out


def test_every_stage_and_run_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}

    chain = toxicity.train(docs, table(spark, SF, "labels"))
    words, stems, tables = toxicity.FeatureIds(b"w"), toxicity.FeatureIds(b"s"), chain.tables()
    texts = {
        k: t for k, t in texts.items()
        if chain.probabilities(toxicity.feature_set(t, words, stems), tables)[-1] < toxicity.CUTOFF
    }
    groups = {k: c for k, _, c in test_ngram_join.brute(list(texts.items()))}
    texts = {k: t for k, t in texts.items() if groups[k] == k}
    texts = cut(list(texts.items()))
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    leaked = {k for k, _ in test_decontaminate.brute(list(texts.items()), items)}
    texts = {k: t for k, t in texts.items() if k not in leaked}
    mixed = test_mixing.brute([(k, t, source[k]) for k, t in texts.items()])

    got = pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got) == sorted(
        m for m in mixed if m[4] > 0
    )
    assert {r["doc_id"]: r["text"] for r in got} == {m[0]: texts[m[0]] for m in mixed if m[4] > 0}
    assert all(r["taken"] == r["repeats"] * r["size"] and r["n_chars"] == len(r["text"]) for r in got)


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents").limit(30)
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema == docs.schema


def test_registered():
    import __spark_entry__ as entry

    names = [q for q in entry.queries() if q.startswith("op")]
    numbers = [int(q[2:].split("_")[0]) for q in names if q[2].isdigit()]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.basename(pipeline.__file__) == "corpus_pipeline.py"


NAMES = ("_gone", "_leak", "_ord", "_null", "_spans", "_mark", "_key", "_m", "_h", "_s", "_rounds", "_below", "_GONE_")


def test_columns_named_as_the_stages_name_theirs(spark):
    """Every stage keeps columns whose names it uses itself, with their values."""
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents")
    wide = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})
    for _, stage in pipeline.STAGES:
        out = stage(spark, wide, SF)
        assert out.columns[: len(wide.columns)] == wide.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in NAMES)


def test_scratch_tables_end_with_their_workspace(spark, tmp_path):
    from regain.llm.common import Workspace

    work = Workspace(spark, "end")
    work.root = f"file://{tmp_path}/end"
    assert work.keep(spark.range(3)).count() == 3 and os.listdir(tmp_path / "end")
    work.close()
    work.close()
    assert not os.path.exists(tmp_path / "end")
