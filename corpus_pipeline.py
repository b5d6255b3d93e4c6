"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

1. toxicity: documents the classifier chain rejects go.
2. n-gram Jaccard join: of each group of similar documents the one with the smallest id stays.
3. suffix-array dedup: strings of 100 bytes that begin earlier in the corpus, too, are cut out of the texts.
4. benchmark decontamination: documents that repeat a benchmark item go.
5. mixing: documents the mix takes stay, with the words taken (``taken``) and how often each is repeated (``repeats``).

All stages take tables with any further columns, whatever their names, and keep them; only ``size``, ``source_size``,
``target``, ``taken`` and ``repeats`` are replaced by the last stage, and ``n_chars`` is set anew where texts are cut.
NULL and empty texts are neither toxic, near copies, repeats nor leaks and pass stages 1 to 4; the mix takes no words of
them, so they end there. Stages 1 and 3 judge every row by its own text; rows that share an id are one document for stages
2 and 4 (what one of them does happens to all), and rows with a NULL id link with nothing. An empty table gives an empty table, with the columns it would have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regain.llm import decontaminate, mixing, ngram_join, suffix_dedup, toxicity
from regain.llm.common import Workspace, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, Workspace(spark, "pipeline-ngram"))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, Workspace(spark, "pipeline-suffix"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "pipeline-leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, Workspace(spark, "pipeline-mix"), whole_rows=True).filter("taken > 0")
    return mixed.withColumn("repeats", (F.col("taken") / F.col("size")).cast("int"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
]

# fitted models and fingerprints are beyond SQL: the tests hold run() against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole ``documents`` table. What a stage wrote goes when the next one has read it."""
    work = Workspace(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir))
        if before is not None:
            work.drop(before)
        before = docs
    return docs


PIPELINE = {"pipeline": run}
PIPELINE_SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
