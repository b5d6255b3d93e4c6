import os

import pytest
from pyspark.sql import functions as F

from regain.plans.store import Layers, Scratch, write_table


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    layers = Layers(f"file://{tmp_path}")
    first = layers.put("t", spark.range(10))
    second = layers.put("t", first.withColumn("id", F.col("id") + 1))
    assert sorted(r[0] for r in second.collect()) == list(range(1, 11))
    assert os.listdir(tmp_path / "intermediate") == ["t"]  # neither the old table nor a half-written one is left


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="no good"):
        write_table(spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no good"))).alias("id")), path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]


def test_scratch_tables_end_with_their_owner(spark):
    with Scratch(spark) as scratch:
        kept = scratch.keep(spark.range(7))
        folder = scratch.root.removeprefix("file://").removeprefix("file:")
        assert kept.count() == 7 and os.path.isdir(folder)
    assert not os.path.exists(folder)
