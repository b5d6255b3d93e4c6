import os
import time

import pytest
from pyspark.sql import functions as F

from regain.operators import explore, marts
from regain.plans import gate, versions
from regain.plans.pipeline import BUILD_ORDER, DETAIL_LAYOUT, STAGING, Pipeline, build
from regain.plans.store import Layers
from regain.sources.sample import SampleTables

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_reader_of_the_old_version_is_not_disturbed(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = versions.put(spark.range(10), path)
    second = versions.put(first.withColumn("id", F.col("id") + 100), path)
    assert ids(first) == list(range(10)) and ids(second) == ids(versions.read(spark, path)) == list(range(100, 110))
    third = versions.put(second.limit(3), path)
    assert third.count() == 3 and second.count() == 10
    # two versions are kept, the first is gone with its data
    assert [v.number for v in versions.versions(spark, path)] == [2, 3]
    assert len([d for d in os.listdir(tmp_path / "t") if d.startswith("v-")]) == 2
    with pytest.raises(Exception, match="(?i)not.*exist|FileNotFound"):
        first.collect()


def test_a_writer_that_dies_between_two_steps(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    versions.put(spark.range(5), path)
    # while it writes data
    with pytest.raises(Exception, match="no good"):
        versions.put(spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no good"))).alias("id")), path)
    assert ids(versions.read(spark, path)) == list(range(5))
    # after the data, before the pointer
    versions.write_data(spark.range(7), path)
    assert ids(versions.read(spark, path)) == list(range(5))
    # inside the pointer
    (tmp_path / "t/_commits" / f"{2:020d}.json").write_text('{"folders": ["v-')
    assert ids(versions.read(spark, path)) == list(range(5)) and versions.current(spark, path).number == 1
    # before old versions are removed
    with monkeypatch.context() as patch:
        patch.setattr(versions, "expire", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            versions.put(spark.range(8), path)
    assert ids(versions.read(spark, path)) == list(range(8))
    # the next writer goes on; what was left without a pointer stays until it is old
    after = versions.put(spark.range(9), path)
    assert ids(after) == list(range(9)) and versions.current(spark, path).number == 4
    monkeypatch.setattr(versions, "ORPHAN_HOURS", -1)
    versions.expire(spark, path)
    assert len([d for d in os.listdir(tmp_path / "t") if d.startswith("v-")]) == 2 and ids(versions.read(spark, path)) == list(range(9))


def test_two_writers_get_two_numbers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    versions.put(spark.range(1), path)
    names = [versions.write_data(spark.range(n), path) for n in (2, 3)]
    schema = spark.range(1).schema
    assert [versions.commit(spark, path, (n,), schema).number for n in names] == [2, 3]
    assert versions.read(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        versions.read(spark, f"file://{tmp_path}/none")


def test_a_table_that_is_not_accepted_is_not_committed(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    versions.put(spark.range(5), path)

    def refuse(written):
        raise ValueError(f"{written.count()} rows")

    with pytest.raises(ValueError, match="6 rows"):
        versions.put(spark.range(6), path, accept=refuse)
    assert versions.read(spark, path).count() == 5 and len(os.listdir(tmp_path / "t")) == 2


def test_buckets_join_without_an_exchange_and_hot_keys_have_none(spark, tmp_path):
    lines = spark.range(4000).select((F.col("id") % 500).cast("string").alias("k"), F.col("id").alias("v"))
    heads = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("w"))
    layout = versions.even_buckets([lines, heads], "k", 1000, 4.0)
    assert layout.bucket_by == "k" and layout.buckets == 8
    a, b = (versions.put(df, f"file://{tmp_path}/{n}", layout) for n, df in (("a", lines), ("b", heads)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = a.join(b, "k")
        assert "Exchange" not in plan_of(joined) and joined.count() == 4000
        assert "Exchange" not in plan_of(versions.read(spark, f"file://{tmp_path}/a").groupBy("k").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    hot = lines.withColumn("k", F.when(F.col("v") % 3 == 0, F.lit("hot")).otherwise(F.col("k")))
    assert versions.even_buckets([hot], "k", 100, 4.0) == versions.PLAIN


@pytest.fixture(scope="module")
def small_build(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('build')}"
    watch = gate.Gate(stop=False)
    return root, build(spark, SampleTables(spark, SMALL), root, gate=watch), watch


def test_one_customer_is_read_from_pruned_files(spark, small_build):
    _, p, _ = small_build
    since = p.dates.last_start
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    one = explore.monthly_profit(p.sales_detail, p.dates, "37", since)
    plan = plan_of(one)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ship_year#" in plan and f">= {since.year}" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    pushed = plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "EqualTo(customer_id,37)" in pushed and "GreaterThanOrEqual(ship_date" in pushed
    years = p.sales_detail.select("ship_year").distinct().count()
    assert years > 2
    # files of a year hold disjoint ranges of customers
    files = p.sales_detail.groupBy("ship_year", F.input_file_name().alias("f")).agg(F.min("customer_id").alias("a"), F.max("customer_id").alias("z")).collect()
    for year in {r["ship_year"] for r in files}:
        spans = sorted((r["a"], r["z"]) for r in files if r["ship_year"] == year and r["a"] is not None)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    everyone = explore.monthly_profit(p.sales_detail, p.dates).filter("customer_id = '37'").filter(F.col("month") >= F.lit(since)).collect()
    assert [r for r in one.collect() if r["month"] >= since] == everyone


def test_status_join_has_no_exchange(spark, small_build):
    _, p, _ = small_build
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        status = p.invoices.select("invoice_no", "reconciliation_status")
        plan = plan_of(p.lines.join(status, "invoice_no", "left"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert DETAIL_LAYOUT.partition_by == ("ship_year",)


def test_gate_reports_what_the_checks_report(spark, small_build):
    from regain.operators import quality
    from regain.plans import catalog, checks

    _, p, watch = small_build
    tables = catalog.table_map(p)
    want = quality.unique(tables, checks.UNIQUE).collect() + quality.not_null(tables, checks.NOT_NULL).collect()
    want += quality.accepted_values(tables, checks.ACCEPTED_VALUES).collect() + quality.relationships(tables, checks.RELATIONSHIPS).collect()
    assert sorted(map(tuple, want), key=str) == sorted(watch.report, key=str)


def test_a_planted_error_stops_the_build_and_a_warning_does_not(spark, tmp_path):
    rules = gate.Rules(
        unique=[("t", "k")], not_null={"t": ("k",)}, accepted=[("t", "v", ("a", "b"))],
        relationships=[("t", "p", "parent", "p", "warn"), ("early", "q", "late", "q", "error")],
    )
    layers = Layers(f"file://{tmp_path}")
    watch = gate.Gate(rules)
    put = watch.guarding(layers)
    put("parent", spark.createDataFrame([("x",)], "p string"))
    good = spark.createDataFrame([("1", "a", "x"), ("2", None, "y")], "k string, v string, p string")
    put("t", good)  # the missing parent is a warning
    assert ("relationships", "t", "p", "warn", 1, "y") in watch.report
    for bad, said in (
        (good.union(good), "unique k: 2 rows, such as 1"), (good.withColumn("k", F.lit(None).cast("string")), "not_null k: 2 rows"),
        (good.withColumn("v", F.lit("z")), "accepted_values v: 2 rows, such as z"),
    ):
        with pytest.raises(gate.CheckFailed, match=said):
            put("t", bad)
        assert sorted(r[0] for r in layers.get(spark, "t").collect()) == ["1", "2"]
    # a child that is written before its parent is checked with the parent
    put("early", spark.createDataFrame([("7",)], "q string"))
    with pytest.raises(gate.CheckFailed, match="relationships q: 1 rows, such as 7"):
        put("late", spark.createDataFrame([("8",)], "q string"))


def test_keys_are_settled_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    rules = gate.Rules(unique=[("t", "a"), ("t", "b")], relationships=[("t", "c", "u", "c", "error"), ("t", "b", "t", "a", "error")])
    written = versions.put(df, f"file://{tmp_path}/t")
    parent = versions.put(df, f"file://{tmp_path}/u")
    census = gate.key_census(written, "t", {"u": parent}.__getitem__, rules)
    plan = plan_of(census)
    # one scan of the table for all its keys, one more where it is its own parent, one of the other parent
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning(line") <= 3


def test_partitions_are_put_in_ranges_one_at_a_time(spark, tmp_path):
    """One exchange held the rows of all partitions before."""
    path = f"file://{tmp_path}/t"
    layout = versions.Layout(derive={"part": "id % 3"}, partition_by=("part",), range_by=("part", "id"))
    rows = spark.range(90).withColumn("id", F.when(F.col("id") != 7, F.col("id")))  # NULL has a partition of its own
    assert versions.put(rows, path, layout).count() == 90
    (data,) = [n for n in os.listdir(tmp_path / "t") if n.startswith("v-")]
    assert len(os.listdir(tmp_path / "t" / data)) >= 4
    writes = {f.split("-", 2)[2].split(".")[0] for f in _part_files(tmp_path / "t" / data)}
    assert len(writes) == 4  # one for each partition
    assert versions.put(rows.limit(0), path, layout).count() == 0


def test_a_partition_is_made_of_its_own_rows(spark, tmp_path):
    """The joins of a table held the rows of all partitions before, and all were written twice."""
    layout = versions.Layout(derive={"part": "id % 3"}, partition_by=("part",), range_by=("part", "id"))
    rows, asked = spark.range(90), []

    def part(same):
        asked.append(rows.filter(same).count())
        return rows.filter(same).withColumn("w", F.col("id") + 1)

    table = versions.put(rows.withColumn("w", F.col("id") + 1), f"file://{tmp_path}/t", layout, part=part)
    assert asked == [30, 30, 30]
    assert sorted((r["id"], r["w"], r["part"]) for r in table.collect()) == [(i, i + 1, i % 3) for i in range(90)]


def test_buckets_are_written_in_turns(spark, tmp_path):
    """One exchange held all rows before."""
    lines = spark.range(4000).select((F.col("id") % 500).cast("string").alias("k"), F.col("id").alias("v"))
    seen = []
    a = versions.put(
        lines, f"file://{tmp_path}/a", versions.Layout(bucket_by="k", buckets=8, turns=2), watch=lambda df: seen.append(df.count()) or df
    )
    b = versions.put(lines.select("k").distinct(), f"file://{tmp_path}/b", versions.Layout(bucket_by="k", buckets=8))
    assert len(seen) == 2 and sum(seen) == 4000 and max(seen) < 3000
    (data,) = [n for n in os.listdir(tmp_path / "a") if n.startswith("v-")]
    assert len(_part_files(tmp_path / "a" / data)) == 8  # a file for each bucket still
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = a.join(b, "k")
        assert "Exchange" not in plan_of(joined) and joined.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a.exceptAll(lines).isEmpty() and lines.exceptAll(a).isEmpty()


def test_detail_of_a_build_is_that_of_a_query(spark, small_build):
    _, p, _ = small_build
    whole = Pipeline.for_query(spark, SampleTables(spark, SMALL)).sales_detail
    years = p.sales_detail.select(*whole.columns)
    assert years.exceptAll(whole).isEmpty() and whole.exceptAll(years).isEmpty()


def test_sorted_keys_take_less_without_a_dictionary(spark, tmp_path):
    rows = spark.range(60000).select(F.concat(F.lit("invoice "), F.lpad(F.col("id").cast("string"), 9, "0")).alias("k"), "id").repartition(2)
    layout = versions.Layout(sort_by=("k",), no_dictionary=("k", "not_there"))
    table = versions.put(rows, f"file://{tmp_path}/t", layout)
    rows.write.parquet(f"file://{tmp_path}/plain", compression=versions.COMPRESSION)

    def size(folder):
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f.startswith("part-"))

    assert size(tmp_path / "t") * 2 < size(tmp_path / "plain")
    assert table.exceptAll(rows).isEmpty() and table.count() == 60000


def test_little_stands_beside_the_steps_that_exchange_the_lines(small_build):
    """The detail was written when all but a few tables stood already."""
    _, p, _ = small_build
    assert BUILD_ORDER.index("sales_detail") < min(BUILD_ORDER.index(n) for n in ("transactions", "days", "product_changes"))
    assert {n for n in STAGING if hasattr(p.staged, n)} == set(STAGING)


def test_counts_of_several_writes_add_up():
    both = gate.all_writes([{"n0": 2, "a1": 0, "s1": None}, {"n0": 1, "a1": 3, "s1": "z"}, {"n0": 0, "a1": 1, "s1": "y"}])
    assert both == {"n0": 3, "a1": 4, "s1": "y"}


def _part_files(folder):
    return [f for _, _, files in os.walk(folder) for f in files if f.startswith("part-")]


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    """They stayed until the driver collected garbage before: a build held those of all its tables."""
    from regain.plans.session import tune

    def shuffle_files():
        files = tune(spark)._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before = shuffle_files()
    versions.put(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), f"file://{tmp_path}/t")
    for _ in range(50):
        if not shuffle_files() - before:
            break
        time.sleep(0.1)
    assert not shuffle_files() - before


def test_rows_are_not_made_to_find_the_bounds_of_ranges(spark, tmp_path, monkeypatch):
    """An exchange by range made every row of a partition twice: once to look for the bounds."""
    monkeypatch.setattr(versions, "ROWS_PER_RANGE", 40)
    monkeypatch.setattr(versions, "SAMPLED_PER_RANGE", 20)
    made = spark.sparkContext.accumulator(0)
    rows = spark.range(3000).select((F.col("id") % 3).alias("part"), F.when(F.col("id") % 50 > 0, F.col("id") % 50).cast("string").alias("c"), "id")
    count = F.udf(lambda v: made.add(1) or v, "long")
    table = versions.put(
        rows, f"file://{tmp_path}/t", versions.Layout(partition_by=("part",), range_by=("part", "c", "id")),
        part=lambda same: rows.filter(same).withColumn("id", count.asNondeterministic()("id")),
    )
    assert made.value == 3000
    assert table.select("part", "c", "id").exceptAll(rows).isEmpty() and table.count() == 3000
    key = F.struct("c", "id")
    files = table.groupBy("part", F.input_file_name().alias("f")).agg(F.min(key).alias("a"), F.max(key).alias("z"), F.count("*").alias("n"))
    for part in range(3):
        own = [r for r in files.filter(F.col("part") == part).selectExpr("f", "n", "row_number() over (order by a) as i", "a < z and a > lag(z, 1, struct(null, -1L)) over (order by a) as ok").collect()]
        assert len(own) > 10 and all(r["ok"] for r in own) and max(r["n"] for r in own) < 150


def test_lines_meet_their_accounts_without_an_exchange(spark, small_build):
    """All columns of the lines were exchanged for what their invoice and accounts give."""
    _, p, _ = small_build
    s, old = p.staged, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = p._by_invoice(marts.invoice_accounts(p.lines, p.headers, p.corrections, p.invoices, s.stg_customers, p.groups))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = plan_of(p._detail(found=found).filter("row_source = 'product_line' and invoice_no is not null"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(product_id" in line]
    assert "ShuffledHashJoin [invoice_no" in plan and not [line for line in plan.splitlines() if "Exchange hashpartitioning(invoice_no" in line]
    assert wide


def test_a_line_without_an_invoice_still_has_its_accounts(spark, small_build):
    """Buckets are met on the invoice; NULL is met apart, as by the query."""
    _, p, _ = small_build
    s = p.staged
    some = F.col("sales_line_id") == F.lit(p.lines.agg(F.min("sales_line_id")).first()[0])
    lines = p.lines.withColumn("invoice_no", F.when(~some, F.col("invoice_no")))
    args = (lines, p.headers, p.corrections, p.invoices, s.stg_customers, p.groups)
    given = (*args, p.people, s.stg_branches, p.products)
    plain, met = marts.sales_detail(*given), marts.sales_detail(*given, found=marts.invoice_accounts(*args))
    assert plain.filter("invoice_no is null and customer_name is not null").count() == 1
    assert plain.exceptAll(met).isEmpty() and met.exceptAll(plain).isEmpty()
