"""Declared checks as a gate: what one write and one pass over a table can tell, before the table is committed.

NULLs and values outside a list are counted while the table is written (``DataFrame.observe``), so they cost no scan.
Keys are taken together: one pass over the written table lists every key of every uniqueness and parent check with its
count, parents add theirs with the count 0, and one aggregate settles all of them. A check of severity ``error`` that
finds a row stops the build and the table stays at its last version; ``warn`` is reported and the build goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from regain.plans import checks, versions

REPORT = "check string, table string, column string, severity string, failing_rows bigint, sample_key string"


@dataclass(frozen=True)
class Rules:
    """The declared checks, by default those of the model."""

    unique: Sequence[tuple[str, str]] = checks.UNIQUE
    not_null: Mapping[str, Sequence[str]] = field(default_factory=lambda: checks.NOT_NULL)
    accepted: Sequence[tuple[str, str, Sequence[str]]] = checks.ACCEPTED_VALUES
    relationships: Sequence[tuple[str, str, str, str, str]] = checks.RELATIONSHIPS


class CheckFailed(RuntimeError):
    """A table that must not be committed: ``failures`` has its report lines."""

    def __init__(self, table: str, failures: list[tuple]):
        self.table, self.failures = table, failures
        super().__init__(f"{table}: " + "; ".join(f"{f[0]} {f[2]}: {f[4]} rows, such as {f[5]}" for f in failures))


def row_metrics(table: str, rules: Rules) -> dict[str, tuple[tuple, Column]]:
    """Checks of single rows as aggregates: name -> (report line without its count, aggregate)."""
    found: dict[str, tuple[tuple, Column]] = {}
    for k, name in enumerate(rules.not_null.get(table, ())):
        found[f"n{k}"] = (("not_null", table, name, "error"), F.count_if(F.col(name).isNull()))
    for k, (own, name, values) in enumerate(rules.accepted):
        if own == table:
            bad = F.col(name).isNotNull() & ~F.col(name).isin(*values)
            found[f"a{k}"] = (("accepted_values", table, name, "error"), F.count_if(bad))
            found[f"s{k}"] = (("sample", table, name, "error"), F.min(F.when(bad, F.col(name).cast("string"))))
    return found


def row_report(metrics: Mapping[str, tuple[tuple, Column]], values: Mapping) -> list[tuple]:
    """Report lines from the observed values."""
    return [
        (*line, int(values[name]), values.get(f"s{name[1:]}") if name[0] == "a" else None)
        for name, (line, _) in metrics.items() if name[0] != "s"
    ]


def all_writes(observed: Sequence[Mapping]) -> dict:
    """The metrics of a table's writes as one: counts add up, the least sample stays."""
    names = {n for values in observed for n in values}
    found = {n: [v[n] for v in observed if v[n] is not None] for n in names}
    return {n: (min(v) if v else None) if n[0] == "s" else sum(v) for n, v in found.items()}


def key_census(df: DataFrame, table: str, parents: Callable[[str], DataFrame], rules: Rules) -> DataFrame | None:
    """Report lines of all checks on keys of one table, from one pass over it and one aggregate.

    ``parents`` gives the tables keys are looked up in; of a parent only the key column is read. Keys are counted before
    the shuffle, so a key with a third of the rows is one row per task.
    """
    lines: list[tuple] = [("unique", table, name, "error") for own, name in rules.unique if own == table]
    owned = [r for r in rules.relationships if r[0] == table]
    lines += [("relationships", table, name, severity) for _, name, _, _, severity in owned]
    if not lines:
        return None
    pairs = [F.struct(F.lit(k).alias("line"), F.col(line[2]).cast("string").alias("key")) for k, line in enumerate(lines)]
    own_keys = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.line", "p.key", F.lit(1).alias("n"), F.lit(False).alias("known"))
    sources = [own_keys.filter("key IS NOT NULL")]
    first = len(lines) - len(owned)
    for k, (_, _, parent, key, _) in enumerate(owned):
        above = df if parent == table else parents(parent)
        sources.append(above.select(
            F.lit(first + k).alias("line"), F.col(key).cast("string").alias("key"), F.lit(0).alias("n"), F.lit(True).alias("known")
        ).filter("key IS NOT NULL"))
    keys = reduce(DataFrame.unionByName, sources).groupBy("line", "key").agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
    is_parent = F.col("line") >= first
    bad = F.when(is_parent, (F.col("n") > 0) & ~F.col("known")).otherwise(F.col("n") > 1)
    weight = F.when(is_parent, F.col("n")).otherwise(1)
    counts = keys.groupBy("line").agg(
        F.coalesce(F.sum(F.when(bad, weight)), F.lit(0)).alias("failing_rows"), F.min(F.when(bad, F.col("key"))).alias("sample_key")
    )
    named = F.explode(F.array(*[
        F.struct(F.lit(k).alias("line"), *[F.lit(v).alias(n) for n, v in zip(("check", "table", "column", "severity"), line)])
        for k, line in enumerate(lines)
    ]))
    report = df.sparkSession.range(1).select(named.alias("l")).select("l.*").join(counts, "line", "left")
    return report.select(
        "check", "table", "column", "severity", F.coalesce("failing_rows", F.lit(0)).cast("bigint").alias("failing_rows"), "sample_key"
    )


@dataclass
class Gate:
    """Checks every table of a build as it is written. ``report`` has a line per check made so far.

    With ``stop`` a failed check of severity ``error`` raises ``CheckFailed`` before the table is committed.
    """

    rules: Rules = field(default_factory=Rules)
    stop: bool = True
    report: list[tuple] = field(default_factory=list)

    def guarding(self, layers) -> Callable[[str, DataFrame], DataFrame]:
        """``layers.put`` with this gate before each commit. A parent is checked against as committed by then; one that a
        build writes later is waited for: the child's lines about it are made when the parent is written."""
        seen: dict[str, DataFrame] = {}
        waiting: dict[str, list[str]] = {}

        def put(name: str, df: DataFrame, part: Callable[[Column], DataFrame] | None = None) -> DataFrame:
            metrics, seen_rows = row_metrics(name, self.rules), []

            def watch(arranged: DataFrame) -> DataFrame:
                if not metrics:
                    return arranged
                seen_rows.append(Observation())
                return arranged.observe(seen_rows[-1], *[a.alias(n) for n, (_, a) in metrics.items()])

            def accept(written: DataFrame) -> None:
                lines = row_report(metrics, all_writes([o.get for o in seen_rows])) if metrics else []
                later = {r[2] for r in self.rules.relationships if r[0] == name} - {name, *seen}
                for parent in later:
                    waiting.setdefault(parent, []).append(name)
                now = Rules(self.rules.unique, {}, (), [r for r in self.rules.relationships if r[2] not in later])
                tables = [(name, now, {**seen, name: written})]
                for child in waiting.pop(name, []):
                    tables.append((child, Rules((), {}, (), [r for r in self.rules.relationships if r[:1] + r[2:3] == (child, name)]), {**seen, name: written}))
                for table, rules, known in tables:
                    census = key_census(known[table], table, known.__getitem__, rules)
                    lines += [tuple(r) for r in census.collect()] if census is not None else []  # a row per check
                self.report += lines
                failed = [line for line in lines if line[3] == "error" and line[4]]
                if failed and self.stop:
                    raise CheckFailed(name, failed)

            layout = layers.layouts.get(name, versions.PLAIN)
            seen[name] = versions.put(df, layers.path(name), layout, accept=accept, watch=watch, part=part)
            return seen[name]

        return put

    def as_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.report, REPORT)
