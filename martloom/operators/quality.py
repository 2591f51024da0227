"""Data checks as Spark jobs.

Each function takes frames by model name and a list of checks of one kind, and returns
one row per check: model, test, column_name, failures. Values are counted before they
are compared or joined, so a value held by a third of the rows moves as one row.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Relationship(NamedTuple):
    model: str
    column: str
    parent: str
    parent_column: str


class AcceptedValues(NamedTuple):
    model: str
    column: str
    values: tuple


class Failing(NamedTuple):
    """A check whose failing values are asked for: ``test`` names its kind."""

    test: str
    model: str
    column: str
    accepted: tuple = ()
    parent: tuple[str, str] = ("", "")


class Rule(NamedTuple):
    name: str
    model: str
    columns: tuple[str, ...]
    violated: Column


def _union(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def _result(counted: DataFrame, model: str, test: str, column: str, failures: Column) -> DataFrame:
    return counted.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        "failures",
    )


def not_null(frames: dict[str, DataFrame], checks: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows without a value. One pass per model covers all its columns."""

    def of_model(model: str, columns: tuple[str, ...]) -> DataFrame:
        counts = frames[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
        )
        return counts.select(F.inline(pairs)).select(
            F.lit(model).alias("model"), F.lit("not_null").alias("test"), "column_name", "failures"
        )

    return _union([of_model(m, c) for m, c in checks.items()])


def unique(frames: dict[str, DataFrame], checks: list[tuple[str, str]]) -> DataFrame:
    """Values that occur more than once. NULL is not a value."""

    def of_column(model: str, column: str) -> DataFrame:
        rows = frames[model].where(F.col(column).isNotNull())
        repeated = rows.groupBy(column).count().where("count > 1")
        return _result(repeated, model, "unique", column, F.count("*"))

    return _union([of_column(*c) for c in checks])


def unique_combination(
    frames: dict[str, DataFrame], checks: list[tuple[str, tuple[str, ...]]]
) -> DataFrame:
    """Combinations that occur more than once. NULLs count as equal."""

    def of_columns(model: str, columns: tuple[str, ...]) -> DataFrame:
        repeated = frames[model].groupBy(*columns).count().where("count > 1")
        return _result(
            repeated, model, "unique_combination_of_columns", ",".join(columns), F.count("*")
        )

    return _union([of_columns(*c) for c in checks])


def relationships(frames: dict[str, DataFrame], checks: list[Relationship]) -> DataFrame:
    """Rows that name a parent which does not exist."""

    def of_check(check: Relationship) -> DataFrame:
        children = (
            frames[check.model]
            .where(F.col(check.column).isNotNull())
            .groupBy(F.col(check.column).alias("child_key"))
            .agg(F.count("*").alias("n"))
        )
        parents = frames[check.parent].select(F.col(check.parent_column).alias("child_key"))
        orphans = children.join(parents, "child_key", "left_anti")
        return _result(orphans, check.model, "relationships", check.column, F.sum("n"))

    return _union([of_check(c) for c in checks])


def accepted_values(frames: dict[str, DataFrame], checks: list[AcceptedValues]) -> DataFrame:
    """Distinct values outside the accepted ones. NULL is not a value."""

    def of_check(check: AcceptedValues) -> DataFrame:
        strange = frames[check.model].where(~F.col(check.column).isin(*check.values))
        return _result(
            strange.groupBy(check.column).count(),
            check.model,
            "accepted_values",
            check.column,
            F.count("*"),
        )

    return _union([of_check(c) for c in checks])


def equal_rowcount(frames: dict[str, DataFrame], checks: list[tuple[str, str, str]]) -> DataFrame:
    """Difference in rows between a model and the one it is compared with."""

    def of_pair(test: str, model: str, other: str) -> DataFrame:
        rows = frames[other].agg(F.count("*")).scalar()
        return _result(frames[model], model, test, other, F.abs(F.count("*") - rows))

    return _union([of_pair(*c) for c in checks])


def rows_without_value(rows: DataFrame, column: str) -> DataFrame:
    """The rows that fail ``not_null``."""
    return rows.where(F.col(column).isNull())


def repeated_values(rows: DataFrame, *columns: str) -> DataFrame:
    """Values or combinations that fail ``unique``, and how many rows hold each."""
    held = rows.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else rows
    return held.groupBy(*columns).agg(F.count("*").alias("rows")).where("rows > 1")


def orphan_rows(rows: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    """The rows that name a parent which does not exist."""
    keys = parents.select(F.col(parent).alias(column)).distinct()
    return rows.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def strange_rows(rows: DataFrame, column: str, accepted: tuple) -> DataFrame:
    """The rows whose value is not an accepted one."""
    return rows.where(~F.col(column).isin(*accepted))


def failing_values(frames: dict[str, DataFrame], wanted: tuple[Failing, ...]) -> DataFrame:
    """The values behind each failure: model, test, column_name, value as text, rows."""

    def of_check(check: Failing) -> DataFrame:
        rows, column = frames[check.model], check.column
        if check.test == "not_null":
            found = rows_without_value(rows, column)
        elif check.test == "accepted_values":
            found = strange_rows(rows, column, check.accepted)
        elif check.test == "relationships":
            model, parent = check.parent
            found = orphan_rows(rows, column, frames[model], parent)
        elif check.test == "unique":
            found = repeated_values(rows, column)
        else:
            raise ValueError(f"no failing values for {check.test}")
        if check.test != "unique":
            found = found.groupBy(column).agg(F.count("*").alias("rows"))
        return found.select(
            F.lit(check.model).alias("model"),
            F.lit(check.test).alias("test"),
            F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("value"),
            "rows",
        )

    return _union([of_check(c) for c in wanted])


def failing_rows(frames: dict[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows that break a rule, with the columns that tell why."""
    return frames[rule.model].where(rule.violated).select(*rule.columns)


def domain_rules(frames: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Rows that break each rule."""
    return _union(
        [
            _result(failing_rows(frames, r), r.model, r.name, ",".join(r.columns), F.count("*"))
            for r in rules
        ]
    )


class Observed:
    """Checks of one model's rows, counted while these are written.

    No row is read once more. ``accepted_values`` counts rows here, not distinct values,
    since an observation holds no set; a check passes here if it passes there.
    """

    def __init__(
        self,
        model: str,
        not_null: tuple[str, ...] = (),
        accepted: list[AcceptedValues] = (),
        rules: list[Rule] = (),
    ):
        self.model = model
        self._checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
        for check in accepted:
            strange = ~F.col(check.column).isin(*check.values)
            self._checks.append(("accepted_values", check.column, strange))
        self._checks += [(r.name, ",".join(r.columns), r.violated) for r in rules]
        self._observation: Observation | None = None

    def __call__(self, rows: DataFrame) -> DataFrame:
        """``rows``, observed. The first action on them counts."""
        self._observation = Observation()
        counts = [F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(self._checks)]
        return rows.observe(self._observation, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def written(self) -> bool:
        return self._observation is not None

    @property
    def rows(self) -> int:
        return self._observation.get["rows"]

    def failures(self) -> list[tuple[str, str, str, int]]:
        """Model, test, column_name, failures: one entry per check."""
        found = self._observation.get
        return [(self.model, t, c, found[f"c{i}"]) for i, (t, c, _) in enumerate(self._checks)]


def outcomes(spark: SparkSession, found: list[tuple[str, str, str, int]]) -> DataFrame:
    """Counted failures as the other checks show them, with a status."""
    names = "model string, test string, column_name string, failures bigint"
    outcome = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return spark.createDataFrame(found, names).withColumn("status", outcome)
