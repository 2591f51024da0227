"""Ranks over a whole table that are kept while its values change."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.operators.sums import PART, GroupTable
from martloom.session import keep, temporary_tables

# Ranges of a ranking: what the manifest holds, and how many tasks rank at once. A range is
# ranked by one task, so rankings of very many values need more of them.
RANGES = 64
# Ranges are cut anew once the largest holds so many times the mean.
UNEVEN = 8
_NONE = "none"


class RankedValues(GroupTable):
    """How many rows hold each value, stored by range of values, largest value first.

    The manifest counts the values and rows of every range. A rank is the place within the
    range plus the counts of the ranges above, so a change writes the ranges of the values
    it touches, and shifts all ranks below by changing counts. NULL is a value of its own
    and comes last.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        kind: str,
        comment: str = "",
        ranges: int = RANGES,
    ):
        super().__init__(spark, root, ("value",), F.lit(None), comment)
        self.kind, self.ranges = kind, ranges
        self._bounds: list[str] = []

    def load(self, rows: DataFrame, value: str) -> None:
        """Count the values of all rows anew."""
        counted = rows.groupBy(F.col(value).cast(self.kind).alias("value"))
        self._cut(counted.agg(F.count("*").alias("n")))

    def add(self, differences: DataFrame, token: int | None = None) -> None:
        """Take over rows that came (``n`` above 0) or went, by value."""
        self._bind(self._state(self._version()))
        super().add(differences.select(F.col("value").cast(self.kind), "n"), token)
        state = self._state(self._version())
        sizes = [values for values, _ in state["ranges"].values()]
        if sizes and max(sizes) * len(sizes) > UNEVEN * sum(sizes):
            self._cut(self.read(), state.get("token"))

    def ranks(self) -> DataFrame:
        """Every value with ``n``, ``dense_rank`` from the largest down, and ``rows_above``."""
        state = self._state(self._version())
        return self._ranked(state, list(state["ranges"]))

    def ranks_of(self, values: DataFrame) -> DataFrame:
        """The ranks of some values (column ``value``); only their ranges are read."""
        state = self._state(self._version())
        self._bind(state)
        wanted = values.select(F.col("value").cast(self.kind)).distinct()
        names = {row[0] for row in wanted.select(self._part).distinct().collect()}
        ranked = self._ranked(state, [p for p in state["ranges"] if p in names])
        return self._join(ranked, wanted, "left_semi")

    def best(self, k: int) -> DataFrame:
        """Values on the first ``k`` dense ranks; only the highest ranges are read."""
        state = self._state(self._version())
        names = [part for part, values, _ in self._starts(state) if values < k]
        return self._ranked(state, names).where(F.col("dense_rank") <= k)

    def _starts(self, state: dict) -> list[tuple[str, int, int]]:
        """Each range in ranking order, with the values and rows ranked before it."""
        ranges = state["ranges"]
        names = sorted((p for p in ranges if p != _NONE), reverse=True)
        names += [p for p in ranges if p == _NONE]
        before = accumulate(
            (ranges[p] for p in names), lambda a, b: (a[0] + b[0], a[1] + b[1]), initial=(0, 0)
        )
        return [(name, values, rows) for name, (values, rows) in zip(names, before)]

    def _ranked(self, state: dict, parts: list[str]) -> DataFrame:
        self._bind(state)
        starts = self.spark.createDataFrame(
            self._starts(state), f"{PART} string, values_above bigint, rows_start bigint"
        )
        inside = W.partitionBy(PART).orderBy(F.desc("value"))
        above = F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, -1))
        return (
            self._read_parts(state, parts)
            .withColumn(PART, self._part)
            .select("*", F.row_number().over(inside).alias("place"), above.alias("above"))
            # One row per range.
            .join(F.broadcast(starts), PART)
            .select(
                "value",
                "n",
                (F.col("values_above") + F.col("place")).alias("dense_rank"),
                (F.col("rows_start") + F.coalesce("above", F.lit(0))).alias("rows_above"),
            )
        )

    def _cut(self, counted: DataFrame, token: int | None = None) -> None:
        """Store counted values in ranges of about equally many."""
        with temporary_tables(self.spark):
            counted = keep(counted, "values")
            shares = [i / self.ranges for i in range(1, self.ranges)]
            found = counted.agg(F.percentile_approx("value", shares)).first()[0] or []
            self._bounds = [str(bound) for bound in sorted(set(found))]
            self._part = self._range()
            version, snapshot = self._version(), self._next_snapshot()
            written = self._write(counted, snapshot)
            self._publish_parts(version, counted, dict.fromkeys(written, snapshot), token)

    def _bind(self, state: dict) -> None:
        self._bounds = state["bounds"]
        self._part = self._range()

    def _range(self) -> Column:
        """The name of a value's range: how many bounds it reaches."""
        reached = F.lit(0)
        if self._bounds:
            bounds = F.array(*[F.lit(b).cast(self.kind) for b in self._bounds])
            reached = F.size(F.filter(bounds, lambda bound: bound <= F.col("value")))
        name = F.lpad(reached.cast("string"), 4, "0")
        return F.when(F.col("value").isNotNull(), name).otherwise(_NONE)

    def _publish_parts(self, base: int, df: DataFrame, parts: dict, token: int | None) -> None:
        before = self._state(base) if base else {"parts": {}, "ranges": {}}
        state = {"schema": df.schema.jsonValue(), "parts": parts, "bounds": self._bounds}
        written = [p for p, s in parts.items() if before["parts"].get(p) != s]
        ranges = {p: counts for p, counts in before["ranges"].items() if p in parts}
        counted = self._read_parts(state, written).groupBy(self._part.alias(PART))
        for part, values, rows in counted.agg(F.count("*"), F.sum("n")).collect():
            ranges[part] = [values, rows]
        state["ranges"] = ranges
        self._publish(base, state if token is None else {**state, "token": token})
