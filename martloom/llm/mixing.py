"""Mixing to target weights: iterative proportional fitting, then calibrated sampling.

Token counts are reduced to one row per cell, that is per combination of the dimension
values. Each sweep scales the cells to the target shares of one dimension after the
other. The ratio of fitted to counted tokens, divided by the largest ratio, is the
probability of a document: the expected tokens of the sample then have the fitted
marginals, and no larger sample has them without drawing a document twice.

One rare cell can thus fix the size of the whole sample. Where a size is asked for, cells
are drawn whole at most, and every sweep spreads what they lack over the others, by one
rule for all sizes: where no cell is drawn whole, the shares are the exact ones. ``lacks`` tells what
is missing from the targets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.tables import read_table
from martloom.session import keep

SWEEPS = 8
WORD = r"[^\x20\x09-\x0D]+"
# A dimension's target shares are its token shares to this power, scaled to 1: below 1,
# rare values gain. A table of shares may be given instead.
POWERS = {"source": 0.6, "lang": 0.7, "topic": 0.8}
SEED = "mix-1"


def topic() -> Column:
    """A topic by the form of the text, for tables without a topic column."""
    text = F.coalesce("text", F.lit(""))
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("token = ") | text.contains("@"), "contact")
        .when(text.contains("%%%") | text.contains("!!") | text.contains("###"), "marked")
        .otherwise("prose")
    )


def token_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def dimension_key(column: str) -> Column:
    """A text for every value, also for a missing one."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value))


def power_targets(cells: DataFrame, name: str, power: float) -> DataFrame:
    """Target share of every value of dimension ``name`` that has tokens."""
    shares = (
        cells.groupBy(name)
        .agg(F.sum("tokens").alias("tokens"))
        .where("tokens > 0")
        .select(F.col(name), F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("raw"))
    )
    total = shares.agg(F.sum("raw")).scalar()
    return shares.select(name, (F.col("raw") / total).alias("share"))


def _same(frame: DataFrame, *names: str) -> tuple[DataFrame, Column]:
    """The right side of a join and its condition; a missing value equals itself.

    The key of the right side becomes ``__same``, or, of several, ``__same`` and a number.
    """
    columns = [f"__same{i or ''}" for i in range(len(names))]
    renamed = frame.withColumnsRenamed(dict(zip(names, columns)))
    same = [F.col(n).eqNullSafe(F.col(c)) for n, c in zip(names, columns)]
    return renamed, reduce(Column.__and__, same)


def _swept(
    cells: DataFrame, wanted: dict[str, DataFrame], column: str, sweeps: int, cut: bool
) -> DataFrame:
    """``cells`` with ``fitted``, scaled in turn to what the values of each dimension are to have.

    What is wanted is joined to the cells once, and every step is written, so that a step
    is one sum and one join: its plan, and what the driver holds for it, has nothing of the
    steps before. The cells stay distributed. ``cut`` cuts them to their tokens after a sweep.
    """
    tokens = F.col("tokens").cast("double")
    fitted, names = cells.withColumn("fitted", tokens), list(wanted)
    for i, name in enumerate(names):
        share = wanted[name].select(name, F.col(column).alias(f"__wanted{i}"))
        fitted = fitted.join(*_same(share, name), "left").drop("__same")
    fitted = keep(fitted, "cells")
    for sweep in range(sweeps):
        for i, name in enumerate(names):
            now = fitted.groupBy(name).agg(F.sum("fitted").alias("__now"))
            factor = F.when(F.col("__now") > 0, F.col(f"__wanted{i}") / F.col("__now"))
            scaled = F.col("fitted") * F.coalesce(factor, F.lit(0.0))
            if cut and name == names[-1]:
                scaled = F.least(scaled, tokens)
            step = fitted.join(*_same(now, name)).withColumn("fitted", scaled)
            fitted = keep(step.drop("__now", "__same"), f"sweep{sweep}")
    return fitted.drop(*[f"__wanted{i}" for i in range(len(names))])


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS
) -> DataFrame:
    """``cells`` (dimensions and ``tokens``) with ``fitted``, shares that add up to 1.

    ``targets`` has for every dimension a frame of value and ``share``. A value without
    a target gets none of the weight.
    """
    return _swept(cells, targets, "share", sweeps, cut=False)


def capped_needs(
    cells: DataFrame, name: str, target: DataFrame, total: float
) -> DataFrame:
    """Tokens to draw of every value of ``name``, ``total`` in all and no more than there are.

    What a value lacks is spread over the others in proportion to their shares.
    """
    values = keep(
        cells.groupBy(name).agg(F.sum("tokens").alias("tokens")).join(*_same(target, name)).drop("__same"),
        "values",
    )
    level, full = 0.0, -1
    while True:
        capped = F.col("tokens") <= F.lit(level) * F.col("share")
        now = values.agg(
            F.count_if(capped).alias("full"),
            F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("taken"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("share"))).alias("open"),
        ).first()
        if now["full"] in (None, full) or not now["open"]:
            break
        full, level = now["full"], (total - now["taken"]) / now["open"]
    return values.select(
        name, F.least(F.col("tokens"), F.lit(level) * F.col("share")).alias("need")
    )


def rake_within(
    cells: DataFrame, targets: dict[str, DataFrame], total: float, sweeps: int = SWEEPS
) -> DataFrame:
    """``cells`` with ``fitted`` tokens, about ``total`` in all and in no cell more than it has.

    Every sweep scales the cells to what each value is to have and then cuts them to their
    tokens, so that the next one spreads over others what a cell could not take. Values
    without a target get nothing.
    """
    needs = {n: keep(capped_needs(cells, n, t, total), "needs") for n, t in targets.items()}
    return _swept(cells, needs, "need", sweeps, cut=True)


def draw(column: str, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the value and the seed alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _counted(docs: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    return docs.withColumns(
        {f"mix_{d}": e for d, e in dimensions.items()} | {"n_tokens": token_count()}
    )


def cell_rates(
    docs: DataFrame,
    dimensions: dict[str, Column],
    targets: dict[str, DataFrame] | None = None,
    powers: dict[str, float] | None = None,
    size: float | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``n_tokens`` and ``probability`` of every cell, and the targets (see ``mix``)."""
    powers = powers or POWERS
    names = [f"mix_{d}" for d in dimensions]
    cells = keep(
        _counted(docs, dimensions).groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "mix_tokens"
    )
    if targets is None:
        targets = {
            f"mix_{d}": keep(power_targets(cells, f"mix_{d}", powers[d]), "targets")
            for d in dimensions
        }
    if size is None:
        rated = rake(cells, targets).withColumn("ratio", _per_token())
        largest = rated.agg(F.nullif(F.max("ratio"), F.lit(0.0))).scalar()
        chance = F.coalesce(F.col("ratio") / largest, F.lit(0.0))
    else:
        total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        rated = rake_within(cells, targets, size * total).withColumn("ratio", _per_token())
        chance = F.least(F.col("ratio"), F.lit(1.0))
    rates = rated.select(*names, F.col("tokens").alias("n_tokens"), chance.alias("probability"))
    return rates, targets


def mix(
    docs: DataFrame,
    dimensions: dict[str, Column],
    targets: dict[str, DataFrame] | None = None,
    powers: dict[str, float] | None = None,
    id_column: str = "doc_id",
    seed: str = SEED,
    size: float | None = None,
    rates: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with ``mix_<dimension>``, ``n_tokens``, ``probability`` and ``sampled``.

    ``dimensions`` names the expression of each dimension; a missing value is a value like
    others. Targets are given as frames of ``mix_<dimension>`` and ``share``, or else
    follow from ``powers``. Documents without tokens get the probability of their cell;
    where a cell has no tokens it is 0. Rows that share an id share their draw; rows
    without id share one as well. Columns of these names are replaced.

    ``size`` is the share of all tokens that is drawn in expectation: rare cells whole, the
    others as near to the targets as they allow. Without it the sample is the largest
    one that has the exact targets. ``rates`` are those of ``cell_rates``, if known.
    """
    names = [f"mix_{d}" for d in dimensions]
    made = {*names, "n_tokens", "probability", "sampled"}
    given = [c for c in docs.columns if c not in made]
    if rates is None:
        rates, _ = cell_rates(docs, dimensions, targets, powers, size)
    own = rates.select(*names, "probability")
    return _counted(docs, dimensions).drop("probability").join(*_same(own, *names)).select(
        *given, *names, "n_tokens", "probability",
        (draw(id_column, seed) < F.col("probability")).alias("sampled"),
    )


def _per_token() -> Column:
    return F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(0.0)


def lacks(mixed: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """dimension, value, wanted, expected and lacking tokens of every target value.

    Wanted is the value's share of the tokens that ``mixed``, a result of ``mix`` or of
    ``cell_rates``, is expected to draw.
    """
    drawn = F.col("n_tokens") * F.col("probability")
    total = mixed.agg(F.sum(drawn)).scalar()
    parts = []
    for name, target in targets.items():
        got = mixed.groupBy(name).agg(F.sum(drawn).alias("expected"))
        wanted = (F.col("share") * total).alias("wanted")
        expected = F.coalesce("expected", F.lit(0.0)).alias("expected")
        rows = target.join(*_same(got, name), "left").select(
            F.lit(name).alias("dimension"), F.col(name).alias("value"), wanted, expected
        )
        short = F.greatest(F.col("wanted") - F.col("expected"), F.lit(0.0))
        parts.append(rows.withColumn("lacking", short))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def document_dimensions() -> dict[str, Column]:
    return {"source": dimension_key("source"), "lang": dimension_key("lang"), "topic": topic()}


def op6_rake_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Probability and draw of every document; native functions only."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return mix(docs, document_dimensions()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "mix_source",
        "mix_lang",
        "mix_topic",
        "n_tokens",
        F.round("probability", 9).alias("probability"),
        "sampled",
    )


def sampled_sql(docs: str) -> str:
    """The rows of ``op6_rake_mixture`` over the relation ``docs``, sweep by sweep."""
    parts = [
        f"""counted AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS mix_source,
    CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS mix_lang,
    CASE WHEN contains(t, ' | ') THEN 'table'
      WHEN contains(t, 'token = ') OR contains(t, '@') THEN 'contact'
      WHEN contains(t, '%%%') OR contains(t, '!!') OR contains(t, '###') THEN 'marked'
      ELSE 'prose' END AS mix_topic,
    len(regexp_extract_all(t, '{WORD}'))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM {docs}))""",
        """cells AS MATERIALIZED (
  SELECT mix_source, mix_lang, mix_topic, sum(n_tokens) AS tokens, sum(n_tokens)::DOUBLE AS fitted
  FROM counted GROUP BY ALL)""",
    ]
    before = "cells"
    for d, power in POWERS.items():
        parts.append(
            f"""target_{d} AS MATERIALIZED (
  SELECT mix_{d}, raw / sum(raw) OVER () AS share FROM (
    SELECT mix_{d}, pow(sum(tokens)::DOUBLE, {power}) AS raw
    FROM cells GROUP BY 1 HAVING sum(tokens) > 0))"""
        )
    for sweep in range(SWEEPS):
        for d in POWERS:
            now = f"sweep{sweep}_{d}"
            parts.append(
                f"""{now} AS MATERIALIZED (
  SELECT c.mix_source, c.mix_lang, c.mix_topic, tokens, fitted * coalesce(share / nullif(now, 0), 0) AS fitted
  FROM {before} c LEFT JOIN (SELECT mix_{d}, sum(fitted) AS now FROM {before} GROUP BY 1) s USING (mix_{d})
  LEFT JOIN target_{d} t USING (mix_{d}))"""
            )
            before = now
    parts.append(
        f"""rates AS MATERIALIZED (
  SELECT mix_source, mix_lang, mix_topic,
    coalesce(ratio / nullif(max(ratio) OVER (), 0), 0) AS probability
  FROM (SELECT *, CASE WHEN tokens > 0 THEN fitted / tokens ELSE 0 END AS ratio FROM {before}))"""
    )
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, mix_source, mix_lang, mix_topic, n_tokens, round(probability, 9) AS probability,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(2**52)}
    < probability AS sampled
FROM counted JOIN rates USING (mix_source, mix_lang, mix_topic)"""
    )


def oracle_sql() -> str:
    return sampled_sql("documents")
