"""How far the sources of a language differ in their words.

Duplicate texts are collapsed first: a filter tells which texts of a language may occur
more than once; only these are shuffled and become one row with the number of copies in
every source, while the others stay where they are as a group of one. Each text is then
tokenized once, and its counts and document frequencies are added with its copies as
weights. Terms of one language lie in one row with the counts of the sources that hold
them, so that a pair of sources is evaluated over the terms they share alone; what
either holds alone depends on a count only and is summed by count.

All figures are whole numbers. A share p = 1 + floor(10^9 (count + 1) / (N + V)) is at
most 10^9 + 1, its distance floor((p - q)^2 / q) below 2^60, and the distances of a pair
add up to less than (10^9 + V)^2, which a long holds for up to 2 * 10^9 terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.tables import read_table
from martloom.session import keep

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000

# Counters are emptied at so many entries, texts are cut to pieces of so many bytes.
ENTRIES = 400_000
PIECE = 1 << 20
# Pairs are formed in slices of so many.
PAIRS = 1 << 20

# Letters of ASCII in lower case, all bytes of longer characters, blanks for the rest.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_COUNTED = "lang string, source string, term string, n long, d long"
_PAIR = "lang string, left int, right int, value long"


def _collapsed(docs: DataFrame) -> DataFrame:
    """lang, text and an array of (source, n): one row per distinct text of a language."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*named)
    keys = rows.select(F.xxhash64("lang", "text").alias("key"))
    known = repeats.repeated_filter(keys, docs.count())
    told = rows.withColumn("key", F.xxhash64("lang", "text")).withColumn(
        "repeated", repeats.may_repeat(known, "key")
    )
    one = F.lit(1).cast("long")
    alone = told.where("NOT repeated").select(
        "lang", "text", F.array(F.struct("source", one.alias("n"))).alias("sources")
    )
    grouped = (
        told.where("repeated")
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
        .groupBy("lang", "digest", "source")
        .agg(F.count("*").alias("n"), F.first("text").alias("text"))
        .groupBy("lang", "digest")
        .agg(F.first("text").alias("text"), F.collect_list(F.struct("source", "n")).alias("sources"))
    )
    return alone.unionAll(grouped.select("lang", "text", "sources"))


def _terms(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded size."""
    data = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + PIECE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term, by language and source."""
    totals: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emptied() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in totals.items():
            for begin in range(0, len(n), 20_000):
                terms = list(n)[begin : begin + 20_000] if len(n) > 20_000 else list(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(terms), pa.string()),
                        pa.array([source] * len(terms), pa.string()),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in terms], pa.int64()),
                        pa.array([d[t] for t in terms], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "d"],
                )
        totals.clear()

    entries = 0
    for batch in batches:
        for lang, text, sources in zip(*(batch.column(i).to_pylist() for i in range(3))):
            single = len(sources) == 1 and sources[0]["n"] == 1
            seen: set[bytes] = set()
            occurrences: Counter = Counter()
            if single:
                n, d = totals.setdefault((lang, sources[0]["source"]), (Counter(), Counter()))
                entries -= len(n)
                for piece in _terms(text):
                    n.update(piece)
                    seen.update(piece)
                d.update(seen)
                entries += len(n)
            else:
                for piece in _terms(text):
                    occurrences.update(piece)
                for place in sources:
                    n, d = totals.setdefault((lang, place["source"]), (Counter(), Counter()))
                    entries -= len(n)
                    for term, times in occurrences.items():
                        n[term] += times * place["n"]
                        d[term] += place["n"]
                    entries += len(n)
            if entries >= ENTRIES:
                yield from emptied()
                entries = 0
    yield from emptied()


def kept_terms(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, term, total and an array of (side, n) of every term in enough documents.

    ``groups`` numbers the sources of a language by ``side``. Sources without the term
    are not in the array.
    """
    counts = (
        _collapsed(docs)
        .mapInArrow(_counted, _COUNTED)
        # One shuffle for both sums: a term is a row per task and source by now.
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    )
    return (
        counts.join(groups.select("lang", "source", "side"), ["lang", "source"])
        .groupBy("lang", "term")
        .agg(
            F.sum("d").alias("documents"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("side", "n")).alias("sides"),
        )
        .where(F.col("documents") >= LEAST_DOCUMENTS)
        .select("lang", "term", "total", "sides")
    )


def _groups(docs: DataFrame) -> DataFrame:
    """Every occurring (lang, source), numbered within its language from 0 by ``side``."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    order = Window.partitionBy("lang").orderBy("source")
    found = docs.select(*names).distinct()
    return keep(found.withColumn("side", F.row_number().over(order) - 1), "groups")


def _share(count: str, whole: str, terms: str) -> str:
    """SQL of p; the product has more digits than a long."""
    return (
        f"1 + (cast(({count}) + 1 as decimal(20, 0)) * cast({SCALE} as decimal(10, 0)))"
        f" div cast({whole} + {terms} as decimal(20, 0))"
    )


def _distance(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _languages(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """terms, whole and, by side, the occurrences of every language, written once."""
    sums = (
        kept.select("lang", F.explode("sides").alias("s"))
        .groupBy("lang", F.col("s.side").alias("side"))
        .agg(F.sum("s.n").alias("n"), F.count("*").alias("held"))
    )
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("whole"))
    zero = F.lit(0).cast("long")
    # Missing sums are those of groups without kept terms.
    filled = groups.join(sums, ["lang", "side"], "left").withColumns(
        {"n": F.coalesce("n", zero), "held": F.coalesce("held", zero)}
    )
    listed = filled.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("side", "source", "n", "held"))).alias("sources")
    )
    out = listed.join(terms, "lang", "left").withColumns(
        {"terms": F.coalesce("terms", zero), "whole": F.coalesce("whole", zero)}
    )
    # The share of a term that a source does not hold; languages without terms have none.
    absent = F.expr(
        f"transform(sources, s -> if(terms = 0, null, {_share('0', 's.n', 'terms')}))"
    )
    return keep(out.withColumn("absent", absent), "languages")


def _shares(kept: DataFrame, languages: DataFrame) -> DataFrame:
    """Kept terms with q and an array of (side, p, absent) of the sources that hold them."""
    sides = F.expr(
        "transform(sides, s -> named_struct('side', s.side, 'p', "
        f"{_share('s.n', 'sources[s.side].n', 'terms')}, 'absent', absent[s.side]))"
    )
    return kept.join(languages, "lang").select(
        "lang", "term", F.expr(_share("total", "whole", "terms")).alias("q"), sides.alias("sides")
    )


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a shared term adds to a pair of sources, against either holding it alone."""

    def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        gap = p - q
        return gap * gap // q

    for batch in batches:
        lists = batch.column("sides")
        entries = lists.flatten()
        side, p, none = (entries.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        counts = np.diff(lists.offsets.to_numpy())
        begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
        # Language by entry, as a number within the batch.
        named = batch.column("lang").dictionary_encode()
        lang = np.repeat(named.indices.to_numpy(zero_copy_only=False), counts).astype(np.int64)
        partners, start = np.repeat(counts, counts), np.repeat(begin, counts)
        upto = np.cumsum(partners)
        sides = int(side.max()) + 1 if len(side) else 1
        at = 0
        while at < len(side):
            before = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, before + PAIRS, side="right")))
            own = partners[at:stop]
            left = np.repeat(np.arange(at, stop), own)
            inside = np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
            right = start[left] + inside
            other = left != right
            left, right = left[other], right[other]
            value = (
                far(p[left], p[right]) - far(p[left], none[right])
                - far(none[left], p[right]) + far(none[left], none[right])
            )
            code = (lang[left] * sides + side[left]) * sides + side[right]
            order = np.argsort(code, kind="stable")
            code, value = code[order], value[order]
            first = np.flatnonzero(np.diff(code, prepend=-1))
            if len(first):
                sums, code = np.add.reduceat(value, first), code[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        named.dictionary.take(pa.array(code // (sides * sides))).cast(pa.string()),
                        pa.array(code // sides % sides, pa.int32()),
                        pa.array(code % sides, pa.int32()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["lang", "left", "right", "value"],
                )
            at = stop


def _pair_rows(shares: DataFrame, languages: DataFrame) -> DataFrame:
    """lang, source, item and value of every ordered pair of a language's sources."""
    shared = shares.select("lang", "sides").mapInArrow(_pair_sums, _PAIR)
    # Terms of one source by their share, as many as there are different counts.
    held = (
        shares.select("lang", F.explode("sides").alias("s"))
        .groupBy("lang", F.col("s.side").alias("side"), F.col("s.p").alias("p"))
        .agg(F.count("*").alias("times"))
    )
    sides = languages.select("lang", "terms", F.posexplode("sources").alias("side", "s"), "absent")
    other = sides.select("lang", F.col("side").alias("other"), F.expr("absent[side]").alias("none"))
    met = held.join(other, "lang").where("side <> other")
    alone = met.select(
        "lang",
        F.col("side").alias("left"),
        F.col("other").alias("right"),
        (_distance("p", "none") * F.col("times")).alias("value"),
    ).unionAll(
        met.select(
            "lang",
            F.col("other").alias("left"),
            F.col("side").alias("right"),
            (_distance("none", "p") * F.col("times")).alias("value"),
        )
    )
    # Every pair, with the terms that neither holds; a shared one is in both numbers and
    # is added again by the shared part.
    pairs = sides.select("lang", "terms", "side", "s", F.expr("absent[side]").alias("p")).join(
        sides.select(
            "lang", F.col("side").alias("other"), F.col("s").alias("o"), F.expr("absent[side]").alias("q")
        ),
        "lang",
    ).where("side <> other")
    neither = F.coalesce(
        _distance("p", "q") * (F.col("terms") - F.col("s.held") - F.col("o.held")), F.lit(0).cast("long")
    )
    named = pairs.select(
        "lang", F.col("side").alias("left"), F.col("other").alias("right"),
        F.col("s.source").alias("source"), F.col("o.source").alias("item"), neither.alias("value"),
    )
    sums = shared.unionAll(alone).groupBy("lang", "left", "right").agg(F.sum("value").alias("more"))
    whole = F.col("value") + F.coalesce("more", F.lit(0).cast("long"))
    return named.join(sums, ["lang", "left", "right"], "left").select(
        "lang", "source", "item", whole.alias("value")
    )


def audit(docs: DataFrame, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value and rank: how a source differs from the others.

    ``docs`` has text, lang and source; missing ones count as empty. Part ``pair`` has
    every other source of the language, part ``term`` the terms that the source uses
    more than its language does, as far as ``ranks``; the largest values first, equal
    ones by item. A language without kept terms has pairs of value 0. Repeated rows
    count each. An empty table gives an empty result.
    """
    groups = _groups(docs)
    kept = keep(kept_terms(docs, groups), "terms")
    languages = _languages(groups, kept)
    shares = _shares(kept, languages)
    place = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    )
    names = languages.select("lang", F.posexplode("sources").alias("side", "s")).select(
        "lang", "side", "s.source"
    )
    terms = (
        shares.select("lang", F.col("term").alias("item"), "q", F.explode("sides").alias("s"))
        .where("s.p > q")
        .select("lang", F.col("s.side").alias("side"), "item", _distance("s.p", "q").alias("value"))
        .join(names, ["lang", "side"])
        .withColumn("rank", place)
        .where(F.col("rank") <= ranks)
    )
    pairs = _pair_rows(shares, languages).withColumn("rank", place)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionAll(part(terms, "term"))


def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(read_table(spark, folder, "documents"))


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents
), words AS MATERIALIZED (
  SELECT r, lang, source, translate(w, '{upper}', '{lower}') AS term, count(*)::HUGEINT AS n
  FROM (SELECT r, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs)
  GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM words GROUP BY 1, 2 HAVING count(*) >= {LEAST_DOCUMENTS}
), counts AS MATERIALIZED (
  SELECT lang, source, term, sum(w.n)::HUGEINT AS n FROM words w JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), langs AS MATERIALIZED (
  SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(k.n), 0)::HUGEINT AS whole
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept k USING (lang) GROUP BY 1
), sizes AS MATERIALIZED (
  SELECT g.lang, g.source, v, whole, coalesce(sum(c.n), 0)::HUGEINT AS size
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2, 3, 4
), shares AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (size + v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + 1)) // (whole + v) AS q
  FROM sizes s JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY 1, 2, 3
  ) z ON z.lang = a.lang AND z.source = a.source AND z.other = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM listed
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR place <= {TERM_RANKS}
"""
