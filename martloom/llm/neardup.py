"""Near duplicates by MinHash, with odd sketches to verify banded candidates.

A document is the set of its distinct five-word shingles. Documents with equal sets form
one class at once. Every class has ``SAMPLES`` MinHash samples. The first of them, in
bands of ``ROWS``, make buckets in which similar classes meet. All samples are folded
into an odd sketch: a bitmap in which sample (i, value) flips one bit, so that the
number of ones in the XOR of two sketches estimates how many samples differ. Pairs
that the sketch finds near enough are confirmed on their full sets.

No bucket is expanded into its pairs. Its members are compared block against block by
array arithmetic, and only the components of near ones leave the task, as one edge per
member. Joined over all buckets, these edges form clusters. Within a cluster the full
sets are compared, again block against block, and again only the components of linked
ones leave the task. Two linked documents that share a bucket are near by their sketches,
so they are in one cluster and their sets are compared: no link is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.llm.tables import NO_ID, carried, read_table, restored
from martloom.llm.words import mixed, shingles, split_words, text_slices
from martloom.session import keep

SHINGLE = 5
PERCENT = 85
SAMPLES = 128
BANDS, ROWS = 20, 4
SKETCH_BITS = 1024
# A pair is confirmed if its estimate is at most this much below the threshold: over
# five standard errors of 128 samples.
MARGIN = 0.2
BLOCK = 512
# Members of a block whose full sets are compared, sketches compared in one step, and
# shingles counted in one step.
SET_BLOCK = 128
COMPARED, COLUMNS = 1 << 16, 1 << 13

_SEEDS = np.random.default_rng(85).integers(1, 2**63, (SAMPLES, 2), dtype=np.uint64)

_GROUP = ["group", "block1", "block2"]
_SIGNATURE = (
    "doc_id long, n_shingles long, print1 long, print2 long, bands array<long>, sketch binary"
)


def signatures(texts: list[str | None]) -> dict[str, list]:
    """Set size, two fingerprints of the set, band hashes and odd sketch of every text."""
    values, first = shingles(split_words(texts, lower=True), SHINGLE)
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    starts = first[:-1][full]
    out = {
        "n_shingles": sizes.tolist(),
        "print1": [0] * len(texts),
        "print2": [0] * len(texts),
        "bands": [None] * len(texts),
        "sketch": [None] * len(texts),
    }
    if not len(full):
        return out
    one = np.add.reduceat(mixed(values ^ np.uint64(11)), starts)
    two = np.add.reduceat(mixed(values ^ np.uint64(13)), starts)
    samples = np.empty((SAMPLES, len(full)), dtype=np.uint64)
    for i, (xor, factor) in enumerate(_SEEDS):
        samples[i] = np.minimum.reduceat((values ^ xor) * (factor | np.uint64(1)), starts)
    banded = samples[: BANDS * ROWS].reshape(BANDS, ROWS, len(full))
    weights = (_SEEDS[:ROWS, 0] | np.uint64(1))[None, :, None]
    keys = mixed((mixed(banded) * weights).sum(1, dtype=np.uint64)).astype(np.int64).T
    places = mixed(samples + _SEEDS[:, 1][:, None]) % np.uint64(SKETCH_BITS)
    flips = np.zeros((len(full), SKETCH_BITS), dtype=np.uint8)
    for row in places:
        flips[np.arange(len(full)), row] ^= 1
    bits = np.packbits(flips, axis=1)
    for at, text in enumerate(full):
        out["print1"][text] = int(one[at].astype(np.int64))
        out["print2"][text] = int(two[at].astype(np.int64))
        out["bands"][text] = keys[at]
        out["sketch"][text] = bits[at].tobytes()
    return out


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated similarity from the number of ones in the XOR of two odd sketches."""
    share = np.minimum(1.0 - 2.0 * differing / SKETCH_BITS, 1.0)
    estimate = 1.0 + SKETCH_BITS / (4.0 * SAMPLES) * np.log(np.maximum(share, 1e-9))
    return estimate


def _signed(frames):
    for frame in frames:
        for part in text_slices(frame["text"], 2_000_000):
            some = frame.iloc[part]
            yield pd.DataFrame(
                {"doc_id": some["doc_id"].to_numpy()} | signatures(some["text"].tolist())
            )


def _sets(frames):
    for frame in frames:
        for part in text_slices(frame["text"]):
            some = frame.iloc[part]
            values, first = shingles(split_words(some["text"].tolist(), lower=True), SHINGLE)
            signed = values.astype(np.int64)
            yield pd.DataFrame(
                {
                    "doc_id": some["doc_id"].to_numpy(),
                    "shingles": [signed[a:b] for a, b in zip(first[:-1], first[1:])],
                }
            )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all nodes of ``edges``.

    ``edges`` has a and b. Larger neighbours are hung on the smallest neighbour, then
    smaller ones, in turn, until every edge leads to a component's smallest node. Each
    step is an aggregate and a join, and is written once.
    """
    stars = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
    stars = keep(stars.where("node <> low").distinct(), "edges")
    before = None
    while True:
        both = stars.unionAll(stars.select("low", "node"))
        least = both.groupBy("node").agg(F.min("low").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        larger = both.where("low > node").join(least, "node")
        large = larger.select(F.col("low").alias("node"), F.col("least").alias("low")).distinct()
        smallest = large.groupBy("node").agg(F.min("low").alias("least"))
        lower = F.when(F.col("low") == F.col("least"), F.col("node")).otherwise(F.col("low"))
        hung = large.join(smallest, "node").select(
            lower.alias("node"), F.col("least").alias("low")
        )
        # Edges and their hashes summed up while they are written: no change, no more steps.
        seen = Observation()
        digest = F.sum(F.shiftright(F.xxhash64("node", "low"), 24)).alias("digest")
        step = hung.where("node <> low").distinct()
        stars = keep(step.observe(seen, F.count(F.lit(1)).alias("edges"), digest), "stars")
        if seen.get == before or not seen.get["edges"]:
            break
        before = seen.get
    linked = stars.groupBy("node").agg(F.min("low").alias("component"))
    roots = linked.select(F.col("component").alias("node"), "component").distinct()
    return linked.unionAll(roots)


class _Group:
    """Columns of the rows that are compared, as arrays."""

    def __init__(self, rows: pd.DataFrame):
        self.side = rows["side"].to_numpy()
        self.node = rows["node"].to_numpy()
        self.size = rows["n_shingles"].to_numpy()
        bits = np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint64)
        self.sketch = bits.reshape(len(rows), SKETCH_BITS // 64)
        self.shingles = rows["shingles"].tolist() if "shingles" in rows else None
        if self.shingles is not None:
            self.size = np.array([len(s) for s in self.shingles])

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sketches of rows ``a`` and ``b`` let them be linked."""
        differing = np.bitwise_count(self.sketch[a] ^ self.sketch[b]).sum(-1, dtype=np.int64)
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        fits = similarity(differing) >= PERCENT / 100 - MARGIN
        return fits & (small * 100 >= large * PERCENT)

    def linked(self, rows: np.ndarray) -> np.ndarray:
        """Whether the full sets of any two of ``rows`` reach the threshold.

        Rows times the shingles that two or more of them hold: the product of this table
        with itself counts what each two have in common.
        """
        sets = [self.shingles[r] for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
        _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = held[column] > 1
        owner, column = owner[shared], column[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], np.cumsum(np.diff(column[order], prepend=-1) > 0) - 1
        common = np.zeros((len(rows), len(rows)))
        cuts = np.searchsorted(column, np.arange(0, column.max(initial=-1) + 2, COLUMNS))
        for begin, end in zip(cuts, np.append(cuts[1:], len(column))):
            table = np.zeros((len(rows), COLUMNS), dtype=np.float32)
            table[owner[begin:end], column[begin:end] % COLUMNS] = 1.0
            common += table @ table.T
        size = self.size[rows]
        return common * 100 >= (size[:, None] + size[None, :] - common) * PERCENT

    def stars(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Components of the rows of one group: the first row and each other one.

        Rows are near by their sketches and, where there are sets, linked by these. Rows
        of two blocks are compared across blocks only.
        """
        rows = np.arange(begin, end)
        meets = np.zeros((len(rows), len(rows)), dtype=bool)
        step = max(1, COMPARED // len(rows))
        for at in range(0, len(rows), step):
            meets[at : at + step] = self.near(rows[at : at + step, None], rows[None, :])
        side = self.side[rows]
        meets &= (side[:, None] != side[None, :]) | (side[:, None] == 0)
        if self.shingles is not None and meets.any():
            meets &= self.linked(rows)
        root = np.full(len(rows), -1)
        for first in range(len(rows)):
            if root[first] >= 0:
                continue
            root[first] = first
            reached = np.array([first])
            while len(reached):
                reached = np.flatnonzero(meets[reached].any(0) & (root < 0))
                root[reached] = first
        other = np.flatnonzero(root != np.arange(len(rows)))
        return self.node[rows[root[other]]], self.node[rows[other]]


def _found(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """Edges between the rows of each group that begins at one of ``starts``."""
    group = _Group(rows)
    ends = np.append(starts[1:], len(rows))
    pairs = [(np.array([], dtype=np.int64), np.array([], dtype=np.int64))]
    single = ends - starts > 2
    if group.shingles is None:
        # Groups of two, which are the most, at once: of one block, or one of each.
        two = starts[ends - starts == 2]
        two = two[np.isin(group.side[two] + group.side[two + 1], (0, 3))]
        two = two[group.near(two, two + 1)]
        pairs.append((group.node[two], group.node[two + 1]))
    else:
        single = ends - starts > 1
    pairs += [group.stars(b, e) for b, e in zip(starts[single], ends[single])]
    a, b = (np.concatenate(x) for x in zip(*pairs))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _compare(frames):
    """Edges of rows that come sorted by group; a group may cross batches."""
    rest = None
    for frame in frames:
        rows = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        keys = rows[_GROUP].to_numpy()
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        rest = rows.iloc[starts[-1] :]
        if len(starts) > 1:
            yield _found(rows.iloc[: starts[-1]], starts[:-1])
    if rest is not None and len(rest):
        yield _found(rest, np.array([0]))


def _edges(members: DataFrame) -> DataFrame:
    """Edges among the members of each group: ``members`` has group, blocks, node.

    A group is cut into blocks; every block is compared with itself and with each other.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = members.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "group",
        F.least("own", "other").alias("block1"),
        F.greatest("own", "other").alias("block2"),
        F.when(F.col("own") == F.col("other"), 0)
        .when(F.col("own") < F.col("other"), 1)
        .otherwise(2)
        .alias("side"),
        *[c for c in members.columns if c not in ("group", "blocks")],
    )
    return (
        placed.repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP)
        .mapInPandas(_compare, "a long, b long")
        .distinct()
    )


def _groups(placed: DataFrame, block: int) -> DataFrame:
    """Groups of two or more of ``placed`` (group, node) and their number of blocks."""
    counted = placed.groupBy("group").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / block).cast("int").alias("blocks")
    return counted.where("members > 1").select("group", blocks)


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (doc_id, n_shingles, node) and components of their nodes.

    ``docs`` has doc_id and text. ``node`` is the smallest doc_id of the class; documents
    without words have none.
    """
    texts = docs.select(carried(), "text")
    signed = keep(texts.mapInPandas(_signed, _SIGNATURE), "signatures")
    classes = (
        signed.where((F.col("n_shingles") > 0) & (F.col("doc_id") != NO_ID))
        .groupBy("print1", "print2", "n_shingles")
        .agg(F.min("doc_id").alias("node"))
    )
    prints = ["print1", "print2", "n_shingles"]
    membership = signed.select("doc_id", *prints).join(classes, prints, "left")
    membership = membership.withColumn("node", F.when(F.col("doc_id") != NO_ID, F.col("node")))
    nodes = keep(
        signed.join(classes.select("node"), signed["doc_id"] == classes["node"], "left_semi")
        .where("n_shingles > 0")
        .select(F.col("doc_id").alias("node"), "n_shingles", "bands", "sketch"),
        "nodes",
    )
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("group"), "node"
    )
    met = keep(banded.join(_groups(banded, BLOCK), "group"), "buckets")
    sketches = nodes.select("node", "n_shingles", "sketch")
    near = keep(_edges(met.join(sketches, "node")), "near")
    clusters = keep(
        components(near).select("node", F.col("component").alias("group")), "clusters"
    )
    sets = texts.join(clusters, texts["doc_id"] == clusters["node"], "left_semi").mapInPandas(
        _sets, "doc_id long, shingles array<long>"
    )
    members = (
        clusters.join(_groups(clusters, SET_BLOCK), "group")
        .join(sketches, "node")
        .join(sets.withColumnRenamed("doc_id", "node"), "node")
    )
    return membership, components(_edges(members))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Texts that are missing or without words have size 0 and are their own component.
    Rows without doc_id are linked with nothing: their component and ``kept`` are null.
    Rows that share a doc_id are one node. An empty table gives an empty result.
    """
    membership, parts = _linked(docs)
    own = F.coalesce("component", "node", "doc_id")
    return restored(membership).join(parts, "node", "left").select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        own.alias("component_id"),
        (F.col("doc_id") == own).alias("kept"),
    )


def op2_odd_sketch_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


def component_sql(docs: str) -> str:
    """Sizes and components of the relation ``docs``, from all pairs that share a shingle."""
    return f"""
worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {docs}
), shingled AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
    THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingled GROUP BY 1
), linked AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reached(a, b) AS (
  SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON l.a = r.b
), found AS MATERIALIZED (
  SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, low) AS component_id
  FROM worded w LEFT JOIN sizes USING (doc_id)
  LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reached GROUP BY 1) USING (doc_id)
)"""


def oracle_sql() -> str:
    return f"""WITH RECURSIVE {component_sql("documents")}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found"""
