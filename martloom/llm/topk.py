"""Exact top-k search by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it. Vectors in the
order of that key are cut into blocks; a block is an annulus around a pivot. For a query
q at distance D from the pivot, the triangle inequality bounds its distance from any
vector of an annulus [a, b] below by gap = max(0, D - b, a - D), and so the product:

    2 q.v = |q|^2 + |v|^2 - |q - v|^2 <= |q|^2 + max |v|^2 - gap^2

A query starts in its own annulus. The k-th best product there is the score to beat:
only annuli whose bound reaches it are read, and in these only the distances that can
reach it. Ties are kept, so that the smaller id wins exactly.

Neighbouring annuli are regions. A query goes once to each region that it can win in, and
there a task reads the region's annuli first and the queries after them, a few at a time.
Nothing is broadcast but the bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.tables import read_table
from martloom.session import keep

PIVOTS = 64
BLOCK_ROWS = 1024
# Bound on the number of full blocks, and so on their broadcast bounds (48 bytes a block;
# pivots and partitions add a part-filled block each): with more rows, blocks grow.
MOST_BLOCKS = 65_536
QUERY_ROWS = 512
# What a task holds of the vectors, as doubles; with fewer vectors, so many regions if there
# are as many blocks.
REGION_BYTES, REGIONS = 2**26, 64
# Queries that one task of a region takes.
LOT_QUERIES = 131_072
# Bounds that are compared with some queries at once.
BOUNDS_AT_ONCE = 8192
SLACK = 1e-6
# Whole numbers up to which a product's sums are exact as doubles, and as 64-bit numbers.
EXACT, WIDEST = 2.0**53, 2.0**63

_BLOCK = (
    "block long, dim int, pivot int, near double, far double, norm double, ids binary,"
    " asked binary, distances binary, vectors binary"
)
# Queries on their way to a region lie behind its blocks, whose numbers are smaller.
_BEHIND = 2**62
_SENT = (
    "task int, block long, dim int, pivot int, near double, far double, norm double, ids binary,"
    " distances binary, vectors binary, prints binary, beats binary"
)
_HIT = "query_id long, vec_id long, score long, print long"


def quantised(embedding: str = "embedding", scale: int = 256) -> Column:
    """floor(scale * x) of every component, null where a vector takes no part."""
    parts = F.col(embedding).cast("array<double>")
    odd = F.exists(
        parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    whole = F.transform(parts, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    return F.when(parts.isNotNull() & ~odd, whole)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _by_dim(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    for frame in frames:
        for dim, part in frame.groupby(frame["vector"].map(len), sort=True):
            yield int(dim), part


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """``count`` vectors of the smallest hashes; one dimension's pivots per entry.

    Pivots only steer the search. A dimension without a pivot gets the zero vector.
    """
    rows = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).select("vector").collect()
    )
    by_dim: dict[int, list] = {}
    for row in rows:
        by_dim.setdefault(len(row["vector"]), []).append(row["vector"])
    return {dim: np.unique(np.array(v, dtype=np.float64), axis=0) for dim, v in by_dim.items()}


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0.0))


def build_index(vectors: DataFrame, pivots: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Blocks of the vectors in the order of dimension, pivot and distance, written once."""

    def keyed(frames):
        for dim, part in _by_dim(frames):
            around = pivots.get(dim, np.zeros((1, dim)))
            distance = _distances(_matrix(part["vector"]), around)
            nearest = distance.argmin(1)
            yield pd.DataFrame(
                {
                    "vec_id": part["vec_id"].to_numpy(),
                    "asked": part["asked"].to_numpy(),
                    "vector": part["vector"].to_numpy(),
                    "dim": dim,
                    "pivot": nearest,
                    "distance": distance[np.arange(len(part)), nearest],
                }
            )

    def packed(frames):
        """Consecutive rows of one pivot; rows wait across batches until a block is full."""
        part, number = _partition(), 0
        waiting = None
        for frame in frames:
            rows = frame if waiting is None else pd.concat([waiting, frame], ignore_index=True)
            waiting = None
            groups = list(rows.groupby(["dim", "pivot"], sort=True))
            for at, ((dim, pivot), some) in enumerate(groups):
                for begin in range(0, len(some), block_rows):
                    block = some.iloc[begin : begin + block_rows]
                    if at == len(groups) - 1 and len(block) < block_rows:
                        waiting = block
                        break
                    yield _block((part << 33) + number, int(dim), int(pivot), block)
                    number += 1
        if waiting is not None:
            dim, pivot = waiting["dim"].iloc[0], waiting["pivot"].iloc[0]
            yield _block((part << 33) + number, int(dim), int(pivot), waiting)

    order = ["dim", "pivot", "distance", "vec_id"]
    ordered = (
        vectors.mapInPandas(
            keyed,
            "vec_id long, asked boolean, vector array<double>, dim int, pivot int, distance double",
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    return keep(ordered.mapInPandas(packed, _BLOCK), "annuli")


def _block(number: int, dim: int, pivot: int, rows: pd.DataFrame) -> pd.DataFrame:
    matrix = _matrix(rows["vector"])
    distance = rows["distance"].to_numpy(dtype=np.float64)
    return pd.DataFrame(
        {
            "block": [number],
            "dim": [dim],
            "pivot": [pivot],
            "near": [distance[0]],
            "far": [distance[-1]],
            "norm": [float((matrix**2).sum(1).max())],
            "ids": [rows["vec_id"].to_numpy(dtype=np.int64).tobytes()],
            "asked": [rows["asked"].to_numpy(dtype=bool).tobytes()],
            "distances": [distance.tobytes()],
            "vectors": [_packed(matrix)],
        }
    )


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _packed(matrix: np.ndarray) -> bytes:
    """Whole numbers, in 16 bits each where all of them fit."""
    if np.abs(matrix).max(initial=0.0) < 2**15:
        return matrix.astype(np.int16).tobytes()
    return matrix.tobytes()


def _unpacked(packed: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.int16 if len(packed) == 2 * rows * dim else np.float64
    return np.frombuffer(packed, dtype=kind).astype(np.float64).reshape(rows, dim)


def _ids_and_vectors(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, dtype=np.int64)
    return ids, _unpacked(row.vectors, len(ids), row.dim)


def _reach(squares: np.ndarray, away: np.ndarray, near, far, norm) -> np.ndarray:
    """The best product that queries, ``away`` from its pivot, can have in an annulus."""
    gap = np.maximum(0.0, np.maximum(away - far, near - away) - SLACK)
    norms = squares + norm
    return (norms - gap**2) / 2 + SLACK * (1 + norms)


def _regions(bounds: pd.DataFrame) -> np.ndarray:
    """The region of each block, blocks being in the order of the index."""
    size = bounds["rows"].to_numpy() * bounds["dim"].clip(lower=1).to_numpy() * 8
    most = min(REGION_BYTES, max(1, -(-int(size.sum()) // REGIONS)))
    return np.unique((np.cumsum(size) - size) // most, return_inverse=True)[1]


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as 64-bit numbers."""
    most = [np.abs(m).max(initial=0.0) for m in (queries, points)]
    largest = most[0] * most[1] * queries.shape[1]
    if largest < EXACT:
        return (queries @ points.T).astype(np.int64)
    if max(largest, *most) >= WIDEST:
        raise ValueError("vector components are too large: an inner product may exceed 64 bits")
    return queries.astype(np.int64) @ points.astype(np.int64).T


class _Best:
    """The k best products of some queries so far, ties to smaller ids."""

    def __init__(self, asked: np.ndarray, beats: np.ndarray, k: int):
        self.asked, self.k = asked, k
        # A product must reach ``beat``; one that equals the k-th, ``worst``, needs a smaller
        # id than that, ``last``.
        self.beat, self.worst = beats.copy(), np.zeros(len(asked), np.int64)
        self.last = np.full(len(asked), np.iinfo(np.int64).max)
        self.rows, self.ids, self.scores = (np.empty(0, np.int64) for _ in range(3))

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of some queries with vectors whose ids are in order."""
        beat = self.beat[rows, None]
        rounded = scores.astype(np.float64)
        hit = (rounded >= beat) & (ids[None, :] != self.asked[rows, None])
        tied = np.flatnonzero(self.last[rows] < np.iinfo(np.int64).max)
        if len(tied):
            late = ids[None, :] >= self.last[rows[tied], None]
            hit[tied] &= ~((scores[tied] == self.worst[rows[tied], None]) & late)
        many = np.flatnonzero(hit.sum(1) > self.k)
        if len(many):
            hit[many] = self._first(scores[many], hit[many])
        at, column = np.nonzero(hit)
        if len(at):
            self._merge(rows[at], ids[column], scores[at, column])

    def _first(self, scores: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """The k best of every row's hits; of equal ones, those to the left."""
        scores = np.where(hit, scores, np.iinfo(np.int64).min)
        kth = np.partition(scores, -self.k, axis=1)[:, -self.k, None]
        above, equal = scores > kth, hit & (scores == kth)
        return above | (equal & (equal.cumsum(1) <= self.k - above.sum(1)[:, None]))

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        rows, ids, scores = (
            np.concatenate(pair)
            for pair in ((self.rows, rows), (self.ids, ids), (self.scores, scores))
        )
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
        kept, full = rank < self.k, rank == self.k - 1
        self.beat[rows[full]] = np.maximum(self.beat[rows[full]], scores[full].astype(np.float64))
        self.last[rows[full]], self.worst[rows[full]] = ids[full], scores[full]
        self.rows, self.ids, self.scores = rows[kept], ids[kept], scores[kept]


def search(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """Each query's k best other vectors: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and ``vector`` (whole numbers as double). Products are exact;
    components so large that one might exceed 64 bits raise an error. Vectors that are null
    take no part; vectors meet only those of their own dimension. A query excludes its own
    row by vec_id. Rows of one vec_id that is repeated are all candidates and are ranked as
    equals. ``is_query`` is asked of every row. Query rows of one vec_id and equal vectors are
    one query; of unlike vectors each has ranks of its own. An empty table gives none.
    """
    spark = vectors.sparkSession
    vectors = vectors.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    count = vectors.count()
    block_rows = max(BLOCK_ROWS, -(-count // MOST_BLOCKS))
    centres = choose_pivots(vectors, pivots)
    asked = F.coalesce(is_query, F.lit(False)).alias("asked")
    blocks = build_index(vectors.select("vec_id", "vector", asked), centres, block_rows)

    def home(frames):
        """Every query within its own annulus, and its k-th best score there."""
        for frame in frames:
            for row in frame.itertuples():
                mine = np.frombuffer(row.asked, dtype=bool)
                if not mine.any():
                    continue
                ids, points = _ids_and_vectors(row)
                asked, matrix = ids[mine], points[mine]
                scores = _products(matrix, points).astype(np.float64)
                allowed = ids[None, :] != asked[:, None]
                ranked = -np.sort(-np.where(allowed, scores, -np.inf), axis=1)
                beat = ranked[:, k - 1] if len(ids) >= k else np.full(len(asked), -np.inf)
                yield pd.DataFrame(
                    {
                        "query_id": asked,
                        "dim": row.dim,
                        "beat": beat,
                        "vector": [v.tobytes() for v in matrix],
                    }
                )

    started = blocks.select("dim", "ids", "asked", "vectors").mapInPandas(
        home, "query_id long, dim int, beat double, vector binary"
    )
    # Query rows that are repeated are one query; the print tells unlike ones of an id apart.
    queries = keep(
        started.groupBy("query_id", "dim", "vector")
        .agg(F.max("beat").alias("beat"))
        .withColumn("print", F.xxhash64("vector")),
        "queries",
    )

    rows = (F.octet_length("ids") / 8).cast("long").alias("rows")
    bounds = blocks.select("block", "dim", "pivot", "near", "far", "norm", rows).toPandas()
    bounds = bounds.sort_values("block", ignore_index=True)
    bounds["region"] = _regions(bounds)
    known = spark.sparkContext.broadcast(
        {int(d): part.reset_index(drop=True) for d, part in bounds.groupby("dim")}
    )
    firsts = bounds.groupby("region")["block"].min().tolist()
    lots = max(1, -(-queries.count() // LOT_QUERIES))

    def routed(frames):
        """For every region the queries whose bound reaches their score to beat."""
        for frame in frames:
            for dim, some in frame.groupby("dim"):
                annuli = known.value[int(dim)]
                region, begins = np.unique(annuli["region"].to_numpy(), return_index=True)
                pivot = annuli["pivot"].to_numpy()
                edges = annuli[["near", "far", "norm"]].to_numpy()
                for at in range(0, len(some), QUERY_ROWS):
                    part = some.iloc[at : at + QUERY_ROWS]
                    ids, prints = (part[c].to_numpy(dtype=np.int64) for c in ("query_id", "print"))
                    beats = part["beat"].to_numpy()
                    matrix = np.stack(
                        [np.frombuffer(v, dtype=np.float64) for v in part["vector"]]
                    )
                    centre = _distances(matrix, centres.get(int(dim), np.zeros((1, int(dim)))))
                    squares = (matrix**2).sum(1)[:, None]
                    wanted = np.empty((len(part), len(annuli)), dtype=bool)
                    for low in range(0, len(annuli), BOUNDS_AT_ONCE):
                        cut = slice(low, low + BOUNDS_AT_ONCE)
                        reach = _reach(squares, centre[:, pivot[cut]], *edges[cut].T)
                        wanted[:, cut] = reach >= beats[:, None]
                    wanted = np.logical_or.reduceat(wanted, begins, axis=1)
                    lot = int(prints[0] % lots)
                    for j in np.flatnonzero(wanted.any(0)):
                        rows = wanted[:, j]
                        yield pd.DataFrame(
                            {
                                "task": [int(region[j]) * lots + lot],
                                "block": [_BEHIND],
                                "dim": [int(dim)],
                                "pivot": [0],
                                **{name: [0.0] for name in ("near", "far", "norm")},
                                "ids": [ids[rows].tobytes()],
                                "distances": [None],
                                "vectors": [_packed(matrix[rows])],
                                "prints": [prints[rows].tobytes()],
                                "beats": [beats[rows].tobytes()],
                            }
                        )

    def scored(frames):
        """The blocks of a region are held while its queries pass."""
        task, held = None, []
        for frame in frames:
            for row in frame.itertuples():
                if row.task != task:
                    task, held = row.task, []
                ids, matrix = _ids_and_vectors(row)
                if row.block < _BEHIND:
                    held.append((row, np.frombuffer(row.distances, dtype=np.float64), ids, matrix))
                    continue
                best = _Best(ids, np.frombuffer(row.beats, dtype=np.float64), k)
                squares = (matrix**2).sum(1)
                centre = _distances(matrix, centres.get(row.dim, np.zeros((1, row.dim))))
                for block, distances, points_ids, points in held:
                    if block.dim != row.dim:
                        continue
                    away = centre[:, block.pivot]
                    reach = _reach(squares, away, block.near, block.far, block.norm)
                    able = np.flatnonzero(reach >= best.beat)
                    if not len(able):
                        continue
                    # The widest part of the annulus that some query can still win in.
                    radius = np.sqrt(
                        np.maximum(0.0, squares[able] + block.norm - 2 * best.beat[able])
                        * (1 + SLACK)
                    )
                    # Distances of products beyond exact doubles are rounded.
                    slack = SLACK * (1.0 + np.sqrt(max(block.norm, squares[able].max())))
                    low = np.searchsorted(distances, (away[able] - radius).min() - slack, "left")
                    high = np.searchsorted(distances, (away[able] + radius).max() + slack, "right")
                    some = low + np.argsort(points_ids[low:high], kind="stable")
                    if len(some):
                        products = _products(matrix[able], points[some])
                        best.add(able, points_ids[some], products)
                prints = np.frombuffer(row.prints, dtype=np.int64)
                yield pd.DataFrame(
                    {
                        "query_id": ids[best.rows],
                        "vec_id": best.ids,
                        "score": best.scores,
                        "print": prints[best.rows],
                    }
                )

    sent = queries.mapInPandas(routed, _SENT)
    nothing = F.lit(None).cast("binary")
    region = F.size(F.filter(F.lit(firsts or [0]), lambda first: first <= F.col("block"))) - 1
    lot = F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))
    there = blocks.withColumn("lot", lot).select(
        (region * lots + F.col("lot")).alias("task"), "block", "dim", "pivot", "near", "far", "norm",
        "ids", "distances", "vectors", nothing.alias("prints"), nothing.alias("beats"),
    )
    hits = (
        there.unionAll(sent)
        .repartitionById(max(1, len(firsts) * lots), "task")
        .sortWithinPartitions("task", "block")
        .mapInPandas(scored, _HIT)
    )
    best = Window.partitionBy("query_id", "print").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_pivot_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best for every vec_id divisible by 50, against all other rows."""
    vectors = read_table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised().alias("vector")
    )
    return search(vectors, F.col("vec_id") % 50 == 0)


def oracle_sql() -> str:
    return """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
WHERE rank <= 5
"""
