"""Largest inner products by stable projections under a kd-tree, until a chi-square test holds."""

from __future__ import annotations

from math import exp, factorial, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.frames import written

PROJECTED = 8  # even, so that the chi-square distribution has a closed form
SAMPLE_ROWS = 16_384
CELL_ROWS = 4096
QUERY_ROWS = 512
LEAF_ROWS = 64
STEP_LEAVES = 8
EXACT_ROWS = 65_536
CONFIDENCE = 0.995


def chi_square(x: float, freedom: int = PROJECTED) -> float:
    """Probability that a chi-square variable of even freedom is at most ``x``."""
    half = x / 2
    return 1 - exp(-half) * sum(half**i / factorial(i) for i in range(freedom // 2))


def chi_square_bound(p: float, freedom: int = PROJECTED) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < p else (low, middle)
    return high


class Space:
    """Vectors made equally long, so that nearest is largest product; and their projection.

    A vector x gets one more component, sqrt(M - x.x) with M the largest x.x of
    all; a query gets 0. Then |x - q|^2 = M + q.q - 2 x.q. Normal random
    directions project differences to normal variables of their length: the
    squared projected distance over the squared distance is chi-square.
    """

    def __init__(self, dim: int, largest: float, seed: int):
        self.largest = largest
        self.directions = np.random.default_rng(seed).standard_normal((dim + 1, PROJECTED))

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x))
        if not query:
            extra = np.sqrt(np.maximum(self.largest - np.einsum("ij,ij->i", x, x), 0))
        return x @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def squared(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.maximum(self.largest + np.einsum("ij,ij->i", q, q) - 2 * score, 0)


def kd_split(points: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers by leaf: halves across the widest side until ``most`` are left."""
    if len(rows) <= most:
        return [rows]
    own = points[rows]
    side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
    order = np.argsort(own[:, side], kind="stable")
    half = len(rows) // 2
    return kd_split(points, rows[order[:half]], most) + kd_split(points, rows[order[half:]], most)


class Cells:
    """The upper kd-tree: cuts the projected space into at most ``cells`` boxes."""

    def __init__(self, points: np.ndarray, cells: int):
        box = np.array([[-inf] * PROJECTED, [inf] * PROJECTED])
        self.boxes: list[np.ndarray] = []
        self.cuts: list = self._cut(points, box, cells)
        self.low = np.array([b[0] for b in self.boxes])
        self.high = np.array([b[1] for b in self.boxes])

    def _cut(self, points, box, cells):
        if cells > 1 and len(points) >= 2:
            side = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            at = float(np.median(points[:, side]))
            left = points[:, side] < at
            # copies of one vector cannot be cut apart
            if left.any() and not left.all():
                lower, upper = box.copy(), box.copy()
                lower[1, side], upper[0, side] = at, at
                return (
                    side,
                    at,
                    self._cut(points[left], lower, cells // 2),
                    self._cut(points[~left], upper, cells - cells // 2),
                )
        self.boxes.append(box)
        return len(self.boxes) - 1

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)

        def go(node, rows):
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                side, at, lower, upper = node
                left = points[rows, side] < at
                go(lower, rows[left])
                go(upper, rows[~left])

        go(self.cuts, np.arange(len(points)))
        return out

    def squared(self, points: np.ndarray) -> np.ndarray:
        return box_distances(points, self.low, self.high)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance from each point to each box."""
    away = np.zeros((len(points), len(low)))
    for side in range(points.shape[1]):
        own = points[:, side, None]
        off = np.maximum(np.maximum(low[:, side] - own, own - high[:, side]), 0)
        away += off * off
    return away


class Index:
    """The lower kd-tree over one cell's rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, space: Space):
        self.space = space
        points = space.project(x, query=False)
        leaves = kd_split(points, np.arange(len(ids)), LEAF_ROWS)
        self.bounds = np.cumsum([0] + [len(leaf) for leaf in leaves])
        order = np.concatenate(leaves)
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order])
        self.widest = int(np.diff(self.bounds).max())
        self.low = np.array([points[leaf].min(axis=0) for leaf in leaves])
        self.high = np.array([points[leaf].max(axis=0) for leaf in leaves])

    def search(self, own: np.ndarray, q: np.ndarray, k: int, reach: np.ndarray, bound: float):
        """Each query's ``k`` largest products: places of queries, ids and scores.

        A query takes leaves in order of projected distance, ``STEP_LEAVES`` at a
        time, and their rows are verified on the vectors themselves, all queries
        that are at a leaf at once. It stops when its next leaf is so far off
        that the test holds for the ``k``-th distance found, or for its
        ``reach``, the squared distance known from before. Its own id is left out.
        """
        away = box_distances(self.space.project(q, query=True), self.low, self.high)
        order = np.argsort(away, axis=1, kind="stable")
        squares = np.einsum("ij,ij->i", q, q)
        reach = reach.copy()
        products = np.full((len(q), len(self.ids)), -inf)
        best = np.full((len(q), k), -inf)
        going = np.arange(len(q))
        for at in range(0, order.shape[1], STEP_LEAVES):
            nearest_leaf = away[going, order[going, at]]
            going = going[nearest_leaf <= bound * reach[going]]
            if not len(going):
                break
            taken = order[going, at : at + STEP_LEAVES]
            step = np.full((len(going), STEP_LEAVES, self.widest), -inf)
            for leaf in np.unique(taken):
                mine, slot = np.nonzero(taken == leaf)
                asks = going[mine]
                rows = slice(self.bounds[leaf], self.bounds[leaf + 1])
                found = q[asks] @ self.x[rows].T
                found[own[asks][:, None] == self.ids[rows]] = -inf
                step[mine, slot, : found.shape[1]] = found
                products[asks, rows] = found
            both = np.concatenate((best[going], step.reshape(len(going), -1)), axis=1)
            best[going] = -np.partition(-both, k - 1, axis=1)[:, :k]
            last = best[going].min(axis=1)
            full = last > -inf
            sure = going[full]
            reach[sure] = np.minimum(reach[sure], self.space.squared(q[sure], last[full]))
        # a product depends on its place in a block by rounding: what may be among
        # the k best is summed row by row alike, so that equal vectors have equal scores
        slack = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt(squares * self.space.largest)
        place, row = np.nonzero((products > -inf) & (products >= (best.min(axis=1) - slack)[:, None]))
        scores = np.zeros(len(place))
        for at in range(0, len(place), EXACT_ROWS):
            some = slice(at, at + EXACT_ROWS)
            scores[some] = (self.x[row[some]] * q[place[some]]).sum(axis=1)
        ids = self.ids[row]
        sort = np.lexsort((ids, -scores, place))
        place, ids, scores = place[sort], ids[sort], scores[sort]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        return place[rank < k], ids[rank < k], scores[rank < k]


def usable(vector: Column) -> Column:
    """True for a vector whose components are all finite, and some not zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf)))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


BLOCK = "cell bigint, part bigint, ids binary, reach binary, vectors binary"


def blocks(df: DataFrame, rows: int, counts: dict[int, int], key: str) -> DataFrame:
    """Rows (id, vector, reach, cell) gathered into blocks of about ``rows``, one a row.

    A cell with more rows is parted by a hash of ``key``, so copies of one
    vector, however many, never meet in one block.
    """
    parts = [-(-counts.get(c, 0) // rows) for c in range(max(counts, default=0) + 1)]
    part = F.pmod(F.xxhash64(key), F.array(*[F.lit(max(1, p)) for p in parts])[F.col("cell").cast("int")])

    def gather(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        return pa.table(
            {
                "cell": pa.array([group["cell"][0].as_py()], pa.int64()),
                "part": pa.array([group["part"][0].as_py()], pa.int64()),
                "ids": pa.array([group["id"].to_numpy().tobytes()], pa.binary()),
                "reach": pa.array([group["reach"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array(
                    [group["vector"].combine_chunks().flatten().to_numpy().tobytes()], pa.binary()
                ),
            }
        )

    return (
        df.select("id", "vector", "reach", "cell", part.cast("bigint").alias("part"))
        .groupBy("cell", "part")
        .applyInArrow(gather, BLOCK)
    )


def nearest(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    *,
    is_query: Column,
    k: int = 20,
    confidence: float = CONFIDENCE,
    sample_rows: int = SAMPLE_ROWS,
    cell_rows: int = CELL_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query row, itself left out.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (a double,
    on the original vectors), nearest first, ties to the smaller id; other
    columns are not carried, so none can clash. Every row is indexed. Cells of
    an upper kd-tree, cut on the ``sample_rows`` rows with the smallest hash,
    spread the rows; each query is searched in its own cell first, then in all
    cells near enough for the chi-square test at ``confidence`` to fail, so a
    near neighbour is missed with a chance of one less ``confidence`` at most.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do those of another than the most common length, nor null ids.
    Rows that share an id are candidates each, and left out for a query of
    that id. With fewer than ``k`` candidates all are returned; an empty table
    gives no rows. The driver gets the sample, a count a cell and two numbers.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    dim = rows.agg(F.mode(F.size("vector"), True)).first()[0]
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if dim is None:
        return empty
    rows = rows.where(F.size("vector") == dim)
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, largest = rows.agg(F.count("*"), F.max(squares)).first()
    space = Space(dim, largest, seed)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()
    points = space.project(matrix(sample["vector"].combine_chunks(), dim), query=False)
    cells = Cells(points, int(min(max(1, n // cell_rows), max(1, len(points) // 16))))
    bound = chi_square_bound(confidence)

    def place(batches):
        for batch in batches:
            x = matrix(batch.column("vector"), dim)
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            home = cells.of(space.project(x, query=False))
            asked = np.where(asks, cells.of(space.project(x, query=True)), -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(home), pa.array(asked)],
                names=["id", "vector", "cell", "asked"],
            )

    placed = written(
        rows.mapInArrow(
            place, "id bigint, vector array<double>, cell bigint, asked bigint"
        ).select("*", F.monotonically_increasing_id().alias("row"), F.lit(inf).alias("reach")),
        "placed",
    )

    def counted(table: DataFrame) -> dict[int, int]:
        # one row a cell, of which there are at most sample_rows / 16
        return {r["cell"]: r["count"] for r in table.groupBy("cell").count().collect()}

    index = written(blocks(placed, cell_rows, counted(placed), "row"), "index")

    def search(batches):
        last = (None, None)
        for batch in batches:
            for r in batch.to_pylist():
                if last[0] != (r["cell"], r["part"]):
                    ids = np.frombuffer(r["ids"], np.int64)
                    x = np.frombuffer(r["vectors"], np.float64).reshape(-1, dim)
                    last = ((r["cell"], r["part"]), Index(ids, x, space))
                own = np.frombuffer(r["q_ids"], np.int64)
                reach = np.frombuffer(r["q_reach"], np.float64)
                asked = np.frombuffer(r["q_vectors"], np.float64).reshape(-1, dim)
                place, ids, scores = last[1].search(own, asked, k, reach, bound)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[place]), pa.array(ids), pa.array(scores)],
                    names=["query_id", "vec_id", "score"],
                )

    def searched(queries: DataFrame) -> DataFrame:
        asked = blocks(queries, query_rows, counted(queries), "id").select(
            "cell", *[F.col(c).alias(f"q_{c}") for c in ("ids", "reach", "vectors")]
        )
        return index.join(asked, "cell").mapInArrow(
            search, "query_id bigint, vec_id bigint, score double"
        )

    def best(found: DataFrame) -> DataFrame:
        """The k best of each query; it has at most k rows from each block of rows."""
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    queries = placed.where("asked >= 0").dropDuplicates(["id"])
    first = written(best(searched(queries.drop("cell").withColumnRenamed("asked", "cell"))), "first")
    last = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")

    def route(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, query_rows):
                batch = whole.slice(start, query_rows)
                x = matrix(batch.column("vector"), dim)
                score = batch.column("score").to_numpy(zero_copy_only=False).astype(float)
                home = batch.column("asked").to_numpy(zero_copy_only=False)
                # a query with fewer than k found knows no distance to stop at
                reach = np.where(np.isnan(score), inf, space.squared(x, np.nan_to_num(score)))
                open_ = cells.squared(space.project(x, query=True)) <= bound * reach[:, None]
                open_[np.arange(len(x)), home] = False
                at, cell = np.nonzero(open_)
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(index),
                        batch.column("vector").take(index),
                        pa.array(reach[at]),
                        pa.array(cell),
                    ],
                    names=["id", "vector", "reach", "cell"],
                )

    routed = written(
        queries.join(last, "id", "left")
        .select("id", "vector", "asked", "score")
        .mapInArrow(route, "id bigint, vector array<double>, reach double, cell bigint"),
        "routed",
    )
    found = first.select("query_id", "vec_id", "score").unionByName(searched(routed))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
