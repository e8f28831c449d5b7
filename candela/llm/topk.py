"""Exact top-k by inner product: a Voronoi kNN join.

Inner products become distances: with M the largest norm, a data vector s gets one more component sqrt(M^2 - |s|^2) and a
query q a zero, so |q' - s'|^2 = |q|^2 + M^2 - 2 <q, s>, and the k best scores of q are its k nearest points.

Queries belong to the cell of their nearest pivot (a bounded sample of queries, refined by a few k-means rounds). One pass
gives the summaries: per pivot p its queries' number and radius U, and the k + 1 smallest distances between p and any data
point, the largest being K. By the triangle inequality every query of the cell has its k neighbours (its own row apart)
within U + K, and so only data with d(p, s) <= 2 U + K can be among them. Cells are put together into groups of at
most ``GROUP_BYTES`` of queries (a larger cell is cut), and a data row is sent to those groups only that have a cell it
can matter to. A group is cut into slices by data, so its rows spread over tasks; a task holds the queries of its group, streams
the data past them and keeps k per query. The slices' best are merged by rank.

Scores are exact. Components are floor(1024 x) as doubles. While M^2 is below 2^24 single precision holds every partial
sum exactly (Cauchy-Schwarz bounds it), below 2^53 double precision does; beyond, Python integers are used and scores
outside a long count as its ends. Bounds carry a margin for rounding; where they are not finite nothing is pruned.

Data without structure in its dimension count cannot be pruned: then every group reads all rows (``GROUP_BYTES`` decides how
often), which is the stated query set against all rows in blocks.

Defined cases. Vectors that are null or hold null or non-finite components take no part, as query or candidate. An empty
vector is all zeros; shorter vectors are padded with zeros. A null id is a candidate behind all other ids of equal score,
never a query. Rows with a query's id are its own, so of repeated ids none is a candidate for another; equal (id, vector)
rows ask once, different vectors of one id each ask; as candidates repeated rows all count. Ties go to smaller ids. Fewer than k candidates: all. No rows: no rows. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import pick, release

SCALE = 1024.0
PIVOTS = 64
SAMPLE = 4096
GROUP_BYTES = 64 << 20
SLICE_ROWS = 4 << 20
PACK_ROWS = 1024
TILE = 1024
NO_ID = np.iinfo(np.int64).max
LONG = -(1 << 63), (1 << 63) - 1
SINGLE, DOUBLE = float(1 << 24), float(1 << 53)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(1024 x); Python integers where doubles would overflow."""
    if np.abs(values).max(initial=0) < 1e300:
        return np.floor(values * SCALE)
    return np.array([[int(np.floor(x * SCALE)) if abs(x) < 1e300 else int(x) * int(SCALE) for x in row] for row in values.tolist()], object)


def as_doubles(ints: np.ndarray) -> np.ndarray:
    """Doubles; integers beyond them are infinite."""
    return ints if ints.dtype != object else np.array([[float(x) if abs(x) < 1 << 1023 else np.inf for x in row] for row in ints.tolist()]).reshape(ints.shape)


def matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as doubles, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Space:
    """What tasks need besides the rows: width, largest norm, pivots."""

    def __init__(self, width: int, top: float):
        self.width, self.top = width, top
        self.kind = np.float32 if top < SINGLE else np.float64 if top < DOUBLE else object
        self.pivots = np.zeros((0, width + 1))

    def lifted(self, ints: np.ndarray, query: bool) -> np.ndarray:
        """Points of the distance space: queries get a zero, data the missing part of the largest norm."""
        x = as_doubles(ints)
        with np.errstate(over="ignore", invalid="ignore"):
            extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(1), 0.0))
        return np.concatenate((x, extra[:, None]), 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Rows x pivots."""
        with np.errstate(over="ignore", invalid="ignore"):
            square = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)[None] - 2.0 * points @ self.pivots.T
            return np.sqrt(np.maximum(square, 0.0))

    @property
    def margin(self) -> float:
        """Rounding of a distance: the squares lose some bits of the largest square, a root takes it to its half."""
        return float(np.sqrt(self.top + 1.0)) * 1e-6


def centres(points: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Pivots from a sample: spread-out starts, then k-means rounds. Any choice gives right results."""
    start = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(start) < min(n, len(points)) and far.max() > 0:
        start.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[start[-1]]) ** 2).sum(1))
    out = points[start]
    for _ in range(rounds):
        near = ((points * points).sum(1)[:, None] + (out * out).sum(1)[None] - 2.0 * points @ out.T).argmin(1)
        for j in range(len(out)):
            if (near == j).any():
                out[j] = points[near == j].mean(0)
    return out


class Best:
    """The k best (score, then smaller id) per query of a task."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, marks: np.ndarray, k: int):
        self.ids, self.queries, self.marks, self.k = ids, queries, marks, k
        self.floor = np.full(len(ids), -np.inf) if queries.dtype != object else np.array([None] * len(ids), object)
        self.kept = [None] * len(ids)  # (scores, ids) per query

    def add(self, ids: np.ndarray, data: np.ndarray) -> None:
        for a in range(0, len(self.ids), TILE):
            q = self.queries[a : a + TILE]
            score = q @ data.T
            mine = self.ids[a : a + TILE, None] == ids[None]
            if score.dtype == object:
                score = np.clip(score, *LONG)
                hit = np.array([[f is None or x >= f for x in row] for row, f in zip(score, self.floor[a : a + TILE])], bool).reshape(score.shape) & ~mine
            else:
                score[mine] = -np.inf
                bar = self.floor[a : a + TILE]
                if score.shape[1] > self.k:
                    bar = np.maximum(bar, -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1])
                hit = (score >= bar[:, None]) & ~mine
            rows, columns = np.nonzero(hit)
            edge = np.searchsorted(rows, np.arange(len(q) + 1))
            for r in np.flatnonzero(np.diff(edge)):
                c = columns[edge[r] : edge[r + 1]]
                self._merge(a + int(r), score[r, c], ids[c])

    def _merge(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        if self.kept[i] is not None:
            score, ids = np.concatenate((self.kept[i][0], score)), np.concatenate((self.kept[i][1], ids))
        order = sorted(range(len(ids)), key=lambda j: (-score[j], ids[j]))[: self.k] if score.dtype == object else np.lexsort((ids, -score))[: self.k]
        self.kept[i] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[i] = score[order][-1]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for q, mark, kept in zip(self.ids.tolist(), self.marks.tolist(), self.kept):
            if kept is not None:
                for s, i in zip(kept[0].tolist(), kept[1].tolist()):
                    yield q, mark, i, int(s)


def _mark(row: np.ndarray) -> int:
    """Tells vectors of one id apart."""
    data = row.tobytes() if row.dtype != object else repr(row.tolist()).encode()
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    d = pick(vectors, **{id_col: "long", vec_col: "array<double>"}).toDF("id", "vec")
    return d.where(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _numbers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    return ids, whole_numbers(matrix(batch.column(1), width))


def _summaries(space: Space, k: int):
    """For mapInArrow over (id, vec, ask): per pivot the radius and number of its queries and the k + 1 nearest data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(space.pivots)
        near, radius, number = np.full((p, k + 1), np.inf), np.zeros(p), np.zeros(p, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, ints = _numbers(batch, space.width)
            near = np.sort(np.concatenate((near, np.nan_to_num(space.distances(space.lifted(ints, False)), nan=np.inf).T), 1), 1)[:, : k + 1]
            ask = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            if ask.any():
                d = np.nan_to_num(space.distances(space.lifted(ints[ask], True)), nan=np.inf)
                cell = d.argmin(1)
                np.maximum.at(radius, cell, d[np.arange(len(cell)), cell])
                np.add.at(number, cell, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p), pa.int32()), pa.array(radius), pa.array(number), pa.array(near.tolist(), pa.list_(pa.float64()))],
                                         names=["pivot", "radius", "number", "near"])
    return run


def _groups(number: np.ndarray, pivots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of every cell. Cells are put together along a chain of near pivots until a group is
    full; a cell with more queries than a group holds gets several groups of its own."""
    left, order = set(np.flatnonzero(number).tolist()), []
    while left:
        here = min(left) if not order else min(left, key=lambda j: ((pivots[j] - pivots[order[-1]]) ** 2).sum())
        left.remove(here)
        order.append(here)
    first, parts = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    group, load = -1, most
    for j in order:
        n = int(number[j])
        if n > most:
            first[j], parts[j] = group + 1, -(-n // most)
            group, load = group + int(parts[j]), most
        else:
            if load + n > most:
                group, load = group + 1, 0
            first[j], parts[j], load = group, 1, load + n
    return first, parts


def top_k(vectors: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS,
          group_bytes: int = GROUP_BYTES, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The k best candidates of every row for which ``queries``, an SQL condition over ``id``, holds: query_id, rank, vec_id, score."""
    return _top_k(vectors, queries, k, id_col, vec_col, pivots, group_bytes, slice_rows)[0]


def _top_k(vectors, queries, k, id_col, vec_col, pivots, group_bytes, slice_rows):
    """The result, and what groups were sent (for tests)."""
    if k < 1 or pivots < 1:
        raise ValueError("k and pivots must be positive")
    spark = vectors.sparkSession
    data = _clean(vectors, id_col, vec_col).withColumn("ask", F.coalesce(F.expr(queries) & F.col("id").isNotNull(), F.lit(False)))

    def extent(batches):
        rows, width, top, asked = 0, 0, 0.0, 0
        for batch in batches:
            if batch.num_rows:
                size = int(np.max(batch.column(1).value_lengths().to_numpy(zero_copy_only=False)))
                _, ints = _numbers(batch, size)
                with np.errstate(over="ignore"):
                    top = max(top, float((as_doubles(ints) ** 2).sum(1).max(initial=0.0)))
                rows, width, asked = rows + batch.num_rows, max(width, size), asked + batch.column(2).true_count
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([width]), pa.array([top]), pa.array([asked])], names=["n", "width", "top", "asked"])

    seen = data.mapInArrow(extent, "n long, width long, top double, asked long")
    n, width, top, asked = seen.agg(F.sum("n"), F.max("width"), F.max("top"), F.sum("asked")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not asked:
        return spark.createDataFrame([], schema), None
    space = Space(max(int(width), 1), float(top))
    sample = data.where("ask").orderBy(F.xxhash64("id"), "vec").limit(SAMPLE).select("vec").toArrow()
    points = space.lifted(whole_numbers(matrix(sample.column("vec"), space.width)), True)
    finite = bool(np.isfinite(points).all() and np.isfinite(top))
    space.pivots = centres(points, pivots) if finite else np.zeros((1, space.width + 1))
    told = data.mapInArrow(_summaries(space, k), "pivot int, radius double, number long, near array<double>")
    told = told.select("pivot", "radius", "number", F.posexplode("near").alias("_i", "d"))
    size = told.where("_i = 0").groupBy("pivot").agg(F.max("radius").alias("radius"), F.sum("number").alias("number"))
    ranked = told.withColumn("_r", F.row_number().over(Window.partitionBy("pivot").orderBy("d"))).where(F.col("_r") <= k + 1)
    reach = ranked.groupBy("pivot").agg(F.max("d").alias("reach"))
    rows = sorted(size.join(reach, "pivot").collect())  # one row per pivot
    radius, number, reach = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    with np.errstate(over="ignore"):
        bound = 2.0 * radius + reach + space.margin * 4
    bound[~np.isfinite(bound)] = np.inf
    item = 8 if space.kind is object else np.dtype(space.kind).itemsize
    first, parts = _groups(number, space.pivots, max(1, group_bytes // (item * space.width)))
    n_groups = int((first + parts).max())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_slices = max(1, -(-n // slice_rows), min(-(-tasks // n_groups), -(-n // PACK_ROWS)))
    group_of = [np.arange(a, a + b) for a, b in zip(first.tolist(), parts.tolist())]
    kind = space.kind

    def pack(ids, ints):
        if kind is object:
            return "\n".join(" ".join(str(int(x)) for x in row) for row in ints.tolist()).encode()
        return np.ascontiguousarray(ints.astype(kind)).tobytes()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for whole in batches:
            for a in range(0, whole.num_rows, PACK_ROWS):
                batch = whole.slice(a, PACK_ROWS)
                ids, ints = _numbers(batch, space.width)
                out = []
                ask = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                if ask.any():
                    cell = np.nan_to_num(space.distances(space.lifted(ints[ask], True)), nan=np.inf).argmin(1)
                    mixed = ids[ask].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                    home = first[cell] + (mixed % np.maximum(parts[cell], 1).astype(np.uint64)).astype(np.int64)
                    for g in np.unique(home).tolist():
                        i = np.flatnonzero(ask)[home == g]
                        blob = pack(ids[i], ints[i])
                        out += [(g * n_slices + s, False, ids[i].tobytes(), blob) for s in range(n_slices)]
                need = ~(space.distances(space.lifted(ints, False)) > bound)  # not a number: needed
                wanted = np.zeros((len(ids), n_groups), bool)
                for j in np.flatnonzero(parts).tolist():
                    wanted[:, group_of[j]] |= need[:, j : j + 1]
                for g in np.flatnonzero(wanted.any(0)).tolist():
                    i = np.flatnonzero(wanted[:, g])
                    out.append((g * n_slices + turn % n_slices, True, ids[i].tobytes(), pack(ids[i], ints[i])))
                turn += 1
                kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(kinds)], names=["part", "data", "ids", "ints"])
        release()

    def read(blob: bytes, rows: int) -> np.ndarray:
        if kind is object:
            return np.array([[int(x) for x in line.split()] for line in blob.decode().split("\n")], object).reshape(rows, space.width)
        return np.frombuffer(blob, kind).reshape(rows, space.width)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked_ids, asked_ints, best = None, [], [], None

        def result():
            found = list(best.rows()) if best else []
            return pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(4)], names=["query_id", "mark", "vec_id", "score"])

        for batch in batches:
            for part, is_data, ids, ints in zip(*(batch.column(c).to_pylist() for c in range(4))):
                ids = np.frombuffer(ids, np.int64)
                if part != now:
                    yield result()
                    now, asked_ids, asked_ints, best = part, [], [], None
                if not is_data:
                    asked_ids.append(ids)
                    asked_ints.append(read(ints, len(ids)))
                    continue
                if best is None and asked_ids:
                    q, m = np.concatenate(asked_ids), np.concatenate(asked_ints)
                    marks = np.array([_mark(r) for r in m], np.int64)
                    _, keep = np.unique(np.stack((q, marks)), axis=1, return_index=True)
                    best, asked_ids, asked_ints = Best(q[keep], m[keep], marks[keep], k), [], []
                if best is not None:
                    best.add(ids, read(ints, len(ids)))
        yield result()
        release()

    dealt = data.mapInArrow(deal, "part int, data boolean, ids binary, ints binary")
    solved = dealt.repartitionById(n_groups * n_slices, F.col("part")).sortWithinPartitions("part", "data")
    solved = solved.mapInArrow(solve, "query_id long, mark long, vec_id long, score long")
    along = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    best = solved.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= k)
    out = best.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"), "score")
    return out, dealt
