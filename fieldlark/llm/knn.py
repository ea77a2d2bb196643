"""Exact top-k search: Voronoi join over pivots with summary bounds, own cells first.

Data vectors go to the cell of their nearest pivot; the number of pivots grows with the square root of the table, up to
MOST_PIVOTS. For each cell Spark keeps a summary of its vectors relative to the pivot: how many, the largest distance, the
largest norm, the range of their components along AXES common directions (those in which the pivots vary most), and the
largest rest beside these directions. A query's scores in a cell are bounded by the least of three figures: q.p + |q| times the
largest distance, |q| times the largest norm, and q.p plus the best corner of the ranges plus |rest of q| times the largest rest.

In a first round each query is solved in the cells with the nearest pivots (by score) that hold more than k vectors, which gives a
k-th score that is surely reached. In the second it is replicated only to those other cells whose bound is not below that score. Cells
are cut into chunks and a cell's queries into blocks, so that a group never grows with the data; each group is solved by
one matrix product, and the best k of each query are merged by a window whose per-group limit Spark applies before its shuffle.
How much the bounds spare depends on the data: nothing where vectors point evenly into all directions, most where they are clustered
(`report` gives the replicated share).

Scores are integer inner products, exact as long as they stay below 2**63. Vectors that are null or hold null or non-finite
components take no part; a vector of another length than the query's is no candidate of it. A null vec_id takes no
part. Repeated rows are candidates of their own, but no row with the query's id is a candidate of it. Rows with one id are one
query: that of the least of their vectors, in the order of arrays. Extra columns are not
read, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import stored, table

#: Pivots at least and at most (a bounded sample, by hash of the id), common directions, vectors of a chunk, queries of a block.
LEAST_PIVOTS, MOST_PIVOTS, AXES, CHUNK, BLOCK = 16, 2048, 16, 1024, 1024


def integer_vectors(embeddings: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, of the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(F.col(id_col).isNotNull() & x.isNotNull() & ok).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v"))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length of vector."""
    length = column.value_lengths().to_numpy()
    flat, first = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(length)))
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, flat[first[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0), np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, by floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if most < 2**53 else a @ b.T


@dataclass
class Pivots:
    """The pivots of one length of vector, and the common directions as columns."""

    p: np.ndarray
    axes: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Pivots:
        _, _, directions = np.linalg.svd(rows - rows.mean(0), full_matrices=False)
        return Pivots(rows, directions[:AXES].T)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return ((self.p**2).sum(1) - 2 * x @ self.p.T).argmin(1)


def _cells(batches: Iterator[pa.RecordBatch], pivots: dict[int, Pivots]) -> Iterator[pa.RecordBatch]:
    """Cell of each vector: its nearest pivot, or one cell for a length without pivots."""
    for batch in batches:
        cell, dim = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
        for rows, v in _matrices(batch.column(1)):
            dim[rows] = v.shape[1]
            if (p := pivots.get(v.shape[1])) is not None:
                for lo in range(0, len(rows), 4096):
                    cell[rows[lo : lo + 4096]] = p.nearest(v[lo : lo + 4096].astype(float))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dim), pa.array(cell)], names=["vec_id", "v", "dim", "cell"])


#: Places of a summary's figures: ranges along the axes from 0 on, and these.
_COUNT, _FAR, _NORM, _REST = -1, -2, -3, -4


def _summed(batches: Iterator[pa.RecordBatch], pivots: dict[int, Pivots]) -> Iterator[pa.RecordBatch]:
    """This task's summaries as (dim, cell, place, least, most, n)."""
    found: dict[tuple[int, int, int], list] = {}
    for batch in batches:
        cells = batch.column(1).to_numpy()
        for rows, v in _matrices(batch.column(0)):
            d, x, cell = v.shape[1], v.astype(float), cells[rows]
            p = pivots.get(d)
            y = x - p.p[cell] if p else x
            z = y @ p.axes if p else np.zeros((len(x), 0))
            rest = np.sqrt(np.maximum((y**2).sum(1) - (z**2).sum(1), 0))
            figures = {_FAR: np.sqrt((y**2).sum(1)), _NORM: np.sqrt((x**2).sum(1)), _REST: rest, _COUNT: rest, **{j: z[:, j] for j in range(z.shape[1])}}
            order = np.argsort(cell, kind="stable")
            head = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) > 0)))
            many = np.diff(np.append(head, len(order)))
            for place, f in figures.items():
                f = f[order]
                for c, lo, hi, n in zip(cell[order[head]].tolist(), np.minimum.reduceat(f, head).tolist(), np.maximum.reduceat(f, head).tolist(), many.tolist(), strict=True):
                    old = found.setdefault((d, c, place), [lo, hi, 0])
                    old[:] = min(old[0], lo), max(old[1], hi), old[2] + n
    cols = zip(*((*k, *v) for k, v in found.items()), strict=True) if found else [()] * 6
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["dim", "cell", "place", "least", "most", "n"])


@dataclass
class Summary:
    """The summaries of all cells of one length of vector."""

    cells: np.ndarray
    p: np.ndarray
    axes: np.ndarray
    count: np.ndarray
    far: np.ndarray
    norm: np.ndarray
    rest: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(q.p, no score of the cell is above this) for each query and cell; a little is added for rounding."""
        size = np.sqrt((q**2).sum(1))[:, None]
        mid, z = q @ self.p.T, q @ self.axes
        beside = np.sqrt(np.maximum(size**2 - (z**2).sum(1)[:, None], 0))
        corner = np.maximum(z, 0) @ self.most.T + np.minimum(z, 0) @ self.least.T
        high = np.minimum(np.minimum(mid + size * self.far, size * self.norm), mid + corner + beside * self.rest)
        return mid, high + 1e-6 * (1 + size * (self.norm + self.far + np.sqrt((self.p**2).sum(1))))


def _summaries(placed: DataFrame, pivots: dict[int, Pivots]) -> dict[int, Summary]:
    """Of each length; the driver gets at most AXES + 4 rows for each pivot, and as many for each further length."""
    part = placed.select("v", "cell").mapInArrow(lambda b: _summed(b, pivots), "dim int, cell int, place int, least double, most double, n long")
    rows = part.groupBy("dim", "cell", "place").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")).collect()
    out = {}
    for d in {r["dim"] for r in rows}:
        own = {(r["cell"], r["place"]): r for r in rows if r["dim"] == d}
        cells = np.array(sorted({c for c, _ in own}))
        p = pivots[d] if d in pivots else Pivots(np.zeros((1, d)), np.zeros((d, 0)))
        get = lambda place, key: np.array([own[c, place][key] for c in cells.tolist()], float)  # noqa: B023, E731
        ranges = [np.stack([get(j, k) for j in range(p.axes.shape[1])], 1) if p.axes.shape[1] else np.zeros((len(cells), 0)) for k in ("least", "most")]
        out[d] = Summary(cells, p.p[cells], p.axes, get(_COUNT, "n"), get(_FAR, "most"), get(_NORM, "most"), get(_REST, "most"), *ranges)
    return out


def _first(batches: Iterator[pa.RecordBatch], summary, k: int) -> Iterator[pa.RecordBatch]:
    """(query, cell) for the cells with the best pivots that hold more than k vectors together."""
    for batch in batches:
        for rows, v in _matrices(batch.column(1)):
            if (s := summary.value.get(v.shape[1])) is None:
                continue
            mid, _ = s.bounds(v.astype(float))
            order = np.argsort(-mid, axis=1, kind="stable")
            before = np.cumsum(s.count[order], axis=1) - s.count[order]
            at, c = np.nonzero(before <= k)
            yield _rows(batch, rows[at], v.shape[1], s.cells[order[at, c]])


def _second(batches: Iterator[pa.RecordBatch], summary, k: int) -> Iterator[pa.RecordBatch]:
    """(query, cell) for every other cell that may hold a score as good as the query's k-th (column 2; none: all cells)."""
    for batch in batches:
        reached = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
        for rows, v in _matrices(batch.column(1)):
            if (s := summary.value.get(v.shape[1])) is None:
                continue
            mid, high = s.bounds(v.astype(float))
            order = np.argsort(-mid, axis=1, kind="stable")
            done = np.zeros(mid.shape, bool)
            np.put_along_axis(done, order, np.cumsum(s.count[order], axis=1) - s.count[order] <= k, axis=1)
            sure = np.where(np.isnan(reached[rows]), -np.inf, reached[rows])
            at, c = np.nonzero((high >= sure[:, None]) & ~done)
            yield _rows(batch, rows[at], v.shape[1], s.cells[c])


def _rows(batch: pa.RecordBatch, rows: np.ndarray, dim: int, cells: np.ndarray) -> pa.RecordBatch:
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(rows), dim, np.int32)), pa.array(cells.astype(np.int32))], names=["query_id", "q", "dim", "cell"])


def _solve(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k best of a chunk for each query of a block; ties to smaller ids."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, qid = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        matrix = lambda c: c.combine_chunks().flatten().to_numpy().reshape(len(c), -1)
        score = _product(matrix(right["q"]), matrix(left["v"])[order])
        out = []
        for i in range(len(qid)):
            s, own = score[i], ids != qid[i]
            s, c = s[own], ids[own]
            if len(s) > k:
                edge = np.partition(s, len(s) - k)[len(s) - k]
                over = np.flatnonzero(s > edge)
                best = np.concatenate((over, np.flatnonzero(s == edge)[: k - len(over)]))
            else:
                best = np.arange(len(s))
            out.append((np.full(len(best), qid[i]), c[best], s[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], schema=schema)

    return run


def _pivots(data: DataFrame) -> dict[int, Pivots]:
    """By length of vector, from a sample of about as many vectors as there shall be pivots."""
    n = data.count()
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(n**0.5)))
    share = min(1.0, 1.5 * wanted / max(n, 1))
    lot = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = data.where(lot).limit(2 * wanted).collect()  # a bounded sample; which vectors are pivots changes no result
    rows = {d: np.unique(np.array([r["v"] for r in sample if len(r["v"]) == d], float), axis=0) for d in {len(r["v"]) for r in sample}}
    return {d: Pivots.of(x) for d, x in rows.items() if d and len(x) > 1}


def _solved(placed: DataFrame, groups: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each chunk for the queries that were sent to its cell."""
    load = asked.groupBy("dim", "cell").agg(F.count("*").alias("asked"))
    plan = F.broadcast(stored(groups.join(load, ["dim", "cell"]).select("dim", "cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), F.ceil(F.col("asked") / BLOCK).cast("int").alias("blocks"))))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(plan, ["dim", "cell"]).select("dim", "cell", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int").alias("chunk"), each("blocks").alias("block"), "vec_id", "v")
    right = asked.join(plan, ["dim", "cell"]).select("dim", "cell", each("chunks").alias("chunk"), F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), "query_id", "q")
    keys = ["dim", "cell", "chunk", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_solve(k), "query_id long, vec_id long, score long")


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, report: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, v) of integer vectors; `queries` has the same columns.

    `report` gets the (query, cell) pairs there are, and those that the bounds left to be compared.
    """
    pivots = _pivots(data)
    queries = stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")))  # rows that share an id are one query
    schema = "query_id long, q array<long>, dim int, cell int"
    placed = stored(data.mapInArrow(lambda b: _cells(b, pivots), "vec_id long, v array<long>, dim int, cell int"))
    found = _summaries(placed, pivots)
    summary = data.sparkSession.sparkContext.broadcast(found)
    groups = stored(placed.groupBy("dim", "cell").agg(F.count("*").alias("n")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    first = stored(queries.mapInArrow(lambda b: _first(b, summary, k), schema))
    near = stored(_solved(placed, groups, first, k).withColumn("rank", rank).where(F.col("rank") <= k))
    reached = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "score")
    second = stored(queries.join(reached, "vec_id", "left").select("vec_id", "v", "score").mapInArrow(lambda b: _second(b, summary, k), schema))
    if report is not None:
        lengths = {r["d"]: r["n"] for r in queries.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
        report |= {"pairs": sum(n * len(found[d].cells) for d, n in lengths.items() if d in found), "compared": first.count() + second.count()}
    best = near.drop("rank").unionAll(_solved(placed, groups, second, k))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_voronoi_knn(spark, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for every vector whose vec_id is divisible by 50."""
    data = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(data, data.where("vec_id % 50 = 0"), 5)


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM (SELECT vec_id, min(v) AS v FROM e WHERE vec_id % 50 = 0 GROUP BY vec_id) q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
