"""Exact k-nearest-neighbour search and classification as a distributed join.

Some training rows serve as pivots. Every training row belongs to the cell of its nearest
pivot, and a test row visits only the cells that can hold one of its k neighbours: the
triangle inequality and the bisecting planes between pivots give a lower bound for the
distance to everything in a cell (Voronoi-partitioned kNN join, Lu, Shen, Chen and Ooi, 2012).
The bound to beat comes from the test row's own cell, which is searched first.

Cells are cut into blocks of bounded size on both sides, however many rows or copies one holds,
and a block hands on at most k rows per test row. No pair of rows is ever written out
before that. Nothing is dropped: results equal those of comparing all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.vectors import checked, width_of
from marginalia.operators.staging import staged

PIVOT_BYTES = 8 << 20  # what every task holds of the pivots
CHUNK = 1 << 21  # distances computed at a time within a task


def nearest(
    train: DataFrame, test: DataFrame, k: int, block_rows: int = 4096, pivots: int | None = None
) -> DataFrame:
    """``(test_id, rank, train_id, label, distance)``: the k nearest training rows by Euclidean distance.

    ``train`` has unique ``id``, ``features`` and ``label``; ``test`` has unique ``id`` and ``features``.
    Equal distances are ordered by training id. Fewer than k training rows give fewer ranks.
    """
    width = width_of(train)
    if width == 0:
        raise ValueError("no training rows")
    centres = _choose_pivots(train, width, pivots)

    cells = staged(_assign(train.select("id", _numbers(width), "label"), centres, k))
    shape = _cell_shape(cells)
    homes = staged(_assign(test.select("id", _numbers(width)), centres, k, shape))
    first = _top(_search(cells, homes.withColumn("cells", F.array("cell")), k, block_rows), k)

    if len(shape[0]) == 1:
        return _result(first)

    first = staged(first)
    known = first.groupBy("test_id").agg(F.max("squared").alias("worst"), F.count("*").alias("found"))
    bounded = homes.join(known, homes["id"] == known["test_id"], "left").select(homes["*"], "worst", "found")
    onward = staged(_route(bounded, centres, shape, k))
    second = _search(cells, onward, k, block_rows)

    return _result(_top(first.drop("rank").unionByName(second), k))


def _result(ranked: DataFrame) -> DataFrame:
    return ranked.select("test_id", "rank", "train_id", "label", F.sqrt("squared").alias("distance"))


def majority(neighbours: DataFrame) -> DataFrame:
    """``(id, prediction)``: the label most of a row's neighbours have; ties go to the smaller label."""
    votes = neighbours.groupBy("test_id", "label").agg(F.count("*").alias("votes"))
    order = Window.partitionBy("test_id").orderBy(F.desc("votes"), "label")
    winner = votes.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return winner.select(F.col("test_id").alias("id"), F.col("label").alias("prediction"))


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The first k pairs of every test row; tasks cut down to k before the shuffle."""
    order = Window.partitionBy("test_id").orderBy("squared", "train_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _numbers(width: int):
    return checked(F.col("features").cast("array<double>"), width).alias("features")


def _choose_pivots(train: DataFrame, width: int, pivots: int | None) -> np.ndarray:
    """Training vectors drawn by hash of the id: ``pivots``, or sqrt(n) of them.

    ``PIVOT_BYTES`` bounds what the driver and every task hold.
    """
    rows = train.count()
    wanted = pivots or math.ceil(math.sqrt(rows))
    wanted = max(1, min(wanted, rows, PIVOT_BYTES // (8 * width)))
    share = min(1.0, 1.5 * wanted / rows)
    threshold = int((share - 0.5) * 2**64)
    drawn = train.filter(F.xxhash64("id") <= F.lit(min(threshold, 2**63 - 1)))
    found = drawn.select(_numbers(width)).limit(wanted).collect()
    if len(found) < wanted:
        found = train.select(_numbers(width)).limit(wanted).collect()
    return np.array([row["features"] for row in found])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _slack(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """More than the rounding error of ``_distances``, per row."""
    size = np.sqrt(np.maximum((x * x).sum(1), (centres * centres).sum(1).max()))
    return 1e-6 * size + 1e-12


def _matrix(batch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _chunks(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, CHUNK // max(1, columns))
    return (slice(at, min(at + step, rows)) for at in range(0, rows, step))


def _assign(df: DataFrame, centres: np.ndarray, k: int, shape=None) -> DataFrame:
    """Add the nearest pivot's ``cell``, its distance ``near`` and a bound ``reach`` for the k-th neighbour.

    With ``shape``, only cells that hold training rows are assigned.
    """
    shared = df.sparkSession.sparkContext.broadcast(centres)
    empty = None if shape is None else np.flatnonzero(shape[0] == 0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            x = _matrix(batch, "features", pivots.shape[1])
            cell, near, reach = np.empty(len(x), np.int32), np.empty(len(x)), np.full(len(x), np.inf)
            for part in _chunks(len(x), len(pivots)):
                d = _distances(x[part], pivots)
                if len(pivots) >= k:
                    # the pivots are training rows, so the k-th nearest of them bounds the k-th neighbour
                    reach[part] = np.partition(d, k - 1, axis=1)[:, k - 1] + _slack(x[part], pivots)
                if empty is not None:
                    d[:, empty] = np.inf
                cell[part] = d.argmin(1)
                near[part] = d.min(1)
            for name, values in (("cell", cell), ("near", near), ("reach", reach)):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(assign, f"{columns}, cell int, near double, reach double")


def _cell_shape(cells: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row count and smallest and largest distance to the pivot, per cell; one row per pivot at most."""
    stats = cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("near").alias("inner"), F.max("near").alias("outer")
    )
    rows = stats.collect()
    length = max(row["cell"] for row in rows) + 1
    count, inner, outer = np.zeros(length, np.int64), np.full(length, np.inf), np.zeros(length)
    for row in rows:
        count[row["cell"]], inner[row["cell"]], outer[row["cell"]] = row["n"], row["inner"], row["outer"]
    return count, inner, outer


def _route(bounded: DataFrame, centres: np.ndarray, shape, k: int) -> DataFrame:
    """``(id, features, cells)``: the further cells in which a test row may still have a neighbour."""
    shared = bounded.sparkSession.sparkContext.broadcast((centres, *shape))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, count, inner, outer = shared.value
        pivots = pivots[: len(count)]
        for batch in batches:
            x = _matrix(batch, "features", pivots.shape[1])
            home = batch.column("cell").to_numpy(zero_copy_only=False)
            worst = batch.column("worst").to_numpy(zero_copy_only=False).astype(float)
            found = batch.column("found").fill_null(0).to_numpy(zero_copy_only=False)
            # k rows found at home bound the k-th neighbour by the worst of them
            known = np.where(found >= k, np.sqrt(np.nan_to_num(worst, nan=np.inf)), np.inf)
            bound = np.minimum(batch.column("reach").to_numpy(zero_copy_only=False), known)
            cells: list[np.ndarray] = []
            for part in _chunks(len(x), len(pivots)):
                slack = _slack(x[part], pivots)[:, None]
                d = _distances(x[part], pivots)
                own = home[part]
                between = np.maximum(_distances(pivots[own], pivots), 1e-300)
                own_d = d[np.arange(len(own)), own][:, None]
                plane = (d * d - own_d * own_d - slack * (d + own_d)) / (2.0 * between)
                plane[between <= slack] = 0.0
                lowest = np.maximum(np.maximum(d - outer, inner - d), plane)
                visit = (lowest <= bound[part][:, None] + 2.0 * slack) & (count > 0)
                visit[np.arange(len(own)), own] = False
                cells += [np.flatnonzero(row).astype(np.int32) for row in visit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("features"),
                 pa.array(cells, pa.list_(pa.int32()))],
                ["id", "features", "cells"],
            )

    id_type = bounded.schema["id"].dataType.simpleString()
    routed = bounded.mapInArrow(route, f"id {id_type}, features array<double>, cells array<int>")
    return routed.filter(F.size("cells") > 0)


def _search(cells: DataFrame, routed: DataFrame, k: int, block_rows: int) -> DataFrame:
    """``(test_id, train_id, label, squared)``: per test row and block, the k nearest in the block.

    A cell with n training rows and m visitors becomes ceil(n / block_rows) x ceil(m / block_rows)
    blocks; the hash of the id deals rows out, whatever their order.
    """
    visits = routed.select("id", "features", F.explode("cells").alias("cell"))
    have = cells.groupBy("cell").agg(F.count("*").alias("n"))
    want = visits.groupBy("cell").agg(F.count("*").alias("m"))
    pieces = have.join(want, "cell").select(
        "cell",
        F.ceil(F.col("n") / block_rows).cast("int").alias("slices"),
        F.ceil(F.col("m") / block_rows).cast("int").alias("parts"),
    )
    plan = F.broadcast(pieces)  # one row per pivot at most, so within PIVOT_BYTES

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        cells.join(plan, "cell")
        .withColumn("slice", F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int"))
        .withColumn("part", every("parts"))
        .select("cell", "slice", "part", F.col("id").alias("train_id"), "label", "features")
    )
    right = (
        visits.join(plan, "cell")
        .withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("parts")).cast("int"))
        .withColumn("slice", every("slices"))
        .select("cell", "slice", "part", F.col("id").alias("test_id"), "features")
    )
    types = {c: cells.schema[c].dataType.simpleString() for c in ("id", "label")}
    schema = f"test_id {routed.schema['id'].dataType.simpleString()}, train_id {types['id']}, label {types['label']}, squared double"
    block = ["cell", "slice", "part"]
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_block_search(k), schema)


def _block_search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            x, t = _table_matrix(left), _table_matrix(right)
            norms = (x * x).sum(1)
            for part in _chunks(len(t), len(x)):
                rows, columns = _near_pairs(t[part], x, norms, k)
                squared = np.zeros(len(rows))
                for f in range(x.shape[1]):  # first element to last, so that equal rows get equal sums
                    squared += (t[part][rows, f] - x[columns, f]) ** 2
                found.append(_best(rows + part.start, columns, squared, left, right, k))
        if found:
            return pa.concat_tables(found)
        none = np.empty(0, np.int64)
        return _best(none, none, np.empty(0), left, right, k)

    return search


def _table_matrix(table: pa.Table) -> np.ndarray:
    vectors = table.column("features").combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _near_pairs(t: np.ndarray, x: np.ndarray, norms: np.ndarray, k: int):
    """Index pairs that hold the k nearest of every row of ``t``, by quick distances with room for rounding."""
    own = (t * t).sum(1)[:, None]
    quick = own + norms[None, :] - 2.0 * (t @ x.T)
    if len(x) <= k:
        return np.nonzero(np.ones_like(quick, dtype=bool))
    room = 1e-9 * (own[:, 0] + norms.max())
    limit = np.partition(quick, k - 1, axis=1)[:, k - 1] + room
    return np.nonzero(quick <= limit[:, None])


def _best(rows, columns, squared, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The first k pairs of every test row by distance, then training id."""
    pairs = pa.table(
        {
            "row": pa.array(rows, pa.int64()),
            "column": pa.array(columns, pa.int64()),
            "squared": pa.array(squared, pa.float64()),
            "train_id": left.column("train_id").combine_chunks().take(pa.array(columns, pa.int64())),
        }
    )
    keys = [("row", "ascending"), ("squared", "ascending"), ("train_id", "ascending")]
    pairs = pairs.take(pc.sort_indices(pairs, sort_keys=keys))
    row = pairs.column("row").to_numpy()
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
    pairs = pairs.filter(pa.array(rank < k))
    return pa.table(
        {
            "test_id": right.column("test_id").combine_chunks().take(pairs.column("row").combine_chunks()),
            "train_id": pairs.column("train_id"),
            "label": left.column("label").combine_chunks().take(pairs.column("column").combine_chunks()),
            "squared": pairs.column("squared"),
        }
    )
