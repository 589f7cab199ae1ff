"""Linear support vector machines, one against the rest, by block dual ascent with a duality gap as certificate.

Every row has a dual variable in [0, 1] for every class. Rows are dealt once into blocks by the hash of their id, and a
block is one row of the state table. A round is a narrow pass: every block goes through its rows in id order and
sets their variables to the best value given the shared weights and what the block has changed so far, its own changes
counted once for every block, so that the sum of all blocks' changes is safe to apply (Ma et al. 2015). The new state is
written as a table; of it only the blocks' sums are read to get the next weights. All classes share every pass.

Blocks, not partitions or cores, define the result. Sums over blocks are integers in fixed point, so weights are equal
for any partitioning. Weights of all classes, one number for each class and feature, are what the driver holds.

The constant 1 is a feature, so the intercept is penalised as the others are. For a class with labels y = -1 or 1,

    primal = reg / 2 * |w|^2 + mean(max(0, 1 - y * w.x))
    dual   = mean(alpha) - reg / 2 * |w|^2        where w = sum(alpha * y * x) / (reg * n)

and the optimum lies between the two whatever the state, so their gap bounds how far the primal value is off.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.keys import hash_bucket
from marginalia.functions.vectors import checked, width_of
from marginalia.operators.staging import staged

#: A block's sums are rounded to 2**-32; they may reach 2**30.
SUM_BITS = 32


@dataclass(frozen=True)
class Round:
    """What a state is worth, by class; ``number`` passes led to it."""

    number: int
    primal: np.ndarray
    dual: np.ndarray

    @property
    def gap(self) -> float:
        return float((self.primal - self.dual).max())


@dataclass
class DualFit:
    classes: list
    reg: float
    rows: int
    blocks: int
    weights: np.ndarray  # one row for each class, the intercept last
    rounds: list[Round] = field(default_factory=list)
    state: DataFrame | None = None

    @property
    def gap(self) -> float:
        return self.rounds[-1].gap


def fit(
    points: DataFrame,
    classes: Sequence,
    reg: float = 0.01,
    tolerance: float = 1e-3,
    max_rounds: int = 100,
    block_rows: int = 4096,
) -> DualFit:
    """Train on ``points(id, features array<double>, label)`` until the gap of every class is within ``tolerance``.

    ``block_rows`` is how many rows a block has on average and part of the way to the result, not of the optimum. Ids must
    be unique. A row whose label is null or none of ``classes`` counts against all classes. Without rows an error is raised.
    """
    if not reg > 0:
        raise ValueError("reg must be positive: the dual needs it")
    width = width_of(points)
    n = points.count()
    if not n or not width:
        raise ValueError("no rows to train on")
    blocks = -(-n // block_rows)
    classes = list(classes)
    shape = (len(classes), width + 1)
    out = DualFit(classes, reg, n, blocks, np.zeros(shape))
    state = staged(_blocked(points, width, classes, blocks))
    alphas = np.zeros(len(classes))
    for number in range(max_rounds + 1):
        following = staged(_ascended(state, out.weights, reg * n, blocks))
        totals = _totals(following, len(classes) * (width + 3)).reshape(len(classes), width + 3)
        penalty = reg / 2.0 * (out.weights**2).sum(axis=1)
        out.rounds.append(Round(number, penalty + totals[:, -2] / n, alphas / n - penalty))
        if out.gap <= tolerance or number == max_rounds:
            break
        state, alphas = following, totals[:, -1]
        out.weights = totals[:, : width + 1] / (reg * n)
    out.state = state
    return out


def _blocked(points: DataFrame, width: int, classes: Sequence, blocks: int) -> DataFrame:
    """``(block, rows)``: the rows of a block in id order, their sides by class and dual variables, all zero."""
    side = F.array(*(F.when(F.col("label").eqNullSafe(F.lit(c)), 1.0).otherwise(-1.0) for c in classes))
    row = F.struct(
        F.col("id"),
        checked(F.col("features").cast("array<double>"), width).alias("x"),
        side.alias("y"),
        F.array_repeat(F.lit(0.0), len(classes)).alias("alpha"),
    )
    block = F.coalesce(hash_bucket(F.col("id"), blocks), F.lit(0)).alias("block")
    packed = points.select(block, row.alias("row")).groupBy("block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return packed.select("block", "rows")


def _ascended(state: DataFrame, weights: np.ndarray, scale: float, blocks: int) -> DataFrame:
    """The state after a round, with ``sums``: by class alpha * y * x, the hinge losses before the round and the alphas.

    A block's rows are unfolded on the way in, so a batch is bounded by its number of rows, and packed on the way out.
    """
    count, width = weights.shape
    one = float(1 << SUM_BITS)
    kind = state.schema["rows"].dataType.elementType.simpleString()

    def packed(block: int, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        columns = {c: rows.column(c).chunk(0) for c in ("id", "x", "y", "alpha")}
        ids = columns["id"].to_numpy(zero_copy_only=False)
        if (ids[1:] == ids[:-1]).any():
            raise ValueError("ids must be unique: they fix the order in which rows are visited")
        x, y, alpha = (columns[c].flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) for c in ("x", "y", "alpha"))
        x, alpha = np.column_stack([x, np.ones(len(ids))]), alpha.copy()
        loss = np.maximum(0.0, 1.0 - y * (x @ weights.T)).sum(axis=0)
        _ascend(x, y, alpha, weights.copy(), scale, blocks)
        sums = np.column_stack([(alpha * y).T @ x, loss, alpha.sum(axis=0)])
        if not (np.abs(sums) < 1 << 30).all():
            raise ValueError("a block's sums are too large: scale the features")
        sums = np.floor(sums * one + 0.5).astype(np.int64).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * count, pa.int32()), pa.array(alpha.ravel()))
        struct = pa.StructArray.from_arrays([columns["id"], columns["x"], columns["y"], lists], ["id", "x", "y", "alpha"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), struct),
                pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums)),
            ],
            ["block", "rows", "sums"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            own = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else []
            for start, stop in zip(starts, [*starts[1:], len(own)]):
                if held and own[start] != block:
                    yield packed(block, pa.Table.from_batches(held))
                    held = []
                block = int(own[start])
                held.append(batch.slice(start, stop - start))
        if held:
            yield packed(block, pa.Table.from_batches(held))

    unfolded = state.select("block", F.inline_outer("rows"))
    return unfolded.mapInArrow(run, f"block bigint, rows array<{kind}>, sums array<bigint>")


def _ascend(x: np.ndarray, y: np.ndarray, alpha: np.ndarray, w: np.ndarray, scale: float, blocks: int) -> None:
    """One pass over a block's rows; ``alpha`` and ``w`` change in place, all classes of a row at once."""
    steps, moves = scale / (blocks * (x * x).sum(axis=1)), y * (blocks / scale)
    for i in range(len(x)):
        wanted = np.clip(alpha[i] + (1.0 - y[i] * (w @ x[i])) * steps[i], 0.0, 1.0)
        change = wanted - alpha[i]
        if change.any():
            w += np.outer(change * moves[i], x[i])
            alpha[i] = wanted


def _totals(state: DataFrame, size: int) -> np.ndarray:
    cells = state.select(F.posexplode("sums").alias("pos", "part"))
    found = np.zeros(size)
    for row in cells.groupBy("pos").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():  # one for each weight
        found[row.pos] = float(row.total) / float(1 << SUM_BITS)
    return found


def duals(fitted: DualFit) -> DataFrame:
    """``(id, class, alpha)`` of the support vectors: all dual variables above zero."""
    names = F.array(*(F.lit(c) for c in fitted.classes))
    rows = fitted.state.select(F.inline("rows")).select("id", F.explode(F.arrays_zip(names.alias("class"), "alpha")).alias("c"))
    return rows.select("id", "c.class", "c.alpha").filter("alpha > 0")


def round_log(points: DataFrame, fitted: DualFit) -> DataFrame:
    """``(round, class, primal, dual, gap)``."""
    kind = points.schema["label"].dataType.simpleString()
    rows = [
        (r.number, c, float(p), float(d), float(p - d)) for r in fitted.rounds for c, p, d in zip(fitted.classes, r.primal, r.dual)
    ]
    return points.sparkSession.createDataFrame(rows, f"round int, class {kind}, primal double, dual double, gap double")


def weight_table(points: DataFrame, fitted: DualFit, names: Sequence[str]) -> DataFrame:
    """``(class, feature, weight)``; the intercept is feature ''."""
    kind = points.schema["label"].dataType.simpleString()
    rows = [(c, f, float(w)) for c, own in zip(fitted.classes, fitted.weights) for f, w in zip([*names, ""], own)]
    return points.sparkSession.createDataFrame(rows, f"class {kind}, feature string, weight double")


def prediction(features: Column, fitted: DualFit) -> Column:
    """The class with the largest margin, the first of equal ones; built-in expressions only."""

    def margin(own: np.ndarray) -> Column:
        weights = F.array(*(F.lit(float(w)) for w in own[:-1]))
        products = F.zip_with(features, weights, lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(own[-1])), lambda s, p: s + p)

    margins = F.array(*(margin(own) for own in fitted.weights))
    names = F.array(*(F.lit(c) for c in fitted.classes))
    return F.element_at(names, F.array_position(margins, F.array_max(margins)).cast("int"))
