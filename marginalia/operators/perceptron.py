"""The perceptron, primal and dual, trained by Spark jobs.

Rows are ``(id, features array<double>, label)`` with label -1 or +1. A row is a mistake when
y (w.x + b) <= 0, and a mistake adds rate * y * x to w and rate * y to b.

``batch``
    Every epoch is one aggregate over all rows: the updates of all mistakes are added up and
    applied together. Independent of row order and partitioning.
``mixing``
    Every shard goes through its rows in id order, each update visible to the next row, from
    the shared (w, b); the shards' results are averaged (iterative parameter mixing, McDonald,
    Hall and Mann 2010). With one shard this is the sequential perceptron.

Training ends after an epoch without a mistake, which proves (w, b) right on every row, or
after ``max_epochs``. Only w, b and the mistake count reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.vectors import checked, weighted_sum, width_of
from marginalia.operators.linear import margin


@dataclass(frozen=True)
class Epoch:
    """Mistakes found during one epoch and (w, b) after it."""

    epoch: int
    mistakes: int
    weights: tuple[float, ...]
    bias: float


@dataclass(frozen=True)
class PerceptronFit:
    mode: str
    rate: float
    shards: int
    averaged: int  # how many shard results each average is over; 1 in batch mode
    epochs: tuple[Epoch, ...]

    @property
    def weights(self) -> tuple[float, ...]:
        return self.epochs[-1].weights

    @property
    def bias(self) -> float:
        return self.epochs[-1].bias

    @property
    def converged(self) -> bool:
        return self.epochs[-1].mistakes == 0

    def starts(self) -> list[tuple[tuple[float, ...], float]]:
        """(w, b) at the start of every epoch."""
        zero = (tuple(0.0 for _ in self.weights), 0.0)
        return [zero] + [(e.weights, e.bias) for e in self.epochs[:-1]]


def perceptron_fit(
    df: DataFrame, mode: str = "batch", rate: float = 1.0, max_epochs: int = 100, shards: int | None = None
) -> PerceptronFit:
    """Train on ``df``. ``shards`` (mixing only) is part of the result's definition; default: cores."""
    if mode not in ("batch", "mixing"):
        raise ValueError(f"unknown mode {mode!r}")
    if max_epochs < 1:
        raise ValueError("max_epochs must be at least 1")
    width = width_of(df)
    if width == 0:
        raise ValueError("no rows to train on")
    shards = shards or df.sparkSession.sparkContext.defaultParallelism
    if mode == "batch":
        rows = _checked_rows(df, width).select("features", "label")
    else:
        rows = _sharded(df, width, shards)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _train(rows, mode, rate, max_epochs, shards, width)
    finally:
        rows.unpersist()


def _train(rows: DataFrame, mode: str, rate: float, max_epochs: int, shards: int, width: int):
    weights, bias, averaged, done = np.zeros(width), 0.0, 1, []
    for number in range(1, max_epochs + 1):
        if mode == "batch":
            mistakes, dw, db = _batch_epoch(rows, weights, bias, width)
            weights, bias = weights + rate * dw, bias + rate * db
        else:
            mistakes, weights, bias, averaged = _mixing_epoch(rows, weights, bias, rate, width)
        done.append(Epoch(number, mistakes, tuple(weights.tolist()), float(bias)))
        if mistakes == 0:
            break
    return PerceptronFit(mode, rate, shards, averaged, tuple(done))


def _batch_epoch(rows: DataFrame, weights: np.ndarray, bias: float, width: int):
    """Mistake count and the summed y * x and y of all mistakes, in one aggregate."""
    wrong = rows.filter(margin(F.col("features"), F.col("label"), weights, bias) <= 0)
    dw, db, mistakes = weighted_sum(wrong, F.col("features"), F.col("label"), width)
    return mistakes, np.array(dw), db


def _mixing_epoch(rows: DataFrame, weights: np.ndarray, bias: float, rate: float, width: int):
    """One sequential pass per shard from the shared (w, b), then the mean over the shards."""

    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b, mistakes, seen, last = weights.copy(), bias, 0, 0, None
        for batch in batches:
            last = _refuse_repeated_ids(batch, last)
            x, y = _arrays(batch, width)
            w, b, found = _visit_in_order(x, y, w, b, rate)
            mistakes, seen = mistakes + found, seen + len(y)
        if seen:
            result = [[*w.tolist(), b, float(mistakes)]]
            yield pa.RecordBatch.from_arrays([pa.array(result, pa.list_(pa.float64()))], ["result"])

    results = rows.mapInArrow(one_pass, "result array<double>")
    total, _, averaged = weighted_sum(results, F.col("result"), F.lit(1.0), width + 2)
    return int(total[-1]), np.array(total[:width]) / averaged, total[width] / averaged, averaged


def _visit_in_order(x: np.ndarray, y: np.ndarray, w: np.ndarray, b: float, rate: float):
    """Sequential updates over a batch: look ahead for the next mistake, apply it, go on after it."""
    start, ahead, mistakes = 0, 32, 0
    while start < len(y):
        stop = start + ahead
        margins = y[start:stop] * (x[start:stop] @ w + b)
        wrong = np.flatnonzero(margins <= 0)
        if len(wrong) == 0:
            start, ahead = stop, min(2 * ahead, 4096)
            continue
        at = start + int(wrong[0])
        w, b, mistakes = w + rate * y[at] * x[at], b + rate * y[at], mistakes + 1
        start, ahead = at + 1, max(ahead // 2, 8)
    return w, b, mistakes


def perceptron_alpha(df: DataFrame, fit: PerceptronFit) -> DataFrame:
    """Add ``alpha``, the dual coefficient: in how many epochs the row was a mistake.

    No Gram matrix and no state per row and epoch: the starting (w, b) of every epoch is known,
    so one pass over the rows replays all epochs side by side. In mixing mode the row's id
    decides its shard and its turn, as in training.
    """
    width = len(fit.weights)
    if fit.mode == "batch":
        return _checked_rows(df, width).withColumn("alpha", _batch_alpha(fit))
    starts = fit.starts()

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = np.array([s[0] for s in starts]), np.array([s[1] for s in starts])
        for batch in batches:
            x, y = _arrays(batch, width)
            alpha = np.zeros(len(y), dtype=np.int64)
            for i in range(len(y)):
                alpha[i] = len(_replay_row(x[i], y[i], w, b, fit.rate)[1])
            yield batch.append_column("alpha", pa.array(alpha))

    rows = _sharded(df, width, fit.shards)
    return rows.mapInArrow(replay, f"{_ddl(rows)}, alpha bigint")


def visit_log(df: DataFrame, fit: PerceptronFit) -> DataFrame:
    """``(epoch, id, margin, mistake)``: every visit of a mixing fit, as it happened in training."""
    if fit.mode != "mixing":
        raise ValueError("rows are visited one by one in mixing mode only")
    width, starts = len(fit.weights), fit.starts()
    rows = _sharded(df, width, fit.shards)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = np.array([s[0] for s in starts]), np.array([s[1] for s in starts])
        numbers = np.arange(1, len(starts) + 1)
        for batch in batches:
            x, y = _arrays(batch, width)
            margins = np.array([_replay_row(x[i], y[i], w, b, fit.rate)[0] for i in range(len(y))])
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(y)), len(starts))))
            flat = margins.reshape(-1)
            columns = [pa.array(np.tile(numbers, len(y)), pa.int32()), ids, pa.array(flat), pa.array(flat <= 0)]
            yield pa.RecordBatch.from_arrays(columns, ["epoch", "id", "margin", "mistake"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(replay, f"epoch int, id {id_type}, margin double, mistake boolean")


def _replay_row(x: np.ndarray, y: float, w: np.ndarray, b: np.ndarray, rate: float):
    """One row against all epochs at once: margins, and the epochs (updated in place) it was wrong in."""
    margins = y * (w @ x + b)
    wrong = np.flatnonzero(margins <= 0)
    w[wrong] += rate * y * x
    b[wrong] += rate * y
    return margins, wrong


def _batch_alpha(fit: PerceptronFit) -> Column:
    text = json.dumps([{"w": list(w), "b": b} for w, b in fit.starts()])
    starts = F.from_json(F.lit(text), "array<struct<w: array<double>, b: double>>")

    def count(n: Column, start: Column) -> Column:
        products = F.zip_with(F.col("features"), start["w"], lambda x, v: x * v)
        score = F.aggregate(products, F.lit(0.0), lambda s, v: s + v) + start["b"]
        return n + F.when(F.col("label") * score <= 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return F.aggregate(starts, F.lit(0).cast("bigint"), count)


def dual_model(alphas: DataFrame, fit: PerceptronFit) -> DataFrame:
    """``(weights, bias)`` rebuilt from ``alpha``: rate * sum of alpha * y * x, over the shards averaged."""
    width = len(fit.weights)
    total, bias, _ = weighted_sum(alphas, F.col("features"), F.col("alpha") * F.col("label"), width)
    scale = fit.rate / fit.averaged
    model = ([scale * v for v in total], scale * bias)
    return alphas.sparkSession.createDataFrame([model], "weights array<double>, bias double")


def model_table(spark: SparkSession, fit: PerceptronFit) -> DataFrame:
    """One row: ``(weights, bias, epochs, converged)``."""
    row = (list(fit.weights), fit.bias, len(fit.epochs), fit.converged)
    return spark.createDataFrame([row], "weights array<double>, bias double, epochs int, converged boolean")


def epoch_log(spark: SparkSession, fit: PerceptronFit) -> DataFrame:
    """``(epoch, mistakes, weights, bias)``, one row per epoch."""
    rows = [(e.epoch, e.mistakes, list(e.weights), e.bias) for e in fit.epochs]
    return spark.createDataFrame(rows, "epoch int, mistakes bigint, weights array<double>, bias double")


def _checked_rows(df: DataFrame, width: int) -> DataFrame:
    label = F.col("label").cast("double")
    signed = F.when(label.isin(-1.0, 1.0), label).otherwise(
        F.raise_error(F.lit("perceptron labels must be -1 or 1")).cast("double")
    )
    numbers = F.col("features").cast("array<double>")
    return df.withColumn("label", signed).withColumn("features", checked(numbers, width))


def _sharded(df: DataFrame, width: int, shards: int) -> DataFrame:
    """Rows in ``shards`` partitions by a ``shard`` column or the hash of the unique id, in id order."""
    shard = F.col("shard") if "shard" in df.columns else F.pmod(F.xxhash64("id"), F.lit(shards))
    rows = _checked_rows(df, width).select("id", "features", "label", shard.cast("int").alias("shard"))
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("id").drop("shard")


def _refuse_repeated_ids(batch: pa.RecordBatch, last):
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    if len(ids) and ((last is not None and ids[0] == last) or (ids[1:] == ids[:-1]).any()):
        raise ValueError("ids must be unique: they fix the order in which rows are visited")
    return ids[-1] if len(ids) else last


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x, batch.column("label").to_numpy(zero_copy_only=False)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
