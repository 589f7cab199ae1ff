"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to these widths an expression is written out element by element, which Spark compiles into
# straight code; wider vectors use array functions or Arrow batches.
UNROLLED_DOT = 16
UNROLLED_SUM = 64


def doubles(values: Column) -> Column:
    """Any numeric array as ``array<double>``."""
    return values.cast("array<double>")


def constant(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def checked(features: Column, width: int) -> Column:
    """``features``, or an error where a row's vector is not ``width`` finite-or-infinite numbers."""
    good = (F.size(features) == width) & ~F.exists(features, lambda v: v.isNull() | F.isnan(v))
    return F.when(F.coalesce(good, F.lit(False)), features).otherwise(
        F.raise_error(F.lit(f"features must be {width} numbers without NULL or NaN")).cast("array<double>")
    )


def dot(a: Column, b: Column) -> Column:
    """Inner product, added up from the first element to the last; unequal lengths are an error."""
    product = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) == F.size(b), product).otherwise(
        F.raise_error(F.lit("vectors of unequal length")).cast("double")
    )


def dot_constant(features: Column, weights: Sequence[float]) -> Column:
    """``features`` times fixed weights, in the same order of addition as ``dot``.

    Lengths are the caller's to check (``checked``).
    """
    if len(weights) <= UNROLLED_DOT:
        total = F.lit(0.0)
        for i, weight in enumerate(weights):
            total = total + F.get(features, F.lit(i)) * F.lit(float(weight))
        return total
    return F.aggregate(
        F.zip_with(features, constant(weights), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v
    )


def width_of(df: DataFrame, features: str = "features") -> int:
    """The length of the first vector found (one row is read); 0 for an empty table."""
    row = df.select(F.size(features).alias("width")).filter("width is not null").first()
    return 0 if row is None else int(row["width"])


def weighted_totals(df: DataFrame, features: Column, factor: Column, width: int) -> DataFrame:
    """``(pos, total)``: at ``pos`` < width the sum of factor * features[pos] over all rows, then the
    sum of the factors and the number of rows.

    Rows without a factor are left out. Every task reduces its rows to one partial vector before
    the shuffle.
    """
    rows = df.select(features.alias("features"), factor.alias("factor")).filter("factor is not null")
    if width <= UNROLLED_SUM:
        sums = [F.sum(F.get("features", F.lit(i)) * F.col("factor")) for i in range(width)]
        sums = [F.coalesce(s, F.lit(0.0)) for s in (*sums, F.sum("factor"))]
        totals = rows.agg(F.array(*sums, F.count("*").cast("double")).alias("totals"))
        return totals.select(F.posexplode_outer("totals").alias("pos", "total"))
    partial = rows.mapInArrow(_partial_sums(width), "partial array<double>")
    elements = partial.select(F.posexplode_outer("partial").alias("pos", "value"))
    return elements.groupBy("pos").agg(F.sum("value").alias("total"))


def weighted_sum(df: DataFrame, features: Column, factor: Column, width: int) -> tuple[list[float], float, int]:
    """The same as driver values, which are as large as one row: vector, sum of factors, row count."""
    found = [0.0] * (width + 2)
    for row in weighted_totals(df, features, factor, width).collect():
        found[row["pos"]] = row["total"]
    return found[:width], found[width], int(found[width + 1])


def _partial_sums(width: int):
    """Per task: one row with the weighted sum, the sum of the factors and the row count."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2)
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            factor = batch.column("factor").to_numpy(zero_copy_only=False).astype(float)
            total += [*(factor @ x), factor.sum(), len(factor)]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["partial"])

    return add_up
