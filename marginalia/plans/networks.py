"""Networks by gradient aggregates: a small one that SQL follows, and one for the language of a document."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import network
from marginalia.plans.machines import shares
from marginalia.sources.labelled import label_names
from marginalia.sources.tables import read_table

DIGITS = 6
#: Start of the small network: two numbers, two hidden units, two classes; the last row of a layer holds offsets.
START = [np.array([[0.5, -0.25], [0.75, 1.0], [0.125, -0.5]]), np.array([[1.0, -1.0], [-0.5, 0.25], [0.0, 0.5]])]
RATE, STEPS = 0.5, 2


def flag_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``(features, label)`` of lineitem: quantity by 50 and ten times the discount; whether it was returned."""
    lines = read_table(spark, folder, "lineitem", "l_quantity", "l_discount", "l_returnflag")
    features = F.array(F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0)
    return lines.select(features.alias("features"), F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("label"))


def _small(spark: SparkSession, folder: str, steps: int) -> tuple[DataFrame, network.Network]:
    rows = flag_rows(spark, folder)
    return rows, network.fit(rows, [False, True], epochs=steps, rate=RATE, layers=START, history=0, max_halvings=0)


def network_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The gradient by every parameter of the small network at its start."""
    rows = flag_rows(spark, folder)
    slopes, _ = network.gradient(network.labelled_rows(rows, [False, True], 2), START, rows.count())
    return network.parameter_table(rows, slopes).withColumn("value", F.round("value", DIGITS))


def network_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Parameters of the small network after two steps."""
    rows, trained = _small(spark, folder, STEPS)
    return network.parameter_table(rows, trained.layers).withColumn("value", F.round("value", DIGITS))


def network_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Mean loss of the small network before and after each step."""
    rows, trained = _small(spark, folder, STEPS)
    return network.epoch_log(rows, trained).select("epoch", F.round("loss", DIGITS).alias("loss"))


def network_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """How many languages a network with 16 hidden units gets right, by split."""
    rows = shares(spark, folder)
    trained = network.fit(rows.filter("split = 'train'"), label_names(rows, "label"))
    parts = [
        network.predicted(rows.filter(F.col("split") == s), trained)
        .agg(F.count("*").alias("n"), F.count(F.when(F.expr("label = prediction"), 1)).alias("correct"))
        .select(F.lit(s).alias("split"), "n", "correct")
        for s in ("train", "test")
    ]
    return parts[0].unionByName(parts[1])


QUERIES = {
    "network_gradient": network_gradient,
    "network_parameters": network_parameters,
    "network_losses": network_losses,
    "network_accuracy": network_accuracy,
}


def _steps_sql() -> str:
    """``pK``: the parameters after K steps in one row, ``uSource_Target`` below, ``vSource_Target`` above; ``gK``: their gradient."""
    cells = [(name, i, j) for name in "uv" for i in range(3) for j in range(2)]
    one = f"{float(1 << network.PART_BITS)!r}::DOUBLE"
    start = ", ".join(f"{START['uv'.index(c)][i, j]!s}::DOUBLE AS {c}{i}_{j}" for c, i, j in cells)
    ctes = [
        f"""points AS (SELECT l_quantity / 50.0::DOUBLE AS x0, l_discount * 10.0::DOUBLE AS x1, 1.0::DOUBLE AS x2,
            CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS t1 FROM lineitem),
        p0 AS (SELECT {start})"""
    ]
    for k in range(STEPS + 1):
        sums = [f"sum(CAST(floor({'x' if c == 'u' else 'h'}{i} * d{c}{j} * {one} + 0.5) AS BIGINT))::DOUBLE / {one} / count(*) AS {c}{i}_{j}" for c, i, j in cells]
        ctes.append(
            f"""h{k} AS (SELECT *, 1.0 / (1.0 + exp(-(x0 * u0_0 + x1 * u1_0 + u2_0))) AS h0, 1.0 / (1.0 + exp(-(x0 * u0_1 + x1 * u1_1 + u2_1))) AS h1,
            1.0::DOUBLE AS h2 FROM points, p{k}),
        z{k} AS (SELECT *, 1.0 / (1.0 + exp((h0 * v0_1 + h1 * v1_1 + v2_1) - (h0 * v0_0 + h1 * v1_0 + v2_0))) AS q0 FROM h{k}),
        e{k} AS (SELECT *, q0 - (1.0 - t1) AS dv0, (1.0 - q0) - t1 AS dv1, -ln(CASE WHEN t1 = 1 THEN 1.0 - q0 ELSE q0 END) AS loss FROM z{k}),
        d{k} AS (SELECT *, (dv0 * v0_0 + dv1 * v0_1) * h0 * (1.0 - h0) AS du0, (dv0 * v1_0 + dv1 * v1_1) * h1 * (1.0 - h1) AS du1 FROM e{k}),
        g{k} AS MATERIALIZED (SELECT {", ".join(sums)}, avg(loss) AS loss FROM d{k}),
        p{k + 1} AS (SELECT {", ".join(f"p{k}.{c}{i}_{j} - {RATE}::DOUBLE * g{k}.{c}{i}_{j} AS {c}{i}_{j}" for c, i, j in cells)} FROM p{k}, g{k})"""
        )
    return "WITH " + ",\n".join(ctes)


def _cells_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({'uv'.index(c)} AS INTEGER) AS layer, CAST({i} AS INTEGER) AS source, CAST({j} AS INTEGER) AS target, round({c}{i}_{j}, {DIGITS}) AS value FROM {table}"
        for c in "uv"
        for i in range(3)
        for j in range(2)
    )


ORACLES = {
    "network_gradient": f"{_steps_sql()} {_cells_sql('g0')}",
    "network_parameters": f"{_steps_sql()} {_cells_sql(f'p{STEPS}')}",
    "network_losses": _steps_sql()
    + " UNION ALL ".join(f" SELECT CAST({k} AS INTEGER) AS epoch, round(loss, {DIGITS}) AS loss FROM g{k}" for k in range(STEPS + 1)),
}
