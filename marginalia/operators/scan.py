"""Running totals over ordered groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators.staging import staged


def running_totals(rows: DataFrame, groups: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """``rows`` with ``upto_<c>`` and ``all_<c>`` of each column of ``sums``: up to the row's ``order`` within its group, and in all.

    Rows are dealt by ranges of group and order, so a large group lies in several ranges. Each range's totals are
    added up first, one row a range and group; they carry over to later ranges. Rows with equal ``order`` in one group lie in one
    range and count for each other. Null group keys do not match; ``rows`` has none.
    """
    dealt = rows.repartitionByRange(*groups, order).withColumn("range_id", F.spark_partition_id())
    dealt = staged(dealt)
    keys = [*groups, "range_id"]
    totals = dealt.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    earlier = Window.partitionBy(*groups).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    carried = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums]
    carried += [F.sum(c).over(whole).alias(f"all_{c}") for c in sums]
    within = Window.partitionBy(*keys).orderBy(order)  # a range frame, so equal rows count together
    upto = {f"upto_{c}": F.col(f"before_{c}") + F.sum(c).over(within) for c in sums}
    joined = dealt.join(totals.select(*keys, *carried), keys).withColumns(upto)
    return joined.drop("range_id", *(f"before_{c}" for c in sums))
