"""Running sums over a whole ordered table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowlens.sources.files import stage

_BLOCK = "_block"


def in_blocks(table: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition ``table`` by (by, order) and number the ranges.

    The result is a table in the shared folder, because a range partitioner samples:
    a second run of the same plan could cut the ranges elsewhere.
    """
    ranged = table.repartitionByRange(*(F.col(c) for c in by), *order)
    return stage(ranged.withColumn(_BLOCK, F.spark_partition_id()), "ranges")


def running_totals(
    blocks: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    totals: Sequence[str],
) -> DataFrame:
    """Add ``cum_<c>`` (sum up to and with the row) and ``all_<c>`` (sum of the group) per column.

    ``blocks`` comes from :func:`in_blocks` with the same ``by`` and ``order``. Each
    range is summed on its own; the sums of the ranges before it, one row per range
    and group, are added to it. No task sees more than one range.
    """
    sums = blocks.groupBy(*by, _BLOCK).agg(*(F.sum(c).alias(f"_sum_{c}") for c in totals))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        _BLOCK,
        *(F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in totals),
        *(F.sum(f"_sum_{c}").over(group).alias(f"all_{c}") for c in totals),
    )
    inside = (
        Window.partitionBy(*by, _BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = blocks.withColumns({f"_cum_{c}": F.sum(c).over(inside) for c in totals})
    kept = [F.col(c) for c in blocks.columns if c != _BLOCK]
    return local.join(offsets, [*by, _BLOCK]).select(
        *kept,
        *((F.col(f"_cum_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in totals),
        *(F.col(f"all_{c}") for c in totals),
    )
