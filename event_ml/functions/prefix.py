"""Running sums over a global order without funnelling the table into one task.

A window with an ``orderBy`` but no ``partitionBy`` sends every row to a
single task.  ``ordered_prefix`` uses a two-level prefix sum at every size:

1. range-partition the rows into as many contiguous order blocks as there are
   shuffle partitions, and freeze the block ids with a reliable checkpoint (so
   a recomputation after executor loss cannot move a row to another block);
2. per-block totals -> exclusive running offsets (one row per block and group);
3. a window partitioned by block adds the offset to the in-block running sum.
   A running window streams its rows, so a block need not fit in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.joins import join_small
from event_ml.session import ensure_checkpoint_dir

_BLOCK = "_prefix_block"


def _order_exprs(order_cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]


def ordered_prefix(
    df: DataFrame,
    order_cols: str | Sequence[str],
    sum_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    descending: bool = False,
    suffix: str = "_cum",
    n_blocks: int | None = None,
    totals: bool = False,
    next_cols: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c><suffix>`` = inclusive running sum of each ``c`` in ``sum_cols``.

    ``totals`` adds ``<c>_total``, the group's sum, which the blocks' totals
    hold already.  ``next_cols`` adds ``<c>_next``, the value in the group's
    next row (null in its last); at a block's end that is the first row of the
    group's next block.

    Rows must be unique per ``partition_cols + order_cols`` (an aggregated
    table), so the running sum is well defined without tie handling.  The
    result does not depend on ``n_blocks``.
    """
    spark = df.sparkSession
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    partition_cols = list(partition_cols)
    order = _order_exprs(order_cols, descending)
    n_blocks = n_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    ensure_checkpoint_dir(spark)
    range_order = [F.col(p).asc() for p in partition_cols] + order
    blocked = (
        df.repartitionByRange(n_blocks, *range_order)
        .withColumn(_BLOCK, F.spark_partition_id())
        .checkpoint(eager=True)
    )
    first = F.max_by if descending else F.min_by
    place = F.struct(*order_cols)
    per_block = blocked.groupBy(_BLOCK, *partition_cols).agg(
        *[F.sum(c).alias(c + "_blk") for c in sum_cols],
        *[first(F.struct(c), place).alias(c + "_first") for c in next_cols],
    )
    in_order = Window.partitionBy(*partition_cols).orderBy(_BLOCK)
    w_off = in_order.rowsBetween(Window.unboundedPreceding, -1)
    w_all = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_block.select(
        _BLOCK,
        *partition_cols,
        *[F.coalesce(F.sum(c + "_blk").over(w_off), F.lit(0)).alias(c + "_off") for c in sum_cols],
        *[F.sum(c + "_blk").over(w_all).alias(c + "_total") for c in sum_cols if totals],
        *[F.lead(c + "_first").over(in_order).alias(c + "_after") for c in next_cols],
    )
    inside = Window.partitionBy(_BLOCK, *partition_cols).orderBy(*order)
    w_in = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most one row per block and group; without groups that is n_blocks rows
    joined = join_small(blocked, offsets, [_BLOCK, *partition_cols]) if partition_cols else blocked.join(F.broadcast(offsets), _BLOCK)

    def following(c: str) -> Column:
        own = F.lead(F.struct(c)).over(inside)
        return F.coalesce(own, F.col(c + "_after"))[c].alias(c + "_next")

    return joined.select(
        *df.columns,
        *[(F.sum(c).over(w_in) + F.col(c + "_off")).alias(c + suffix) for c in sum_cols],
        *[c + "_total" for c in sum_cols if totals],
        *[following(c) for c in next_cols],
    )
