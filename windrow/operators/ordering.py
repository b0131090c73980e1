"""Running minima and maxima along one global order, without putting the order in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from windrow.functions.clock import floor_to
from windrow.session import enable_checkpoints

ROW_BLOCK, LEVEL_BLOCK, TOP_ROWS = 1 << 20, 1 << 12, 1 << 20


def with_arrival_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Number the rows along `order` (columns that together leave no ties), with gaps.

    One range-partitioned sort. The result is checkpointed in the shared folder, because the
    numbers depend on how the sort cut its ranges and every later pass must see the same ones.
    """
    enable_checkpoints(df.sparkSession)
    return df.orderBy(*order).withColumn(name, F.monotonically_increasing_id()).checkpoint()


def blocks_for(df: DataFrame, position: str) -> list[int]:
    """Block sizes for the range that the positions of `df` span, so that at most `TOP_ROWS` blocks are left at the top."""
    low, high = df.agg(F.min(position), F.max(position)).first()
    span = 1 if low is None else high - low + 1
    blocks, covered = [ROW_BLOCK], ROW_BLOCK
    while covered * (TOP_ROWS - 1) < span:  # the first and the last block may be cut
        blocks.append(LEVEL_BLOCK)
        covered *= LEVEL_BLOCK
    return blocks


def running_before(
    df: DataFrame,
    position: str,
    value: str,
    how: str,
    *,
    name: str,
    by: Sequence[str] = (),
    blocks: Sequence[int] | None = None,
) -> DataFrame:
    """Add `name`: the `max` or `min` of `value` over all rows with a smaller position.

    `position` is a BIGINT without duplicates (within `by`) and without nulls. It is cut into
    blocks of `blocks[0]` positions; since positions are unique, no block can hold more rows than
    that, whatever the data look like. The extremes of the blocks form a much smaller table of the
    same shape, which is treated likewise with `blocks[1]`, and so on. Only the topmost table is
    ordered in one task: it has at most a row for each stretch of positions as long as the product of
    `blocks`. Unless given, they follow from the range that the positions span, which is read
    once for it, so that no task orders more than 2^20 rows (of a value of `by`) however sparse they are.

    What a block inherits from those before it enters as one more row at its front. The rows are
    therefore read twice and shuffled once, by block, and there is no join.
    """
    return _running(df, list(by), position, value, how, name, 1, blocks_for(df, position) if blocks is None else list(blocks))


def _running(
    df: DataFrame, by: list[str], position: str, value: str, how: str, name: str, step: int, blocks: list[int]
) -> DataFrame:
    extreme = F.max if how == "max" else F.min
    if not blocks:
        return df.withColumn(name, _before(extreme(value), by, position))

    step *= blocks[0]
    block = f"_block{step}"
    rows = df.withColumn(block, floor_to(F.col(position), step))
    per_block = rows.groupBy(*by, block).agg(extreme(value).alias(value))
    inherited = _running(per_block, by, block, value, how, "_inherited", step, blocks[1:])
    fronts = inherited.select(*by, block, F.col("_inherited").alias(value), F.lit(True).alias("_front"))
    chained = rows.withColumn("_front", F.lit(False)).unionByName(fronts, allowMissingColumns=True)
    # a front has no position of its own and sorts first
    known = chained.withColumn(name, _before(extreme(value), [*by, block], position))
    return known.filter(~F.col("_front")).select(*df.columns, name)


def _before(aggregate: Column, keys: list[str], position: str) -> Column:
    order = W.partitionBy(*keys).orderBy(F.col(position).asc_nulls_first())
    return aggregate.over(order.rowsBetween(W.unboundedPreceding, -1))
