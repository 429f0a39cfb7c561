"""Order-dependent building blocks that never put one group in one task.

A running total over a group is computed in two levels: the order is cut into
blocks, each block is summed, and a row's total is the sum of the blocks before
it plus the running sum inside its own block.  A group holding a third of all
rows is thereby spread over as many tasks as it has blocks, and only one row
per block takes part in the second level.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.hashing import HASH_BITS, hash_key
from textloom.sources.scratch import durable

_BLOCK, _VALUE, _BEFORE = "__block", "__value", "__offset"
MAX_BLOCKS = 20_000
ROWS_PER_BLOCK = 1_000_000
PLACES_PER_BLOCK = 65_536
BYTES_PER_PART = 8 << 20


def running_total(
    df: DataFrame,
    *,
    order: Sequence[Column],
    block: Column | str,
    value: Column,
    out: str,
    group: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """Add `out`, the sum of `value` over the rows before (or up to) each row.

    `block` must not decrease along `order`; `order` must be total. A null
    group is a group of its own.
    """
    keys = list(group)
    block = F.col(block) if isinstance(block, str) else block
    rows = df.withColumn(_BLOCK, block).withColumn(_VALUE, value)
    earlier_blocks = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, _BLOCK)
        .agg(F.sum(_VALUE).alias("__sum"))
        .select(
            *[F.col(k).alias(f"__of_{k}") for k in keys],
            F.col(_BLOCK).alias("__at"),
            F.coalesce(F.sum("__sum").over(earlier_blocks), F.lit(0)).alias(_BEFORE),
        )
    )
    same = F.col(_BLOCK) == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    within = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        rows.join(offsets, same)
        .withColumn(out, F.col(_BEFORE) + F.coalesce(F.sum(_VALUE).over(within), F.lit(0)))
        .drop(_BLOCK, _VALUE, _BEFORE, "__at", *[f"__of_{k}" for k in keys])
    )


def parts_for(df: DataFrame, size: Column, bytes_per_part: int = BYTES_PER_PART) -> int:
    """Number of partitions that hold about `bytes_per_part` of `size` each.

    Rows that a text is cut into are many times its size, and partitions merged
    by their size before the cut would be sorted and grouped on disk.
    """
    total = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return min(MAX_BLOCKS, max(1, math.ceil(total / bytes_per_part)))


def by_key(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """`df` partitioned by `keys`: two tables with equal `parts` meet on the keys, and on more columns, without a shuffle."""
    return df.repartition(*keys) if parts is None else df.repartition(parts, *keys)


def with_quantile_block(df: DataFrame, column: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add a block number that follows `column` and holds about equal row counts.

    The cut points are read once and become literals, so a recomputed task
    always sees the same blocks. There are two blocks at least, so that tables
    of all sizes take the same way.
    """
    blocks = min(MAX_BLOCKS, math.ceil(df.count() / rows_per_block) + 1)
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    cuts = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, 20 * blocks)).first()[0]
    splits = [-math.inf, *sorted({c for c in cuts or () if math.isfinite(c)} or {0.0}), math.inf]
    keyed = df.withColumn("__order", F.col(column).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="__order", outputCol=_BLOCK, handleInvalid="keep").transform(keyed)
    # A row without a place comes first, as in any ascending sort.
    return cut.withColumn(_BLOCK, F.when(F.col(column).isNull(), -1.0).otherwise(F.col(_BLOCK))).drop("__order")


def dense_index(df: DataFrame, column: str, out: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Number the rows 0..n-1 along a unique numeric column."""
    return running_total(
        with_quantile_block(df, column, rows_per_block),
        order=[F.col(column)],
        block=_BLOCK,
        value=F.lit(1).cast("bigint"),
        out=out,
    ).drop(_BLOCK)


def dense_index_by(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Number the rows 0..n-1 along any total order (strings, several columns).

    Range partitioning samples its input, so the partitioned rows are stored
    before the partition sizes are added up.
    """
    ranged = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias(_BLOCK)).agg(F.count("*").alias("__n"))
    before = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select(_BLOCK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_BEFORE))
    local = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn(_BLOCK, part)
        .join(offsets, _BLOCK)
        .withColumn(out, F.col(_BEFORE) + local)
        .drop("__at", _BLOCK, _BEFORE)
    )


def prefix_offset(
    df: DataFrame, column: str, length: Column, out: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Start offset of each row when the rows are laid end to end along `column`."""
    return running_total(
        with_quantile_block(df, column, rows_per_block),
        order=[F.col(column)],
        block=_BLOCK,
        value=length.cast("bigint"),
        out=out,
    ).drop(_BLOCK)


def grouped_offset(
    df: DataFrame, group: str, column: str, length: Column, out: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """`prefix_offset` restarted in each group."""
    return running_total(
        with_quantile_block(df, column, rows_per_block),
        group=[group],
        order=[F.col(column)],
        block=_BLOCK,
        value=length.cast("bigint"),
        out=out,
    ).drop(_BLOCK)


def shuffled_rank(
    df: DataFrame, key: str, seed: int, out: str, group: Sequence[str] = (), block_bits: int = 12
) -> DataFrame:
    """0-based place of each row in a seeded shuffle, per group if one is given."""
    hashed = df.withColumn("__hash", hash_key(F.col(key), seed))
    return running_total(
        hashed,
        group=group,
        order=[F.col("__hash"), F.col(key)],
        block=F.shiftright("__hash", HASH_BITS - block_bits),
        value=F.lit(1).cast("bigint"),
        out=out,
    ).drop("__hash")


def fill_gaps(
    df: DataFrame, group: Sequence[str], order: str, value: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Fill nulls from the row before, and leading nulls from the row after, in each group.

    Works in two levels like `running_total`: inside blocks of the numeric
    order column, and between the blocks' first and last known values.
    """
    keys = list(group)
    rows = with_quantile_block(df, order, rows_per_block)
    known = F.when(F.col(value).isNotNull(), F.col(order))
    ends = rows.groupBy(*keys, _BLOCK).agg(F.max_by(value, known).alias("__last"), F.min_by(value, known).alias("__first"))
    blocks = Window.partitionBy(*keys).orderBy(_BLOCK)
    before = F.last("__last", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("__first", ignorenulls=True).over(blocks.rowsBetween(1, Window.unboundedFollowing))
    around = ends.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col(_BLOCK).alias("__at"), before.alias("__before"), after.alias("__after")
    )
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(order)
    forward = F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    backward = F.first(value, ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
    same = F.col(_BLOCK) == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    filled = rows.join(around, same).withColumn(value, F.coalesce(forward, "__before", backward, "__after"))
    return filled.drop(_BLOCK, "__before", "__after", "__at", *[f"__of_{k}" for k in keys])


def place_block(order: str, places: int = PLACES_PER_BLOCK) -> Column:
    """Block number of a place counted inside its group: no block holds more than `places` places."""
    return F.floor(F.col(order) / places)


def runs(
    df: DataFrame, group: Sequence[str], order: str, value: str, opens: Column | None = None, block: Column | None = None
) -> DataFrame:
    """Maximal runs of equal `value` along `order` in each group: `(group, value, start, end, n)`.

    `opens` marks rows that start a run in any case. Runs are found inside blocks of places; only the first and the last
    run of a block can go on in a neighbour, so only these two meet again, one list a group. `block` must not decrease
    along `order`; without it `order` counts the places of a group, as `place_block` takes it. Nulls are equal values, a
    null group is a group, a row without a place comes first. Rows of one place have no order between them.
    """
    keys = list(group)
    block = place_block(order) if block is None else block
    opens = F.lit(False) if opens is None else F.coalesce(opens, F.lit(False))
    rows = df.withColumns({_BLOCK: block, "__opens": opens}).select(*keys, order, value, _BLOCK, "__opens")
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(inside))
    new = (F.row_number().over(inside) == 1) | F.col("__opens") | changed
    rows = rows.withColumns({"__new": new.cast("bigint"), "__ends": F.lead(F.lit(1)).over(inside).isNull()})
    rows = rows.withColumn("__run", F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    local = rows.groupBy(*keys, _BLOCK, "__run", value).agg(
        F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("n"),
        F.bool_or((F.col("__new") == 1) & F.col("__opens")).alias("__opens"), F.bool_or("__ends").alias("__ends"),
    )
    # Runs inside a block are lists of their own; those at its edges are one list a group.
    edge = (F.col("__run") == 1) | F.col("__ends")
    local = local.withColumn("__list", F.when(~edge, F.struct(_BLOCK, "__run")))
    along = Window.partitionBy(*keys, "__list").orderBy(_BLOCK, "__run")
    joins = F.col(value).eqNullSafe(F.lag(value).over(along)) & ~F.col("__opens")
    joins = joins & F.coalesce(~F.col(_BLOCK).eqNullSafe(F.lag(_BLOCK).over(along)), F.lit(False))
    joins = joins & (F.row_number().over(along) > 1)
    merged = local.withColumn("__new", F.when(joins, 0).otherwise(1).cast("bigint"))
    merged = merged.withColumn("__merged", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = merged.groupBy(*keys, "__list", "__merged", value).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")
    )
    return whole.drop("__list", "__merged")


def previous_value(
    df: DataFrame, group: Sequence[str], order: str, value: str, out: str, block: Column | None = None
) -> DataFrame:
    """Add `out`, the `value` of the row before along `order` in the same group, null for the first.

    Inside blocks, and between a block's last value and the next block; `block` is as in `runs`.
    """
    keys = list(group)
    rows = df.withColumn(_BLOCK, place_block(order) if block is None else block)
    blocks = Window.partitionBy(*keys).orderBy(_BLOCK)
    ends = rows.groupBy(*keys, _BLOCK).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(order)).alias("__end"))
    ends = ends.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col(_BLOCK).alias("__at"), F.lag("__end").over(blocks).alias("__before")
    )
    same = F.col(_BLOCK).eqNullSafe(F.col("__at"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(order)
    before = F.coalesce(F.lag(F.struct(F.col(value).alias("v"))).over(inside), F.col("__before"))
    found = rows.join(ends, same).withColumn(out, before["v"])
    return found.drop(_BLOCK, "__at", "__before", *[f"__of_{k}" for k in keys])
