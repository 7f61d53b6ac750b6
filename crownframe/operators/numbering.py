"""Row numbers and running totals that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from crownframe.functions.batches import changes
from crownframe.session import cut


def range_stamped(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows range-sorted by keys and order, with their position `_pos` and range block `_blk`."""
    sort = [F.col(k) for k in keys] + list(order)
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    stamped = cut(ranged.withColumn("_pos", F.monotonically_increasing_id()), "stamp")
    return stamped.withColumn("_blk", F.shiftright("_pos", 33))


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
              start: int = 0) -> DataFrame:
    """`start, start+1, ...` within `keys` in `order`.

    A key that holds a large share of the rows is spread over many range blocks; only one row per
    block and key is added up in a window. `keys` may be empty for a global number. `order` should
    end in a unique column.
    """
    keys = list(keys)
    stamped = range_stamped(df, keys, order)
    blocks = stamped.groupBy(*keys, "_blk").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_blk").alias("_k_blk"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + start).alias("_shift"))
    if not keys:        # a row per block; left to itself, Spark may broadcast the stamped rows, whose files are small
        offsets = F.broadcast(offsets)
    on = stamped["_blk"] == offsets["_k_blk"]
    for k in keys:
        on = on & stamped[k].eqNullSafe(offsets[f"_k_{k}"])
    numbered = stamped.join(offsets, on).withColumn(
        name, (F.col("_pos") + F.col("_shift")).cast("long"))
    return numbered.select(*df.columns, name)


def dense_index(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str, group_name: str, start: int = 1) -> DataFrame:
    """Two numbers from `start`: of the row, in the order of `groups` and `order`, and of its group. One sort gives both."""
    groups = list(groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, so_far = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = changes(b, groups)
            if last is not None:
                new[0] = changes(pa.Table.from_batches([last, b.slice(0, 1).select(groups)]).combine_chunks().to_batches()[0], groups)[1]
            number = so_far + np.cumsum(new)
            last, so_far = b.slice(b.num_rows - 1).select(groups), int(number[-1])
            yield b.append_column("_g", pa.array(number.astype(np.int64)))

    sort = [F.col(g) for g in groups] + list(order)
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(count, T.StructType([*df.schema, T.StructField("_g", T.LongType())]))
    stamped = cut(ranged.withColumn("_pos", F.monotonically_increasing_id()), "stamp").withColumn("_blk", F.shiftright("_pos", 33))
    here = F.struct(*groups)
    blocks = stamped.groupBy("_blk").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"), F.max("_g").alias("_g"),
                                         F.min_by(here, "_pos").alias("_a"), F.max_by(here, "_pos").alias("_z"))
    in_order = Window.partitionBy().orderBy("_blk")          # a row per block
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    on = F.coalesce(F.lag("_z").over(in_order) == F.col("_a"), F.lit(False)).cast("long")       # the group before goes on
    blocks = blocks.withColumn("_on", on)
    offsets = blocks.select("_blk", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + start).alias("_shift"),
                            (F.coalesce(F.sum(F.col("_g") + 1 - F.col("_on")).over(before), F.lit(0)) - F.col("_on") + start).alias("_more"))
    return stamped.join(F.broadcast(offsets), "_blk").select(
        *df.columns, (F.col("_pos") + F.col("_shift")).cast("long").alias(name), (F.col("_g") + F.col("_more")).cast("long").alias(group_name))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sum of each expression in `sums` within `keys` in `order`."""
    keys, names = list(keys), list(sums)
    # What is added up is worked out after the rows are written, not sorted and written with them.
    stamped = range_stamped(df, keys, order).withColumns({f"_v_{n}": e for n, e in sums.items()})
    inside = Window.partitionBy(*keys, "_blk").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = stamped.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(inside) for n in names})
    blocks = stamped.groupBy(*keys, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *keys, "_blk",
        *[F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names])
    joined = local.join(offsets, [*keys, "_blk"])
    return joined.select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in names])


def assign_object_id(df: DataFrame, order: Sequence[Column], name: str = "object_id",
                     keys: Sequence[str] = ()) -> DataFrame:
    """Add ids 0..n-1 when the column is missing, else return the table as it is."""
    return df if name in df.columns else row_index(df, keys, order, name)


def reassign_duplicates(df: DataFrame, order: Sequence[Column], name: str = "object_id") -> DataFrame:
    """The first row of an id keeps it; every further one gets max+1, max+2, ..."""
    nth = row_index(df, [name], order, "_nth")
    return renumbered(nth, F.col("_nth") > 0, order, name).drop("_nth")


def renumbered(df: DataFrame, repeated: Column, order: Sequence[Column], name: str) -> DataFrame:
    """`df`, which is read several times, with new ids from max+1 in `order` for the `repeated` rows."""
    top = df.agg(F.max(name)).first()[0]
    fresh = row_index(df.filter(repeated), [], order, "_new", start=(top or 0) + 1)
    fresh = fresh.withColumn(name, F.col("_new").cast(df.schema[name].dataType)).drop("_new")
    return df.filter(~repeated).unionByName(fresh.select(*df.columns))


def in_batches(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: int,
               name: str = "batch") -> DataFrame:
    """Number rows within `keys` and cut them into batches of `size`: 0, 1, 2, ..."""
    numbered = row_index(df, keys, order, "_n")
    return numbered.withColumn(name, F.floor(F.col("_n") / size).cast("long")).drop("_n")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  rank: str | None = None) -> DataFrame:
    """First k rows per group. Spark trims each map task to k rows per group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
    return top.withColumnRenamed("_rank", rank) if rank else top.drop("_rank")


def by_size(tables: Sequence[DataFrame], keys: Sequence[str], most: int,
            weight: Column | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Keys with at most `most` rows in all tables together, and those with more; None where there are no such keys.

    A row counts as one, or as its `weight`. Rows with a null key are in neither.
    """
    keys, weight = list(keys), F.lit(1) if weight is None else weight
    rows = tables[0].select(*keys, weight.alias("_w"))
    for more in tables[1:]:
        rows = rows.unionByName(more.select(*keys, weight.alias("_w")))
    counts = cut(rows.dropna(subset=keys).groupBy(*keys).agg(F.sum("_w").alias("_n")), "sizes")
    few, many = counts.agg(F.count_if(F.col("_n") <= most), F.count_if(F.col("_n") > most)).first()
    return (counts.filter(F.col("_n") <= most).select(*keys) if few else None,
            counts.filter(F.col("_n") > most).select(*keys) if many else None)


def of_keys(df: DataFrame, keys: Sequence[str], wanted: DataFrame, rest: DataFrame | None) -> DataFrame:
    """Rows of the `wanted` keys; without `rest` those are all that have a key."""
    keys = list(keys)
    return df.dropna(subset=keys) if rest is None else df.join(wanted, keys, "left_semi")
