"""First-wins deduplication, anti-joins, and merges of immutable tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALTS = 32


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order (whole rows, so that ties give one of equal rows).

    An aggregate, not a window: rows are combined before the shuffle, and a key that a third of
    the rows share reaches its task as one row a partition.
    """
    cols = [c if isinstance(c, Column) else F.col(c) for c in order]
    packed = df.select(*keys, F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cols)]).alias("_o"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    won = packed.groupBy(*keys).agg(F.min_by("_row", "_o").alias("_row"))
    return won.select("_row.*")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key in the given order; rows without a place in it come first."""
    cols = [c if isinstance(c, Column) else F.col(c) for c in order]
    # max_by passes over null orders, so the nulls' place is made explicit
    o = F.struct(*[x for i, c in enumerate(cols) for x in (c.isNotNull().alias(f"_n{i}"), c.alias(f"_o{i}"))])
    packed = df.select(*keys, o.alias("_o"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    return packed.groupBy(*keys).agg(F.max_by("_row", "_o").alias("_row")).select("_row.*")


def not_in(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't known yet."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def insert_or_ignore(table: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The table with those rows appended whose key it lacks; of new rows of one key the first."""
    return table.unionByName(first_wins(not_in(rows, table, keys), keys, order), allowMissingColumns=True)


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Insert, or set ``columns`` of the rows there; the other columns keep their values. One change a key."""
    t, c = table.alias("t"), changes.alias("c")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    hit = F.col("c._hit").isNotNull()
    joined = t.join(changes.withColumn("_hit", F.lit(True)).alias("c"), on, "full_outer")
    out = []
    for name in table.columns:
        if name in keys:
            out.append(F.coalesce(f"t.{name}", f"c.{name}").alias(name))
        elif name in columns:
            out.append(F.when(hit, F.col(f"c.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        elif name in changes.columns:
            out.append(F.coalesce(f"t.{name}", f"c.{name}").alias(name))
        else:
            out.append(F.col(f"t.{name}").alias(name))
    return joined.select(*out)


def update(table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set ``columns`` of the rows there; a change of a key the table lacks does nothing."""
    c = changes.select(*keys, *(F.col(x).alias(f"_{x}") for x in columns), F.lit(True).alias("_hit"))
    joined = table.join(c, list(keys), "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) if x in columns else F.col(x) for x in table.columns))


def new_and_repeated(df: DataFrame, group: Sequence[str], keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Per group, how many rows brought a key first and how many repeated one."""
    cols = [c if isinstance(c, Column) else F.col(c) for c in order]
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cols)], *[F.col(g) for g in group])).alias("_f"))
    news = firsts.select(*[F.col(f"_f.{g}").alias(g) for g in group]).groupBy(*group).agg(F.count("*").alias("new_rows"))
    every = df.groupBy(*group).agg(F.count("*").alias("rows"))
    return every.join(news, list(group), "left").select(*group, F.coalesce("new_rows", F.lit(0)).alias("new_rows"), (F.col("rows") - F.coalesce("new_rows", F.lit(0))).alias("repeated_rows"))


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank", parts: int | None = None) -> DataFrame:
    """Rank of every row from 1 in a total order, without gathering the rows in one task.

    Rows are range-partitioned and numbered within their partition; a table of one row a
    partition gives each the number of rows before it.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    ranged = ranged.withColumn("_k", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("bigint"), 33))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return ranged.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_before") + F.col("_k") + 1).drop("_p", "_k", "_before")
