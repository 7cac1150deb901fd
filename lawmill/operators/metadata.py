"""Attribute maps: label look-ups, merges and picks by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawmill.functions.text import normalise_label


def contained_label(cell: Column, labels: dict[str, str]) -> Column:
    """The field of the first label, in order, that the cell contains; null if none."""
    low = F.lower(cell)
    out = F.lit(None).cast("string")
    for label, field in reversed(labels.items()):
        out = F.when(low.contains(label), field).otherwise(out)
    return out


def exact_label(cell: Column, labels: dict[str, str]) -> Column:
    """The field of a label that the normalised cell equals."""
    return F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))[normalise_label(cell)]


def merge(under: Column, over: Column) -> Column:
    """Both maps; where they share a key the second wins. A null map counts as empty."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    a, b = F.coalesce(under, empty), F.coalesce(over, empty)
    kept = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.map_concat(kept, b)


def with_defaults(metadata: Column, defaults: dict[str, Column]) -> Column:
    """The map with keys added that it lacks."""
    return merge(F.create_map(*(x for k, v in defaults.items() for x in (F.lit(k), v))), metadata)


def longest(candidates: list[Column]) -> Column:
    """The longest text, of equals the first; null texts count as empty."""
    best = F.coalesce(candidates[0], F.lit(""))
    for c in candidates[1:]:
        x = F.coalesce(c, F.lit(""))
        best = F.when(F.length(x) > F.length(best), x).otherwise(best)
    return best


def by_priority(blocks: list[Column], fields: list[str], enough: tuple[str, str]) -> Column:
    """Of each field the first non-null value over the blocks (structs), none beyond the block at which
    both fields of ``enough`` are known."""
    done = F.lit(False)
    got: dict[str, Column] = {f: F.lit(None).cast("string") for f in fields}
    for b in blocks:
        new = {f: F.when(done, got[f]).otherwise(F.coalesce(got[f], b[f])) for f in fields}
        got = new
        done = done | (got[enough[0]].isNotNull() & got[enough[1]].isNotNull())
    return F.struct(*(c.alias(f) for f, c in got.items()))


def lookup(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, name: str) -> DataFrame:
    """``df`` with the dimension's name for a key, empty where there is none. The dimension is a fixed list."""
    d = F.broadcast(dim.select(F.col(dim_key).alias("_k"), F.col(name)))
    return df.withColumn("_key", key.try_cast("int")).join(d, F.col("_key") == F.col("_k"), "left").withColumn(name, F.coalesce(name, F.lit(""))).drop("_key", "_k")


def with_fallback(wanted: DataFrame, pages: DataFrame, central: str, fallback: str) -> DataFrame:
    """``wanted`` (item_id, scope) with the page (item_id, scope, page) of its own scope, or of the
    fallback scope where the central scope has none."""
    own = pages.select("item_id", "scope", F.col("page").alias("_own"))
    other = pages.where(F.col("scope") == fallback).select("item_id", F.col("page").alias("_other"))
    j = wanted.join(own, ["item_id", "scope"], "left").join(other, "item_id", "left")
    page = F.coalesce("_own", F.when(F.col("scope") == central, F.col("_other")))
    used = F.when(F.col("_own").isNotNull(), F.col("scope")).when((F.col("scope") == central) & F.col("_other").isNotNull(), F.lit(fallback))
    return j.withColumn("page", page).withColumn("scope_used", used).drop("_own", "_other")
