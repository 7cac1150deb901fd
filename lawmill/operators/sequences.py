"""Order-dependent logic: stop rules, streaks, batches, limits of successes, retry queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lawmill.operators.dedupe import first_wins, global_rank
from lawmill.session import stage


def until_first_empty(pages: DataFrame, job: Sequence[str], page: str, size: str) -> DataFrame:
    """Pages of each job before its first empty one. An aggregate and a join, no window over a job's pages."""
    stop = pages.where(F.coalesce(F.col(size), F.lit(0)) == 0).groupBy(*job).agg(F.min(page).alias("_stop"))
    return pages.join(stop, list(job), "left").where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def streaks(attempts: DataFrame, group: Sequence[str], order: Sequence[str], ok: Column, trigger: int = 5) -> DataFrame:
    """For every failed attempt, the length of the run of failures it belongs to so far; ``tripped`` at each full ``trigger``.

    The group must bound its rows (a worker's attempts of a day, say).
    """
    w = W.partitionBy(*group).orderBy(*order)
    d = attempts.withColumn("_ok", ok.cast("int")).withColumn("_island", F.sum("_ok").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    run = F.sum(1 - F.col("_ok")).over(W.partitionBy(*group, "_island").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return d.withColumn("streak", run).where("_ok = 0").withColumn("tripped", F.col("streak") % trigger == 0).drop("_ok", "_island")


def batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Batch number from 0 of rows in order, ``size`` rows each."""
    return global_rank(df, order, "_r").withColumn("batch", F.floor((F.col("_r") - 1) / size).cast("bigint")).drop("_r")


def until_successes(attempts: DataFrame, order: Sequence[str], ok: Column, limit: int) -> DataFrame:
    """Attempts in order up to the one that brings the limit of successes, which is the last kept."""
    ranked = stage(global_rank(attempts.withColumn("_ok", ok), order, "_r"), "ranked")  # read for the count and for the cut
    success = global_rank(ranked.where("_ok").select("_r"), ["_r"], "_s")
    end = success.where(F.col("_s") == limit).agg(F.min("_r").alias("_end")).first()._end  # one number
    kept = ranked if end is None else ranked.where(F.col("_r") <= end)
    return kept.drop("_ok", "_r")


def retry_queue(errors: DataFrame, stage: str = "document_fetch", order: Sequence[str] = ("when_utc",), limit: int | None = None) -> DataFrame:
    """The failed documents to fetch again: of one stage, with a URL, each URL once (its first error)."""
    rows = errors.where((F.col("stage") == stage) & (F.trim(F.coalesce("url", F.lit(""))) != ""))
    once = first_wins(rows, ["url"], [*order, "sitemap_index", "document_index", "error"])
    return once if limit is None else once.orderBy(*order, "url").limit(limit)
