"""Counts, shares, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lawmill.functions.text import percent
from lawmill.operators.dedupe import global_rank

#: Batches whose running sums one task makes.
GROUP = 10_000


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("doc_type", "status").agg(F.count("*").alias("n"))


def status_pivot(state: DataFrame, statuses: list[str]) -> DataFrame:
    return state.groupBy("doc_type").agg(*(F.count_if(F.col("status") == s).alias(s) for s in statuses))


def status_share(state: DataFrame) -> DataFrame:
    """Counts by type and status with their share of the type, and a TOTAL row a type."""
    counts = status_counts(state)
    totals = counts.groupBy("doc_type").agg(F.sum("n").alias("total"))
    shares = counts.alias("c").join(totals.alias("t"), F.col("c.doc_type").eqNullSafe(F.col("t.doc_type"))).select("c.doc_type", "status", "n", percent(F.col("n"), F.col("total")).alias("share"))
    return shares.unionByName(totals.select("doc_type", F.lit("TOTAL").alias("status"), F.col("total").alias("n"), F.lit(100.0).alias("share")))


def progress(errors: DataFrame, started: Column, target: int, saved: Column | None = None, max_documents: int | None = None) -> DataFrame:
    """Attempts, elapsed seconds, rate and seconds left by stage: to ``target`` attempts by their rate, or to ``max_documents``
    saved ones by theirs, if that many are wanted; ``eta_scope`` says which. ``saved`` tells the attempts that were."""
    ok = F.lit(True) if saved is None else F.coalesce(saved, F.lit(False))
    a = errors.groupBy("stage").agg(F.count("*").alias("attempts"), F.count_if(ok).alias("saved"), F.max("at").alias("last"))
    a = a.withColumn("elapsed", (F.unix_micros("last") - F.unix_micros(started)) / 1e6)
    per = lambda c: F.when(F.col("elapsed") > 0, F.col(c) / F.col("elapsed")).otherwise(0.0)
    a = a.withColumn("rate", per("attempts")).withColumn("saved_rate", per("saved"))
    goal, counted, rate, scope = (target, "attempts", "rate", "sitemap") if max_documents is None else (max_documents, "saved", "saved_rate", "max_documents")
    left = F.greatest(F.lit(goal) - F.col(counted), F.lit(0))
    return a.withColumn("eta", F.when(F.col(rate) > 0, left / F.col(rate))).withColumn("eta_scope", F.lit(scope)).drop("last")


def batch_counts(results: DataFrame, batch: Column, ok: Column) -> DataFrame:
    """(batch, done, failed, done_so_far, failed_so_far) of the results of a phase, by batch number: one row a batch."""
    b = results.groupBy(batch.alias("batch")).agg(F.count_if(ok).alias("done"), F.count_if(~ok).alias("failed"))
    ranked = global_rank(b, ["batch"], "_r")
    w = W.partitionBy(F.floor((F.col("_r") - 1) / GROUP)).orderBy("_r").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = ranked.withColumn("_g", F.floor((F.col("_r") - 1) / GROUP)).withColumn("_d", F.sum("done").over(w)).withColumn("_f", F.sum("failed").over(w))
    sums = inside.groupBy("_g").agg(F.sum("done").alias("_sd"), F.sum("failed").alias("_sf"))
    before = W.orderBy("_g").rowsBetween(W.unboundedPreceding, -1)  # one row for every GROUP batches
    sums = sums.select("_g", F.coalesce(F.sum("_sd").over(before), F.lit(0)).alias("_sd"), F.coalesce(F.sum("_sf").over(before), F.lit(0)).alias("_sf"))
    return inside.join(sums, "_g").select("batch", "done", "failed", (F.col("_d") + F.col("_sd")).alias("done_so_far"), (F.col("_f") + F.col("_sf")).alias("failed_so_far"))


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """The plan with counters that cost no pass of their own: whatever action runs it fills the observation."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(k) for k, c in counts.items())), o


def catalogue_entries(text: DataFrame) -> DataFrame:
    """The entries of a nested catalogue in either form (maps of maps, or arrays of one-key maps): (doc_type, page, idx, url, title)."""
    entry = "struct<document_url: string, document_title: string>"
    v1 = F.from_json("json", f"map<string, map<string, map<string, {entry}>>>")
    v2 = F.from_json("json", f"map<string, array<map<string, array<map<string, {entry}>>>>>")
    a = text.select(F.explode(v1).alias("doc_type", "p")).select("doc_type", F.explode("p").alias("page", "e")).select("doc_type", "page", F.explode("e").alias("idx", "x"))
    b = (
        text.select(F.explode(v2).alias("doc_type", "ps")).select("doc_type", F.explode("ps").alias("p")).select("doc_type", F.explode("p").alias("page", "es"))
        .select("doc_type", "page", F.explode("es").alias("e")).select("doc_type", "page", F.explode("e").alias("idx", "x"))
    )
    return a.unionByName(b).where("x.document_url is not null").select("doc_type", "page", "idx", F.col("x.document_url").alias("url"), F.col("x.document_title").alias("title"))


def reshape_catalogue(json: Column) -> Column:
    """Maps of maps of maps as arrays of one-key maps, twice nested."""
    entry = "struct<document_url: string, document_title: string>"
    m = F.from_json(json, f"map<string, map<string, map<string, {entry}>>>")
    one = lambda e: F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))
    pages = F.transform_values(m, lambda _, p: F.transform(F.map_entries(p), lambda e: F.map_from_arrays(F.array(e["key"]), F.array(F.transform(F.map_entries(e["value"]), one)))))
    return F.to_json(pages)


def catalogue_report(entries: DataFrame) -> DataFrame:
    """All documents, and those whose page lacks the full text, by type."""
    return entries.groupBy("doc_type").agg(F.count("*").alias("documents"), F.count_if(~F.col("url").contains("toanvan")).alias("without_fulltext"))
