"""Writers: idempotent appends, shards, exports. Files are committed whole by Spark's writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawmill.functions.text import retry_shard, shard_name
from lawmill.operators.dedupe import first_wins, not_in


def append_new(rows: DataFrame, existing: DataFrame | None, key: str, order: list[str], folder: str) -> DataFrame:
    """Rows whose key was never written, appended as text, CSV and JSON lines side by side; the rows appended."""
    fresh = first_wins(rows if existing is None else not_in(rows, existing, [key]), [key], order)
    fresh.write.mode("append").json(f"{folder}/jsonl")
    written = fresh.sparkSession.read.schema(fresh.schema).json(f"{folder}/jsonl")
    fresh.select(key).write.mode("append").text(f"{folder}/txt")
    fresh.write.mode("append").option("header", "true").csv(f"{folder}/csv")
    return written


def by_doc_type(records: DataFrame, folder: str, mode: str = "append") -> None:
    records.write.mode(mode).partitionBy("doc_type").json(folder)


def sitemap_shards(documents: DataFrame, folder: str, mode: str = "append") -> None:
    """Documents (sitemap_url, sitemap_index, ...) in a folder per sitemap."""
    documents.withColumn("shard", shard_name(F.col("sitemap_url"), F.col("sitemap_index"))).write.mode(mode).partitionBy("shard").json(folder)


def retry_shards(documents: DataFrame, folder: str) -> None:
    documents.withColumn("shard", retry_shard(F.coalesce("sitemap_index", F.lit(0)))).write.mode("append").partitionBy("shard").json(folder)


def split_envelopes(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of worker results (document_index, url, ok, doc, error)."""
    good = envelopes.where("ok").select("document_index", "url", "doc.*") if "doc" in envelopes.columns else envelopes.where("ok").drop("error")
    return good, envelopes.where("not ok").drop("ok", "doc")


def export_records(state: DataFrame, doc_type: str) -> DataFrame:
    """The detail records of a type in order of item_id; rows whose JSON is broken are passed over."""
    d = state.where((F.col("doc_type") == doc_type) & F.col("detail_json").isNotNull() & (F.trim("detail_json") != ""))
    d = d.withColumn("_v", F.try_parse_json("detail_json")).where("_v is not null").drop("_v")
    return d.select("item_id", "scope", "doc_type", "detail_json").orderBy("item_id", "scope")


def state_documents(state: DataFrame) -> DataFrame:
    """State rows as JSON lines; detail is an object where it parses, else the raw string."""
    broken = F.try_parse_json("detail_json").isNull() & F.col("detail_json").isNotNull()
    head = F.to_json(F.struct("item_id", "scope", "doc_type", "status", "error_message"))
    detail = F.when(F.col("detail_json").isNull(), F.lit("null")).when(broken, F.to_json(F.struct(F.col("detail_json").alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("detail_json").alias("x")))) - 6)).otherwise(F.col("detail_json"))
    return state.select("item_id", "scope", F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"detail":'), detail, F.lit("}")).alias("json"))


def full_state(state: DataFrame, crawl_progress: DataFrame, now: Column, source: str) -> tuple[DataFrame, DataFrame]:
    """(header, documents) of an export of the whole state: one JSON object of generated_at, source and crawl_progress
    (one entry a document type), and a JSON line a document in order of type and item, with the detail as an object where it
    parses, else as the raw string, and the output record made of it."""
    progress = F.sort_array(F.collect_list(F.struct(*crawl_progress.columns)))
    header = crawl_progress.agg(progress.alias("crawl_progress")).select(F.to_json(F.struct(now.alias("generated_at"), F.lit(source).alias("source"), "crawl_progress")).alias("json"))
    detail = F.try_parse_json("detail_json")
    parsed = F.from_json("detail_json", "text string, metadata map<string,string>, attachment_urls array<struct<filename: string, url: string, type: string>>")
    record = F.when(detail.isNotNull(), F.struct(
        F.concat(F.lit("VBPL-"), F.col("item_id").cast("string")).alias("id"), parsed["text"].alias("text"), parsed["metadata"].alias("metadata"), parsed["attachment_urls"].alias("attachments"),
        parsed["metadata"]["ngay_ban_hanh"].alias("created_timestamp"), F.col("updated_at").alias("downloaded_timestamp"), parsed["metadata"]["source_url"].alias("url"),
    ))
    head = F.to_json(F.struct("item_id", "scope", "doc_type", "status", "error_message", "discovered_at", "updated_at", record.alias("record")), {"ignoreNullFields": "false"})
    text = F.when(F.trim(F.coalesce("detail_json", F.lit(""))) == "", F.lit("null")).when(detail.isNotNull(), F.trim("detail_json")).otherwise(_json_string(F.col("detail_json")))
    documents = state.select("doc_type", "item_id", "scope", F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"detail":'), text, F.lit("}")).alias("json"))
    return header, documents.orderBy("doc_type", "item_id", "scope")


def _json_string(c: Column) -> Column:
    whole = F.to_json(F.struct(c.alias("x")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def append_errors(envelopes: DataFrame, stage: str, now: Column, folder: str) -> None:
    """The failures among worker results appended to the error log, with their stage."""
    _, bad = split_envelopes(envelopes)
    bad.select(now.alias("when_utc"), F.lit(stage).alias("stage"), *bad.columns).write.mode("append").json(folder)


def missing_files(attachments: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Attachments (item_id, filename, ...) that aren't on disk (item_id, filename, length) or are empty there."""
    return attachments.join(on_disk.where("length > 0").select("item_id", "filename"), ["item_id", "filename"], "left_anti")


def json_arrays(rows: DataFrame, column: str, folder: str) -> None:
    """JSON values in order, each part file one whole JSON array; read back with multiLine. No part is held in memory."""

    def wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        yield pd.DataFrame({"value": ["["]})
        for b in batches:
            lines = b["value"].tolist()
            if not lines:
                continue
            out = [] if held is None else [held + ","]
            out += [x + "," for x in lines[:-1]]
            held = lines[-1]
            yield pd.DataFrame({"value": pd.Series(out, dtype=object)})
        yield pd.DataFrame({"value": ["]"] if held is None else [held, "]"]})

    rows.select(rows[column].alias("value")).where("value is not null").mapInPandas(wrap, "value string").write.mode("overwrite").text(folder)


def nested_catalogue(entries: DataFrame) -> DataFrame:
    """(doc_type, page, json) of listing entries (doc_type, page, idx, url, title): one row a page of a type, whose
    entries a listing page bounds."""
    x = F.struct(F.col("url").alias("document_url"), F.col("title").alias("document_title"))
    pages = entries.groupBy("doc_type", "page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("k"), x.alias("v"))))).alias("m"))
    return pages.select("doc_type", "page", F.to_json(F.create_map("doc_type", F.create_map("page", "m"))).alias("json"))


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Attachments (item_id, filename, content) written under ``folder``/item_id, a folder that all executors mount;
    (item_id, filename, ok, error) of each. Files that are there and not empty are left alone. Lazy, as a plan."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, name, content in zip(b["item_id"], b["filename"], b["content"]):
                error = None
                try:
                    place = Path(folder) / str(i) / Path(name).name
                    if not (place.exists() and place.stat().st_size):
                        place.parent.mkdir(parents=True, exist_ok=True)
                        part = place.with_name(place.name + f".{uuid.uuid4().hex}")
                        part.write_bytes(bytes(content))
                        part.replace(place)  # whole or not at all, if a task is repeated
                except (OSError, TypeError) as e:
                    error = str(e)
                rows.append((i, name, error is None, error))
            yield pd.DataFrame(rows, columns=["item_id", "filename", "ok", "error"])

    return files.where("item_id is not null and filename is not null").mapInPandas(write, "item_id bigint, filename string, ok boolean, error string")


def sitemap_cache(urls: DataFrame, folder: str) -> bool:
    """The list of sitemaps kept for a run that can't find them; an empty list is not kept."""
    if urls.isEmpty():
        return False
    urls.select("sitemap_index", "url").write.mode("overwrite").json(folder)
    return True
