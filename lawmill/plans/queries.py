"""The core's queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawmill import dims
from lawmill.functions import text, urls
from lawmill.functions.html import menu_links, page
from lawmill.operators import dedupe, discover, graph, metadata, reports, sequences
from lawmill.operators.timestamps import odd_times
from lawmill.plans import pipelines
from lawmill.session import read_table, stage_path
from lawmill.sources import readers, sinks
from lawmill.streaming import resume

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
BASE = "https://congbo.example"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query()
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return odd_times(spark, *(read_table(spark, d, t) for t in ("vbpl_records", "tvpl_documents", "crawl_workers")))


# --- URLs -------------------------------------------------------------------------------------


@query("""
SELECT record_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
       split_part(regexp_replace(regexp_replace(url, '^[A-Za-z]+://[^/]*/', ''), '[?#].*$', ''), '/', 1) AS section, regexp_extract(url, 'ItemID=([0-9]+)', 1) AS item
FROM vbpl_records
""")
def url_host_section(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return read_table(spark, d, "vbpl_records").select("record_id", urls.host(u).alias("host"), urls.segment(u, 1).alias("section"), urls.query_param(u, "ItemID").alias("item"))


@query("""
SELECT record_id, 'https://congbo.example' || regexp_replace(url, '^[A-Za-z]+://[^/]*', '') AS rooted, 'https://congbo.example/' || regexp_extract(url, '([^/]*)$', 1) AS bare,
       url AS kept, regexp_extract(url, '([^/]*)$', 1) AS base_name, contains(lower(url), 'vbpq-toanvan.aspx') OR contains(lower(url), 'vbpq-van-ban-goc.aspx') AS is_detail,
       NOT contains(url, 'toanvan') AS lacks_fulltext
FROM vbpl_records
""")
def url_absolutise(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    rooted, bare = F.regexp_replace(u, r"^[A-Za-z]+://[^/]*", ""), urls.basename(u)
    return read_table(spark, d, "vbpl_records").select(
        "record_id", urls.absolutise(rooted, BASE).alias("rooted"), urls.absolutise(bare, BASE).alias("bare"), urls.absolutise(u, BASE).alias("kept"),
        bare.alias("base_name"), urls.is_detail(u).alias("is_detail"), urls.lacks_fulltext(u).alias("lacks_fulltext"),
    )


@query("""
SELECT record_id, a.filename AS filename, regexp_extract(a.url, '([^/]*)$', 1) AS base_name, CASE WHEN lower(a.url) LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches(lower(a.url), '\\.docx?$') THEN 'doc' ELSE 'other' END AS kind
FROM (SELECT record_id, unnest(attachments) AS a FROM vbpl_records) WHERE regexp_matches(lower(a.url), '\\.(docx?|pdf|zip|rar)$')
""")
def attachment_types(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "vbpl_records").select("record_id", F.explode("attachments").alias("a")).where(urls.is_attachment(F.col("a.url")))
    return a.select("record_id", "a.filename", urls.basename(F.col("a.url")).alias("base_name"), urls.attachment_type(F.col("a.url")).alias("kind"))


@query("""
SELECT DISTINCT item_id, scope, CASE WHEN doc_type = 'vbhn' THEN 'https://congbo.example/' || scope || '/Pages/vbpq-van-ban-goc-hopnhat.aspx?ItemID=' || item_id
                      ELSE 'https://congbo.example/' || scope || '/Pages/vbpq-toanvan.aspx?ItemID=' || item_id END AS detail_url,
       CASE WHEN doc_type = 'vbhn' THEN 'van_ban_hop_nhat' ELSE 'van_ban_phap_quy' END AS collection
FROM crawl_state
""")
def document_urls(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    collection = F.when(F.col("doc_type") == "vbhn", dims.COLLECTIONS["vbhn"]).otherwise(dims.COLLECTIONS["vbpq"])
    return s.select("item_id", "scope", urls.document_url(BASE, F.col("doc_type"), F.col("scope"), F.col("item_id")).alias("detail_url"), collection.alias("collection")).distinct()


@query("""
SELECT DISTINCT 'https://congbo.example/' || scope || '/Pages/vanban.aspx?idLoaiVanBan=' || (item_id % 23) || '&dvid=' || (item_id % 7) || '&Page=' || (item_id % 11) AS url,
       scope || '|' || (item_id % 7) || '|' || (item_id % 23) AS job_key, 'p=' || scope || '&row=' || (item_id % 11) AS body
FROM crawl_state WHERE scope IS NOT NULL
""")
def listing_urls(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").where("scope is not null").select("scope", (F.col("item_id") % 23).alias("t"), (F.col("item_id") % 7).alias("u"), (F.col("item_id") % 11).alias("p"))
    c = F.col
    return s.select(
        urls.listing_url(BASE, c("scope"), c("t"), c("u"), c("p")).alias("url"), text.job_key(c("scope"), c("u"), c("t")).alias("job_key"), urls.form_body({"p": c("scope"), "row": c("p")}).alias("body")
    ).distinct()


# --- text -------------------------------------------------------------------------------------

_BLANK = r"[\t\n\v\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(rf"""
SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{_BLANK}+', ' ', 'g'), '^ | $', '', 'g')) AS collapsed_md5, length(text) AS n_chars FROM documents WHERE text IS NOT NULL
""")
def normalise_whitespace(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "documents").where("text is not null")
    return t.select("doc_id", F.md5(text.collapse(F.col("text"))).alias("collapsed_md5"), F.length("text").cast("bigint").alias("n_chars"))


@query("""
SELECT canon_id, lower(canon_value) AS label, canon_value AS trimmed, 'x' || canon_value AS no_bom FROM canon_values
""")
def label_functions(spark: SparkSession, d: str) -> DataFrame:
    c, v = read_table(spark, d, "canon_values"), F.col("canon_value")
    return c.select(
        "canon_id", text.normalise_label(F.concat(F.lit("  "), F.regexp_replace(v, " ", "  "), F.lit(" :"))).alias("_l"), text.trim_value(F.concat(F.lit(":- "), v, F.lit(" -:"))).alias("trimmed"),
        text.strip_bom(F.concat(F.lit("﻿x"), v)).alias("no_bom"),
    ).select("canon_id", F.rtrim("_l").alias("label"), "trimmed", "no_bom")


_FIELDS = list(text.ATTRIBUTE_LABELS.values())
_CLEAN = "nullif(regexp_replace(regexp_replace(regexp_replace({v}, '" + _BLANK + "+', ' ', 'g'), '^ | $', '', 'g'), '^[:\\- ]+|[:\\- ]+$', '', 'g'), '')"


@query("SELECT row_id, " + ", ".join(f"{_CLEAN.replace('{v}', f'attributes.{f}')} AS {f}" for f in _FIELDS) + " FROM tvpl_documents")
def labelled_attributes(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "tvpl_documents")
    written = F.concat_ws(" ", *(F.concat(F.lit(k.upper() if i % 2 else k.capitalize()), F.lit(" : "), F.coalesce(F.col(f"attributes.{f}"), F.lit(""))) for i, (k, f) in enumerate(text.ATTRIBUTE_LABELS.items())))
    return t.select("row_id", text.labelled_fields(written).alias("x")).select("row_id", "x.*")


@query("""
SELECT when_utc, stage, url, sitemap_url, error,
       CASE WHEN document_index IS NULL THEN 'unknown' WHEN document_index >= 3600 THEN printf('%02d:%02d:%02d', document_index // 3600, document_index % 3600 // 60, document_index % 60) ELSE printf('%02d:%02d', document_index // 60, document_index % 60) END AS duration,
       CASE WHEN regexp_matches(sitemap_url, 'resitemap[0-9]+\\.xml') THEN 'resitemap_' || lpad(regexp_extract(sitemap_url, 'resitemap([0-9]+)\\.xml', 1), 4, '0') ELSE printf('sitemap_%04d', sitemap_index) END AS shard,
       CASE WHEN coalesce(sitemap_index, 0) >= 1 THEN printf('resitemap_%04d', sitemap_index) ELSE 'retry_unmapped' END AS retry_shard,
       least(120.0, (CASE WHEN contains(error, '429') THEN 8.0 ELSE 1.0 END) * power(2.0, greatest(coalesce(sitemap_index, 1) % 6 - 1, 0)))::DOUBLE AS backoff,
       CASE WHEN document_index IS NOT NULL THEN greatest(document_index::DOUBLE, 0.0) END AS retry_after, (2.0 * power(2.0, coalesce(sitemap_index, 0) % 4))::DOUBLE AS delay
FROM crawl_errors
""")
def retry_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    e, c = read_table(spark, d, "crawl_errors"), F.col
    status = F.when(c("error").contains("429"), 429).otherwise(500)
    return e.select(
        "when_utc", "stage", "url", "sitemap_url", "error", text.duration_text(c("document_index").cast("double")).alias("duration"), text.shard_name(c("sitemap_url"), c("sitemap_index")).alias("shard"),
        text.retry_shard(F.coalesce("sitemap_index", F.lit(0))).alias("retry_shard"), text.backoff_seconds(status, F.coalesce("sitemap_index", F.lit(1)) % 6).alias("backoff"),
        text.retry_after_seconds(c("document_index").cast("string"), F.current_timestamp()).alias("retry_after"), text.exponential_delay(F.coalesce("sitemap_index", F.lit(0)) % 4).alias("delay"),
    )


@query("""
SELECT page_id, contains(lower(text[1:1200]), 'just a moment') AND contains(lower(text[1:1200]), 'cloudflare') OR contains(lower(text[1:1200]), 'cf-challenge') AS challenge,
       contains(lower(text), 'không tìm thấy') OR contains(lower(text), 'not found') AS missing, contains(lower(text[1:200]), '<html') OR contains(lower(text[1:200]), '<!doctype html') AS html
FROM ministry_pages
""")
def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read_table(spark, d, "ministry_pages").select("page_id", text.looks_like_challenge(t).alias("challenge"), text.looks_missing(t).alias("missing"), text.looks_like_html(t).alias("html"))


# --- state ------------------------------------------------------------------------------------

_STATE_ROW = "coalesce(status, ''), coalesce(detail_json, ''), coalesce(error_message, ''), coalesce(doc_type, '')"
_LATEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, scope ORDER BY updated_at DESC NULLS LAST, discovered_at DESC NULLS LAST, {_STATE_ROW.replace(')', ') DESC').replace(') DESC, coalesce', ') DESC, coalesce')}) AS rn FROM crawl_state) WHERE rn = 1"


def _latest(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    blank = F.lit("")
    return dedupe.last_wins(s, ["item_id", "scope"], ["updated_at", "discovered_at", *(F.coalesce(c, blank) for c in ("status", "detail_json", "error_message", "doc_type"))])


@query(f"SELECT item_id, scope, doc_type, status, error_message, updated_at FROM ({_LATEST})")
def state_latest(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d).select("item_id", "scope", "doc_type", "status", "error_message", "updated_at")


@query("SELECT doc_type, status, count(*) AS n FROM crawl_state GROUP BY ALL")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.status_counts(read_table(spark, d, "crawl_state"))


@query("""SELECT doc_type, count(*) FILTER (status = 'discovered') AS discovered, count(*) FILTER (status = 'detail_done') AS detail_done, count(*) FILTER (status = 'attachments_done') AS attachments_done,
       count(*) FILTER (status = 'failed') AS failed FROM crawl_state GROUP BY doc_type""")
def status_pivot(spark: SparkSession, d: str) -> DataFrame:
    return reports.status_pivot(read_table(spark, d, "crawl_state"), ["discovered", "detail_done", "attachments_done", "failed"])


@query("""
WITH c AS (SELECT doc_type, status, count(*) AS n FROM crawl_state GROUP BY ALL), t AS (SELECT doc_type, sum(n) AS total FROM c GROUP BY doc_type)
SELECT c.doc_type, status, n, round(n::DOUBLE * 100.0 / total, 1) AS share FROM c JOIN t ON c.doc_type IS NOT DISTINCT FROM t.doc_type
UNION ALL SELECT doc_type, 'TOTAL', total::BIGINT, 100.0 FROM t
""")
def status_share(spark: SparkSession, d: str) -> DataFrame:
    return reports.status_share(read_table(spark, d, "crawl_state"))


@query("SELECT DISTINCT item_id, scope, doc_type FROM crawl_state WHERE status = 'discovered'")
def pending_details(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.pending(read_table(spark, d, "crawl_state")).distinct()


@query("SELECT DISTINCT item_id, scope, doc_type FROM crawl_state WHERE status = 'detail_done' AND doc_type = 'vbpq'")
def pending_attachments(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.pending(read_table(spark, d, "crawl_state"), "detail_done", "vbpq").distinct()


@query("""
WITH old AS (SELECT DISTINCT item_id, scope FROM crawl_state WHERE status = 'failed'),
     fresh AS (SELECT item_id, scope, min(doc_type) AS doc_type FROM crawl_state WHERE status <> 'failed' GROUP BY ALL)
SELECT item_id, scope, 'old' AS doc_type FROM old
UNION ALL SELECT item_id, scope, doc_type FROM fresh WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.item_id = fresh.item_id AND old.scope = fresh.scope)
""")
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    old = s.where("status = 'failed'").select("item_id", "scope").distinct().withColumn("doc_type", F.lit("old"))
    return dedupe.insert_or_ignore(old, s.where("status <> 'failed'").select("item_id", "scope", "doc_type"), ["item_id", "scope"], ["doc_type"])


@query("""
WITH t AS (SELECT scope, count(*) AS total_pages, max(item_id) AS last_page FROM crawl_state WHERE status = 'discovered' GROUP BY scope),
     c AS (SELECT scope, count(*) AS total_pages FROM crawl_state WHERE status = 'failed' GROUP BY scope)
SELECT coalesce(t.scope, c.scope) AS scope, coalesce(c.total_pages, t.total_pages) AS total_pages, t.last_page FROM t FULL JOIN c ON t.scope IS NOT DISTINCT FROM c.scope
""")
def state_upsert(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    table = s.where("status = 'discovered'").groupBy("scope").agg(F.count("*").alias("total_pages"), F.max("item_id").alias("last_page"))
    changes = s.where("status = 'failed'").groupBy("scope").agg(F.count("*").alias("total_pages"))
    return dedupe.upsert(table, changes, ["scope"], ["total_pages"])


@query(f"""
WITH s AS ({_LATEST}), done AS (SELECT DISTINCT try_cast(substr(id, 6) AS BIGINT) AS item_id FROM vbpl_records)
SELECT s.item_id, s.scope, CASE WHEN done.item_id IS NOT NULL THEN 'attachments_done' ELSE s.status END AS status FROM s LEFT JOIN done ON s.item_id = done.item_id
""")
def state_update(spark: SparkSession, d: str) -> DataFrame:
    done = read_table(spark, d, "vbpl_records").select(F.substring("id", 6, 20).try_cast("bigint").alias("item_id")).distinct().withColumn("status", F.lit("attachments_done"))
    return dedupe.update(_latest(spark, d), done, ["item_id"], ["status"]).select("item_id", "scope", "status")


@query("SELECT scope, arg_max(item_id, (updated_at, item_id)) AS last_item FROM crawl_state WHERE updated_at IS NOT NULL GROUP BY scope")
def last_page(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "crawl_state").where("updated_at is not null").groupBy("scope").agg(F.max_by("item_id", F.struct("updated_at", "item_id")).alias("last_item"))


@query("""
SELECT DISTINCT item_id, scope, doc_type, detail_json FROM crawl_state WHERE doc_type = 'vbpq' AND detail_json IS NOT NULL AND trim(detail_json) <> '' AND json_valid(detail_json)
""")
def export_records(spark: SparkSession, d: str) -> DataFrame:
    return sinks.export_records(read_table(spark, d, "crawl_state"), "vbpq").distinct()


@query("""
SELECT item_id, scope, json_valid(detail_json) AS parsed, CASE WHEN json_valid(detail_json) THEN json_extract_string(detail_json, '$.metadata.loai_van_ban') END AS loai
FROM crawl_state WHERE detail_json IS NOT NULL AND trim(detail_json) <> ''
""")
def export_state(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").where("detail_json is not null and trim(detail_json) <> ''")
    out = sinks.state_documents(s)
    return out.select("item_id", "scope", (F.substring(F.get_json_object("json", "$.detail"), 1, 1) == "{").alias("_o"), F.get_json_object("json", "$.detail.metadata.loai_van_ban").alias("loai"), "json").select(
        "item_id", "scope", F.try_parse_json(F.get_json_object("json", "$.detail")).isNotNull().alias("parsed"), "loai"
    )


# --- errors -----------------------------------------------------------------------------------


@query("""
SELECT url, min(when_utc) AS when_utc FROM crawl_errors WHERE stage = 'document_fetch' AND trim(coalesce(url, '')) <> '' GROUP BY url
""")
def retry_queue(spark: SparkSession, d: str) -> DataFrame:
    return sequences.retry_queue(read_table(spark, d, "crawl_errors")).select("url", "when_utc")


@query("SELECT stage, count(*) AS n, count(url) AS with_url, count(DISTINCT url) AS urls FROM crawl_errors GROUP BY stage")
def error_counts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "crawl_errors").groupBy("stage").agg(F.count("*").alias("n"), F.count("url").alias("with_url"), F.countDistinct("url").alias("urls"))


@query("""
WITH e AS (SELECT stage, try_cast(when_utc AS TIMESTAMPTZ) AS t FROM crawl_errors), a AS (SELECT stage, count(*) AS attempts, max(t) AS last FROM e GROUP BY stage),
     b AS (SELECT stage, attempts, (epoch_us(last) - epoch_us(TIMESTAMPTZ '2025-01-01 00:00:00+00')) / 1e6 AS elapsed FROM a)
SELECT stage, attempts, attempts AS saved, elapsed, attempts / elapsed AS rate, attempts / elapsed AS saved_rate, greatest(100000 - attempts, 0) / (attempts / elapsed) AS eta, 'sitemap' AS eta_scope FROM b
""")
def throughput_eta(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "crawl_errors").withColumn("at", F.col("when_utc").try_cast("timestamp"))
    return reports.progress(e, F.lit("2025-01-01 00:00:00").cast("timestamp"), 100_000)


@query("""
WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ok FROM events),
     i AS (SELECT *, sum(ok) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
SELECT user_id, event_id, sum(1 - ok) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak,
       sum(1 - ok) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) % 2 = 0 AS tripped FROM i WHERE ok = 0
""")
def error_streak_breaker(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return sequences.streaks(e, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error", 2).select("user_id", "event_id", "streak", "tripped")


@query("""
WITH e AS (SELECT event_id, event_type <> 'error' AS ok, row_number() OVER (ORDER BY ts, event_id) AS r FROM events), s AS (SELECT *, row_number() OVER (ORDER BY r) AS k FROM e WHERE ok)
SELECT event_id FROM e WHERE r <= coalesce((SELECT r FROM s WHERE k = 500), (SELECT max(r) FROM e))
""")
def limit_successes(spark: SparkSession, d: str) -> DataFrame:
    return sequences.until_successes(read_table(spark, d, "events"), ["ts", "event_id"], F.col("event_type") != "error", 500).select("event_id")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch FROM documents")
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    return sequences.batches(read_table(spark, d, "documents").select("doc_id"), ["doc_id"], 100).select("doc_id", "batch")


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity >= 5 AS full_page FROM lineitem), s AS (SELECT l_orderkey, min(l_linenumber) AS stop FROM l WHERE NOT full_page GROUP BY l_orderkey)
SELECT l.l_orderkey, l.l_linenumber FROM l LEFT JOIN s USING (l_orderkey) WHERE stop IS NULL OR l_linenumber < stop
""")
def until_first_empty(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") >= 5).cast("int").alias("n"))
    return sequences.until_first_empty(p, ["l_orderkey"], "l_linenumber", "n").select("l_orderkey", "l_linenumber")


# --- records ----------------------------------------------------------------------------------


@query("""SELECT id, min(record_id) AS record_id FROM vbpl_records GROUP BY id""")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.first_wins(read_table(spark, d, "vbpl_records").select("id", "record_id"), ["id"], ["record_id"]).select("id", "record_id")


@query("""
WITH r AS (SELECT worker_id, url, row_id, row_number() OVER (PARTITION BY url ORDER BY row_id) AS rn FROM tvpl_documents)
SELECT worker_id, count(*) FILTER (rn = 1) AS new_rows, count(*) FILTER (rn > 1) AS repeated_rows FROM r WHERE worker_id IS NOT NULL GROUP BY worker_id
""")
def new_and_repeated(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "tvpl_documents").select("worker_id", "url", "row_id")
    return dedupe.new_and_repeated(t, ["worker_id"], ["url"], ["row_id"]).where("worker_id is not null")


@query("""
SELECT DISTINCT u.url FROM (SELECT url FROM crawl_errors WHERE url IS NOT NULL) u WHERE NOT EXISTS (SELECT 1 FROM tvpl_documents t WHERE t.url = u.url AND t.attributes.tinh_trang IS NOT NULL)
""")
def pending_jobs(spark: SparkSession, d: str) -> DataFrame:
    known = read_table(spark, d, "tvpl_documents").where("attributes.tinh_trang is not null").select("url")
    return dedupe.not_in(read_table(spark, d, "crawl_errors").where("url is not null").select("url"), known, ["url"]).distinct()


@query("""
SELECT record_id, coalesce(metadata['tinh_trang'], 'không rõ') AS tinh_trang, coalesce(metadata['linh_vuc'], 'khác') AS linh_vuc, 'VBPL-' || substr(id, 6) AS rebuilt_id
FROM vbpl_records
""")
def default_metadata(spark: SparkSession, d: str) -> DataFrame:
    r = read_table(spark, d, "vbpl_records")
    m = metadata.with_defaults(F.col("metadata"), {"tinh_trang": F.lit("không rõ"), "linh_vuc": F.lit("khác")})
    return r.withColumn("m", m).select("record_id", F.col("m")["tinh_trang"].alias("tinh_trang"), F.col("m")["linh_vuc"].alias("linh_vuc"), F.concat(F.lit("VBPL-"), F.substring("id", 6, 20)).alias("rebuilt_id"))


@query("""
WITH s AS (SELECT item_id, min(scope) AS scope FROM crawl_state GROUP BY item_id)
SELECT record_id, CASE WHEN metadata['co_quan_ban_hanh'] IS NOT NULL THEN metadata['co_quan_ban_hanh'] ELSE s.scope END AS co_quan_ban_hanh, s.scope AS attr_scope
FROM vbpl_records r JOIN s ON try_cast(substr(r.id, 6) AS BIGINT) = s.item_id
""")
def merge_metadata(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").groupBy("item_id").agg(F.min("scope").alias("scope_"))
    r = read_table(spark, d, "vbpl_records").withColumn("item_id", F.substring("id", 6, 20).try_cast("bigint")).join(s, "item_id")
    attrs = F.create_map(F.lit("co_quan_ban_hanh"), F.col("scope_"), F.lit("attr_scope"), F.col("scope_"))
    return r.withColumn("m", metadata.merge(attrs, F.col("metadata"))).select("record_id", F.col("m")["co_quan_ban_hanh"].alias("co_quan_ban_hanh"), F.col("m")["attr_scope"].alias("attr_scope"))


@query("""
SELECT canon_id, CASE WHEN contains(lower(canon_value), 'liên tỉnh') THEN 'scope' WHEN contains(lower(canon_value), 'tỉnh') THEN 'province' WHEN contains(lower(canon_value), 'bộ') THEN 'ministry' END AS field FROM canon_values
""")
def label_priority(spark: SparkSession, d: str) -> DataFrame:
    labels = {"liên tỉnh": "scope", "tỉnh": "province", "bộ": "ministry"}
    return read_table(spark, d, "canon_values").select("canon_id", metadata.contained_label(F.col("canon_value"), labels).alias("field"))


_PICK = "CASE WHEN length(coalesce({b}, '')) > length(coalesce({a}, '')) THEN coalesce({b}, '') ELSE coalesce({a}, '') END"
_PICK2 = _PICK.format(a="title", b="attributes.so_hieu")


@query(f"SELECT row_id, {_PICK.format(a=f'({_PICK2})', b='attributes.noi_ban_hanh')} AS best FROM tvpl_documents")
def best_content_container(spark: SparkSession, d: str) -> DataFrame:
    best = metadata.longest([F.col("title"), F.col("attributes.so_hieu"), F.col("attributes.noi_ban_hanh")])
    return read_table(spark, d, "tvpl_documents").select("row_id", best.alias("best"))


@query("""
SELECT row_id, attributes.so_hieu AS so_hieu, CASE WHEN attributes.so_hieu IS NOT NULL AND attributes.nguoi_ky IS NOT NULL THEN NULL ELSE title END AS title,
       coalesce(attributes.nguoi_ky, CASE WHEN attributes.so_hieu IS NOT NULL AND attributes.nguoi_ky IS NOT NULL THEN NULL ELSE attributes.noi_ban_hanh END) AS nguoi_ky FROM tvpl_documents
""")
def attributes_by_container(spark: SparkSession, d: str) -> DataFrame:
    null = F.lit(None).cast("string")
    first = F.struct(F.col("attributes.so_hieu").alias("so_hieu"), F.col("attributes.nguoi_ky").alias("nguoi_ky"), null.alias("title"))
    second = F.struct(null.alias("so_hieu"), F.col("attributes.noi_ban_hanh").alias("nguoi_ky"), F.col("title").alias("title"))
    picked = metadata.by_priority([first, second], ["so_hieu", "nguoi_ky", "title"], ("so_hieu", "nguoi_ky"))
    return read_table(spark, d, "tvpl_documents").select("row_id", picked.alias("x")).select("row_id", "x.*")


@query("SELECT l_orderkey, l_linenumber, coalesce(CASE l_linenumber + 13 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in dims.DOC_TYPES.items()) + " END, '') AS doc_type_name FROM lineitem")
def doc_type_lookup(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return metadata.lookup(li, dims.doc_types(spark), (F.col("l_linenumber") + 13).cast("string"), "doc_type_id", "doc_type_name")


@query("""
WITH w AS (SELECT DISTINCT item_id, CASE WHEN scope = 'trunguong' THEN 'tw' ELSE scope END AS scope FROM crawl_state),
     p AS (SELECT DISTINCT item_id, scope, 'page ' || item_id || scope AS page FROM (SELECT item_id, CASE WHEN scope = 'trunguong' THEN 'botaichinh' ELSE scope END AS scope FROM crawl_state WHERE item_id % 2 = 0))
SELECT w.item_id, w.scope, coalesce(o.page, CASE WHEN w.scope = 'tw' THEN f.page END) AS page, CASE WHEN o.page IS NOT NULL THEN w.scope WHEN w.scope = 'tw' AND f.page IS NOT NULL THEN 'botaichinh' END AS scope_used
FROM w LEFT JOIN p o ON w.item_id = o.item_id AND w.scope = o.scope LEFT JOIN p f ON w.item_id = f.item_id AND f.scope = 'botaichinh'
""")
def fallback_scope_fetch(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    moved = lambda to: F.when(F.col("scope") == "trunguong", to).otherwise(F.col("scope"))
    wanted = s.select("item_id", moved("tw").alias("scope")).distinct()
    pages = s.where("item_id % 2 = 0").select("item_id", moved("botaichinh").alias("scope")).distinct()
    pages = pages.withColumn("page", F.concat(F.lit("page "), F.col("item_id").cast("string"), F.col("scope")))
    return metadata.with_fallback(wanted, pages, dims.CENTRAL_SCOPE, dims.FALLBACK_SCOPE)


# --- catalogues -------------------------------------------------------------------------------


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "vbpl_records").where("record_id is not null").select(
        F.coalesce(F.col("metadata")["doc_type"], F.lit("none")).alias("t"), F.concat(F.lit("Page_"), F.floor(F.col("record_id") / 20).cast("string")).alias("p"), F.col("record_id").cast("string").alias("i"), F.struct(F.col("url").alias("document_url"), F.coalesce("id", F.lit("")).alias("document_title")).alias("x"),
    )
    pages = e.groupBy("t", "p").agg(F.map_from_entries(F.collect_list(F.struct("i", "x"))).alias("m"))  # 20 entries a page
    return pages.select(F.to_json(F.create_map("t", F.create_map("p", "m"))).alias("json"))


@query("SELECT coalesce(metadata['doc_type'], 'none') AS doc_type, 'Page_' || (record_id // 20) AS page, record_id::VARCHAR AS idx, url, coalesce(id, '') AS title FROM vbpl_records WHERE url IS NOT NULL")
def catalogue_reshape(spark: SparkSession, d: str) -> DataFrame:
    c = _catalogue(spark, d)
    return reports.catalogue_entries(c.select(reports.reshape_catalogue(F.col("json")).alias("json")))


@query("SELECT coalesce(metadata['doc_type'], 'none') AS doc_type, count(*) AS documents, count(*) FILTER (NOT contains(url, 'toanvan')) AS without_fulltext FROM vbpl_records WHERE url IS NOT NULL GROUP BY 1")
def catalogue_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.catalogue_report(reports.catalogue_entries(_catalogue(spark, d)))


@query("SELECT coalesce(metadata['doc_type'], 'none') AS doc_type, 'Page_' || (record_id // 20) AS page, record_id::VARCHAR AS idx, url, coalesce(id, '') AS title FROM vbpl_records WHERE url IS NOT NULL")
def catalogue_export(spark: SparkSession, d: str) -> DataFrame:
    return reports.catalogue_entries(sinks.nested_catalogue(reports.catalogue_entries(_catalogue(spark, d))).select("json"))


@query("""
SELECT json_extract_string(detail_json, '$.metadata.loai_van_ban') AS loai, count(*) AS n FROM crawl_state
WHERE doc_type = 'vbpq' AND detail_json IS NOT NULL AND trim(detail_json) <> '' AND json_valid(detail_json) GROUP BY 1
""")
def json_array_export(spark: SparkSession, d: str) -> DataFrame:
    path = stage_path(spark, "arrays")
    sinks.json_arrays(sinks.export_records(read_table(spark, d, "crawl_state"), "vbpq"), "detail_json", path)
    return readers.json_array(spark, path, "metadata struct<loai_van_ban: string>").groupBy(F.col("metadata.loai_van_ban").alias("loai")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT ministry AS name, regexp_replace(url, '^([A-Za-z]+://[^/]+/[^/]+).*$', '\\1') AS href FROM ministry_pages WHERE ministry IS NOT NULL AND url IS NOT NULL")
def ministry_menu(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "ministry_pages").where("ministry is not null and url is not null").select("ministry", F.regexp_extract("url", r"^([A-Za-z]+://[^/]+/[^/]+)", 1).alias("home")).distinct()
    menu = F.concat(F.lit('<ul><li><a href="#">Bộ, ngành</a><ul>'), F.array_join(F.collect_list(F.concat(F.lit('<li><a href="'), "home", F.lit('">'), _escape(F.col("ministry")), F.lit("</a></li>"))), ""), F.lit("</ul></li></ul>"))
    pages = p.agg(menu.alias("html"))  # a menu: one entry a ministry
    return pages.select(F.explode(menu_links(F.col("html"), "Bộ, ngành")).alias("m")).select("m.name", "m.href")


@query("SELECT record_id AS doc_id, '#/texts/0' AS self_ref, url AS text FROM vbpl_records UNION ALL SELECT record_id, '#/texts/1', id FROM vbpl_records")
def converter_blocks(spark: SparkSession, d: str) -> DataFrame:
    t = lambda i, c: F.struct(F.lit(f"#/texts/{i}").alias("self_ref"), F.col(c).alias("text"))
    j = read_table(spark, d, "vbpl_records").select(F.col("record_id").alias("doc_id"), F.to_json(F.struct(F.array(t(0, "url"), t(1, "id")).alias("texts"))).alias("json"))
    return readers.converter_blocks(j)


# --- pages ------------------------------------------------------------------------------------


def _escape(c) -> object:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _detail_pages(spark: SparkSession, d: str) -> DataFrame:
    """Detail pages written around the records' fields, by the markup that crawls meet."""
    r = read_table(spark, d, "vbpl_records")
    m, s = F.col("metadata"), lambda c: _escape(F.coalesce(c, F.lit("")))
    row = lambda label, v: F.concat(F.lit(f'<tr><td class="label">{label}</td><td>'), s(v), F.lit("</td></tr>"))
    links = F.array_join(F.transform(F.coalesce("attachments", F.array().cast("array<struct<filename:string,url:string,type:string>>")), lambda a: F.concat(F.lit('<li><a href="/tep/'), s(a["filename"]), F.lit('">tải về</a></li>'))), "")
    html = F.concat(
        F.lit("<html><head><title>"), s(F.col("id")), F.lit("</title><script>if (a < b) {}</script></head><body><h1> "), s(m["so_hieu"]), F.lit(" </h1><!-- x --><ul>"), links,
        F.lit("</ul><table>"), row("Số hiệu", m["so_hieu"]), row("Loại văn bản", m["loai_van_ban"]), row("Người ký", m["nguoi_ky"]),
        F.lit('<tr><td>Tình trạng hiệu lực: '), s(m["tinh_trang"]), F.lit("</td></tr></table>"),
        F.lit('<div id="toanvan"><p>Số <b>'), s(m["so_hieu"]), F.lit("</b><p>"), s(F.col("text")), F.lit("<br>"), s(F.col("url")), F.lit('<br></div><div class="paging"><a href="javascript:Nexpage(\'divResultSearch\',\'7\');">7</a></div></body></html>'),
    )
    return r.select("record_id", "id", "metadata", "attachments", "url", html.alias("html"))


_STRIPPED = "regexp_replace({v}, '^" + _BLANK + "+|" + _BLANK + "+$', '', 'g')"
_M = "nullif(" + _STRIPPED.replace("{v}", "coalesce(metadata['{f}'], '')") + ", '')"
_HEADING = "trim(regexp_replace(coalesce(metadata['so_hieu'], ''), '" + _BLANK + "+', ' ', 'g'))"


@query(f"""
SELECT record_id, id AS title, {_HEADING} AS heading, {_M.replace('{f}', 'so_hieu')} AS so_hieu, {_M.replace('{f}', 'loai_van_ban')} AS loai_van_ban, {_M.replace('{f}', 'nguoi_ky')} AS nguoi_ky,
       7 AS pages, coalesce(len(attachments), 0)::INTEGER AS list_items FROM vbpl_records
""")
def html_metadata(spark: SparkSession, d: str) -> DataFrame:
    p = _detail_pages(spark, d).select("record_id", page(F.col("html"), "title", "heading", "metadata", "pager", "list_items").alias("p"))
    m = F.col("p.metadata")
    return p.select(
        "record_id", "p.title", "p.heading", m["so_hieu"].alias("so_hieu"), m["loai_van_ban"].alias("loai_van_ban"), m["nguoi_ky"].alias("nguoi_ky"), discover.total_pages(F.col("p.pager")).alias("pages"), F.col("p.list_items").alias("list_items"),
    )


@query("""
SELECT record_id, a.filename AS filename, 'https://congbo.example/tep/' || a.filename AS url, CASE WHEN a.filename LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches(a.filename, '\\.docx?$') THEN 'doc' ELSE 'other' END AS kind
FROM (SELECT DISTINCT record_id, unnest(attachments) AS a FROM vbpl_records) WHERE regexp_matches(lower(a.filename), '\\.(docx?|pdf|zip|rar)$')
""")
def html_attachments(spark: SparkSession, d: str) -> DataFrame:
    p = _detail_pages(spark, d).select("record_id", page(F.col("html"), "anchors")["anchors"].alias("a"))
    return p.select("record_id", F.explode(discover.attachments(F.col("a"), BASE)).alias("x")).select("record_id", "x.filename", "x.url", F.col("x.type").alias("kind"))


_CLEAN_PAGE = _STRIPPED.replace("{v}", "coalesce({c}, '')")


@query(rf"""
WITH p AS (SELECT record_id, 'Số' || {_CLEAN_PAGE.replace("{c}", "metadata['so_hieu']")} || chr(10) || {_CLEAN_PAGE.replace("{c}", "text")} || chr(10) || coalesce(url, '') || chr(10) AS t FROM vbpl_records),
     q AS (SELECT record_id, regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM p)
SELECT record_id, {_STRIPPED.replace("{v}", "t")} AS clean_text FROM q
""")
def html_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _detail_pages(spark, d).select("record_id", page(F.col("html"), "clean_text")["clean_text"].alias("clean_text"))


def _search_pages(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").select("item_id", "scope").distinct()
    link = F.concat(F.lit('<a href="/'), "scope", F.lit("/Pages/vbpq-toanvan.aspx?ItemID="), F.col("item_id").cast("string"), F.lit('">van ban '), F.col("item_id").cast("string"), F.lit("</a>"))
    rows = s.withColumn("page_no", F.floor(F.col("item_id") / 50)).withColumn("link", F.concat(link, F.lit('<a href="/x/y">z</a>')))
    return rows.groupBy("page_no").agg(F.array_join(F.array_sort(F.collect_list("link")), "\n").alias("html"))  # 50 documents a page


@query("""
WITH l AS (SELECT DISTINCT item_id, scope, item_id // 50 AS page_no FROM crawl_state WHERE scope IS NOT NULL),
     f AS (SELECT *, row_number() OVER (PARTITION BY page_no, item_id ORDER BY scope) AS rn FROM l)
SELECT page_no, item_id, scope, 'van ban ' || item_id AS title FROM f WHERE rn = 1
""")
def search_results(spark: SparkSession, d: str) -> DataFrame:
    return discover.search_hits(_search_pages(spark, d).select("page_no", page(F.col("html"), "anchors")["anchors"].alias("anchors")))


@query("SELECT DISTINCT split_part(url, '/', 5) AS section, url FROM tvpl_documents WHERE url IS NOT NULL")
def sitemap_locs(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "tvpl_documents").where("url is not null").select(F.split_part("url", F.lit("/"), F.lit(5)).alias("section"), "url").distinct()
    part = F.pmod(F.xxhash64("url"), F.lit(16))  # a sitemap holds a bounded part of a section
    xml = F.concat(F.lit('﻿<?xml version="1.0"?><n:urlset xmlns:n="x">'), F.array_join(F.collect_list(F.concat(F.lit("<n:url><n:loc> "), "url", F.lit(" </n:loc></n:url>"))), ""), F.lit("</n:urlset>"))
    return t.groupBy("section", part.alias("part")).agg(xml.alias("xml")).select("section", F.explode(discover.sitemap_locs(F.col("xml"))).alias("url"))


@query("SELECT i::INTEGER AS sitemap_index, 'https://congbo.example/resitemap' || i || '.xml' AS url FROM range(1, 41) t(i)")
def fallback_sitemaps(spark: SparkSession, d: str) -> DataFrame:
    return discover.fallback_sitemaps(spark, BASE, 40)


@query("SELECT DISTINCT sitemap_url AS url FROM crawl_errors WHERE sitemap_url IS NOT NULL")
def discover_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "crawl_errors")
    listed = e.where("stage = 'no such stage'").select(F.col("sitemap_url").alias("url"))
    cached = e.where("sitemap_url is not null").select(F.col("sitemap_url").alias("url")).distinct()
    return discover.first_nonempty([listed, cached, discover.fallback_sitemaps(spark, BASE, 5).select("url")])


@query("SELECT DISTINCT scope AS slug, (item_id % 23)::VARCHAR AS doc_type_id, (item_id % 7)::VARCHAR AS unit_id FROM crawl_state WHERE scope IS NOT NULL")
def job_catalogue(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").where("scope is not null").select("scope", (F.col("item_id") % 23).alias("t"), (F.col("item_id") % 7).alias("u")).distinct()
    link = F.concat(F.lit('<a href="?idLoaiVanBan='), F.col("t").cast("string"), F.lit("&amp;dvid="), F.col("u").cast("string"), F.lit('">x</a><a href="?dvid=&amp;idLoaiVanBan=3">y</a>'))
    sections = s.groupBy(F.col("scope").alias("slug")).agg(F.array_join(F.collect_list(link), "").alias("html"))  # 161 jobs at most
    return discover.jobs(sections.select("slug", page(F.col("html"), "anchors")["anchors"].alias("anchors")))


# --- crawls over the tables ---------------------------------------------------------------------

LISTED = 40  # documents of a listing page


def _listing_pages(spark: SparkSession, d: str) -> DataFrame:
    """(slug, page_no, html): listing pages of every scope, with a menu that links to documents; the list holds those discovered only."""
    s = read_table(spark, d, "crawl_state").where("scope is not null").select(F.col("scope").alias("slug"), F.expr(f"item_id div {LISTED}").alias("page_no"), "item_id", "status")
    url = F.concat(F.lit("/"), "slug", F.lit("/Pages/vbpq-toanvan.aspx?ItemID="), F.col("item_id").cast("string"))
    li = F.concat(F.lit('<li><div><p><a href=" '), url, F.lit('">Văn bản\n'), F.col("item_id").cast("string"), F.lit('</a></p><p><a href="/tep">kèm</a></p></div></li>'))
    s = s.groupBy("slug", "page_no", "item_id").agg(F.count_if(F.col("status") == "discovered").alias("n")).withColumn("li", F.when(F.col("n") > 0, li))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "li"))), lambda x: F.coalesce(x["li"], F.lit(""))), "")  # LISTED a page
    menu = '<ul><li><a href="/x/Pages/vbpq-toanvan.aspx?ItemID=0">mới</a></li></ul>'
    html = F.concat(F.lit(f'{menu}<div id="tabVB_lv1"><div>đầu</div><div><ul>'), items, F.lit("</ul></div></div>"))
    return s.groupBy("slug", "page_no").agg(html.alias("html"))


_LISTED = f"""s AS (SELECT scope AS slug, item_id // {LISTED} AS page_no, item_id, count(*) FILTER (status = 'discovered') > 0 AS listed FROM crawl_state WHERE scope IS NOT NULL GROUP BY ALL),
     n AS (SELECT slug, page_no, count(*) FILTER (listed) AS n FROM s GROUP BY ALL), stop AS (SELECT slug, min(page_no) AS stop FROM n WHERE n = 0 GROUP BY slug),
     known AS (SELECT DISTINCT scope AS slug, item_id FROM crawl_state WHERE status = 'detail_done')"""
_LISTED_URL = "'https://congbo.example/' || slug || '/Pages/vbpq-toanvan.aspx?ItemID=' || item_id"


def _listing_parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(jobs, completed, pages, known_urls): the central scope's job is completed, documents with details are known."""
    s, pages = read_table(spark, d, "crawl_state").where("scope is not null"), _listing_pages(spark, d)
    known = s.where("status = 'detail_done'").select(urls.document_url(BASE, F.lit("vbpq"), F.col("scope"), F.col("item_id")).alias("url"))
    jobs = s.select(F.col("scope").alias("slug"), "doc_type").distinct()
    return jobs, jobs.where("slug = 'trunguong'").select("slug").distinct(), pages, known


@query(f"""
WITH {_LISTED}
SELECT slug, page_no, {_LISTED_URL} AS url, 'Văn bản ' || item_id AS title FROM s LEFT JOIN stop USING (slug)
WHERE listed AND slug <> 'trunguong' AND (stop IS NULL OR page_no < stop) AND NOT EXISTS (SELECT 1 FROM known k WHERE k.slug = s.slug AND k.item_id = s.item_id)
""")
def listing_crawl(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.listing_crawl(*_listing_parts(spark, d), pipelines.Options(base=BASE))


@query(f"""
WITH {_LISTED}, v AS (SELECT s.*, stop FROM s LEFT JOIN stop USING (slug) WHERE slug <> 'trunguong' AND (stop IS NULL OR page_no <= stop)),
     j AS (SELECT DISTINCT scope AS slug, doc_type FROM crawl_state WHERE scope IS NOT NULL)
SELECT (SELECT count(DISTINCT slug) FROM j) AS slugs_total, (SELECT count(*) FROM j) AS jobs_total, (SELECT count(DISTINCT slug) FROM j WHERE slug = 'trunguong') AS slugs_done, (SELECT count(*) FROM j WHERE slug = 'trunguong') AS jobs_done,
       (SELECT count(*) FROM (SELECT DISTINCT slug, page_no FROM v)) AS pages_visited, count(*) FILTER (listed) AS candidate_links_found, 0 AS failures,
       count(*) FILTER (listed AND NOT EXISTS (SELECT 1 FROM known k WHERE k.slug = v.slug AND k.item_id = v.item_id)) AS unique_detail_urls,
       count(*) FILTER (listed AND EXISTS (SELECT 1 FROM known k WHERE k.slug = v.slug AND k.item_id = v.item_id)) AS duplicates_skipped FROM v
""")
def listing_counters(spark: SparkSession, d: str) -> DataFrame:
    jobs, completed, pages, known = _listing_parts(spark, d)
    return pipelines.listing_stats(jobs, completed, pages, known, pipelines.Options(base=BASE))


@query(f"""
WITH {_LISTED} SELECT slug, page_no, row_number() OVER (PARTITION BY slug, page_no ORDER BY item_id)::INTEGER AS item, {_LISTED_URL.replace("example/", "example /")} AS url, 'Văn bản ' || item_id AS title FROM s WHERE listed
""".replace("example /", "example/"))
def listing_items(spark: SparkSession, d: str) -> DataFrame:
    p = _listing_pages(spark, d).select("slug", "page_no", page(F.col("html"), "listing")["listing"].alias("listing"))
    return discover.listing_items(p, BASE)


@query("SELECT d AS department, t.id::INTEGER AS doc_type_id, t.name AS doc_type_name, 'https://congbo.example/' || d || '/Pages/vanban.aspx?idLoaiVanBan=' || t.id || '&dvid=213&Page=1' AS url FROM unnest(["
       + ", ".join(f"'{x}'" for x in dims.DEPARTMENTS) + "]) AS x(d), (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in dims.DOC_TYPES.items()) + ") AS t(id, name)")
def department_jobs(spark: SparkSession, d: str) -> DataFrame:
    return discover.department_jobs(spark, BASE)


@query("""
SELECT item_id, scope, doc_type, status, CASE WHEN trim(coalesce(detail_json, '')) = '' THEN 'none' WHEN json_valid(detail_json) THEN 'object' ELSE 'text' END AS detail,
       CASE WHEN json_valid(detail_json) AND trim(coalesce(detail_json, '')) <> '' THEN 'VBPL-' || item_id END AS record_id, count(*) AS n FROM crawl_state GROUP BY ALL
""")
def full_state_export(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state")
    progress = s.groupBy("doc_type").agg(F.count("*").alias("documents"))
    _, documents = sinks.full_state(s, progress, F.current_timestamp(), "crawl_state")
    v = F.parse_json("json")
    kind = F.schema_of_variant(F.variant_get(v, "$.detail", "variant"))
    get = lambda p, t: F.variant_get(v, p, t)
    detail = F.when(kind.isNull() | (kind == "VOID"), "none").when(kind.startswith("OBJECT"), "object").otherwise("text")
    out = documents.select(get("$.item_id", "bigint").alias("item_id"), get("$.scope", "string").alias("scope"), get("$.doc_type", "string").alias("doc_type"), get("$.status", "string").alias("status"), detail.alias("detail"), get("$.record.id", "string").alias("record_id"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("SELECT stage, count(*) AS attempts, count(url) AS saved, 'max_documents' AS eta_scope, count(url) / ((epoch_us(max(try_cast(when_utc AS TIMESTAMPTZ))) - epoch_us(TIMESTAMPTZ '2025-01-01 00:00:00+00')) / 1e6) AS saved_rate FROM crawl_errors GROUP BY stage")
def saved_rates(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "crawl_errors").withColumn("at", F.col("when_utc").try_cast("timestamp"))
    return reports.progress(e, F.lit("2025-01-01 00:00:00").cast("timestamp"), 0, F.col("url").isNotNull(), 1_000_000).select("stage", "attempts", "saved", "eta_scope", "saved_rate")


@query("""
WITH b AS (SELECT doc_id // 500 AS batch, count(*) FILTER (n_chars > 1000) AS done, count(*) FILTER (NOT coalesce(n_chars > 1000, false)) AS failed FROM documents GROUP BY 1)
SELECT batch, done, failed, sum(done) OVER (ORDER BY batch)::BIGINT AS done_so_far, sum(failed) OVER (ORDER BY batch)::BIGINT AS failed_so_far FROM b
""")
def batch_counters(spark: SparkSession, d: str) -> DataFrame:
    return reports.batch_counts(read_table(spark, d, "documents"), F.expr("doc_id div 500"), F.coalesce(F.col("n_chars") > 1000, F.lit(False)))


def _sitemaps(spark: SparkSession, d: str) -> DataFrame:
    """(sitemap_index, xml): sitemaps of twenty documents, in order of the key."""
    t = read_table(spark, d, "tvpl_documents").where("url is not null").select((F.expr("row_id div 20") + 1).cast("int").alias("sitemap_index"), "row_id", "url")
    locs = F.transform(F.array_sort(F.collect_list(F.struct("row_id", "url"))), lambda x: F.concat(F.lit("<url><loc>"), _escape(x["url"]), F.lit("</loc></url>")))
    return t.groupBy("sitemap_index").agg(F.concat(F.lit("<urlset>"), F.array_join(locs, ""), F.lit("</urlset>")).alias("xml"))


@query("""
WITH s AS (SELECT (row_id // 20 + 1)::INTEGER AS sitemap_index, (row_number() OVER (PARTITION BY row_id // 20 ORDER BY row_id) - 1)::INTEGER AS document_index, url FROM tvpl_documents WHERE url IS NOT NULL)
SELECT * FROM s WHERE sitemap_index >= 2 AND document_index >= CASE WHEN sitemap_index = 2 THEN 7 ELSE 0 END
""")
def sitemap_range(spark: SparkSession, d: str) -> DataFrame:
    done = spark.createDataFrame([(2, 7)], "sitemap_index int, next_url_index int")
    return pipelines.sitemap_urls(_sitemaps(spark, d), pipelines.Options(base=BASE, sitemap_start=2), done)


@query("SELECT DISTINCT (row_id // 20 + 1)::INTEGER AS n, 'https://congbo.example/resitemap' || (row_id // 20 + 1) || '.xml' AS url FROM tvpl_documents WHERE url IS NOT NULL")
def sitemap_links(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("sitemap_index").cast("string")
    html = F.concat(F.lit('<a href="/resitemap'), i, F.lit('.xml">a</a><a href="https://congbo.example/resitemap'), i, F.lit('.XML?x=1">b</a><a href="resitemap'), i, F.lit('.xml">c</a><a href="/x.html">d</a>'))
    p = _sitemaps(spark, d).select(F.col("sitemap_index").alias("n"), page(html, "anchors")["anchors"].alias("a"))
    return p.select("n", F.explode(discover.sitemap_links(F.col("a"), BASE)).alias("url")).where(~F.col("url").contains("?"))


@query(rf"""
SELECT row_id::INTEGER AS document_index, url, {_HEADING.replace("metadata['so_hieu']", "title")} AS title, {_HEADING.replace("metadata['so_hieu']", "content_text")} AS content_text,
       {_CLEAN.replace('{v}', 'attributes.so_hieu')} AS so_hieu, {_CLEAN.replace('{v}', 'attributes.tinh_trang')} AS tinh_trang FROM tvpl_documents
""")
def sitemap_documents(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: _escape(F.coalesce(c, F.lit("")))
    a = F.concat(F.lit("Số hiệu: "), s(F.col("attributes.so_hieu")), F.lit("<br>Tình trạng: "), s(F.col("attributes.tinh_trang")))
    html = F.concat(F.lit("<title>"), s(F.col("title")), F.lit('</title><div id="divThuocTinh">'), a, F.lit('</div><div id="divNoiDung">'), s(F.col("content_text")), F.lit("</div>"))
    t = read_table(spark, d, "tvpl_documents")
    # SQL's type while every key fits it; beyond, where SQL fails, the keys' own
    wide = t.agg(F.bool_or(F.col("row_id").isNotNull() & F.col("row_id").try_cast("int").isNull())).first()[0]
    t = t.select(F.col("row_id").cast("bigint" if wide else "int").alias("document_index"), "url", html.alias("html"))
    return pipelines.sitemap_documents(t, F.lit("now")).select("document_index", "url", "title", "content_text", "attributes.so_hieu", "attributes.tinh_trang")


@query("""
WITH w AS (SELECT DISTINCT item_id, scope FROM crawl_state WHERE status = 'discovered' AND scope IS NOT NULL), d AS (SELECT item_id, scope, any_value(error_message) IS NOT NULL AS bad FROM crawl_state WHERE status = 'failed' GROUP BY ALL)
SELECT w.item_id, w.scope, CASE WHEN d.item_id IS NOT NULL THEN 'failed' ELSE 'detail_done' END AS status, CASE WHEN d.item_id IS NULL THEN '7/' || w.item_id END AS so_hieu,
       CASE WHEN d.item_id IS NULL THEN 'https://congbo.example/' || w.scope || '/Pages/vbpq-toanvan.aspx?ItemID=' || w.item_id END AS url FROM w LEFT JOIN d ON w.item_id = d.item_id AND w.scope = d.scope
""")
def detail_phase(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "crawl_state").where("scope is not null")
    wanted = s.where("status = 'discovered'").select("item_id", "scope").distinct().withColumn("doc_type", F.lit("vbpq"))
    failed = s.where("status = 'failed'").select("item_id", "scope").distinct().withColumn("bad", F.lit(True))
    keys = wanted.join(failed, ["item_id", "scope"], "left")
    details = keys.select("item_id", "scope", F.when(F.col("bad"), F.lit("<p>Không tìm thấy văn bản</p>")).otherwise(F.lit('<div id="toanvan">nội dung</div>')).alias("page"))
    row = F.concat(F.lit('<table><tr><td class="label">Số hiệu</td><td>7/'), F.col("item_id").cast("string"), F.lit("</td></tr></table>"))
    attributes = keys.select("item_id", "scope", row.alias("page"))
    done = pipelines.detailed(wanted, details, attributes, pipelines.Options(base=BASE))
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    state = wanted.select("item_id", "scope", "doc_type", F.lit("discovered").alias("status"), *(F.lit(None).cast("string").alias(c) for c in ("detail_json", "error_message")), now.alias("updated_at"))
    after = pipelines.apply_details(state, done, now)
    return after.select("item_id", "scope", "status", F.get_json_object("detail_json", "$.metadata.so_hieu").alias("so_hieu"), F.get_json_object("detail_json", "$.metadata.source_url").alias("url"))


@query("""
SELECT page_id, starts_with(url, regexp_extract(url, '^([A-Za-z]+://[^/]+/[^/]+)', 1)) AS own, contains(lower(url), 'vbpq-toanvan.aspx') AS priority, contains(lower(url), 'vbpq-toanvan.aspx') AND url IS NOT NULL AS leaf FROM ministry_pages WHERE url IS NOT NULL
""")
def site_links(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return read_table(spark, d, "ministry_pages").where("url is not null").select("page_id", urls.same_site(u, F.regexp_extract(u, r"^([A-Za-z]+://[^/]+/[^/]+)", 1)).alias("own"), urls.is_priority(u).alias("priority"), urls.is_priority(u).alias("leaf"))


# --- graph, sources, streams --------------------------------------------------------------------


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey % 997 AS src, l_partkey % 997 AS dst FROM lineitem),
r(node, depth) AS (SELECT 0::BIGINT, 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON node = src WHERE depth < 4)
SELECT node, min(depth) AS depth FROM r GROUP BY node
""")
def bfs_reachable(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "lineitem").select((F.col("l_orderkey") % 997).alias("src"), (F.col("l_partkey") % 997).alias("dst"))
    return graph.reachable(e, spark.range(1).select(F.col("id").alias("node")), 4)


@query("SELECT DISTINCT ministry FROM ministry_pages WHERE trim(coalesce(ministry, '')) <> ''")
def jsonl_tolerant_scan(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "ministry_pages")
    path = stage_path(spark, "jsonl")
    good = p.select(F.to_json(F.struct("ministry", "url", "title", "text")).alias("value"))
    broken = p.select(F.concat(F.lit('{"ministry": "'), F.coalesce("ministry", F.lit("")), F.lit("x")).alias("value"))
    good.unionByName(broken).unionByName(p.select(F.lit("").alias("value"))).write.text(path)
    return readers.known_keys(spark, path, readers.MINISTRY_SCHEMA, "ministry")


@query("SELECT CASE WHEN regexp_matches(sitemap_url, 'resitemap[0-9]+\\.xml') THEN 'resitemap_' || lpad(regexp_extract(sitemap_url, 'resitemap([0-9]+)\\.xml', 1), 4, '0') ELSE printf('sitemap_%04d', coalesce(sitemap_index, 0)) END AS shard, count(*) AS n FROM crawl_errors GROUP BY 1")
def sharded_export(spark: SparkSession, d: str) -> DataFrame:
    path = stage_path(spark, "shards")
    sinks.sitemap_shards(read_table(spark, d, "crawl_errors").withColumn("sitemap_index", F.coalesce("sitemap_index", F.lit(0))), path)
    return spark.read.json(path).groupBy("shard").agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT url) AS urls FROM tvpl_documents WHERE url IS NOT NULL")
def idempotent_append(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "tvpl_documents").where("url is not null").select("url", "title", "row_id")
    path = stage_path(spark, "append")
    first = sinks.append_new(rows, None, "url", ["row_id"], path)
    return sinks.append_new(rows, first, "url", ["row_id"], path).agg(F.count("url").alias("urls"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def resume_stream(spark: SparkSession, d: str) -> DataFrame:
    e, base = read_table(spark, d, "events"), stage_path(spark, "stream")
    schema = "event_id bigint, event_type string"
    for part in (0, 1):
        e.where(F.col("event_id") % 2 == part).select("event_id", "event_type").write.mode("append").json(f"{base}/in")
        out = resume.resume_files(spark, f"{base}/in", schema, f"{base}/out", f"{base}/checkpoint", keys=["event_id"])
    return out.groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"SELECT status, doc_type, count(*) AS n, count(detail_json) AS details FROM ({_LATEST}) GROUP BY ALL")
def merge_state_stream(spark: SparkSession, d: str) -> DataFrame:
    s, base = read_table(spark, d, "crawl_state"), stage_path(spark, "merge")
    schema = "item_id bigint, scope string, doc_type string, status string, detail_json string, error_message string, discovered_at timestamp, updated_at timestamp"
    order = ["updated_at", "discovered_at", *(F.coalesce(c, F.lit("")) for c in ("status", "detail_json", "error_message", "doc_type"))]
    for part in (0, 1):
        s.where(F.pmod(F.xxhash64("item_id", "scope", "status"), F.lit(2)) == part).write.mode("append").parquet(f"{base}/in")
        out = resume.merge_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/checkpoint", ["item_id", "scope"], order)
    return out.groupBy("status", "doc_type").agg(F.count("*").alias("n"), F.count("detail_json").alias("details"))
