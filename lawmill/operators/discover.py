"""Discovery: sitemaps, search results, pagers, listings, jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawmill import dims
from lawmill.functions import urls
from lawmill.functions.text import looks_like_html, strip_bom
from lawmill.operators.dedupe import first_wins


def sitemap_locs(xml: Column) -> Column:
    """All locations of a sitemap, whatever the namespace; none if the answer is a web page."""
    bare = strip_bom(xml)
    locs = F.regexp_extract_all(bare, F.lit(r"(?s)<(?:[\w.-]+:)?loc(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:[\w.-]+:)?loc>"), F.lit(1))
    clean = F.transform(locs, lambda x: F.replace(F.trim(x), F.lit("&amp;"), F.lit("&")))
    return F.when(looks_like_html(bare), F.array().cast("array<string>")).otherwise(F.filter(clean, lambda x: x != ""))


def sitemap_links(anchors: Column, base: str) -> Column:
    """The distinct links to sitemaps among a page's links, in order."""
    return F.array_distinct(F.filter(F.transform(anchors, lambda a: urls.absolutise(a["href"], base)), urls.is_sitemap))


def fallback_sitemaps(spark: SparkSession, base: str, n: int) -> DataFrame:
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias("sitemap_index"), F.concat(F.lit(base.rstrip("/") + "/resitemap"), F.col("id").cast("string"), F.lit(".xml")).alias("url"))


def first_nonempty(candidates: list[DataFrame]) -> DataFrame:
    """The rows of the first candidate list that has any; later lists aren't evaluated."""
    for c in candidates[:-1]:
        if not c.isEmpty():
            return c
    return candidates[-1]


def search_hits(pages: DataFrame) -> DataFrame:
    """(page_no, item_id, scope, title) of every document on search pages (page_no, anchors), once a page.

    Links to other pages, and those without a whole item id, are passed over; the scope is the first part of
    a path of two parts or more, else TW.
    """
    a = pages.select("page_no", F.posexplode("anchors").alias("pos", "a")).select("page_no", "pos", F.col("a.href").alias("href"), F.col("a.text").alias("title"))
    a = a.where(urls.is_search_hit(F.col("href"))).withColumn("item_id", urls.query_param(F.col("href"), "ItemID").try_cast("bigint")).where("item_id is not null")
    parts = F.size(F.filter(F.split(urls.path(F.col("href")), "/"), lambda p: p != ""))
    a = a.withColumn("scope", F.when(parts >= 2, urls.segment(F.col("href"), 1)).otherwise("TW"))
    return first_wins(a, ["page_no", "item_id"], ["pos"]).select("page_no", "item_id", "scope", "title")


def total_pages(pager: Column) -> Column:
    """The largest page number among a pager's links; 1 without a pager."""
    numbers = F.transform(pager, lambda h: F.regexp_extract(h, r"Nexpage\w*\('[^']*',\s*'(\d+)'\)", 1).try_cast("int"))
    return F.greatest(F.lit(1), F.coalesce(F.array_max(numbers), F.lit(1)))


def listing_links(pages: DataFrame, base: str) -> DataFrame:
    """(..., pos, url, title) of every document in the list of listing pages (..., listing), in order; links elsewhere on the page don't count."""
    keys = [c for c in pages.columns if c != "listing"]
    a = pages.select(*keys, F.posexplode("listing").alias("pos", "a")).where(F.col("a.href") != "")
    return a.select(*keys, "pos", urls.absolutise(F.col("a.href"), base).alias("url"), F.col("a.text").alias("title")).where(urls.is_detail(F.col("url")))


def result_count(listing: Column, base: str) -> Column:
    """How many documents a listing page's list links to; a page with none has no results, whatever its menus hold."""
    return F.size(F.filter(listing, lambda a: (a["href"] != "") & urls.is_detail(urls.absolutise(a["href"], base))))


def listing_items(pages: DataFrame, base: str) -> DataFrame:
    """(..., item, url, title): of every item of listing pages (..., listing) the first link, the host put before it unchecked."""
    keys = [c for c in pages.columns if c != "listing"]
    a = pages.select(*keys, F.posexplode("listing").alias("pos", "a"))
    a = a.select(*keys, "pos", F.col("a.item").alias("item"), urls.prefix_host(F.col("a.href"), base).alias("url"), F.col("a.text").alias("title"))
    return first_wins(a, [*keys, "item"], ["pos"]).drop("pos")


def department_jobs(spark: SparkSession, base: str, page: int = 1) -> DataFrame:
    """(department, doc_type_id, doc_type_name, url) of every department and document type: a product of two fixed lists."""
    types = F.explode(F.array(*(F.struct(F.lit(i).alias("doc_type_id"), F.lit(n).alias("doc_type_name")) for i, n in dims.DOC_TYPES.items())))
    d = dims.departments(spark).select("department", types.alias("t")).select("department", "t.*")
    return d.withColumn("url", urls.listing_url(base, F.col("department"), F.col("doc_type_id"), F.lit(dims.UNIT), F.lit(page)))


def jobs(pages: DataFrame) -> DataFrame:
    """(slug, doc_type_id, unit_id) of every job that section pages (slug, anchors) link to, in numeric order."""
    a = pages.select("slug", F.explode("anchors").alias("a")).where(urls.is_job_link(F.col("a.href")))
    j = a.select("slug", urls.query_param(F.col("a.href"), "idLoaiVanBan").alias("doc_type_id"), urls.query_param(F.col("a.href"), "dvid").alias("unit_id")).distinct()
    return j.orderBy(F.col("doc_type_id").try_cast("int"), F.col("unit_id").try_cast("int"), "slug")


def attachments(anchors: Column, base: str) -> Column:
    """The attachments among a page's links: file name, absolute URL and type, each raw link once."""
    links = F.array_distinct(F.transform(F.filter(anchors, lambda a: urls.is_attachment(a["href"])), lambda a: a["href"]))
    return F.transform(links, lambda h: F.struct(urls.basename(h).alias("filename"), urls.absolutise(h, base).alias("url"), urls.attachment_type(h).alias("type")))
