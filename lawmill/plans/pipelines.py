"""The three crawls as composed plans over a state table and a page source, and their options."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawmill.dims import CENTRAL_SCOPE, COLLECTIONS, FALLBACK_SCOPE
from lawmill.functions import urls
from lawmill.functions.html import page
from lawmill.functions.text import labelled_fields, looks_like_challenge, looks_missing
from lawmill.operators import discover, metadata, reports
from lawmill.operators.dedupe import first_wins, insert_or_ignore, not_in, update
from lawmill.operators.sequences import retry_queue, until_first_empty
from lawmill.session import stage
from lawmill.sources import http, sinks


PHASES = ("discovery", "detail", "attachments", "export")
#: The search form of each type, and the rows of a page of hits.
SEARCH = {
    "vbpq": ("/VBQPPL_UserControls/Publishing_22/TimKiem/p_KetQuaTimKiemVanBan.aspx", "divResultSearch"),
    "vbhn": ("/VBQPPL_UserControls/Publishing_22/Timkiem/p_KetQuaTimKiemHopNhat.aspx", "divResultSearchHN"),
}
ROWS_PER_PAGE = 50


@dataclass(frozen=True)
class Options:
    """What the command lines of a crawl set."""

    base: str = "https://example.org"
    phase: str = "all"  # one of PHASES, or all
    doc_type: str | None = None
    attachments: bool = True
    max_documents: int | None = None
    sitemap_start: int = 1
    sitemap_end: int | None = None
    fallback_sitemaps: int | None = None
    resume: bool = True
    retry_stage: str = "document_fetch"
    retry_limit: int | None = None
    include_html: bool = False
    transport: str = "auto"
    concurrency: int = 16
    timeout: float = 45.0
    retries: int = 5
    sleep: float = 3.0

    def fetching(self) -> dict:
        """What the fetcher takes of them."""
        return {"partitions": self.concurrency, "timeout": self.timeout, "retries": self.retries, "delay": self.sleep, "session": http.transport(self.transport)}


def search_requests(spark: SparkSession, o: Options, doc_type: str, first: int, last: int) -> DataFrame:
    """(page_no, url, form) of the search pages of a type, to be posted."""
    path, box = SEARCH[doc_type]
    fields = {"SearchIn": "", "DivID": box, "IsVietNamese": "True", "type": "0", "s": "0", "DonVi": "", "RowPerPage": str(ROWS_PER_PAGE)}
    form = urls.form_body({**{k: F.lit(v) for k, v in fields.items()}, "page": F.col("page_no")})
    return spark.range(first, last + 1).select(F.col("id").alias("page_no"), F.lit(o.base.rstrip("/") + path).alias("url"), form.alias("form"))


def limited(wanted: DataFrame, o: Options) -> DataFrame:
    """At most as many documents as a run is to take, in order of item_id."""
    return wanted if o.max_documents is None else wanted.orderBy("item_id", "scope").limit(o.max_documents)


def discovery(state: DataFrame, o: Options, doc_type: str, now, fetch=None, last_page: int = 0, **fetching) -> tuple[DataFrame, int]:
    """Phase 1 over the wire: (state, pages in all) after the search pages behind ``last_page``. Pages that fail are passed over."""
    spark = state.sparkSession
    first = stage(http.pages(search_requests(spark, o, doc_type, 1, 1), fetch, **fetching), "search-first")
    total = first.select(discover.total_pages(page(F.col("page"), "pager")["pager"])).first()[0]  # one number
    rest = search_requests(spark, o, doc_type, max(2, last_page + 1), total) if total > 1 else None
    found = first if rest is None else first.unionByName(http.pages(rest, fetch, **fetching))
    return discovered(state, found.select("page_no", F.col("page").alias("html")), doc_type, now), total


def detail_pages(wanted: DataFrame, o: Options, purpose: str, fetch=None, **fetching) -> DataFrame:
    """(item_id, scope, page) of the pages of documents: of the central scope both its own page and that of the scope that stands in for it."""
    scopes = F.when(F.col("scope") == CENTRAL_SCOPE, F.array("scope", F.lit(FALLBACK_SCOPE))).otherwise(F.array("scope"))
    w = wanted.withColumn("scope", F.explode(scopes)).distinct()
    w = w.withColumn("url", urls.document_url(o.base, F.col("doc_type"), F.col("scope"), F.col("item_id"), purpose))
    return http.pages(w, fetch, missing=True, **fetching).where("page is not null").select("item_id", "scope", "page")


def attachment_files(state: DataFrame) -> DataFrame:
    """(item_id, scope, filename, url) of the attachments of documents whose details are done; consolidated texts have none."""
    urls_ = F.from_json("detail_json", "attachment_urls array<struct<filename: string, url: string>>")["attachment_urls"]
    d = state.where((F.col("status") == "detail_done") & (F.col("doc_type") == "vbpq"))
    return d.select("item_id", "scope", F.explode(urls_).alias("a")).select("item_id", "scope", "a.*")


def attached(state: DataFrame, done: DataFrame, now) -> DataFrame:
    """The state after phase 3: a document is done once all its attachments are; ``done`` is (item_id, scope, filename, ok)."""
    files = attachment_files(state)
    failed = files.join(done.where("ok"), ["item_id", "scope", "filename"], "left_anti").select("item_id", "scope").distinct()
    ready = state.where((F.col("status") == "detail_done") & (F.col("doc_type") == "vbpq")).select("item_id", "scope").join(failed, ["item_id", "scope"], "left_anti")
    return update(state, ready.distinct().select("item_id", "scope", F.lit("attachments_done").alias("status"), now.alias("updated_at")), ["item_id", "scope"], ["status", "updated_at"])


def crawl(state: DataFrame, o: Options, folder: str, now, fetch=None) -> DataFrame:
    """The phases that the options ask for, one type after the other, each from the written state of the one before; the last state."""
    fetching = o.fetching()
    for doc_type in [o.doc_type] if o.doc_type else list(SEARCH):
        if o.phase in ("all", "discovery"):
            state = stage(discovery(state, o, doc_type, now, fetch, **fetching)[0], "crawl-discovered")
        if o.phase in ("all", "detail"):
            wanted = stage(limited(pending(state, doc_type=doc_type), o), "crawl-wanted")
            results = stage(detailed(wanted, detail_pages(wanted, o, "detail", fetch, **fetching), detail_pages(wanted, o, "attributes", fetch, **fetching), o), "crawl-details")
            if not o.attachments:
                results = results.withColumn("attachment_urls", F.slice("attachment_urls", 1, 0))
            sinks.by_doc_type(records(results, now).withColumn("doc_type", F.lit(doc_type)), f"{folder}/records")
            state = stage(apply_details(state, results, now), "crawl-detailed")
        if o.phase in ("all", "attachments") and o.attachments and doc_type == "vbpq":
            files = attachment_files(state)
            got = http.fetch_all(files.select("url"), fetch, **fetching).where("body is not null").select("url", F.col("body").alias("content"))
            written = sinks.write_files(files.join(got, "url").select("item_id", "filename", "content"), f"{folder}/attachments")
            done = files.join(written, ["item_id", "filename"]).select("item_id", "scope", "filename", "ok")
            state = stage(attached(state, stage(done, "crawl-attachments"), now), "crawl-attached")
        if o.phase in ("all", "export"):
            sinks.json_arrays(sinks.export_records(state, doc_type), "detail_json", f"{folder}/{doc_type}")
    if o.phase in ("all", "export"):
        by_type = state.groupBy("doc_type").agg(F.count("*").alias("documents"), F.count_if(F.col("status") != "discovered").alias("visited"))
        header, documents = sinks.full_state(state, by_type, now, o.base)
        header.write.mode("overwrite").text(f"{folder}/state/header")
        documents.select("json").write.mode("overwrite").text(f"{folder}/state/documents")
    return state


def discovered(state: DataFrame, search_pages: DataFrame, doc_type: str, now) -> DataFrame:
    """Phase 1: hits on search pages (page_no, html) join the state as discovered; known documents stay as they are."""
    hits = discover.search_hits(search_pages.select("page_no", page(F.col("html"))["anchors"].alias("anchors")))
    rows = hits.select(
        "item_id", "scope", F.lit(doc_type).alias("doc_type"), F.lit("discovered").alias("status"), F.lit(None).cast("string").alias("detail_json"),
        F.lit(None).cast("string").alias("error_message"), now.alias("discovered_at"), now.alias("updated_at"), "page_no",
    )
    return insert_or_ignore(state, rows, ["item_id", "scope"], ["page_no"]).select(*state.columns)


def pending(state: DataFrame, status: str = "discovered", doc_type: str | None = None) -> DataFrame:
    """The documents that wait for a phase, in order of item_id."""
    d = state.where(F.col("status") == status)
    if doc_type:
        d = d.where(F.col("doc_type") == doc_type)
    return d.select("item_id", "scope", "doc_type").orderBy("item_id", "scope")


def detailed(wanted: DataFrame, details: DataFrame, attributes: DataFrame, o: Options) -> DataFrame:
    """Phase 2: each wanted document's record from its page, with the attribute page's fields under its own.

    ``details`` and ``attributes`` are (item_id, scope, page) with the page's markup. A page is parsed
    once. A document without a page, or whose page says so, is failed with an error.
    """
    d = metadata.with_fallback(wanted, details, CENTRAL_SCOPE, FALLBACK_SCOPE)
    scope = F.when(F.col("scope") == CENTRAL_SCOPE, FALLBACK_SCOPE).otherwise(F.col("scope"))
    a = attributes.select(F.col("item_id"), F.col("scope").alias("_scope"), page(F.col("page"))["metadata"].alias("attrs"))
    d = d.withColumn("_scope", scope).join(a, ["item_id", "_scope"], "left").drop("_scope")
    ok = F.col("page").isNotNull() & ~looks_missing(F.col("page")) & ~looks_like_challenge(F.col("page"))
    d = d.withColumn("ok", F.coalesce(ok, F.lit(False))).withColumn("p", page(F.when(F.col("ok"), F.col("page"))))
    defaults = {
        "scope": F.col("scope"),
        "doc_type": F.when(F.col("doc_type") == "vbhn", COLLECTIONS["vbhn"]).otherwise(COLLECTIONS["vbpq"]),
        "source_url": urls.document_url(o.base, F.col("doc_type"), F.coalesce("scope_used", "scope"), F.col("item_id")),
    }
    meta = metadata.with_defaults(metadata.merge(F.col("attrs"), F.col("p.metadata")), defaults)
    return d.select(
        "item_id", "scope", "doc_type", "ok", F.when(F.col("ok"), F.col("p.clean_text")).alias("text"), F.when(F.col("ok"), meta).alias("metadata"),
        F.when(F.col("ok"), discover.attachments(F.col("p.anchors"), o.base)).alias("attachment_urls"), F.when(~F.col("ok"), "no page").alias("error"),
    )


def apply_details(state: DataFrame, results: DataFrame, now) -> DataFrame:
    """The state after phase 2: detail_done with the record as JSON, or failed with the error."""
    changes = results.select(
        "item_id", "scope", F.when(F.col("ok"), "detail_done").otherwise("failed").alias("status"),
        F.when(F.col("ok"), F.to_json(F.struct("text", "metadata", "attachment_urls"))).alias("detail_json"), F.col("error").alias("error_message"), now.alias("updated_at"),
    )
    return update(state, changes, ["item_id", "scope"], ["status", "detail_json", "error_message", "updated_at"])


def records(results: DataFrame, now) -> DataFrame:
    """Output records of the documents that succeeded."""
    return results.where("ok").select(
        F.concat(F.lit("VBPL-"), F.col("item_id").cast("string")).alias("id"), "text", "metadata", F.col("attachment_urls").alias("attachments"),
        F.col("metadata")["ngay_ban_hanh"].alias("created_timestamp"), now.alias("downloaded_timestamp"), F.col("metadata")["source_url"].alias("url"),
    )


def sitemap_urls(sitemaps: DataFrame, o: Options, done: DataFrame | None = None) -> DataFrame:
    """(sitemap_index, document_index, url) of the documents that sitemaps (sitemap_index, xml) list, within the range
    and beyond what is done (sitemap_index, next_url_index)."""
    s = sitemaps.where(F.col("sitemap_index") >= o.sitemap_start)
    if o.sitemap_end is not None:
        s = s.where(F.col("sitemap_index") <= o.sitemap_end)
    d = s.select("sitemap_index", F.posexplode(discover.sitemap_locs(F.col("xml"))).alias("document_index", "url"))
    if done is not None and o.resume:
        d = d.join(done, "sitemap_index", "left").where(F.col("document_index") >= F.coalesce("next_url_index", F.lit(0))).drop("next_url_index")
    return d


def sitemap_index(spark: SparkSession, o: Options, index_url: str, cached: DataFrame | None = None, fetch=None, **fetching) -> DataFrame:
    """(sitemap_index, url) of the sitemaps: from the index page's links, else kept from an earlier run, else by number."""
    wanted = spark.range(1).select(F.lit(index_url).alias("url"))
    found = http.pages(wanted, fetch, **fetching).select(F.posexplode(discover.sitemap_links(page(F.col("page"), "anchors")["anchors"], o.base)).alias("i", "url"))
    candidates = [stage(found.select((F.col("i") + 1).cast("int").alias("sitemap_index"), "url"), "sitemap-index")]
    if cached is not None:
        candidates.append(cached.select("sitemap_index", "url"))
    if o.fallback_sitemaps:
        candidates.append(discover.fallback_sitemaps(spark, o.base, o.fallback_sitemaps))
    return discover.first_nonempty(candidates)


def sitemap_crawl(sitemaps: DataFrame, o: Options, folder: str, now, done: DataFrame | None = None, fetch=None) -> DataFrame:
    """Documents of sitemaps (sitemap_index, url) over the wire, in a folder a sitemap; failures are appended to the error log,
    and where each sitemap was left is returned (sitemap_index, next_url_index), to resume from."""
    fetching = o.fetching()
    maps = http.pages(sitemaps.select("sitemap_index", F.col("url").alias("sitemap_url"), "url"), fetch, **fetching)
    wanted = sitemap_urls(maps.select("sitemap_index", F.col("page").alias("xml")), o, done)
    if o.max_documents is not None:
        wanted = wanted.orderBy("sitemap_index", "document_index").limit(o.max_documents)
    got = stage(http.pages(wanted.join(sitemaps.select("sitemap_index", F.col("url").alias("sitemap_url")), "sitemap_index"), fetch, **fetching), "sitemap-pages")
    good = got.where("page is not null")
    docs = sitemap_documents(good.withColumn("html", F.col("page")), now).join(good.select("url", "sitemap_index", "sitemap_url", *([F.col("page").alias("html")] if o.include_html else [])).dropDuplicates(["url"]), "url")
    sinks.sitemap_shards(docs, f"{folder}/documents", "append")
    bad = got.where("page is null").select("document_index", "url", F.lit(False).alias("ok"), F.col("fetch_error").alias("error"), "sitemap_index", "sitemap_url")
    sinks.append_errors(bad, "document_fetch", now, f"{folder}/errors")
    return wanted.groupBy("sitemap_index").agg((F.max("document_index") + 1).alias("next_url_index"))


def sitemap_documents(pages: DataFrame, now) -> DataFrame:
    """Attribute documents of fetched pages (document_index, url, html): one row a page, parsed once."""
    p = pages.withColumn("p", page(F.col("html")))
    fields = ["so_hieu", "loai_van_ban", "noi_ban_hanh", "nguoi_ky", "ngay_ban_hanh", "ngay_hieu_luc", "ngay_cong_bao", "so_cong_bao", "tinh_trang"]
    # each block's fields are a column of their own: the pick names them many times
    p = p.select("*", *(labelled_fields(F.try_element_at(F.col("p.attribute_blocks"), F.lit(i))).alias(f"_block{i}") for i in range(1, 5)))
    p = p.withColumn("a", metadata.by_priority([F.col(f"_block{i}") for i in range(1, 5)], fields, ("so_hieu", "loai_van_ban")))
    attributes = F.struct(*(F.col(f"a.{f}").alias(f) for f in fields), F.col("p.title").alias("title"))
    return p.select("document_index", "url", now.alias("fetched_at_utc"), F.col("p.title").alias("title"), attributes.alias("attributes"), F.col("p.content").alias("content_text"), F.length("p.content").alias("content_length"))


def listing_crawl(jobs: DataFrame, completed: DataFrame, pages: DataFrame, known_urls: DataFrame, o: Options, last_page: DataFrame | None = None) -> DataFrame:
    """(slug, page_no, url, title) of the new documents of jobs that aren't completed: listing pages (slug, page_no, html)
    up to each job's first page without results, each URL once, none known before.

    ``last_page`` (slug, last_page) resumes a job behind the page it was left at.
    """
    left = not_in(jobs.select("slug").distinct(), completed, ["slug"])
    p = pages.join(left, "slug", "left_semi")
    if last_page is not None and o.resume:
        p = p.join(last_page.select("slug", "last_page"), "slug", "left").where(F.col("page_no") > F.coalesce("last_page", F.lit(0))).drop("last_page")
    p = p.withColumn("listing", page(F.col("html"), "listing")["listing"])
    p = until_first_empty(p.withColumn("n", discover.result_count(F.col("listing"), o.base)), ["slug"], "page_no", "n")
    a = discover.listing_links(p.select("slug", "page_no", "listing"), o.base)
    return first_wins(not_in(a, known_urls, ["url"]), ["url"], ["slug", "page_no", "pos"]).drop("pos")


def listing_stats(jobs: DataFrame, completed: DataFrame, pages: DataFrame, known_urls: DataFrame, o: Options) -> DataFrame:
    """The counters of a listing crawl as one row: slugs and jobs in all and done, pages visited, links found, new and repeated, failures.

    A page is visited up to and with its job's first one without results; a page without markup has failed.
    """
    named = jobs.select("slug", F.concat_ws("|", *jobs.columns).alias("job")).distinct()
    done = completed.select("slug").distinct()
    p = pages.join(not_in(named.select("slug").distinct(), completed, ["slug"]), "slug", "left_semi").withColumn("listing", page(F.col("html"), "listing")["listing"])
    p = p.withColumn("n", F.when(F.col("html").isNotNull(), discover.result_count(F.col("listing"), o.base)))
    stop = p.where("n = 0").groupBy("slug").agg(F.min("page_no").alias("stop"))
    p = p.join(stop, "slug", "left").where(F.col("stop").isNull() | (F.col("page_no") <= F.col("stop")))
    seen = p.agg(F.count("*").alias("pages_visited"), F.coalesce(F.sum("n"), F.lit(0)).alias("candidate_links_found"), F.count_if(F.col("html").isNull()).alias("failures"))
    new = not_in(discover.listing_links(p.where("n > 0").select("slug", "page_no", "listing"), o.base), known_urls, ["url"]).agg(F.countDistinct("url").alias("unique_detail_urls"))
    totals = named.agg(F.countDistinct("slug").alias("slugs_total"), F.count("*").alias("jobs_total"))
    ended = named.join(done, "slug", "left_semi").agg(F.countDistinct("slug").alias("slugs_done"), F.count("*").alias("jobs_done"))
    one = F.lit(1).alias("_k")  # four tables of one row
    out = totals.select("*", one).join(ended.select("*", one), "_k").join(seen.select("*", one), "_k").join(new.select("*", one), "_k").drop("_k")
    return out.withColumn("duplicates_skipped", F.col("candidate_links_found") - F.col("unique_detail_urls"))


def replay(errors: DataFrame, fetch: Callable[[DataFrame], DataFrame], o: Options) -> tuple[DataFrame, DataFrame]:
    """(answers, queue) of failed documents fetched once more."""
    queue = retry_queue(errors, o.retry_stage, limit=o.retry_limit)
    return fetch(queue.select("url")).join(queue.select("url", "sitemap_index", "document_index"), "url"), queue


def retry_crawl(errors: DataFrame, o: Options, folder: str, now, fetch=None) -> DataFrame:
    """Failed documents fetched once more: documents into retry shards, failures into a new error log; the errors that are left."""
    answers, queue = replay(errors, lambda u: http.pages(u, fetch, **o.fetching()), o)
    got = stage(answers, "retry-answers")
    sinks.retry_shards(sitemap_documents(got.where("page is not null").withColumn("html", F.col("page")), now).join(queue.select("url", "sitemap_index"), "url"), f"{folder}/documents")
    bad = got.where("page is null").select("document_index", "url", F.lit(False).alias("ok"), F.col("fetch_error").alias("error"))
    sinks.append_errors(bad, o.retry_stage, now, f"{folder}/errors")
    return not_in(errors, got.where("page is not null"), ["url"])


def report(state: DataFrame) -> DataFrame:
    return reports.status_share(state)
