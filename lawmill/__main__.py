"""Command line: python -m lawmill COMMAND ..., over Parquet tables of state, pages and errors."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lawmill.operators import reports
from lawmill.plans import pipelines
from lawmill.session import build_session, stage
from lawmill.sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lawmill", description=__doc__)
    p.add_argument("--base", default=pipelines.Options.base, help="address of the site")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *paths: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for x in paths:
            c.add_argument(x)
        return c

    def wire(c: argparse.ArgumentParser) -> None:
        d = pipelines.Options()
        c.add_argument("--max-documents", type=int)
        c.add_argument("--timeout", type=float, default=d.timeout)
        c.add_argument("--retries", type=int, default=d.retries)
        c.add_argument("--sleep", type=float, default=d.sleep, help="seconds between two requests of a task")
        c.add_argument("--transport", choices=("auto", "urllib", "requests", "cloudscraper"), default=d.transport)
        c.add_argument("--concurrency", "--workers", type=int, default=d.concurrency, help="tasks that fetch at once")
        c.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
        c.add_argument("--verbose", action="store_true", help="log the counts of each phase")

    command("stats", "counts and shares of the state table", "state").add_argument("--doc-type")
    c = command("discover", "search pages into the state table", "state", "pages", "out")
    c.add_argument("--doc-type", default="vbpq")
    c = command("detail", "pending documents from detail and attribute pages", "state", "details", "attributes", "out")
    c.add_argument("--doc-type")
    c.add_argument("--no-attachments", action="store_true", help="leave the attachment list of records empty")
    c = command("export", "detail records as JSON arrays", "state", "out")
    c.add_argument("--doc-type", default="vbpq")
    c = command("sitemap", "document URLs that sitemaps list", "sitemaps", "out")
    c.add_argument("--start", type=int, default=1)
    c.add_argument("--end", type=int)
    c.add_argument("--done", help="table of (sitemap_index, next_url_index) to resume from")
    c = command("crawl", "the phases of a crawl over the wire, from a state table", "state", "out")
    c.add_argument("--phase", choices=("all", *pipelines.PHASES), default="all")
    c.add_argument("--doc-type", choices=tuple(pipelines.SEARCH))
    c.add_argument("--no-attachments", action="store_true")
    c.add_argument("--stats", action="store_true", help="counts and shares at the end")
    wire(c)
    c = command("sitemap-crawl", "documents of a site's sitemaps over the wire", "out")
    c.add_argument("--sitemap-index-url", required=True)
    c.add_argument("--start-sitemap", type=int, default=1)
    c.add_argument("--end-sitemap", type=int)
    c.add_argument("--fallback-sitemap-count", type=int)
    c.add_argument("--include-html", action=argparse.BooleanOptionalAction, default=False)
    c.add_argument("--retry-errors-file", help="replay the document failures of an error log instead")
    c.add_argument("--retry-max-urls", type=int)
    wire(c)
    c = command("retry", "the queue of failed documents", "errors", "out")
    c.add_argument("--stage", default="document_fetch")
    c.add_argument("--limit", type=int)
    return p


def options(a: argparse.Namespace) -> pipelines.Options:
    """The options of the commands that fetch."""
    o = pipelines.Options(base=a.base, max_documents=a.max_documents, timeout=a.timeout, retries=a.retries, sleep=a.sleep, transport=a.transport, concurrency=a.concurrency, resume=a.resume)
    if a.command == "crawl":
        return replace(o, phase=a.phase, doc_type=a.doc_type, attachments=not a.no_attachments)
    return replace(o, sitemap_start=a.start_sitemap, sitemap_end=a.end_sitemap, fallback_sitemaps=a.fallback_sitemap_count, include_html=a.include_html, retry_limit=a.retry_max_urls)


def fetch_commands(spark: SparkSession, a: argparse.Namespace, now: Column, fetch=None) -> None:
    """The commands that go over the wire; ``fetch`` stands in for it in tests."""
    o = options(a)
    if a.command == "crawl":
        before = spark.read.parquet(a.state)
        state = pipelines.crawl(before, o, a.out, now, fetch)
        state, seen = reports.observed(state, "crawl", failed=F.col("status") == "failed", done=F.col("status").endswith("_done"))
        state.write.mode("overwrite").parquet(f"{a.out}/table")
        if a.verbose or a.stats:
            print(seen.get)
        if a.stats:
            pipelines.report(spark.read.parquet(f"{a.out}/table")).orderBy("doc_type", F.desc("n")).show(100, truncate=False)
    elif a.retry_errors_file:
        errors = readers.jsonl(spark, a.retry_errors_file, readers.ERROR_SCHEMA)
        pipelines.retry_crawl(errors, o, a.out, now, fetch).write.mode("overwrite").json(f"{a.out}/errors-left")
    else:
        left = f"{a.out}/left-at"
        done = readers.table_or_none(spark, left) if o.resume else None
        cached = readers.table_or_none(spark, f"{a.out}/sitemaps", "json")
        sitemaps = pipelines.sitemap_index(spark, o, a.sitemap_index_url, cached, fetch, **o.fetching())
        if cached is None:
            sinks.sitemap_cache(sitemaps, f"{a.out}/sitemaps")
        reached = pipelines.sitemap_crawl(sitemaps, o, a.out, now, done, fetch)
        if done is not None:
            reached = reached.unionByName(done).groupBy("sitemap_index").agg(F.max("next_url_index").alias("next_url_index"))
        stage(reached, "left-at").write.mode("overwrite").parquet(left)


def main(argv: list[str] | None = None, fetch=None) -> None:
    a = parser().parse_args(argv)
    spark = build_session()
    read = spark.read.parquet
    now = F.current_timestamp()
    if a.command in ("crawl", "sitemap-crawl"):
        fetch_commands(spark, a, now, fetch)
    elif a.command == "stats":
        state = read(a.state)
        pipelines.report(state.where(F.col("doc_type") == a.doc_type) if a.doc_type else state).orderBy("doc_type", F.desc("n")).show(100, truncate=False)
    elif a.command == "discover":
        pipelines.discovered(read(a.state), read(a.pages), a.doc_type, now).write.mode("overwrite").parquet(a.out)
    elif a.command == "detail":
        state, o = read(a.state), pipelines.Options(base=a.base)
        wanted = pipelines.pending(state, doc_type=a.doc_type)
        pipelines.detailed(wanted, read(a.details), read(a.attributes), o).write.mode("overwrite").parquet(f"{a.out}/results")
        results = read(f"{a.out}/results")
        if a.no_attachments:
            results = results.withColumn("attachment_urls", F.slice("attachment_urls", 1, 0))
        pipelines.apply_details(state, results, now).write.mode("overwrite").parquet(f"{a.out}/state")
        sinks.by_doc_type(pipelines.records(results, now).withColumn("doc_type", F.col("metadata")["doc_type"]), f"{a.out}/records", "overwrite")
    elif a.command == "export":
        sinks.json_arrays(sinks.export_records(read(a.state), a.doc_type), "detail_json", a.out)
    elif a.command == "sitemap":
        o = pipelines.Options(base=a.base, sitemap_start=a.start, sitemap_end=a.end)
        pipelines.sitemap_urls(read(a.sitemaps), o, read(a.done) if a.done else None).write.mode("overwrite").parquet(a.out)
    elif a.command == "retry":
        from lawmill.operators.sequences import retry_queue

        retry_queue(read(a.errors), a.stage, limit=a.limit).write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()
