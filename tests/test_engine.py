import json

from pyspark.sql import functions as F

from lawmill import dims
from lawmill.functions import text, urls
from lawmill.operators import dedupe, discover, graph, metadata, reports, sequences
from lawmill.plans import pipelines, queries
from lawmill.sources import http, readers, sinks
from lawmill.streaming import resume

BASE = "https://a.example"


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_urls(spark):
    f = lambda h: urls.absolutise(F.lit(h), BASE, F.lit("https://a.example/x/y.aspx?q=1"))
    got = one(spark, *(f(h).alias(str(i)) for i, h in enumerate(["/p", "z.html", "http://b/c", "//c/d", "?k=2", "javascript:x()"])))
    assert list(got) == ["https://a.example/p", "https://a.example/x/z.html", "http://b/c", "https://c/d", "https://a.example/x/y.aspx?k=2", "javascript:x()"]
    got = one(spark, urls.query_param(F.lit("a b|?ItemID=7&x="), "ItemID").alias("a"), urls.query_param(F.lit("?x="), "x").alias("b"), urls.is_attachment(F.lit("a.PDF")).alias("c"), urls.is_attachment(F.lit("a.pdf?x")).alias("d"), urls.same_site(F.lit("https://a.example/boyte2"), F.lit("https://a.example/boyte")).alias("e"))
    assert list(got) == ["7", None, True, False, True]


def test_text(spark):
    got = one(spark, text.collapse(F.lit(" a  b　c ")).alias("a"), text.safe_decode(F.lit(b"a\xffb")).alias("b"), text.duration_text(F.lit(3661.0)).alias("c"), text.duration_text(F.lit(None).cast("double")).alias("d"), text.percent(F.lit(1), F.lit(0)).alias("e"), text.percent(F.lit(1), F.lit(3)).alias("f"))
    assert list(got) == ["a b c", "a�b", "01:01:01", "unknown", 0.0, 33.3]
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    got = one(spark, text.retry_after_seconds(F.lit("Wed, 01 Jan 2025 00:00:30 GMT"), now).alias("a"), text.retry_after_seconds(F.lit("-5"), now).alias("b"), text.retry_after_seconds(F.lit("soon"), now).alias("c"), text.backoff_seconds(F.lit(429), F.lit(9)).alias("d"))
    assert list(got) == [30.0, 0.0, None, 120.0]
    x = one(spark, text.labelled_fields(F.lit("SỐ HIỆU: 1 Loại  văn bản : - Số hiệu: 2 Tình trạng:")).alias("x")).x
    assert (x.so_hieu, x.loai_van_ban, x.tinh_trang) == ("2", None, None)


def test_discovery(spark):
    html = '<html><a href="/tw/Pages/vbpq-toanvan.aspx?ItemID=5">A</a><a href="/tw/Pages/vbpq-toanvan.aspx?ItemID=5">B</a><a href="vbpq-toanvan.aspx?ItemID=x">C</a><div class=paging><a href="javascript:Nexpage(\'d\',\'12\');">x</a></div></html>'
    from lawmill.functions.html import page

    p = spark.createDataFrame([(1, html)], "page_no int, html string").select("page_no", page(F.col("html")).alias("p")).select("page_no", "p.*")
    assert [tuple(r) for r in discover.search_hits(p).collect()] == [(1, 5, "tw", "A")]
    assert p.select(discover.total_pages(F.col("pager"))).first()[0] == 12
    got = one(spark, discover.sitemap_locs(F.lit("﻿<u><loc> a </loc><n:loc>b&amp;c</n:loc></u>")).alias("a"), discover.sitemap_locs(F.lit("<!DOCTYPE html><loc>x</loc>")).alias("b"))
    assert got.a == ["a", "b&c"] and got.b == []


def test_merges(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, w int")
    c = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, dedupe.upsert(t, c, ["k"], ["v"]).collect())) == [(1, "a", 5), (2, "c", None), (3, "d", None)]
    assert sorted(map(tuple, dedupe.update(t, c, ["k"], ["v"]).collect())) == [(1, "a", 5), (2, "c", None)]
    rows = spark.createDataFrame([(3, "x", 1), (3, "y", 0), (1, "z", 1), (3, "y", 0)], "k int, v string, w int")
    once = dedupe.insert_or_ignore(t, rows, ["k"], ["w"])
    assert sorted(r.v for r in once.collect()) == ["a", "b", "y"]
    assert dedupe.insert_or_ignore(once, rows, ["k"], ["w"]).count() == 3  # idempotent
    empty = t.limit(0)
    assert dedupe.first_wins(empty, ["k"], ["w"]).count() == 0
    assert dedupe.last_wins(t, ["k"], ["w"]).count() == 2
    null_last = spark.createDataFrame([(1, None, "n"), (1, 3, "x"), (1, 2, "y")], "k int, o int, v string")
    assert dedupe.last_wins(null_last, ["k"], ["o"]).first().v == "x"


def test_rank_is_dense_and_total(spark):
    r = dedupe.global_rank(spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x")), ["x"])
    assert sorted(map(tuple, r.select("x", "rank").collect())) == [(i, i + 1) for i in range(1000)]


def test_sequences(spark):
    a = spark.createDataFrame([(i, i not in (2, 3, 4, 7)) for i in range(10)], "i int, ok boolean").withColumn("g", F.lit(1))
    assert [(r.i, r.streak, r.tripped) for r in sequences.streaks(a, ["g"], ["i"], F.col("ok"), 2).orderBy("i").collect()] == [(2, 1, False), (3, 2, True), (4, 3, False), (7, 1, False)]
    assert sorted(r.i for r in sequences.until_successes(a, ["i"], F.col("ok"), 3).collect()) == [0, 1, 2, 3, 4, 5]
    assert sequences.until_successes(a, ["i"], F.col("ok"), 99).count() == 10


def test_metadata(spark):
    m = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    got = one(spark, metadata.merge(m({"a": "1", "b": "2"}), m({"b": "3"})).alias("x"), metadata.merge(F.lit(None).cast("map<string,string>"), m({"b": "3"})).alias("y"), metadata.longest([F.lit("ab"), F.lit("cd"), F.lit(None).cast("string")]).alias("z"))
    assert got.x == {"a": "1", "b": "3"} and got.y == {"b": "3"} and got.z == "ab"


def test_catalogues_in_both_forms(spark):
    v1 = {"Luat": {"Page_1": {"1": {"document_url": "u/toanvan", "document_title": "t"}, "2": {"document_url": "v", "document_title": "s"}}}}
    df = spark.createDataFrame([(json.dumps(v1),)], "json string")
    again = df.select(reports.reshape_catalogue(F.col("json")).alias("json"))
    assert sorted(map(tuple, reports.catalogue_entries(df).collect())) == sorted(map(tuple, reports.catalogue_entries(again).collect()))
    assert tuple(reports.catalogue_report(reports.catalogue_entries(again)).first()) == ("Luat", 2, 1)
    assert reports.catalogue_entries(spark.createDataFrame([("{broken",), (None,)], "json string")).count() == 0


def test_bfs_stops_at_leaves_depth_and_cap(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "doc"), ("doc", "x"), (None, "y")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "node string")
    got = dict(map(tuple, graph.reachable(e, start, 9, leaf=F.col("node") == "doc").collect()))
    assert got == {"a": 0, "b": 1, "c": 2, "doc": 2}
    assert graph.reachable(e, start, 1).count() == 2
    assert graph.reachable(e, start, 9, max_discovered=1).count() == 2
    assert graph.fetch_order(graph.reachable(e, start, 9), F.col("node") == "doc").first().node == "doc"


def test_readers_pass_over_broken_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"ministry": "A", "url": "u"}\n\n{broken\n{"ministry": " "}\n')
    assert [r.ministry for r in readers.known_keys(spark, str(p), readers.MINISTRY_SCHEMA, "ministry").collect()] == ["A"]
    got = one(spark, readers.json_list(F.lit('["a"," ",null]')).alias("a"), readers.json_list(F.lit("{}")).alias("b"), readers.checkpoint(F.lit("{x"), 3).alias("c"), readers.checkpoint(F.lit('{"current_sitemap_index": 9}')).alias("d"))
    assert got.a == ["a"] and got.b == [] and tuple(got.c) == (3, 0, 0, 0) and tuple(got.d) == (9, 0, 0, 0)
    (tmp_path / "arr.json").write_text('[\n\n{"id": "x"}\n]\n')
    assert readers.json_array(spark, str(tmp_path / "arr.json"), "id string").count() == 1


def test_fetch_retries_only_what_may_pass():
    calls = []

    def fetch(url, timeout):
        calls.append(url)
        if url == "bad":
            raise OSError("reset")
        return {"ok": (200, b"x", {}), "gone": (404, b"", {}), "busy": (503, b"", {"Retry-After": "1"})}[url]

    slept = []
    got = {u: http.attempt(u, fetch, 2, 1.0, slept.append) for u in ("ok", "gone", "busy", "bad")}
    assert got["ok"][2:4] == (200, b"x") and got["gone"][5] == 1 and got["busy"][5] == 3 and got["bad"][4] == "reset"
    assert calls.count("gone") == 1 and calls.count("busy") == 3


def test_fetch_rows(spark):
    u = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    got = http.fetch_all(u, lambda url, t: (200, url.encode(), {}), partitions=2, delay=0, sleep=lambda s: None)
    assert sorted((r.url, bytes(r.body)) for r in got.collect()) == [("a", b"a"), ("b", b"b")]


def test_three_phases(spark):
    o = pipelines.Options(base=BASE)
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    schema = "item_id bigint, scope string, doc_type string, status string, detail_json string, error_message string, discovered_at timestamp, updated_at timestamp"
    pages = spark.createDataFrame([(1, "".join(f'<a href="/tw/Pages/vbpq-toanvan.aspx?ItemID={i}">d{i}</a>' for i in (1, 2, 3)))], "page_no int, html string")
    state = pipelines.discovered(spark.createDataFrame([], schema), pages, "vbpq", now)
    state = pipelines.discovered(state, pages, "vbpq", now)
    assert state.count() == 3
    body = '<div id="toanvan">nội dung</div><a href="/f/a.pdf">x</a>'
    details = spark.createDataFrame([(1, "tw", body), (2, dims.FALLBACK_SCOPE, body), (3, "tw", "Không tìm thấy văn bản")], "item_id bigint, scope string, page string")
    attrs = spark.createDataFrame([(1, dims.FALLBACK_SCOPE, "<table><tr><td class=label>Số hiệu</td><td>7</td></tr></table>")], "item_id bigint, scope string, page string")
    res = pipelines.detailed(pipelines.pending(state), details, attrs, o)
    done = pipelines.apply_details(state, res, now)
    assert {r.item_id: r.status for r in done.collect()} == {1: "detail_done", 2: "detail_done", 3: "failed"}
    rec = {r.id: r for r in pipelines.records(res, now).collect()}
    assert rec["VBPL-1"].metadata["so_hieu"] == "7" and rec["VBPL-1"].attachments[0].url == BASE + "/f/a.pdf"
    assert rec["VBPL-2"].url == f"{BASE}/{dims.FALLBACK_SCOPE}/Pages/vbpq-toanvan.aspx?ItemID=2"
    assert pipelines.report(done).count() == 3


def test_sitemap_documents_keeps_keys_beyond_int(spark, tmp_path):
    schema = "row_id bigint, url string, title string, attributes struct<so_hieu: string, tinh_trang: string>, content_text string"
    for name, keys, kind in (("narrow", [1, 2**31 - 1, None], "int"), ("wide", [1, 2**31, -(2**31) - 1, 10**10, None], "bigint")):
        rows = [(k, f"u{k}", f"T {k}", ("5/NĐ", "Còn hiệu lực: "), f"a <b> {k}") for k in keys]
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/tvpl_documents.parquet")
        got = queries.queries()["sitemap_documents"](spark, f"{tmp_path}/{name}")
        assert got.schema["document_index"].dataType.simpleString() == kind
        assert {tuple(r) for r in got.collect()} == {(k, f"u{k}", f"T {k}", f"a <b> {k}", "5/NĐ", "Còn hiệu lực") for k in keys}


def test_sitemap_and_listing_crawls(spark):
    o = pipelines.Options(base=BASE, sitemap_start=2)
    maps = spark.createDataFrame([(1, "<loc>z</loc>"), (2, "<loc>a</loc><loc>b</loc>")], "sitemap_index int, xml string")
    done = spark.createDataFrame([(2, 1)], "sitemap_index int, next_url_index int")
    assert [r.url for r in pipelines.sitemap_urls(maps, o, done).collect()] == ["b"]
    html = '<title>T</title><div id="divThuocTinh">Số hiệu: 5 Loại văn bản: Luật</div><div id="divNoiDung">nội dung dài hơn</div>'
    d = pipelines.sitemap_documents(spark.createDataFrame([(0, "u", html), (1, "v", None)], "document_index int, url string, html string"), F.lit("now")).orderBy("document_index").collect()
    assert d[0].attributes.so_hieu == "5" and d[0].content_text == "nội dung dài hơn" and d[0].content_length == 16 and d[1].content_text is None
    menu = '<ul><li><a href="/x/vbpq-toanvan.aspx?ItemID=9">menu</a></li></ul>'
    li = lambda i: f'<li><div><p><a href="/x/vbpq-toanvan.aspx?ItemID={i}">t{i}</a></p></div></li>'
    box = lambda items: f'{menu}<div id="tabVB_lv1"><div>head</div><div><ul>{items}</ul></div></div>'
    pages = spark.createDataFrame([("s", 1, box(li(1) + li(1))), ("s", 2, menu), ("s", 3, box(li(3))), ("done", 1, box(li(4))), ("t", 1, box(li(5))), ("t", 2, box(li(6))), ("t", 3, box(""))], "slug string, page_no int, html string")
    done, none = spark.createDataFrame([("done",)], "slug string"), spark.createDataFrame([], "url string")
    got = pipelines.listing_crawl(pages.select("slug"), done, pages, none, o)
    assert sorted(r.title for r in got.collect()) == ["t1", "t5", "t6"]
    left_at = spark.createDataFrame([("t", 1)], "slug string, last_page int")
    assert sorted(r.title for r in pipelines.listing_crawl(pages.select("slug"), done, pages, none, o, left_at).collect()) == ["t1", "t6"]
    s = pipelines.listing_stats(pages.select("slug").distinct(), done, pages, none, o).first().asDict()
    assert s == {"slugs_total": 3, "jobs_total": 3, "slugs_done": 1, "jobs_done": 1, "pages_visited": 5, "candidate_links_found": 4, "failures": 0, "unique_detail_urls": 3, "duplicates_skipped": 1}


def test_replay_and_envelopes(spark):
    e = spark.createDataFrame([("t2", "document_fetch", 1, 2, "u", None, "x"), ("t1", "document_fetch", 1, 2, "u", None, "y"), ("t1", "sitemap_fetch", 1, None, None, "s", "z")], "when_utc string, stage string, sitemap_index int, document_index int, url string, sitemap_url string, error string")
    answers, queue = pipelines.replay(e, lambda u: u.withColumn("ok", F.lit(True)), pipelines.Options())
    assert queue.first().error == "y" and answers.count() == 1
    env = spark.createDataFrame([(0, "u", True, ("t",), None), (1, "v", False, None, "e")], "document_index int, url string, ok boolean, doc struct<title: string>, error string")
    good, bad = sinks.split_envelopes(env)
    assert good.first().title == "t" and bad.first().error == "e"


def test_files_and_partitioned_output(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "item_id int, filename string")
    disk = spark.createDataFrame([(1, "a", 5), (1, "b", 0)], "item_id int, filename string, length int")
    assert sorted(map(tuple, sinks.missing_files(a, disk).collect())) == [(1, "b"), (2, "a")]
    sinks.by_doc_type(spark.createDataFrame([("x", "vbpq")], "id string, doc_type string"), str(tmp_path / "o"))
    sinks.retry_shards(spark.createDataFrame([("x", None), ("y", 3)], "id string, sitemap_index int"), str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {"shard=retry_unmapped", "shard=resitemap_0003"}


def test_resumed_stream_equals_one_run(spark, tmp_path):
    base = str(tmp_path)
    for lines in (['{"k": "a"}', "{broken", '{"k": "b"}'], ['{"k": "b"}', '{"k": "c"}']):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in")
        out = resume.resume_files(spark, f"{base}/in", "k string", f"{base}/out", f"{base}/ck", keys=["k"])
    assert sorted(r.k for r in out.collect()) == ["a", "b", "c"]
    assert resume.resume_files(spark, f"{base}/in", "k string", f"{base}/out", f"{base}/ck", keys=["k"]).count() == 3


def test_json_arrays_and_nested_catalogues(spark, tmp_path):
    rows = spark.createDataFrame([(i, json.dumps({"id": str(i)})) for i in range(50)], "i int, j string").repartitionByRange(3, "i")
    sinks.json_arrays(rows, "j", str(tmp_path / "a"))
    assert readers.json_array(spark, str(tmp_path / "a"), "id string").count() == 50
    parts = [json.loads(p.read_text()) for p in (tmp_path / "a").glob("part-*")]
    assert sum(map(len, parts)) == 50
    sinks.json_arrays(rows.limit(0), "j", str(tmp_path / "e"))
    assert readers.json_array(spark, str(tmp_path / "e"), "id string").count() == 0
    entries = spark.createDataFrame([("Luat", "Page_1", "2", "u", "t"), ("Luat", "Page_1", "1", "v", "s")], "doc_type string, page string, idx string, url string, title string")
    nested = sinks.nested_catalogue(entries)
    assert sorted(map(tuple, reports.catalogue_entries(nested.select("json")).collect())) == sorted(map(tuple, entries.collect()))


def test_files_are_written_once_and_failures_are_rows(spark, tmp_path):
    f = spark.createDataFrame([(1, "../a.pdf", bytearray(b"x")), (1, "b", None), (None, "c", bytearray(b"y"))], "item_id bigint, filename string, content binary")
    for _ in range(2):
        got = {r.filename: r.ok for r in sinks.write_files(f, str(tmp_path)).collect()}
    assert got == {"../a.pdf": True, "b": False} and (tmp_path / "1" / "a.pdf").read_bytes() == b"x"
    assert not sinks.sitemap_cache(spark.createDataFrame([], "sitemap_index int, url string"), str(tmp_path / "c"))


def test_menus_tabs_and_existing_pages(spark):
    from lawmill.functions.html import menu_links, tab_links

    h = '<ul><li><a href="#">Bộ, ngành</a><ul><li><a href="/a">Bộ A</a></li><li><a href="/b">Bộ B</a></li></ul></li></ul><div class="box-tab"><a href="/t">Toàn văn</a></div>'
    got = spark.createDataFrame([(h,), (None,)], "h string").select(menu_links(F.col("h"), "Bộ, ngành").alias("m")).collect()
    assert [x.name for x in got[0].m] == ["Bộ A", "Bộ B"] and got[1].m == []
    assert tab_links(h) == [("Toàn văn", "/t")]
    u = spark.createDataFrame([("a",), ("b",)], "url string")
    assert [r.url for r in http.existing(u, lambda url, t: (200 if url == "a" else 404, b"", {}), partitions=1, delay=0, sleep=lambda s: None).collect()] == ["a"]


def test_command_line(spark, tmp_path):
    from lawmill.__main__ import main

    schema = "item_id bigint, scope string, doc_type string, status string, detail_json string, error_message string, discovered_at timestamp, updated_at timestamp"
    p = lambda n: str(tmp_path / n)
    spark.createDataFrame([], schema).write.parquet(p("s0"))
    spark.createDataFrame([(1, '<a href="/x/Pages/vbpq-toanvan.aspx?ItemID=5">d</a>')], "page_no int, html string").write.parquet(p("pages"))
    main(["discover", p("s0"), p("pages"), p("s1")])
    spark.createDataFrame([(5, "x", '<div id="toanvan">nội dung</div>')], "item_id bigint, scope string, page string").write.parquet(p("d"))
    spark.createDataFrame([], "item_id bigint, scope string, page string").write.parquet(p("a"))
    main(["detail", p("s1"), p("d"), p("a"), p("o")])
    main(["export", f"{p('o')}/state", p("e")])
    assert readers.json_array(spark, p("e"), "text string").first().text == "nội dung"
    main(["stats", f"{p('o')}/state", "--doc-type", "vbpq"])
    spark.createDataFrame([(1, "<loc>u</loc>")], "sitemap_index int, xml string").write.parquet(p("m"))
    main(["sitemap", p("m"), p("u"), "--end", "3"])
    assert spark.read.parquet(p("u")).first().url == "u"


def test_challenges_missing_bodies_and_sessions():
    from datetime import datetime, timezone

    class Turning:
        turn = 0

        def rotate(self):
            self.turn += 1

        def __call__(self, url, timeout, form=None):
            return (200, b"Just a moment... Cloudflare", {}) if self.turn < 2 else (200, (form or "page").encode(), {})

    f = Turning()
    assert http.attempt("u", f, 3, 1.0, lambda s: None, "a=1")[2:] == (200, b"a=1", None, 3) and f.turn == 2
    assert http.attempt("u", Turning(), 0, 1.0, lambda s: None)[4] == "challenge page"
    missing = lambda url, t: (200, "Không tìm thấy văn bản".encode(), {})
    assert http.attempt("u", missing, 0, 1.0, None, missing=True)[2:5] == (404, None, "status 404")
    assert http.attempt("u", missing, 0, 1.0, None)[2] == 200
    now = lambda: datetime(2025, 1, 1, tzinfo=timezone.utc)
    assert [http.asked_pause({"retry-after": v}, now) for v in ("7", "Wed, 01 Jan 2025 00:00:30 GMT", "soon", "-3")] == [7.0, 30.0, 0.0, 0.0]
    assert isinstance(http.transport("urllib")(), http.Session) and http.transport("auto")().turn == 0


def site(url, timeout, form=None):
    """A site of three documents on two search pages, two sitemaps and one attachment."""
    hit = lambda i: f'<a href="/tw/Pages/vbpq-toanvan.aspx?ItemID={i}">d{i}</a>'
    if form is not None:
        if "HN" in form:
            return 200, b"", {}
        number = form.rsplit("page=", 1)[1]
        pager = "<div class=paging><a href=\"javascript:Nexpage('divResultSearch','2');\">2</a></div>"
        return 200, {"1": hit(1) + hit(2) + pager, "2": hit(3)}[number].encode(), {}
    if url.endswith("index"):
        return 200, b'<a href="/resitemap1.xml">a</a><a href="/resitemap2.xml">b</a>', {}
    if url.endswith(".xml"):
        n = url[-5]
        return 200, f"\ufeff<u><loc>{BASE}/doc/{n}0</loc><loc>{BASE}/doc/{n}1</loc></u>".encode(), {}
    if "/doc/" in url:
        return (503, b"", {}) if url.endswith("21") else (200, f"<title>T{url[-2:]}</title><div id=divNoiDung>nội dung</div>".encode(), {})
    if url.endswith(".pdf"):
        return 200, b"%PDF", {}
    if "thuoctinh" in url:
        return 200, "<table><tr><td class=label>Số hiệu</td><td>7</td></tr></table>".encode(), {}
    if url.endswith("ItemID=3"):
        return 200, "Không tìm thấy văn bản".encode(), {}
    return 200, f'<div id=toanvan>nội dung {url[-1]}</div><a href="/f/{url[-1]}.pdf">x</a>'.encode(), {}


def test_crawl_from_search_to_export(spark, tmp_path):
    from lawmill.__main__ import main

    schema = "item_id bigint, scope string, doc_type string, status string, detail_json string, error_message string, discovered_at timestamp, updated_at timestamp"
    out = str(tmp_path / "out")
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "s"))
    main(["--base", BASE, "crawl", str(tmp_path / "s"), out, "--sleep", "0", "--retries", "0", "--concurrency", "2", "--stats"], site)
    state = {r.item_id: r for r in spark.read.parquet(f"{out}/table").collect()}
    assert {i: r.status for i, r in state.items()} == {1: "attachments_done", 2: "attachments_done", 3: "failed"}
    assert json.loads(state[1].detail_json)["metadata"]["so_hieu"] == "7"
    assert (tmp_path / "out" / "attachments" / "2" / "2.pdf").read_bytes() == b"%PDF"
    documents = [json.loads(r.value) for r in spark.read.text(f"{out}/state/documents").collect()]
    assert len(documents) == 3 and {d["item_id"]: d["detail"] is None for d in documents} == {1: False, 2: False, 3: True}
    assert next(d for d in documents if d["item_id"] == 1)["record"]["id"] == "VBPL-1"
    header = json.loads(spark.read.text(f"{out}/state/header").first().value)
    assert header["crawl_progress"] == [{"doc_type": "vbpq", "documents": 3, "visited": 3}] and "generated_at" in header
    assert readers.json_array(spark, f"{out}/vbpq", "text string").count() == 2
    again = pipelines.crawl(spark.read.parquet(f"{out}/table"), pipelines.Options(base=BASE, sleep=0, retries=0, phase="detail", max_documents=1), out, F.current_timestamp(), site)
    assert {r.item_id: r.status for r in again.collect()} == {i: r.status for i, r in state.items()}  # nothing waits


def test_sitemap_crawl_resumes_and_replays(spark, tmp_path):
    from lawmill.__main__ import main

    out = str(tmp_path / "o")
    common = ["--base", BASE, "sitemap-crawl", out, "--sitemap-index-url", f"{BASE}/index", "--sleep", "0", "--retries", "0", "--concurrency", "2"]
    main([*common, "--max-documents", "3", "--include-html"], site)
    docs = spark.read.json(f"{out}/documents")
    assert sorted(r.title for r in docs.collect()) == ["T10", "T11", "T20"] and docs.where("html like '%nội dung%'").count() == 3
    main(common, site)
    assert spark.read.json(f"{out}/documents").count() == 3
    errors = spark.read.json(f"{out}/errors").collect()
    assert [(r.stage, r.url, r.sitemap_index) for r in errors] == [("document_fetch", f"{BASE}/doc/21", 2)]
    main([*common, "--retry-errors-file", f"{out}/errors"], lambda url, t, form=None: (200, b"<title>late</title>", {}))
    assert {r.title for r in spark.read.json(f"{out}/documents").collect()} == {"T10", "T11", "T20", "late"}
    assert spark.read.schema("url string").json(f"{out}/errors-left").count() == 0


def test_state_outlives_its_checkpoint(spark, tmp_path):
    base, schema = str(tmp_path), "k int, v string, n int"
    rows = lambda *r: spark.createDataFrame(r, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    merge = lambda ck: sorted(map(tuple, resume.merge_state(spark, f"{base}/in", schema, f"{base}/state", f"{base}/{ck}", ["k"], ["n"], buckets=4).collect()))
    rows((1, "a", 1), (2, "b", 1), (3, "c", 1))
    assert merge("c1") == [(1, "a", 1), (2, "b", 1), (3, "c", 1)]
    rows((2, "B", 2), (1, "old", 0))
    assert merge("c1") == [(1, "a", 1), (2, "B", 2), (3, "c", 1)]
    assert merge("c1") == [(1, "a", 1), (2, "B", 2), (3, "c", 1)]  # nothing new
    assert merge("fresh") == [(1, "a", 1), (2, "B", 2), (3, "c", 1)]  # everything again, onto the state that is there
    left = [p for p in (tmp_path / "state").glob("v*/_bucket=*")]
    assert len({p.name for p in left}) == len(left)  # one version of each bucket


def test_counters_by_batch_and_observations(spark):
    r = spark.createDataFrame([(i, i % 3 != 0) for i in range(10)], "i int, good boolean")
    got = sorted(map(tuple, reports.batch_counts(r, (F.col("i") / 4).cast("int"), F.col("good")).collect()))
    assert got == [(0, 2, 2, 2, 2), (1, 3, 1, 5, 3), (2, 1, 1, 6, 4)]
    df, seen = reports.observed(r, "seen", bad=~F.col("good"))
    assert df.count() == 10 and seen.get == {"rows": 10, "bad": 4}
    e = spark.createDataFrame([("a", "2025-01-01 00:00:10", True), ("a", "2025-01-01 00:00:20", False)], "stage string, at string, ok boolean").withColumn("at", F.col("at").cast("timestamp"))
    p = reports.progress(e, F.lit("2025-01-01 00:00:00").cast("timestamp"), 100, F.col("ok"), 11).first()
    assert (p.saved, p.saved_rate, p.eta, p.eta_scope) == (1, 0.05, 200.0, "max_documents")
