from hypothesis import given
from hypothesis import strategies as st

from lawmill.functions.html import clean_text, extract, page, parse


def test_table_sidebar_and_heading():
    h = """<h1 class="title">Trích</h1><table><tr><td class="label">Cơ quan ban hành/ Chức danh / Người ký</td><td>Bộ A</td><td>Bộ trưởng</td><td>Ông B</td></tr>
    <tr><td class=label>Số ký hiệu</td><td>1/2020<td class=label>Loại văn bản</td><td>...</td></tr><tr><td colspan=4>Tình trạng hiệu lực: Còn Hiệu lực</td></tr></table>
    <ul><li><span>Ngành:</span> Y tế</li><li><span>Số hiệu:</span> khác</li></ul>"""
    m = extract(h)["metadata"]
    assert m == {"co_quan_ban_hanh": "Bộ A", "chuc_danh": "Bộ trưởng", "nguoi_ky": "Ông B", "so_hieu": "1/2020", "tinh_trang": "còn hiệu lực", "nganh": "Y tế", "trich_yeu": "Trích"}


def test_text_order_of_containers_and_silence():
    h = "<div class=menu>" + "x" * 500 + "</div><div id=a><p>foo <b>bar</b><!-- no --><script>var a='</p>';</script><p>baz<br>qux</div>"
    assert extract(h)["clean_text"] == "foobar\nbaz\nqux"
    assert clean_text(parse(h).find("div")[1], spaced=True).startswith("foo bar")
    assert extract("<div class=fulltext>late</div><div id=toanvan>first</div>")["clean_text"] == "first"
    assert extract("<p>no div")["clean_text"] == ""
    assert extract(None) is None
    assert extract("")["anchors"] == []


def test_title_falls_back_to_a_heading_with_a_type():
    assert extract("<h2>Trang</h2><b>Nghị  định 5</b>")["heading"] == "Nghị định 5"


@given(st.text(alphabet="<>/abpdivtr \n\"='&;", max_size=200))
def test_any_markup_gives_text_without_long_gaps(h):
    assert "\n\n\n" not in extract(h)["clean_text"]


def test_page_of_nulls_and_long_pages(spark):
    df = spark.createDataFrame([(1, None), (2, "<div id=toanvan>" + "a <b>b</b> " * 50_000 + "</div>"), (3, "")], "k int, html string")
    got = {r.k: r.p for r in df.select("k", page(df.html).alias("p")).collect()}
    assert got[1].clean_text is None and len(got[2].clean_text) > 50_000 and got[3].list_items == 0


def test_listing_is_read_in_its_container_only():
    item = '<li><div><p><a href=" /a ">Một\n hai</a><a href="/b">b</a></p></div></li>'
    h = f'<ul><li><div><p><a href="/menu">m</a></p></div></li></ul><div id="tabVB_lv1"><div><ul>{item}</ul></div><div><ul>{item}<li>x</li>{item}</ul></div><div><ul>{item}</ul></div></div>'
    got = extract(h, "listing", "listing_items")
    assert got["listing_items"] == 3 and [(x["item"], x["href"], x["text"]) for x in got["listing"]] == [(i, *x) for i in (1, 3) for x in (("/a", "Một hai"), ("/b", "b"))]
    assert extract("<p>none", "listing")["listing"] == [] and extract('<div id="tabVB_lv1"></div>', "listing_items") == {"listing_items": 0}


def test_named_fields_equal_all_fields(spark):
    h = '<title>T</title><h1>H</h1><ul><li><a href="/x">y</a></li></ul><div class="paging"><a href="p">1</a></div><div id="toanvan">nội dung</div><table><tr><td class=label>Số hiệu</td><td>7</td></tr></table>'
    every = extract(h)
    assert all(extract(h, f) == {f: every[f]} for f in every)
    df = spark.createDataFrame([(h,), (None,)], "html string").select(page("html").alias("a"), page("html", "title", "anchors").alias("b")).collect()
    assert (df[0].b.title, df[0].b.anchors) == (df[0].a.title, df[0].a.anchors) and df[1].b.title is None
