"""URL expressions. Every function takes and gives columns and stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Page names that mark a document's own page, and the search hits that lead to one.
DETAIL_PAGES = ("vbpq-toanvan.aspx", "vbpq-van-ban-goc.aspx")
SEARCH_PAGES = ("vbpq-toanvan", "ivbpq-toanvan", "vbpq-van-ban-goc")
#: Page templates of a document by type and purpose.
TEMPLATES = {
    ("vbpq", "detail"): "/{scope}/Pages/vbpq-toanvan.aspx?ItemID={item}",
    ("vbpq", "attributes"): "/{scope}/Pages/vbpq-thuoctinh.aspx?ItemID={item}",
    ("vbhn", "detail"): "/{scope}/Pages/vbpq-van-ban-goc-hopnhat.aspx?ItemID={item}",
    ("vbhn", "attributes"): "/{scope}/Pages/vbpq-thuoctinh-hopnhat.aspx?ItemID={item}",
}
ATTACHMENT = r"(?i)\.(docx?|pdf|zip|rar)$"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """The path of an absolute or relative URL, without query and fragment."""
    return F.regexp_extract(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"^([^?#]*)", 1)


def query_param(url: Column, name: str) -> Column:
    """The first value of a query parameter; null where it's missing. Broken URLs are read too."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def segment(url: Column, n: int) -> Column:
    """The n-th part of the path, from 1 (from the end if negative); empty beyond it."""
    return F.split_part(F.trim(path(url), F.lit("/")), F.lit("/"), F.lit(n))


def basename(url: Column) -> Column:
    return F.regexp_extract(url, r"([^/]*)$", 1)


def absolutise(href: Column, base: str, page: Column | None = None) -> Column:
    """A link made absolute: as it is if it has a scheme, against the host if it starts with a slash,
    against its page's folder if one is given, else against the host."""
    root = base.rstrip("/")
    folder = F.regexp_extract(page, r"^([^?#]*/)", 1) if page is not None else F.lit(root + "/")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(root.split("//")[0]), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .when(href.startswith("#") | href.startswith("?"), F.concat(F.regexp_extract(page, r"^([^?#]*)", 1) if page is not None else F.lit(root + "/"), href))
        .otherwise(F.concat(folder, href))
    )


def prefix_host(href: Column, base: str) -> Column:
    """The host put before a link, whatever it is."""
    return F.concat(F.lit(base.rstrip("/")), href)


def is_detail(url: Column) -> Column:
    low = F.lower(url)
    return low.contains(DETAIL_PAGES[0]) | low.contains(DETAIL_PAGES[1])


def is_priority(url: Column) -> Column:
    return F.lower(url).contains(DETAIL_PAGES[0])


def is_search_hit(href: Column) -> Column:
    """Case-sensitive: a document id and one of the document page names."""
    return href.contains("ItemID=") & (href.contains(SEARCH_PAGES[0]) | href.contains(SEARCH_PAGES[1]) | href.contains(SEARCH_PAGES[2]))


def is_job_link(href: Column) -> Column:
    return query_param(href, "idLoaiVanBan").isNotNull() & query_param(href, "dvid").isNotNull()


def is_attachment(href: Column) -> Column:
    """A query string after the suffix defeats the test."""
    return href.rlike(ATTACHMENT)


def attachment_type(href: Column) -> Column:
    low = F.lower(href)
    return F.when(low.endswith(".pdf"), "pdf").when(low.endswith(".doc") | low.endswith(".docx"), "doc").otherwise("other")


def is_sitemap(url: Column) -> Column:
    return F.lower(path(url)).endswith(".xml")


def same_site(url: Column, base_prefix: Column) -> Column:
    """Same host, and the prefix as a bare string: a sibling whose name starts alike passes."""
    return (host(url) == host(base_prefix)) & url.startswith(base_prefix)


def lacks_fulltext(url: Column) -> Column:
    return ~url.contains("toanvan")


def document_url(base: str, doc_type: Column, scope: Column, item: Column, purpose: str = "detail") -> Column:
    """The page of a document; consolidated texts have pages of their own."""

    def fill(t: str) -> Column:
        head, tail = t.split("{scope}")
        middle, _ = tail.split("{item}")
        return F.concat(F.lit(base.rstrip("/") + head), scope, F.lit(middle), item.cast("string"))

    return F.when(doc_type == "vbhn", fill(TEMPLATES["vbhn", purpose])).otherwise(fill(TEMPLATES["vbpq", purpose]))


def listing_url(base: str, slug: Column, doc_type_id: Column, unit_id: Column, page: Column) -> Column:
    return F.concat(
        F.lit(base.rstrip("/") + "/"), slug, F.lit("/Pages/vanban.aspx?idLoaiVanBan="), doc_type_id.cast("string"), F.lit("&dvid="), unit_id.cast("string"), F.lit("&Page="), page.cast("string")
    )


def form_body(fields: dict[str, Column]) -> Column:
    """A form-encoded request body; a null value is sent empty."""
    return F.concat_ws("&", *(F.concat(F.lit(k + "="), F.coalesce(F.url_encode(v.cast("string")), F.lit(""))) for k, v in fields.items()))
