"""One pass over a page's markup that gives all that extraction needs, as one struct.

The tokeniser is the standard library's; it runs once per page in Arrow batches, and every
operator projects from its struct. Unclosed paragraphs, rows and cells are closed by the next,
void tags open nothing, comments are dropped, script, style and nav give no text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "nav"))
BREAK = frozenset("br p div h1 h2 h3 h4 h5 h6 tr li".split())
#: Containers of a document's text, first match first, and words that mark a block as no content.
FULLTEXT = (("id", "toanvancontent"), ("id", "toanvan"), ("class", "toanvancontent"), ("class", "content1"), ("id", "divContentDoc"), ("class", "fulltext"))
NO_CONTENT = ("menu", "nav", "header", "footer", "sidebar")
CONTENT = (("id", "divNoiDung"), ("class", "content1"), ("id", "divPrint"), ("class", "contentDoc"), ("tag", "article"), ("tag", "main"))
ATTRIBUTES = (("id", "divThuocTinh"), ("id", "tab-1"), ("class", "contentDoc"), ("tag", "body"))
TITLE_WORDS = ("Thông tư", "Nghị định", "Quyết định", "Luật")
#: Labels of the attribute table and sidebar, in the order in which they are tried.
TABLE_LABELS = {
    "số hiệu": "so_hieu", "số ký hiệu": "so_hieu", "loại văn bản": "loai_van_ban", "cơ quan ban hành": "co_quan_ban_hanh", "chức danh": "chuc_danh",
    "người ký": "nguoi_ky", "ngày ban hành": "ngay_ban_hanh", "ngày có hiệu lực": "ngay_hieu_luc", "ngày hiệu lực": "ngay_hieu_luc",
    "ngày hết hiệu lực": "ngay_het_hieu_luc", "tình trạng hiệu lực": "tinh_trang", "tình trạng": "tinh_trang", "lĩnh vực": "linh_vuc", "ngành": "nganh",
    "trích yếu": "trich_yeu", "nơi ban hành": "noi_ban_hanh", "ngày đăng công báo": "ngay_cong_bao", "số công báo": "so_cong_bao",
    "nguồn thu thập": "nguon_thu_thap", "phạm vi": "pham_vi",
}

SCHEMA = (
    "title string, heading string, anchors array<struct<href: string, text: string, in_list: boolean>>, clean_text string, lines_text string, "
    "content string, attribute_blocks array<string>, metadata map<string,string>, list_items int, pager array<string>, "
    "listing array<struct<item: int, href: string, text: string>>, listing_items int"
)
#: Fixed value: the container of a listing page, whose items lie below its second div.
LISTING = "tabVB_lv1"


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self, silent: frozenset = frozenset()) -> Iterator[Node | str]:
        """Nodes and texts in document order, without the insides of silent tags."""
        stack = list(reversed(self.children))
        while stack:
            x = stack.pop()
            yield x
            if not isinstance(x, str) and x.tag not in silent:
                stack.extend(reversed(x.children))

    def find(self, *tags: str) -> list[Node]:
        return [x for x in self.walk() if not isinstance(x, str) and x.tag in tags]

    def has(self, kind: str, value: str) -> bool:
        if kind == "tag":
            return self.tag == value
        if kind == "id":
            return self.attrs.get("id") == value
        return value in self.attrs.get("class", "").split()

    def strings(self) -> list[str]:
        return [s for x in self.walk(SILENT) if isinstance(x, str) and (s := x.strip())]

    def glued(self) -> str:
        return "".join(self.strings())

    def spaced(self) -> str:
        return re.sub(r"\s+", " ", " ".join(self.strings())).strip()


class _Builder(HTMLParser):
    CLOSES = {"p": ("p",), "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.CLOSES and self.at.tag in self.CLOSES[tag]:
            while self.at.tag in self.CLOSES[tag]:
                self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        x = self.at
        while x.parent is not None and x.tag != tag:
            x = x.parent
        if x.parent is not None:
            self.at = x.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def clean_text(node: Node, spaced: bool = False) -> str:
    """Text with a line per block and a blank per cell. Inline pieces are glued, or set apart if ``spaced``."""
    out: list[str] = []
    for x in node.walk(SILENT):
        if isinstance(x, str):
            if s := x.strip():
                out.append(s + " " if spaced else s)
        elif x.tag in BREAK:
            out.append("\n")
        elif x.tag == "td":
            out.append("\t")
    text = re.sub(r"[ \t]+", " ", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n", "\n", text) if spaced else text).strip()


def full_text_node(root: Node) -> Node | None:
    """The document's container: the first named one, else the div with most text that is no page furniture."""
    divs = root.find("div")
    for kind, value in FULLTEXT:
        for d in divs:
            if d.has(kind, value):
                return d
    best, most = None, 0
    for d in divs:
        mark = f"{d.attrs.get('id', '')} {d.attrs.get('class', '')}".lower()
        if any(w in mark for w in NO_CONTENT):
            continue
        if (n := len(d.glued())) > most:
            best, most = d, n
    return best


def _field(text: str) -> str | None:
    return next((f for label, f in TABLE_LABELS.items() if label in text), None)


def table_metadata(root: Node) -> dict[str, str]:
    """Attributes from the table, completed by the sidebar and the heading."""
    out: dict[str, str] = {}
    for row in root.find("tr"):
        cells = [(c, c.glued()) for c in row.find("td")]
        if not cells:
            continue
        first = cells[0][1].lower()
        if "cơ quan ban hành" in first and "người ký" in first:
            if len(cells) >= 4:
                out.update(zip(("co_quan_ban_hanh", "chuc_danh", "nguoi_ky"), (t for _, t in cells[1:4])))
            continue
        if "tình trạng hiệu lực" in first:
            _, colon, value = first.partition(":")
            if colon and value.strip():
                out["tinh_trang"] = value.strip()
            continue
        i = 0
        while i + 1 < len(cells):
            cell, text = cells[i][0], cells[i][1].lower()
            field = _field(text)
            if field is None and not cell.has("class", "label"):
                i += 1
                continue
            value = cells[i + 1][1]
            if field and value and value != "...":
                out[field] = value
            i += 2
    for li in root.find("li"):
        spans = li.find("span")
        if not spans:
            continue
        head = spans[0].glued()
        value = li.glued()[len(head) :].strip().lstrip(":").strip()
        field = _field(head.lower().rstrip(":"))
        if field and value:
            out.setdefault(field, value)
    if "trich_yeu" not in out:
        for h in root.find("h1", "h2"):
            if re.search("title|tieude", h.attrs.get("class", ""), re.I):
                out["trich_yeu"] = h.glued()
                break
    return out


def _children(node: Node, tag: str) -> list[Node]:
    return [x for x in node.children if not isinstance(x, str) and x.tag == tag]


def listing(root: Node) -> list[Node]:
    """The items of a listing page's list."""
    box = next((x for x in root.walk() if not isinstance(x, str) and x.attrs.get("id") == LISTING), None)
    second = _children(box, "div")[1:2] if box is not None else []
    return [li for d in second for ul in _children(d, "ul") for li in _children(ul, "li")]


class Page:
    """A parsed page: one walk sorts its nodes by tag; each field is made only if it is asked for."""

    def __init__(self, html: str):
        self.root = parse(html)
        self.nodes = [x for x in self.root.walk() if not isinstance(x, str)]
        self.tags: dict[str, list[Node]] = {}
        for x in self.nodes:
            self.tags.setdefault(x.tag, []).append(x)

    def of(self, tag: str) -> list[Node]:
        return self.tags.get(tag, [])

    def title(self) -> str | None:
        found = self.of("title")
        return found[0].spaced() if found else None

    def heading(self) -> str:
        if h1 := self.of("h1"):
            return h1[0].spaced()
        named = (x for x in self.nodes if x.tag in ("h2", "strong", "b"))
        return next((t for x in named if any(w in (t := x.spaced()) for w in TITLE_WORDS)), "")

    def anchors(self) -> list[dict]:
        listed = {id(a) for li in self.of("li") for a in li.find("a")}
        return [{"href": a.attrs["href"].strip(), "text": a.spaced(), "in_list": id(a) in listed} for a in self.of("a") if "href" in a.attrs]

    def clean_text(self) -> str:
        node = full_text_node(self.root)
        return clean_text(node) if node is not None else ""

    def lines_text(self) -> str:
        return "\n".join(self.root.strings())

    def content(self) -> str:
        candidates = [x.spaced() for kind, value in CONTENT for x in self.nodes if x.has(kind, value)]
        body = self.of("body")
        return max(candidates, key=len, default="") or (body[0] if body else self.root).spaced()

    def attribute_blocks(self) -> list[str]:
        return list(dict.fromkeys(x.spaced() for kind, value in ATTRIBUTES for x in self.nodes if x.has(kind, value)))

    def metadata(self) -> dict[str, str]:
        return table_metadata(self.root)

    def list_items(self) -> int:
        return len(self.of("li"))

    def pager(self) -> list[str]:
        return [h for d in self.of("div") if d.has("class", "paging") for a in d.find("a") if (h := a.attrs.get("href"))]

    def listing(self) -> list[dict]:
        return [
            {"item": i, "href": a.attrs.get("href", "").strip(), "text": a.spaced()}
            for i, li in enumerate(listing(self.root), 1) for d in _children(li, "div") for p in _children(d, "p") for a in _children(p, "a")
        ]

    def listing_items(self) -> int:
        return len(listing(self.root))


_TYPES = dict(re.findall(r"(\w+) (string|int|map<string,string>|array<string>|array<struct<[^>]*>>)(?:, |$)", SCHEMA))
FIELDS = tuple(_TYPES)


def extract(html: str | None, *fields: str) -> dict | None:
    """The fields of a page, all of them unless some are named."""
    if html is None:
        return None
    p = Page(html)
    return {f: getattr(p, f)() for f in fields or FIELDS}


def page(html: Column, *fields: str) -> Column:
    """The struct of a page's fields, all of them unless some are named; all are null for a null page."""
    wanted = fields or FIELDS

    def run(html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract(h, *wanted) or dict.fromkeys(wanted) for h in html], columns=list(wanted))

    run.__annotations__ = {"html": pd.Series, "return": pd.DataFrame}  # the types themselves, which the UDF reads
    return F.pandas_udf(run, ", ".join(f"{f} {_TYPES[f]}" for f in wanted))(html)


def labelled_links(html: str | None, label: str) -> list[dict]:
    """The links of the list item in which a label stands: (name, href), the label's own link left out."""
    if html is None:
        return []
    for li in parse(html).find("li"):
        own = [s for x in li.children if not isinstance(x, str) and x.tag in ("a", "span") for s in [x.spaced()]] + [x.strip() for x in li.children if isinstance(x, str)]
        if label in own:
            return [{"name": a.spaced(), "href": a.attrs["href"].strip()} for a in li.find("a") if "href" in a.attrs and a.spaced() not in ("", label)]
    return []


def menu_links(html: Column, label: str) -> Column:
    """array<struct<name, href>> of the links below a label of a page's menu."""

    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([labelled_links(h, label) for h in pages], dtype=object)

    return F.pandas_udf(run, "array<struct<name: string, href: string>>")(html)


def tab_links(html: str | None) -> list[tuple[str, str]]:
    """(caption, href) of the tabs over a document."""
    if html is None:
        return []
    out = []
    for box in parse(html).find("div", "ul"):
        if "tab" in f"{box.attrs.get('id', '')} {box.attrs.get('class', '')}".lower():
            out += [(a.spaced(), a.attrs["href"]) for a in box.find("a") if "href" in a.attrs and (a.spaced(), a.attrs["href"]) not in out]
    return out
