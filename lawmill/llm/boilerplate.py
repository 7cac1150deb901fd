"""Page furniture told from the document by wrapper induction over the pages of a host.

Method: a page's blocks are a tree (the page, its lines, and the items of a line that is a
menu). Over all pages of a host, node labels that recur with many different documents are
the constant nodes of the host's template, ordered by their mean place. Each page's tree is
aligned with its host's template by simple tree matching; matched nodes are template, the others are
its varying slots, and those are content: lines of any length, in any language. Varying nodes that belong to the template are told by its
constants: a breadcrumb or menu some of whose items are constants, and an entry of a list of other
documents. Formulas that documents share recur as well, but they are document grammar and stay.

How often a label recurs is counted in distinct documents (a minhash of the page's sentences),
so that a document copied to a third of a host's pages doesn't turn into its template.
Every label of every page is counted, exactly: pairs of a label and a document are made distinct before the
documents of a label are counted, so a host that holds a third of all
pages is no hot key. Templates are broadcast if all of them together stay under
``MAX_TEMPLATE_NODES``, else each page is joined with its host's.

Values with a wrong character encoding are read as repaired; a character lost for good matches
any. Null and empty texts have no furniture lines. Lines are counted from 0 after splitting
at "\\n" and are judged whole; blank lines are no furniture, and records without a key give no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress, count, repeat
from operator import lt
from weakref import WeakSet

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawmill.llm.mojibake import QUESTION, Model, chains, repair_value
from lawmill.session import stage

#: A label is a constant node if this share of its host's distinct documents has it, and so many at least.
SHARE, LEAST = 0.02, 4
#: Letters beyond which a line is counted by a hash.
LONG = 110
MAX_TEMPLATE_NODES = 400_000
#: Short lines whose judgement a process remembers, of all hosts; menus and formulas recur on most pages.
KNOWN = 50_000
COMMON_HOSTS = 2

TYPES = "Bộ luật|Luật|Pháp lệnh|Lệnh|Nghị quyết liên tịch|Nghị quyết|Nghị định|Quyết định|Thông tư liên tịch|Thông tư|Chỉ thị|Công văn|Thông báo|Văn bản hợp nhất|Kế hoạch|Hướng dẫn"
UPPER = "A-ZÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝĂĐĨŨƠƯ" + "".join(chr(c) for c in range(0x1EA0, 0x1EFA, 2))
LOWER = UPPER.replace("A-Z", "").lower() + "a-z"
#: Lines of document grammar.
GRAMMAR = re.compile(
    "(?:"
    + "|".join((
        r"Điều \d+|\d+\. |[a-zđ]\) |\d+ \| |- .*[;.]$|Số: |Căn cứ |Theo đề nghị |Về việc |Nơi nhận:|Biểu kèm theo|\(Đã ký\)$",
        rf"(?:TM|KT|TL|TUQ)\. |LIÊN TỈNH |Kiên trì -|[{UPPER}][^\d|]{{1,40}}, ngày \d+ tháng \d+ năm \d+$",
        rf"(?:{TYPES}) \S*\d\S*/\S*\d\S*/\S+ |(?:{TYPES.upper()})$",
        rf"(?:BỘ|ỦY BAN|HỘI ĐỒNG|TỔNG CỤC|VIỆN|TÒA ÁN|KHO BẠC|NGÂN HÀNG|VĂN PHÒNG|CỤC|SỞ) [{UPPER} ]+$",
        r"(?:PHÓ )?(?:CHỦ TỊCH|THỨ TRƯỞNG|BỘ TRƯỞNG|TỔNG CỤC TRƯỞNG|CHÁNH VĂN PHÒNG|VIỆN TRƯỞNG|CHÁNH ÁN|THỐNG ĐỐC|TỔNG GIÁM ĐỐC|GIÁM ĐỐC|CỤC TRƯỞNG)$",
        rf"[{UPPER}][{LOWER}]*(?: [{UPPER}][{LOWER}]+){{2,3}}$",
    ))
    + ")"
)
#: An entry of a list of other documents: type, number and year, and no issuer's code.
ENTRY = re.compile(rf"(?:{TYPES}) \d+/\d{{4}} về (?!việc )[^.;]{{3,90}}$")
LOST_ENTRY = re.compile(r"(?:\S+ ){1,4}\d+/\d{4} v\S{1,3} (?!vi\S{1,3}c )[^.;]{3,90}$")
PATH = re.compile(r"\s[»>/›]\s")
SEPARATOR = re.compile(r"\s+[|·»>/›]\s+|\s{2,}")


_NUMBER, _DIGIT = re.compile(r"\d[\d.]*"), re.compile(r"\d")
_GAP, _SIGN = re.compile(r"\s[|·»>/›]\s|\s\s"), re.compile("[|·»>/›]")


def _odd_blanks(line: str) -> bool:
    """Whether a line may have other blanks than single spaces, none of which is printable; it has none if not."""
    return "  " in line or not line.isprintable()


def label(line: str) -> str:
    """A line with its numbers folded and its blanks collapsed."""
    s = line.strip()
    if _odd_blanks(s):
        s = re.sub(r"\s+", " ", s)
    return _NUMBER.sub("0", s) if _DIGIT.search(s) else s


def items(line: str) -> list[str]:
    """The items of a line that is a menu or a breadcrumb; one item for any other line."""
    s = line.strip()
    if not _GAP.search(s):
        return [label(s)] if s else []
    return [x for x in (label(p) for p in SEPARATOR.split(s)) if x]


def lost(line: str) -> bool:
    """Whether characters of the line were replaced for good."""
    return "�" in line or "?" in line and bool(QUESTION.search(line))


def is_grammar(line: str) -> bool:
    return bool(GRAMMAR.match(line))


def align(places: list[int | None]) -> list[bool]:
    """Which nodes belong to the largest order-keeping match, given each one's place in the template.

    Labels of a template are distinct, so simple tree matching of the root's children is the
    longest increasing run of places.
    """
    known = [p for p in places if p is not None]
    if all(map(lt, known, known[1:])):
        return [p is not None for p in places]
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = [-1] * len(places)
    for i, p in enumerate(places):
        if p is None:
            continue
        k = bisect_left(tails, p)
        back[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(p)
            ends.append(i)
        else:
            tails[k], ends[k] = p, i
    out = [False] * len(places)
    i = ends[-1] if ends else -1
    while i >= 0:
        out[i] = True
        i = back[i]
    return out


#: What an entry, a menu and a line with lost characters have.
_TELLING = re.compile("[/|·»>›?�\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Letters that no wrong decoding gives.
_RESTORED = re.compile("[\u1e00-\u1eff]")
_SIGNS = re.compile(r"^\W+|[^\x00-\xff]")


def _words(s: str) -> str:
    """The words of two letters or more."""
    return " ".join(w for w in re.findall(r"[^\W\d_]+", s.lower()) if len(w) > 1)


class Template:
    """The constant nodes of a host, by label, with their order."""

    _all: WeakSet[Template] = WeakSet()
    _held = 0  # lines remembered by all templates, those of templates that are gone included

    def __init__(self, nodes: list[tuple[str, float]], shared: set[str] = frozenset()):
        self.place = {n: i for i, (n, _) in enumerate(sorted(nodes, key=lambda x: (x[1], x[0])))}
        self.items = set(self.place) | set(shared)
        self.words = {w for n in self.place if len(w := _words(n)) > 5}
        self.long = any(n[0] == "\0" for n in self.place if n)
        self.known: dict[str, tuple[int | None, bool, bool]] = {}
        Template._all.add(self)

    def menu(self, line: str) -> bool:
        if not _GAP.search(line):
            return False
        parts = items(line)
        if len(parts) < 2:
            return False
        known = [p in self.items or self.lossy(p) for p in parts]
        if known[0] and PATH.search(line):
            return all(len(p) <= 40 for p in parts)  # a breadcrumb's first item is a constant, the others are its slot
        return sum(known) * 2 >= len(parts) and (sum(known) >= 2 or known[0])

    def lossy(self, text: str) -> bool:
        """Whether the text is a constant node some of whose characters were lost."""
        if "?" not in text and "�" not in text:
            return False
        pattern = re.compile(".{1,3}".join(re.escape(x) for x in re.split(r"[?�]+", label(text))))
        return any(pattern.fullmatch(other) for other in self.items)

    def constant(self, line: str, name: str) -> bool:
        """Whether a line that isn't aligned is a moved constant, a menu or an entry of a list."""
        if name and name in self.place:
            return True
        return bool((_TELLING.search(line) or "  " in line) and (ENTRY.match(line) or self.menu(line) or self.lossy(line) or (lost(line) and LOST_ENTRY.match(line))))

    def misread(self, line: str) -> bool:
        """Whether a line of a page that was repaired in part or not at all has a constant's words in any reading."""
        if line.isascii():
            return False
        return _words(line) in self.words or not _RESTORED.search(line) and any(_words(t) in self.words for _, t in chains(_SIGNS.sub("", line)))

    def judged(self, line: str) -> tuple[int | None, bool, bool]:
        """(place in the template, constant wherever it stands, neither blank nor grammar) of a line; formulas are document grammar, however often they recur."""
        bare = line.strip()
        open_ = bool(bare) and not GRAMMAR.match(bare)
        name = label(line) if open_ else ""
        name = _mark(name) if len(name) <= LONG or self.long else ""
        out = (self.place.get(name), self.constant(bare, name), True) if open_ else (None, False, False)
        if len(line) <= LONG:
            if Template._held >= KNOWN:
                Template._held = 0
                for t in Template._all:
                    t.known.clear()
            Template._held += 1
            self.known[line] = out
        return out

    def furniture(self, lines: list[str], garbled: bool = False) -> list[bool]:
        """For each line of a page whether it is furniture; ``garbled`` where some lines of it were wrongly decoded."""
        known = self.known
        judged = [known.get(x) or self.judged(x) for x in lines]
        matched = align([p for p, _, _ in judged])
        if not garbled:
            return [open_ and (m or c) for m, (_, c, open_) in zip(matched, judged)]
        return [open_ and (m or c or self.misread(x.strip())) for m, (_, c, open_), x in zip(matched, judged, lines)]


def signature(lines: list[str]) -> int:
    """A minhash of the page's sentences: near copies of a document mostly share it."""
    return min((zlib.crc32(x.encode("utf-8", "replace")) for x in lines if len(x) > 40 and x[-1:] == "."), default=zlib.crc32("\n".join(lines).encode("utf-8", "replace")))


def _mark(name: str) -> str:
    """What a long label is counted by."""
    return name if len(name) <= LONG else "\0" + hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


NODES = "host string, label string, kind string, document bigint, place double"


def _frame(**columns: tuple[list, str]) -> pd.DataFrame:
    """A frame of the given types, which empty columns don't show."""
    return pd.DataFrame({name: pd.Series(values, dtype=kind) for name, (values, kind) in columns.items()})


def _node(line: str) -> tuple[str, list[str]] | None:
    """(label, items of a menu) of a line; None if it is blank, grammar or an entry of a list."""
    x = line.strip()
    if not x or GRAMMAR.match(x) or ENTRY.match(x):
        return None
    parts = items(x) if (_SIGN.search(x) or _odd_blanks(x)) and _GAP.search(x) else []
    return _mark(label(x)), [p for p in parts if len(p) <= 40] if len(parts) > 2 else []


def _nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the nodes of pages."""
    known: dict[str, tuple[str, list[str]] | None] = {}
    for b in batches:
        hosts, labels, kinds, documents, places = [], [], [], [], []
        for h, t in zip(b["host"], b["text"]):
            if not t:
                continue
            lines = t.split("\n")
            seen = {("", "page", 0.0)}
            for i, x in enumerate(lines):
                if (node := known.get(x, known)) is known:
                    node = _node(x)
                    if len(x) <= LONG:
                        if len(known) >= KNOWN:
                            known.clear()
                        known[x] = node
                if node:
                    if node[1]:
                        seen.update((p, "item", 0.0) for p in node[1])
                    seen.add((node[0], "line", round(i / len(lines), 2)))
            hosts += repeat(h, len(seen))
            documents += repeat(signature(lines), len(seen))
            for column, values in zip((labels, kinds, places), zip(*seen)):
                column += values
        yield _frame(host=(hosts, "object"), label=(labels, "object"), kind=(kinds, "object"), document=(documents, "int64"), place=(places, "float64"))


def induce(pages: DataFrame) -> DataFrame:
    """The templates: (host, label, place) of every constant node of ``pages`` (host, text)."""
    nodes = pages.select(F.coalesce("host", F.lit("")).alias("host"), "text").mapInPandas(_nodes, NODES)
    pairs = nodes.groupBy("host", "label", "kind", "document").agg(F.sum("place").alias("place"), F.count("*").alias("nodes"))
    counts = pairs.groupBy("host", "label", "kind").agg(F.count("*").alias("n"), (F.sum("place") / F.sum("nodes")).alias("place"))
    counts = stage(counts, "template-counts")  # read several times below; the pages once
    sizes = counts.where("kind = 'page'").select("host", F.col("n").alias("documents"))
    named = counts.where("kind != 'page'")
    own = named.join(sizes, "host").where((F.col("n") >= SHARE * F.col("documents")) & (F.col("n") >= LEAST)).select("host", "label", "place")
    # what is constant on several hosts is furniture wherever else it is seen, as on hosts of few pages
    common = own.groupBy("label").agg(F.countDistinct("host").alias("hosts")).where(F.col("hosts") >= COMMON_HOSTS).select("label")
    kept = own.unionByName(named.join(common, "label", "left_semi").select("host", "label", "place"))
    return kept.groupBy("host", "label").agg(F.min("place").alias("place"))


FOUND = "src string, row_key bigint, line_no bigint"


def _classify(rows: Iterator[tuple], template_of, model: Model | None) -> pd.DataFrame:
    src, key, line = [], [], []
    for s, k, h, t in rows:
        if not t:
            continue
        bad = False
        if model is not None and s == "tvpl_documents":
            bad, _, fixed, _ = repair_value(model, t)
            t = fixed or t
        found = list(compress(count(), template_of(h).furniture(t.split("\n"), bad)))
        src += repeat(s, len(found))
        key += repeat(k, len(found))
        line += found
    return _frame(src=(src, "object"), row_key=(key, "int64"), line_no=(line, "int64"))


def furniture_lines(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(src, row_key, line_no) of every furniture line of ``pages`` (src, row_key, host, text)."""
    pages = pages.select("src", "row_key", F.coalesce("host", F.lit("")).alias("host"), "text").where("text is not null and row_key is not null")
    templates = stage(induce(pages), "templates")
    n = templates.count()
    sc = pages.sparkSession.sparkContext
    shipped_model = sc.broadcast((model.tri, model.margin, model.floor)) if model else None
    if n <= MAX_TEMPLATE_NODES:
        nodes: dict[str, list] = {}
        for r in templates.collect():
            nodes.setdefault(r.host, []).append((r.label, r.place))
        shipped = sc.broadcast(nodes)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m = Model(*shipped_model.value) if shipped_model else None
            built: dict[str, Template] = {}

            def of(h: str) -> Template:
                if h not in built:
                    built[h] = Template(shipped.value.get(h, []))
                return built[h]

            for b in batches:
                yield _classify(zip(b["src"], b["row_key"], b["host"], b["text"]), of, m)

        return pages.mapInPandas(run, FOUND)
    by_host = templates.groupBy("host").agg(F.collect_list(F.struct("label", "place")).alias("nodes"))  # bounded: lines a page over SHARE

    def run_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*shipped_model.value) if shipped_model else None
        for b in batches:
            last: tuple = (None, None)

            def of(page: tuple[str, list | None]) -> Template:
                nonlocal last
                h, nodes = page
                if h != last[0]:
                    last = (h, Template([(x["label"], x["place"]) for x in nodes] if nodes is not None else []))
                return last[1]

            yield _classify(zip(b["src"], b["row_key"], zip(b["host"], b["nodes"]), b["text"]), of, m)

    return pages.join(by_host, "host", "left").mapInPandas(run_joined, FOUND)


def main_text(lines: list[str], flags: list[bool]) -> str:
    """The document's lines, from its heading to its signature or annex."""
    return "\n".join(x for x, f in zip(lines, flags) if not f)
