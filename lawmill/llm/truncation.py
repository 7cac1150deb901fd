"""Texts cut at a field limit or during transfer, and how often each source cuts.

Method: a structural check of completeness. A stack automaton reads each text from its first
character to its last and reports what it leaves open: brackets, curly and straight quotes, markup; beside it stand
an escape or a multibyte sequence broken at the
end, a provision or recital begun and not ended, a signature without its name, a table row
without its last cell; an end without any terminator is the weakest sign. Against that stand
the baselines of the source: a length in characters, words, parts or bytes at which texts pile up against
the lengths beside it, mostly unterminated, and beyond which fewer texts go than stop at it, is its field
limit, and all texts of that length are cut; a sign that most of a source's sound texts leave open, and
an end without terminator where most of them lack it, is its style and no sign of a cut.

Lengths are counted over all texts of a source with map-side aggregation; a source that holds
a third of all rows costs a few rows a task.

Defined results: null, empty and blank texts and texts without a doc_id aren't cases; a signature, a list of recipients or
a table ends a text as well as a full stop; marks put in place of the lost end ("…", "[...]",
"(xem tiếp)") are signs; what stands after a whole end (emoji, a special token's name) is passed
over.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lawmill.llm.boilerplate import LOWER, UPPER
from lawmill.llm.lookalike import BARRED, LOOKALIKES, direct

#: A length is a limit if this many texts have it, this share of the source's, and most of them lack an end.
LIMIT_LEAST, LIMIT_SHARE, LIMIT_OPEN = 3, 0.01, 0.5
#: Where this share of a source's texts below the limit lacks a terminator, that is its style.
STYLE_SHARE, STYLE_LEAST = 0.5, 20
#: Lengths on either side of a limit, in steps of its slack, that must hold fewer texts than the limit.
NEAR = 10
#: Bytes that a cut inside a character can cost.
BYTE_SLACK = 3

#: Marks put in place of a lost end.
MARKS = re.compile(r"(?:…|\.\.\.|\[\s*(?:\.\.\.|…)\s*\]|\((?:xem tiếp|còn nữa|more)\)|(?:…|\.\.\.)?\s*(?:Xem thêm|Đọc tiếp|Read more))\s*$", re.I)
AFTER = re.compile(r"(?:<\|[a-z_]+\|>|[☀-➿\U0001f000-\U0001faff️‍]|\s)+$")
ESCAPE = re.compile(r"(?:&#?\w{0,8}|\\u[0-9a-fA-F]{0,3}|\\x?[0-9a-fA-F]?|%[0-9A-Fa-f]?|<[/\w][^<>]{0,200})$")
OPEN_LINE = re.compile(r"(?:Điều \d+\.?|Article \d+\.?|\d+\.|[a-zđ]\)|-|Nơi nhận:|Biểu kèm theo|\(Đã ký\)|For the Council|(?:KT|TM|TL|TUQ)\. .*|(?:PHÓ )?(?:CHỦ TỊCH|BỘ TRƯỞNG|THỨ TRƯỞNG|CHÁNH VĂN PHÒNG|TỔNG CỤC TRƯỞNG))$", re.I)
OPEN_NUMBER = re.compile(r"(?:\blà|\bis|không quá|ceiling of|số|No\.) \d{1,3}(?:\.\d{3})*\.$")
MOVED = re.compile(r"(?:Căn cứ .*;|Theo đề nghị .*,|Về việc .{20,}|.{5,40}, ngày \d+ tháng \d+ năm \d{4}|- .*;|Nơi nhận:|Biểu kèm theo|Điều \d+\. .{8,})$", re.I)
CLOSED = re.compile(r"\n\s*\(Đã ký\)|\n\s*- Lưu: VT, \w{3}\.", re.I)
ROW = re.compile(r"\d+ \|")
WHOLE_ROW = re.compile(r"\d+ \| [^|]+ \| [^|]+ \| [\d.,]+ \S+$")
NAME = re.compile(rf"[{UPPER}][{LOWER}]*(?: [{UPPER}][{LOWER}]*){{2,3}}$")
BLANK = re.compile(r"[._…]{5,}$")  # of a form, to be filled in
#: What stands above a signature.
SIGNATURE = re.compile(r"^\s*(?:\(Đã ký[)）]|For the Council|(?:KT|TM|TL|TUQ)\. |(?:PHÓ )?(?:CHỦ TỊCH|BỘ TRƯỞNG|THỨ TRƯỞNG|CHÁNH VĂN PHÒNG|TỔNG CỤC TRƯỞNG|VIỆN TRƯỞNG|CHÁNH ÁN|THỐNG ĐỐC|TỔNG GIÁM ĐỐC|GIÁM ĐỐC|CỤC TRƯỞNG))", re.I | re.M)
ENDED = re.compile(rf"[.!?;:)»”/\"]$|^[{UPPER} ().,-]+$|ký\)$|^$")  # a line that a name may follow
SIGNED = re.compile(r"\(Đã ký\)$|For the Council$", re.I)
_SWAP = str.maketrans(LOOKALIKES | BARRED)
PAIRS = {")": "(", "）": "(", "]": "[", "］": "[", "}": "{", "»": "«", "”": "“", "」": "「"}
OPENERS = {"（": "(", "［": "["}
#: Elements whose end tag is required.
ELEMENTS = frozenset("a article aside b blockquote button code div em fieldset figure font footer form h1 h2 h3 h4 h5 h6 header i main nav ol pre section select span strong sub sup table textarea u ul".split())
_SIGNS = re.compile(r"[()\[\]{}«»“”「」（）［］\"]|<!--|-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)(?=[\s/>])[^<>]*>")


def left_open(text: str) -> list[str]:
    """What a stack automaton still holds at the end of a text: brackets, quotes, elements and comments of markup.

    A closing sign without its opening one ("a) ...") is passed over; a line break ends nothing; a
    straight quote closes the one that is open, else opens; elements that need no end tag are passed over.
    """
    stack: list[str] = []

    def close(x: str) -> None:
        if x in stack:
            while stack.pop() != x:
                pass

    for m in _SIGNS.finditer(text):
        c = m[0]
        if c == '"':
            close(c) if c in stack else stack.append(c)
        elif len(c) == 1:
            close(PAIRS[c]) if c in PAIRS else stack.append(OPENERS.get(c, c))
        elif c == "-->":
            close("<!--")
        elif c == "<!--":
            stack.append(c)
        elif (name := m[2].lower()) in ELEMENTS and not c.endswith("/>"):
            close(name) if m[1] else stack.append(name)
    return stack


def plain_line(s: str) -> str:
    """A line with look-alikes and unusual blanks made plain, so that its grammar shows."""
    return s if s.isascii() else direct(s).translate(_SWAP).strip()


def ending(text: str | None) -> str:
    """How a text ends: "none" (nothing there), "whole", "held" (a sentence's end, but a sign left open), "open" (no
    terminator) or "cut" (something begun and lost)."""
    if not text or not text.strip():
        return "none"
    text = text.rstrip()
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    last = lines[-1]
    if BLANK.search(last):
        return "whole"
    if last.endswith("�") or MARKS.search(last):
        return "cut"
    if not last[-1].isalnum():  # what stands after the end may fill lines of its own
        while lines and not (last := AFTER.sub("", lines[-1])):
            lines.pop()
        if not lines:
            return "none"
    last, before = (plain_line(x) for x in (last, lines[-2] if len(lines) > 1 else ""))
    if not last:
        return "whole"
    if SIGNED.search(before):
        words = last.split()
        return "whole" if len(words) >= 3 and all(w[0].isupper() for w in words) else "cut"
    if MOVED.match(last) and CLOSED.search("\n" + "\n".join(lines[:-1])):
        return "whole"  # a whole line after the signature or the recipients: it was moved, not cut
    if NAME.match(last) and (ENDED.search(before) or SIGNATURE.search(text)):  # a signature whose heading went missing or was moved
        return "whole"
    if ROW.match(last):
        return "whole" if WHOLE_ROW.match(last) else "cut"
    if last.endswith("/."):
        return "whole"
    if OPEN_LINE.match(last) or OPEN_NUMBER.search(last) or ESCAPE.search(last):
        return "cut"
    if re.match(r"(?:Căn cứ|Theo đề nghị|Số:) ", last, re.I):
        return "cut"
    held = left_open(text)
    if last[-1] in ".!?" or last[-1] in "”»\")]" and len(last) > 1 and last[-2] in ".!?":
        return "held" if held else "whole"
    if last[-1] in ",;:-(/" or left_open(last):
        return "cut"
    return "held" if held else "open"


#: The units of a field limit, with the units below it that a cut may leave: characters, words, parts between single blanks, bytes.
UNITS = {"chars": 0, "words": 0, "parts": 0, "bytes": BYTE_SLACK}
FACTS = "doc_id bigint, source string, ending string, chars bigint, words bigint, parts bigint, bytes bigint"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, s, t in zip(b["doc_id"], b["source"], b["text"]):
            e = ending(t)
            if e == "none":
                continue
            kept = t[:-1] if t.endswith("�") else t
            rows.append((i, s, e, len(t), len(t.split()), t.count(" ") + 1, len(kept.encode("utf-8", "surrogatepass"))))
        yield pd.DataFrame(rows, columns=["doc_id", "source", "ending", *UNITS])


def measure(documents: DataFrame) -> DataFrame:
    """How each non-blank text ends, and its length in every unit."""
    d = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text").where("text is not null and doc_id is not null")
    return d.mapInPandas(_read, FACTS)


def limits(facts: DataFrame) -> DataFrame:
    """The field limits: (source, unit, longest, slack). Of a source and unit at most one row.

    The windows run over the distinct lengths of a source, at most as many as its longest text is long.
    """
    unit = F.explode(F.array(*(F.struct(F.lit(u).alias("unit"), F.col(u).alias("n"), F.lit(s).alias("slack")) for u, s in UNITS.items()))).alias("x")
    at = facts.select("source", "ending", unit).select("source", "x.*", (~F.col("ending").isin("whole", "held")).alias("open"))
    counts = at.groupBy("source", "unit", "n", "slack").agg(F.count("*").alias("texts"), F.sum(F.col("open").cast("long")).alias("open"))
    w = W.partitionBy("source", "unit").orderBy("n")

    def held(column: str, first: int, last: int) -> Column:
        return F.coalesce(F.sum(column).over(w.rangeBetween(first, last)), F.lit(0))

    def by_slack(f: Callable[[int], Column]) -> Column:
        return F.when(F.col("slack") == 0, f(0)).otherwise(f(BYTE_SLACK))

    c = counts.select(
        "source", "unit", "n", "slack", by_slack(lambda s: held("texts", -s, 0)).alias("texts"), by_slack(lambda s: held("open", -s, 0)).alias("open"),
        by_slack(lambda s: held("texts", -s - NEAR * (s + 1), -s - 1) + held("texts", 1, NEAR * (s + 1))).alias("beside"),
        held("texts", 1, W.unboundedFollowing).alias("longer"), F.sum("texts").over(W.partitionBy("source", "unit")).alias("all"),
    )
    # a limit gathers texts, and few go beyond it; lengths that merely end there thin out
    c = c.where((F.col("texts") > F.col("beside")) & (F.col("longer") <= F.col("texts")))
    c = c.where((F.col("texts") >= LIMIT_LEAST) & (F.col("texts") >= LIMIT_SHARE * F.col("all")) & (F.col("open") >= LIMIT_OPEN * F.col("texts")))
    best = c.groupBy("source", "unit", "slack").agg(F.max_by("n", F.struct("texts", -F.col("n"))).alias("longest"))
    return best.select("source", "unit", "longest", "slack")


def judge(facts: DataFrame) -> DataFrame:
    """``facts`` with column ``cut``; they should be written or cached, as they are read several times."""
    wide = limits(facts).groupBy("source").agg(*(F.max(F.when(F.col("unit") == u, F.col("longest"))).alias(f"max_{u}") for u in UNITS))
    f = facts.join(wide, "source", "left")
    at_limit = F.lit(False)
    for u, slack in UNITS.items():
        at_limit = at_limit | F.coalesce(F.col(u).between(F.col(f"max_{u}") - slack, F.col(f"max_{u}")), F.lit(False))
    f = f.withColumn("at_limit", at_limit)
    share = lambda *e: F.avg(F.col("ending").isin(*e).cast("double"))
    style = f.where(~F.col("at_limit")).groupBy("source").agg(F.count("*").alias("below"), share("open").alias("bare"), share("held").alias("loose"))
    f = f.join(style, "source", "left")
    styled = lambda c: F.coalesce((F.col("below") >= STYLE_LEAST) & (F.col(c) >= STYLE_SHARE), F.lit(False))
    cut = F.col("at_limit") | (F.col("ending") == "cut") | ((F.col("ending") == "open") & ~styled("bare")) | ((F.col("ending") == "held") & ~styled("loose"))
    return f.select("doc_id", "source", "ending", "at_limit", cut.alias("cut"))
