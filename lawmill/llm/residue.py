"""Template residue, filler, error pages, waiting, login and script notices instead of content.

Method: lines that carry evidence are found in one pass; normalised lines (digits folded,
blanks collapsed) are counted by host in distinct documents, told apart by what a record holds besides
its evidence lines: an error page copied to many rows counts once. A line that recurs on a large share of
its host's distinct documents is the site's boilerplate and is subtracted; a record whose residual
lines still carry evidence is excluded, and so is one that holds nothing but evidence lines. Only evidence
lines are counted: a line without evidence can't change the outcome, so the shuffle holds a few rows
in a hundred records and a hash a record instead of every line of the corpus.

Evidence is of two kinds. Marks of template engines and programs (placeholders, stack traces, bodies of failed calls) and
filler count wherever they stand. Notices (status lines, errors, waiting, login, scripts required) count by
their grammar, and only in a sentence that lays nothing down: a sentence of the law ("the portal must report error 404 ...",
"whoever ... shall ...") merely speaks of such matters. Filler is a line of the customary pseudo-Latin words, or
one phrase set again and again.

Defined results: null, empty and blank texts aren't cases; a text of any length is
scanned whole; a record with several kinds of evidence gives one row; repeated keys give
one row; a record without a key can't be named and gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawmill.session import stage

#: A line is boilerplate if it is on this share of its host's distinct documents, and on this many at least.
BOILERPLATE_SHARE, BOILERPLATE_LEAST = 0.05, 20

#: Marks of template engines and programs.
_UP = "A-ZÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝĂĐĨŨƠƯ" + "".join(chr(c) for c in range(0x1EA0, 0x1EFA, 2))
PLACEHOLDERS = (
    r"\{\{[^{}\n]*\}\}|\{%[^%\n]*%\}|<%[^%\n]*%>|[$#]!?\{[A-Za-z_][\w.]*\}|%%\w+%%|\[{2}\w+\]{2}|__[A-Z0-9_]{3,}__"
    rf"|@Model\.\w|«[^«»\s]*_[^«»\s]*»|<[{_UP}]{{2,}}(?: [{_UP}]{{2,}})+>|\[[{_UP}]{{2,}}(?: [{_UP}]{{2,}})+\]"
    r"|\[(?:[Nn]hập|[Đđ]iền|[Ii]nsert|[Ee]nter|[Yy]our) [^\]\n]*\]|\$[A-Z][A-Z_]{2,}\$"
    r"|#(?:REF!|N/A|VALUE!|NAME\?|DIV/0!|NULL!|NUM!)|\$\$\w+\$\$|<\?php|<\w+_\w+>|\{[A-Za-z]+_\w+\}|\(null\)"
    r"|\{\d\}/\{\d\}|undefined/NaN|NaN/undefined|\[object Object\]|System\.Data\.DataRowView"
)
#: What setters put in for text, and servers and programs write when they fail.
PROGRAMS = (
    r"[Ll]orem ipsum|"
    r"\bat [\w.$]+\([\w.: ]*\)|\b[\w.]*\w\.\w*(?:Exception|Error): |\b(?:Warning|Fatal error|Notice): \w+\(|Fatal error:|Traceback \(most recent"
    r"|\{\"code\":\d+,\"message\"|Object reference not set|\bORA-\d{5}:|SQLSTATE\["
)
#: Reason phrases of failed requests.
REASON = (
    "Bad Request|Unauthori[sz]ed|Forbidden|(?:Page )?[Nn]ot [Ff]ound|Method Not Allowed|Request Time-?out|Gone|Too Many Requests|Internal (?:Server )?Error|Not Implemented|Bad Gateway"
    "|Service (?:Temporarily )?Unavailable|Gateway Time-?out|Không tìm thấy(?: trang| nội dung)?|Access [Dd]enied|Truy cập bị từ chối"
)
STATUS = rf"\b[45]\d\d\b\s*[-–—:.|]?\s*(?:{REASON})\b|HTTP(?:/\d\.\d)? (?:Error )?[45]\d\d\b|^(?:Error:? |Lỗi:? )?(?:{REASON})[.!]*$"
#: Errors told to a reader.
ERRORS = (
    r"You don't have permission to (?:view|access)|The page you (?:are looking for|requested)|^Không tìm thấy trang|[Đđ]ường dẫn bạn (?:yêu cầu|truy cập)|[Tt]rang bạn (?:tìm|yêu cầu)"
    r"|^Lỗi(?:!|: không) |Quá nhiều yêu cầu từ|[Ss]omething went wrong|[Đđ]ã (?:có|xảy ra) lỗi\b"
)
#: Waiting, login and maintenance messages.
NOTICES = (
    r"Just a moment\.\.\.|Checking (?:if the connection|your browser)|[Vv]erify(?:ing)? (?:that )?you are (?:a )?human|xác minh (?:rằng )?bạn không phải|Đang tải (?:dữ liệu|trang|nội dung)|^Loading(?:\.\.\.|…)"
    r"|[Nn]ội dung đang được cập nhật|[Tt]rang (?:web |này )?(?:đang|chưa) (?:được )?(?:xây dựng|hoàn thiện|bảo trì)|chưa có nội dung tiếng|Nhấn F\d+ để|Hệ thống đang bảo trì|Mong quý vị thông cảm"
    r"|[Pp]hiên làm việc (?:của bạn )?đã hết hạn|[Ss]ession (?:has )?(?:expired|timed out)|Hãy đăng nhập|[Vv]ui lòng đăng nhập|[Pp]lease (?:log|sign) in|^(?:Tên đăng nhập|Mật khẩu|Quên mật khẩu\?)$|Bạn chưa đăng ký gói"
    r"|[Tt]hử lại sau \d|^(?:(?:This )?(?:[Ss]ite|[Pp]age) (?:is )?)?[Uu]nder (?:[Cc]onstruction|[Mm]aintenance)\b|^Coming [Ss]oon\b"
)
#: That scripts are off, or are wanted.
_SCRIPT, _WANTED = r"(?:[Jj]ava[Ss]cript|\bscripts?\b|tập lệnh)", r"(?:[Ee]nabled?|[Tt]urn(?:ed)? (?:on|off)|[Dd]isabled|[Rr]equires?|[Nn]eeds?|[Ss]upport|bật|tắt|không (?:hỗ trợ|chạy))"
SCRIPTS = rf"{_WANTED}[^.!?\n]{{0,30}}{_SCRIPT}|{_SCRIPT}[^.!?\n]{{0,30}}{_WANTED}|[Tt]rình duyệt (?:của bạn )?không (?:chạy|hỗ trợ)"
#: Words of sentences that lay something down.
NORM = re.compile(r"(?<!không )\bphải\b|\bthì\b|có trách nhiệm|\bkhông được\b|theo (?:hướng dẫn|quy định)|\bshall\b|\b(?:portal|site|office|authority|agency|provider)s? must\b|^(?:Điều|Article|Khoản) \d", re.I)
#: The customary filler words of four letters or more; a line is filler if so many of its words, and this share, are among them.
LATIN = frozenset((
    "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat "
    "duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum "
    "vitae congue mollis risus magnis orci turpis tempus sodales bibendum fringilla lacus ornare pharetra porttitor vestibulum pellentesque curabitur maecenas phasellus"
).split())
LATIN_WORDS, LATIN_SHARE = 4, 1 / 4
#: A line is filler too if it has so many words and so few different ones: a phrase set again and again.
REPEATED_WORDS, REPEATED_SHARE = 8, 1 / 3
#: Letters whose lines are searched at once.
AT_ONCE = 2_000_000

#: Strings one of which each alternative above contains, but for calls in a stack trace: only lines with one of them, or such a call, are looked at.
TRIGGERS = (
    "{", "<", "[", "__", "%%", "@Model.", "«", "$", "(null)", "Warning: ", "Notice: ", "undefined/", "/undefined", "System.Data.DataRowView", "#REF!", "#N/A", "#VALUE!", "#NAME?", "#DIV/0!", "#NULL!", "#NUM!", "ORA-", "SQLSTATE",
    "orem ipsum", "xception: ", "rror", "Traceback", "Object reference", "Bad Request", "nauthori", "orbidden", "ot Found", "ot found", "ot Allowed", "imeout", "ime-out", "Gone", "Too Many", "ot Implemented", "Bad Gateway", "navailable", "ccess Denied", "ccess denied", "HTTP",
    "You don't", "The page you", "hông tìm thấy", "ruy cập bị", "ường dẫn bạn", "rang bạn", "Lỗi", " lỗi", "Quá nhiều yêu", "omething went", "Just a moment", "Checking ", "erify", "xác minh", "Đang tải", "Loading", "đang được cập", "chưa có nội dung",
    "rang web ", "rang này ", "rang đang ", "rang chưa ", "đang bảo trì", "Nhấn F", "Mong quý", "hiên làm", "ession ", "ăng nhập", "lease log", "lease sign", "Mật khẩu", "Quên mật", "Bạn chưa", "hử lại sau", "nder con", "nder Con", "nder main", "nder Main", "Coming", "cript", "tập lệnh", "rình duyệt",
)

MARKS = re.compile("|".join((PLACEHOLDERS, PROGRAMS)), re.M)
NOTICE = re.compile("|".join((STATUS, ERRORS, NOTICES, SCRIPTS)), re.M)
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")

#: For Arrow, whose expressions run over the lines of a whole batch: a trigger; a blank that parts words otherwise than one space does.
_TRIGGER, _ODD_BLANK = "|".join((r"at [^ ]+\(", *map(re.escape, TRIGGERS))), "[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|  "

LINES = "src string, row_key bigint, host string, line string, rest bigint, bare boolean"


def normalise_line(s: str) -> str:
    return re.sub(r"\d+", "0", re.sub(r"\s+", " ", s)).strip()


def repeated(words: list[str]) -> bool:
    return len(words) >= REPEATED_WORDS and len(set(words)) <= len(words) * REPEATED_SHARE


def filler(line: str) -> bool:
    """Whether a line is a phrase set again and again, or pseudo-Latin."""
    raw = line.split()
    if line.isascii() and len(raw) >= LATIN_WORDS:
        words = re.findall(r"[a-z]+", line.lower())
        latin = sum(w in LATIN for w in words)
        if latin >= LATIN_WORDS and latin >= len(words) * LATIN_SHARE:
            return True
    return len(raw) >= REPEATED_WORDS and len(set(raw)) * 2 <= len(raw) and repeated(re.findall(r"\w+", line.lower()))


def notice(line: str, m: re.Match) -> bool:
    """Whether the sentence of a line around a match lays nothing down."""
    a = b = 0
    for cut in _SENTENCE.finditer(line):
        if cut.start() >= m.end():
            b = cut.start()
            break
        if cut.end() <= m.start():
            a = cut.end()
    return not NORM.search(line[a : b or len(line)])


def _maybe_filler(lines: pa.Array) -> np.ndarray:
    """Of which lines ``filler`` has to look at the words: of all that it holds for, and few others.

    A line has as many different words at least as there are bits among them, where each word has one of 64.
    """
    words = pc.split_pattern(lines, " ")
    starts, n = words.offsets.to_numpy()[:-1], np.diff(words.offsets.to_numpy())
    bits = np.uint64(1) << (words.flatten().dictionary_encode().indices.to_numpy() & 63).astype(np.uint64)
    few = (n >= REPEATED_WORDS) & (np.bitwise_count(np.bitwise_or.reduceat(bits, starts)) * 2 <= n + 2)  # a blank at an end parts off an empty word
    odd = pc.match_substring_regex(lines, _ODD_BLANK).to_numpy(zero_copy_only=False)
    # a line of few words is no filler
    return (n >= LATIN_WORDS) & (few | odd | pc.string_is_ascii(lines).to_numpy(zero_copy_only=False))


def evidence(texts: Iterable[str | None]) -> list[list[str]]:
    """For each text its normalised lines that carry evidence."""
    out: list[list[str]] = []
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size > AT_ONCE:
            out += _evidence(held)
            held, size = [], 0
    return out + _evidence(held) if held else out


def _evidence(texts: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in texts]
    split = pc.split_pattern(pa.array(texts, pa.large_string()), "\n")
    lines, ends = split.flatten(), split.offsets.to_numpy()[1:]

    def those(which: np.ndarray) -> Iterator[tuple[int, str]]:
        at = np.flatnonzero(which)
        return zip(np.searchsorted(ends, at, side="right").tolist(), lines.take(pa.array(at)).to_pylist())

    for i, line in those(_maybe_filler(lines)):
        if filler(line):
            out[i].append(normalise_line(line))
    for i, line in those(pc.match_substring_regex(lines, _TRIGGER).to_numpy(zero_copy_only=False)):
        if MARKS.search(line) or any(notice(line, m) for m in NOTICE.finditer(line)):
            out[i].append(normalise_line(line))
    return out


def evidence_lines(text: str | None) -> list[str]:
    """The normalised lines of a text that carry evidence."""
    return evidence([text])[0]


def remainder(text: str, evidence: list[str]) -> str:
    """The lines of a text besides its evidence lines."""
    return "\n".join(x.strip() for x in text.split("\n") if x.strip() and normalise_line(x) not in evidence)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for s, k, h, t, found in zip(b["src"], b["row_key"], b["host"], b["text"], evidence(b["text"])):
            if found:
                rest = remainder(t, found)
                mark = int.from_bytes(hashlib.blake2b(rest.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
                rows += [(s, k, h, line, mark, not rest) for line in found]
        yield pd.DataFrame(rows, columns=["src", "row_key", "host", "line", "rest", "bare"])


def residue_records(texts: DataFrame, share: float = BOILERPLATE_SHARE, least: int = BOILERPLATE_LEAST) -> DataFrame:
    """(src, row_key) of the records to exclude, of ``texts`` (src, row_key, host, text; other columns are ignored)."""
    t = texts.where("row_key is not null").select("src", "row_key", F.coalesce("host", F.lit("")).alias("host"), "text")
    t = t.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    lines = t.mapInPandas(_scan, LINES).distinct()
    lines = stage(lines, "residue-lines")  # few rows, read several times: the texts are scanned once
    counts = lines.groupBy("src", "host", "line").agg(F.countDistinct("rest").alias("n")).where(F.col("n") >= least)
    # of each host, how many distinct texts there are: one row a host, joined to the few lines that recur
    sizes = t.select("src", "host", F.xxhash64("text").alias("text")).distinct().groupBy("src", "host").agg(F.count("*").alias("documents"))
    boilerplate = counts.join(sizes, ["src", "host"]).where(F.col("n") >= share * F.col("documents")).select("src", "host", "line", F.lit(True).alias("common"))
    left = lines.join(boilerplate, ["src", "host", "line"], "left").where("common is null or bare").select("src", "row_key").distinct()
    return stage(left, "residue-found")  # its written size tells a later join that it is small


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]+)", 1))


def corpus_texts(vbpl: DataFrame | None = None, tvpl: DataFrame | None = None, documents: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """The texts of the given tables as (src, row_key, host, text). A document's host is its site section."""
    parts = []
    if vbpl is not None:
        parts.append(vbpl.select(F.lit("vbpl_records").alias("src"), F.col("record_id").alias("row_key"), host_of(F.col("url")).alias("host"), "text"))
    if tvpl is not None:
        parts.append(tvpl.select(F.lit("tvpl_documents").alias("src"), F.col("row_id").alias("row_key"), host_of(F.col("url")).alias("host"), F.col("content_text").alias("text")))
    if documents is not None:
        parts.append(documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("row_key"), F.coalesce("source", F.lit("")).alias("host"), "text"))
    if pages is not None:
        parts.append(pages.select(F.lit("ministry_pages").alias("src"), F.col("page_id").alias("row_key"), host_of(F.col("url")).alias("host"), "text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
