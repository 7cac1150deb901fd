"""Text decoded with the wrong character encoding: found and, where nothing was lost, restored.

Method: a smoothed character trigram model is trained on all clean records; every chain of
encodings and decodings that applies to a line is scored by the model, and the
likeliest is accepted if its gain per character is beyond a margin. A step of a chain encodes the line by any of
the encodings it may have been read as (single-byte and multi-byte) and decodes it by any it may have been written in (UTF-8,
the Vietnamese code page, the two legacy Vietnamese font encodings); chains go on as long as a step undoes UTF-8, each of
which shortens the text. The margin is validated on every clean line, held out in turn: the model of the other folds
tells what the likeliest chain gains on the line as it is and what undoing each of ``VALIDATED`` gains on the line once garbled. The
cut between the two that misplaces the fewest lines is taken, and the margin lies a tenth of the way from
the largest gain of a sound line below it to the least gain of a garbled one above it.

Lines in which characters were replaced by U+FFFD or "?" can't be restored; they are found
by the mark itself where it stands inside words the model knows nothing like.

The model is the count of trigrams over a fixed alphabet: at most ``len(ALPHABET) ** 3`` numbers,
whatever the corpus. Only lines with an unusual character are scored.

Defined results: null, empty and blank values and values without a key aren't garbled; a value is garbled if any line of it
is; a replacement character that ends the value (a cut, not a wrong decoding) is none; a line
that no chain improves is kept as it is.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOWELS = "aàáảãạăằắẳẵặâầấẩẫậeèéẻẽẹêềếểễệiìíỉĩịoòóỏõọôồốổỗộơờớởỡợuùúủũụưừứửữựyỳýỷỹỵđ"
ALPHABET = "".join(dict.fromkeys(" " + VOWELS + "".join(map(chr, range(33, 127))).lower()))
UNKNOWN = len(ALPHABET)
WIDTH = UNKNOWN + 1
#: Parts of the clean records, each of which is validated by the model of the others; letters beyond which a line is validated.
FOLDS, LINE = 4, 20
SMOOTHING = 0.05
#: Letters up to which a line's likeliest chain is remembered, and of how many lines.
SHORT, KNOWN = 110, 20_000

_INDEX = np.full(0x110000, UNKNOWN, dtype=np.uint8)
for _i, _c in enumerate(ALPHABET):
    for _x in {_c, _c.upper()}:
        if len(_x) == 1:
            _INDEX[ord(_x)] = _i
_INDEX[[10, 13, 9]] = 0

USUAL = "".join(map(re.escape, sorted(set(VOWELS + VOWELS.upper())))) + r"\x20-\x7e\t\r\n"
ODD = re.compile(f"[^{USUAL}]")
#: Tone marks of the Vietnamese code page read as letters: usual letters, in an order that no word has.
STACKED = re.compile("[ÌÒìò](?:(?<=[a-zâêôăơưđ][ÌÒ])|(?<=[aeâêôý][ìò])|(?<=[^gG]i[ìò]))")
#: Signs that sound lines hold besides; none of them alone makes a line odd that has other letters than Latin-1's.
SIGNS = set("©·»«▲°±²³µ½¼¾…–—“”‘’")
BEYOND = re.compile("[Ā-ỿ]")
LOST_MARK = re.compile(r"\?\w|\w\?\?+")
QUESTION = re.compile(r"(?<![\w/])\?+\w|\w\?+\w|\w\?\?+")

#: Encodings that bytes may have been read as: single-byte ones, whose undefined bytes stand for themselves, and multi-byte ones.
CODE_PAGES = ("latin-1", "cp1252", "cp1258", "cp1251", "cp1250", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp437", "cp850", "cp866", "cp874", "iso8859_2", "iso8859_5", "iso8859_15", "mac_roman", "koi8_r")
WIDE_PAGES = ("gbk", "cp932", "big5", "cp949")
#: Single-byte encodings that text may have been written in, besides UTF-8 and the fonts, with the bytes of their tone marks after a letter.
WRITTEN = {"cp1258": re.compile(rb"[A-Za-z\xc0-\xff][\xcc\xd2\xde\xec\xf2]")}
#: Where the margin lies between clean and garbled lines, and the chains it is validated on.
MARGIN_SHARE = 0.1
VALIDATED = ("utf-8 as latin-1", "utf-8 as cp1252", "utf-8 as cp1252 as cp1252", "utf-8 as cp1251", "utf-8 as mac_roman", "tcvn3")

#: The TCVN3 font encoding, as its bytes look in Latin-1, and the letters they stand for.
TCVN3 = dict(zip(
    "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòô­õøö÷ùúýûüþ¡¢§£¤¥¦",
    "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵĂÂĐÊÔƠƯ",
))
#: The VNI font encoding: marks typed after a letter, and letters with a code of their own.
VNI_MARKS = {"ù": "́", "ø": "̀", "û": "̉", "õ": "̃", "ï": "̣", "â": "̂", "á": "̂́", "à": "̂̀", "å": "̂̉", "ã": "̂̃", "ä": "̣̂", "ê": "̆", "é": "̆́", "è": "̆̀", "ú": "̆̉", "ü": "̆̃", "ë": "̣̆"}
VNI_LETTERS = {"ñ": "đ", "ô": "ơ", "ö": "ư", "æ": "ỉ", "ó": "ĩ", "ò": "ị", "î": "ỵ"}


def _page_table(page: str) -> dict[str, int]:
    """The bytes of a code page by character; bytes it leaves undefined stand for themselves."""
    out = {}
    for b in range(256):
        try:
            out.setdefault(bytes([b]).decode(page), b)
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


_PAGES = {p: _page_table(p) for p in CODE_PAGES}


def _bytes_read_as(page: str, s: str) -> bytes | None:
    """The bytes that were read as ``s``; None where the encoding doesn't have its characters."""
    if page in WIDE_PAGES:
        try:
            return s.encode(page)
        except UnicodeEncodeError:
            return None
    table = _PAGES[page]
    try:
        return bytes(map(table.__getitem__, s))
    except KeyError:
        return None


#: Usual letters that no step of a chain can undo: a line with one of them has no chain.
_FIRM = re.compile("[" + "".join(c for c in sorted(set(VOWELS + VOWELS.upper())) if ord(c) > 255 and not any(_bytes_read_as(p, c) is not None for p in (*CODE_PAGES, *WIDE_PAGES))) + "]")


def _utf8(raw: bytes, page: str) -> str | None:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return _with_blanks(raw, _PAGES[page].get("\xa0", 0xA0)) if page in _PAGES else None


def _with_blanks(raw: bytes, no_break: int) -> str | None:
    """UTF-8 some of whose bytes were no-break spaces that a later step made ordinary blanks."""
    out, need = bytearray(raw), 0
    for i, b in enumerate(raw):
        if need:
            if b == 0x20:
                out[i] = no_break
            elif not 0x80 <= b < 0xC0:
                return None
            need -= 1
        elif b >= 0x80:
            need = 1 if 0xC2 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if 0xF0 <= b < 0xF5 else -1
            if need < 0:
                return None
    try:
        return out.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _match_case(s: str) -> str:
    """Capitals are lost in TCVN3: a word with no other small letters than the marked ones had none."""

    def word(m: re.Match) -> str:
        w = m[0]
        bare = [c for c in w if c.isascii() and c.isalpha()]
        return w.upper() if bare and all(c.isupper() for c in bare) and (len(bare) > 1 or len(w) == 1 or not w[1:].islower()) else w

    return re.sub(r"[^\W\d_]+", word, s)


def _from_tcvn3(s: str) -> str | None:
    if any(ord(c) > 255 for c in s):
        return None
    return _match_case("".join(TCVN3.get(c, c) for c in s))


def _from_vni(s: str) -> str | None:
    if any(ord(c) > 255 for c in s):
        return None
    out: list[str] = []
    for c in s:
        low = c.lower()
        base = out[-1][0] if out else ""
        if low in VNI_MARKS and base and base.lower() in "aeouyơư" and len(out[-1]) == 1:
            out[-1] += VNI_MARKS[low]
        elif low in VNI_LETTERS:
            x = VNI_LETTERS[low]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def chains(s: str) -> Iterator[tuple[str, str]]:
    """(name, text) of every chain that applies to the text, those of fewer steps first."""
    if _FIRM.search(s):
        return
    seen, level = {s}, [("", s)]
    while level:
        longer = []
        for name, t in level:
            read: dict[bytes, str] = {}
            for p in (*CODE_PAGES, *WIDE_PAGES):
                raw = _bytes_read_as(p, t)
                if raw is None or raw in read:
                    continue
                read[raw] = p
                if (u := _utf8(raw, p)) is not None and u not in seen:
                    seen.add(u)
                    longer.append((f"{name or 'utf-8'} as {p}", u))
                    yield longer[-1]
            if name or longer:
                continue  # other encodings are undone by the first step only, and where it isn't UTF-8
            for raw, p in read.items():
                for w, tones in WRITTEN.items():
                    if w != p and p not in WIDE_PAGES and tones.search(raw) and (u := unicodedata.normalize("NFC", raw.decode(w, "replace"))) not in seen and "�" not in u:
                        seen.add(u)
                        yield f"{w} as {p}", u
        level = longer
    for name, f in (("tcvn3", _from_tcvn3), ("vni", _from_vni)):
        x = f(s)
        if x is not None and x != s:
            yield name, x


def garble(s: str, chain: str) -> str | None:
    """The text as it looks after the wrong decoding that ``chain`` undoes; None where it can't pass."""
    if chain == "tcvn3":
        back = {v: k for k, v in TCVN3.items()}
        return "".join(back.get(c, back.get(c.lower(), c)) for c in s)
    written, *pages = chain.split(" as ")
    if not pages:
        return None
    try:
        raw = _marks_apart(s).encode("cp1258") if written == "cp1258" else s.encode(written)
        for i, page in enumerate(reversed(pages)):
            raw = raw if not i else s.encode("utf-8")
            s = raw.decode(page) if page in WIDE_PAGES else "".join(map({b: c for c, b in _PAGES[page].items()}.__getitem__, raw))
    except UnicodeError:
        return None
    return s


def _marks_apart(s: str) -> str:
    """The text as the Vietnamese code page writes it: letters with their hats, tone marks after them."""
    out = []
    for c in s:
        d = unicodedata.normalize("NFD", c)
        if len(d) > 1:
            tone = [m for m in d[1:] if m in "\u0300\u0301\u0303\u0309\u0323"]
            c = unicodedata.normalize("NFC", d[0] + "".join(m for m in d[1:] if m not in tone)) + "".join(tone)
        out.append(c)
    return "".join(out)


class _Memo(dict):
    """What a function gives for a key, computed when it is first asked for."""

    def __init__(self, f: Callable[[int], float]):
        self.f = f

    def __missing__(self, k: int) -> float:
        self[k] = out = self.f(k)
        return out


class Model:
    """Log-probabilities of a character after two others, interpolated with the shorter contexts."""

    def __init__(self, counts: dict[int, int], margin: float = 0.5, floor: float = -99.0):
        tri: dict[int, int] = counts
        bi: dict[int, int] = {}
        uni: dict[int, int] = {}
        ctx: dict[int, int] = {}
        for k, n in tri.items():
            bi[k % (WIDTH * WIDTH)] = bi.get(k % (WIDTH * WIDTH), 0) + n
            uni[k % WIDTH] = uni.get(k % WIDTH, 0) + n
            ctx[k // WIDTH] = ctx.get(k // WIDTH, 0) + n
        self.tri, self.bi, self.uni, self.ctx = tri, bi, uni, ctx
        self.total = sum(uni.values()) or 1
        self.margin, self.floor = margin, floor
        self._memo = _Memo(self._logp)
        self._best: dict[str, tuple[str, str, float] | None] = {}

    @cached_property
    def table(self) -> np.ndarray:
        """What ``logp`` gives, of all trigrams at once."""
        k, n = np.array(list(self.tri), dtype=np.int64), np.array(list(self.tri.values()), dtype=np.float64)
        uni = np.bincount(k % WIDTH, n, WIDTH)
        p1 = (uni + SMOOTHING) / (self.total + SMOOTHING * WIDTH)
        p1[UNKNOWN] = 1e-7
        p2 = (np.bincount(k % WIDTH**2, n, WIDTH**2).reshape(WIDTH, WIDTH) + 2 * p1) / (uni[:, None] + 2)
        p3 = np.broadcast_to((2 * p2).astype(np.float32), (WIDTH, WIDTH, WIDTH)).reshape(-1)  # a copy
        p3[k] += n.astype(np.float32)
        p3 = p3.reshape(WIDTH**2, WIDTH) / (np.bincount(k // WIDTH, n, WIDTH**2) + 2).astype(np.float32)[:, None]
        return np.log(p3, out=p3).reshape(-1)

    def logp(self, k: int) -> float:
        return self._memo[k]

    def _logp(self, k: int) -> float:
        c, b = k % WIDTH, k % (WIDTH * WIDTH)
        p1 = 0.0 if c == UNKNOWN else (self.uni.get(c, 0) + SMOOTHING) / (self.total + SMOOTHING * WIDTH)
        p1 = p1 or 1e-7
        nb = self.uni.get(b // WIDTH, 0)
        p2 = (self.bi.get(b, 0) + 2 * p1) / (nb + 2)
        p3 = (self.tri.get(k, 0) + 2 * p2) / (self.ctx.get(k // WIDTH, 0) + 2)
        return math.log(p3)

    def score(self, s: str) -> float:
        """Mean log-probability of a character."""
        codes = trigrams(s)
        return sum(map(self._memo.__getitem__, codes.tolist())) / max(1, len(codes))

    def best(self, line: str) -> tuple[str, str, float] | None:
        """(chain, text, gain) of the likeliest chain on a line."""
        options = [(self.score(t) * len(t) / len(line) if len(t) < len(line) else self.score(t), n, t) for n, t in chains(line)]
        if not options:
            return None
        raw = self.score(line)
        _, n, t = max(options, key=lambda x: x[0])  # of equals the first, which has the fewest steps
        return n, t, self.score(t) - raw

    def remembered(self, line: str) -> tuple[str, str, float] | None:
        """``best``, tried once for a short line that recurs."""
        if line in self._best:
            return self._best[line]
        out = self.best(line)
        if len(line) <= SHORT:
            if len(self._best) >= KNOWN:
                self._best.clear()
            self._best[line] = out
        return out

    def salvage(self, line: str) -> str:
        """The likeliest reading of a line some of whose bytes are gone, with U+FFFD for them."""
        best = (self.score(line), line)
        for p in ("latin-1", "cp1252", "cp1258", "cp1251", "mac_roman"):
            table = _PAGES[p]
            if all(c in table or c == "�" for c in line):
                t = bytes(table.get(c, 0xFF) for c in line).decode("utf-8", "replace")
                best = max(best, (self.score(t), t))
        return best[1]

    def verdict(self, line: str) -> tuple[str, str] | None:
        """(chain, restored) if the line is garbled, ("lost", line) if beyond repair, None if it is sound."""
        if "�" in line:
            return "lost", self.salvage(line)
        if ((odd := ODD.findall(line)) or STACKED.search(line)) and not (odd and SIGNS.issuperset(odd) and BEYOND.search(line)) and (b := self.remembered(line)) and b[2] > self.margin:
            return b[0], b[1]
        if "?" in line and QUESTION.search(line) and "://" not in line and ".aspx?" not in line:
            # the letters between the marks are known Vietnamese; the marks aren't
            if self.score(line) < self.floor:
                return "lost", line
        return None


def trigrams(s: str) -> np.ndarray:
    a = _INDEX[np.frombuffer(("  " + s).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)
    return (a[:-2] * WIDTH + a[1:-1]) * WIDTH + a[2:]


def _letters(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, lengths) of lines written one after another, two blanks before each."""
    return np.frombuffer("".join("  " + x for x in lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))


def _codes(places: np.ndarray) -> np.ndarray:
    a = places.astype(np.int32)
    out = a[:-2] * WIDTH
    out += a[1:-1]
    out *= WIDTH
    out += a[2:]
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((FOLDS, WIDTH**3), dtype=np.int64)
    held: list[list[str]] = [[] for _ in range(FOLDS)]
    size = [0] * FOLDS

    def add(fold: int) -> None:
        if held[fold]:
            letters, n = _letters(held[fold])
            own = np.ones(len(letters) - 2, dtype=bool)  # not the blanks between two texts
            ends = np.cumsum(n + 2)[:-1] - 2
            own[ends] = own[ends + 1] = False
            total[fold] += np.bincount(_codes(_INDEX[letters])[own], minlength=WIDTH**3)
        held[fold], size[fold] = [], 0

    for b in batches:
        for f, t in zip(b["fold"], b["text"]):
            if t and not ODD.search(t) and not ("?" in t and LOST_MARK.search(t)):
                held[f].append(t)
                size[f] += len(t)
                if size[f] > CHUNK:
                    add(f)
    for f in range(FOLDS):
        add(f)
        k = np.flatnonzero(total[f])
        yield pd.DataFrame({"fold": np.full(len(k), f, dtype=np.int32), "code": k, "n": total[f, k]})


#: Letters that are scored at once, and steps by which gains and scores are told apart.
CHUNK, STEPS = 500_000, 1000
STILL, GARBLED, SOUND, LOST = range(4)


def train(texts: DataFrame) -> Model:
    """The model of all clean records of ``texts`` (text), with its margin and floor validated on all their lines.

    The records are dealt to ``FOLDS`` folds by their hash; lines are validated by the model of the other folds. The driver sees
    counts over the alphabet and over the steps of gains and scores.
    """
    t = texts.select("text").where("text is not null").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    table = t.mapInPandas(_count, "fold int, code bigint, n bigint").groupBy("fold", "code").agg(F.sum("n").alias("n")).toPandas()
    counts = table.groupby("code")["n"].sum()
    model = Model(dict(zip(counts.index.tolist(), counts.tolist())))
    others: list[dict[int, int]] = []
    for f in range(FOLDS):
        rest = counts.sub(table[table["fold"] == f].set_index("code")["n"], fill_value=0)
        rest = rest[rest > 0].astype("int64")
        others.append(dict(zip(rest.index.tolist(), rest.tolist())))
    shipped = texts.sparkSession.sparkContext.broadcast(others)

    def gauge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [Model(c) for c in shipped.value]
        seen: Counter = Counter()
        for b in batches:
            for f in range(FOLDS):
                clean = (x for x in b["text"][b["fold"] == f] if "?" not in x and not ODD.search(x))
                seen.update(gauged(models[f], (line for x in clean for line in x.split("\n"))))
        yield pd.DataFrame([(k, v, n) for (k, v), n in seen.items()], columns=["kind", "step", "n"])

    rows = t.mapInPandas(gauge, "kind int, step int, n bigint").groupBy("kind", "step").agg(F.sum("n").alias("n")).collect()
    model.margin, model.floor = bounds({(r.kind, r.step): r.n for r in rows})
    return model


def gauged(model: Model, clean: Iterable[str]) -> Counter:
    """How often clean lines have which gains and scores, as (kind, step): the gain of the likeliest chain on a line as it is, of undoing each of
    ``VALIDATED`` on the line once garbled, the line's score, and its score once the letters are lost that Latin-1 doesn't have."""
    out: Counter = Counter()
    held: dict[str, int] = {}
    size = 0
    for s in clean:
        if s in held:
            held[s] += 1
        elif len(s) > LINE:
            held[s] = 1
            size += len(s)
            if size > CHUNK:
                out.update(_gauged(model, held))
                held, size = {}, 0
    if held:
        out.update(_gauged(model, held))
    return out


def _gauged(model: Model, often: dict[str, int]) -> Counter:
    out: Counter = Counter()
    for s, k in often.items():
        if not s.isascii() and not _FIRM.search(s) and (b := model.best(s)):
            out[STILL, round(b[2] * STEPS)] += k
    letters, n = _letters(list(often))
    weights = np.fromiter(often.values(), dtype=np.int64, count=len(often))

    def add(kind: int, *parts: tuple[np.ndarray, np.ndarray]) -> None:
        steps = np.concatenate([np.rint(values[those] * STEPS).astype(np.int64) for values, those in parts])
        if len(steps):
            low = steps.min()
            counts = np.bincount(steps - low, np.concatenate([weights[those] for _, those in parts]))
            at = np.flatnonzero(counts)
            out.update(dict(zip(((kind, x) for x in (at + low).tolist()), counts[at].astype(np.int64).tolist())))

    places = _INDEX[letters]
    sound = _means(model, places, n)
    add(SOUND, (sound, n > 0))
    lost = letters > 255
    add(LOST, (_means(model, np.where(lost, _INDEX[ord("?")], places), n), _by_line(lost[2:], n) > 0))
    written, gains = _in_utf8(letters, n), []
    for chain in VALIDATED:
        there, m, changed = garbled_places(letters, n, chain, written)
        gains.append((sound - _means(model, there, m), changed))
    add(GARBLED, *gains)
    return out


def _by_line(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sums of the values of each line; those of the blanks between lines are left out."""
    starts = np.cumsum(n + 2) - n - 2
    return np.add.reduceat(values, np.stack((starts, starts + n), axis=1).reshape(-1)[:-1], dtype=np.float64)[::2]


def _means(model: Model, places: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What ``Model.score`` gives for each line, from its letters' places in the alphabet."""
    return _by_line(model.table[_codes(places)], n) / n


@lru_cache(maxsize=None)
def _page(page: str) -> tuple[np.ndarray, bytes]:
    """The letters of an encoding's bytes, and their places in the alphabet."""
    letters = np.zeros(256, dtype=np.uint32)
    for c, b in _PAGES[page].items():
        letters[b] = ord(c)
    return letters, _INDEX[letters].tobytes()


@lru_cache(maxsize=None)
def _tcvn3_letters() -> np.ndarray:
    out = np.arange(0x110000, dtype=np.uint32)
    for c in set(VOWELS + VOWELS.upper()):
        out[ord(c)] = ord(garble(c, "tcvn3"))
    return out


def _in_utf8(letters: np.ndarray, n: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bytes, lengths) of lines in UTF-8."""
    width = (letters >= 0x80).astype(np.uint8)
    width += letters >= 0x800
    width += letters >= 0x10000
    return letters.tobytes().decode("utf-32-le").encode("utf-8"), n + _by_line(width[2:], n).astype(np.int64)


def garbled_places(letters: np.ndarray, n: np.ndarray, chain: str, written: tuple[bytes, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in the alphabet, lengths, whether changed) of lines as ``garble`` leaves them, by UTF-8 read as single-byte encodings or by TCVN3.

    ``written``: the lines in UTF-8, where known.
    """
    if chain == "tcvn3":
        other = _tcvn3_letters()[letters]
        return _INDEX[other], n, _by_line((other != letters)[2:], n) > 0
    raw, m = written or _in_utf8(letters, n)
    *later, first = chain.split(" as ")[1:]
    last = first
    for page in reversed(later):
        raw, m = _in_utf8(_page(last)[0][np.frombuffer(raw, dtype=np.uint8)], m)
        last = page
    return np.frombuffer(raw.translate(_page(last)[1]), dtype=np.uint8), m, m != n


def parted(sound: dict[int, int], bad: dict[int, int]) -> tuple[int | None, int | None]:
    """(largest of ``sound`` below, least of ``bad`` above) the cut that misplaces the fewest, of equals the highest one."""
    values = np.array(sorted({*sound, *bad}), dtype=np.int64)
    below = np.cumsum([0, *(bad.get(v, 0) for v in values.tolist())])
    above = sum(sound.values()) - np.cumsum([0, *(sound.get(v, 0) for v in values.tolist())])
    wrong = below + above
    cut = len(wrong) - 1 - int(np.argmin(wrong[::-1]))
    return max((v for v in values[:cut].tolist() if v in sound), default=None), min((v for v in values[cut:].tolist() if v in bad), default=None)


def bounds(seen: dict[tuple[int, int], int]) -> tuple[float, float]:
    """(margin, floor): the margin lies ``MARGIN_SHARE`` of the way from the largest gain on a clean line to the smallest gain on a garbled one,
    the floor below the clean lines' scores, both at the cuts that misplace the fewest lines."""
    of = [{v: n for (k, v), n in seen.items() if k == kind} for kind in range(4)]
    if not of[SOUND]:
        return 0.5, -4.0
    still, gain = parted(of[STILL], of[GARBLED])
    low, high = max(still or 0, 0) / STEPS, 1.0 if gain is None else gain / STEPS
    score, _ = parted({-v: n for v, n in of[SOUND].items()}, {-v: n for v, n in of[LOST].items()})
    return max(low + MARGIN_SHARE * max(high - low, 0.0), 0.15), (-4.0 if score is None else -score / STEPS - 0.05)


def validate(model: Model, clean: list[str]) -> tuple[float, float]:
    """The (margin, floor) of a model by all of the given lines."""
    return bounds(gauged(model, clean))


def repair_value(model: Model, value: str | None) -> tuple[bool, bool, str | None, list[str]]:
    """(garbled, restored, text, chains) of a value."""
    if not value or not value.strip():
        return False, False, value, []
    if not ODD.search(value) and not ("?" in value and QUESTION.search(value)) and not STACKED.search(value):
        return False, False, value, []
    body = value.rstrip()
    lines = value.split("\n")
    found, lost, out = [], False, []
    for i, line in enumerate(lines):
        probe = line
        if i == len(lines) - 1 and body.endswith("�") and line.count("�") == 1:
            probe = line.replace("�", "")
        if not (ODD.search(probe) or "?" in probe and QUESTION.search(probe) or STACKED.search(probe)) or not (v := model.verdict(probe)):
            out.append(line)
            continue
        found.append(v[0])
        lost |= v[0] == "lost"
        out.append(v[1])
    return bool(found), bool(found) and not lost, "\n".join(out), sorted(set(found))


FOUND = "src string, row_key bigint, field string, restored boolean, chains array<string>, text string"


def repair(values: DataFrame, model: Model) -> DataFrame:
    """The garbled ones of ``values`` (src, row_key, field, value), with the chains undone and the text restored."""
    shipped = values.sparkSession.sparkContext.broadcast((model.tri, model.margin, model.floor))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*shipped.value)
        for b in batches:
            rows = []
            for s, k, f, v in zip(b["src"], b["row_key"], b["field"], b["value"]):
                bad, ok, text, names = repair_value(m, v)
                if bad:
                    rows.append((s, k, f, ok, names, text))
            yield pd.DataFrame(rows, columns=["src", "row_key", "field", "restored", "chains", "text"])

    return values.where("value is not null and row_key is not null").select("src", "row_key", "field", "value").mapInPandas(run, FOUND)


def tvpl_values(tvpl: DataFrame, fields: tuple[str, ...] = ("title", "content_text")) -> DataFrame:
    items = [F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]
    return tvpl.select(F.lit("tvpl_documents").alias("src"), F.col("row_id").alias("row_key"), F.explode(F.array(*items)).alias("x")).select("src", "row_key", "x.*")


def repair_tvpl(tvpl: DataFrame, fields: tuple[str, ...] = ("title", "content_text")) -> DataFrame:
    """The garbled titles and texts; the model is trained on both fields' clean values in either case."""
    model = train(tvpl_values(tvpl).select(F.col("value").alias("text")))
    return repair(tvpl_values(tvpl, fields), model)
