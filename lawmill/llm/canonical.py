"""Freely typed values mapped to the closest entry of a reference list.

Method: the distinct values of the corpus are looked up in a symmetric-delete dictionary
of the reference list (every spelling of an entry, without accents and blanks, with up to two characters deleted),
which is broadcast; the candidates within the bound of edits are ranked, accents and blanks and all, by a weighted
Damerau-Levenshtein distance (an accent costs less than a blank, a blank less than a letter) and then by how often the corpus
spells the entry exactly; values without a candidate within the bound are reported as
misses (canon_id -1).

Only distinct values are resolved, after a map-side aggregation, in tasks of their own number, and joined back, so a
value that a third of the rows share costs one lookup and the join has one row for it on
the dictionary's side. A reference list beyond ``MAX_ENTRIES`` isn't broadcast: its deletions are a table then, which the
deletions of the values are joined with.

Defined results: null values give no row; an empty or blank value is a miss; of entries
equally near, the more frequent one in the corpus wins, then the smaller canon_id;
repeated entries keep the smallest canon_id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lawmill.session import stage

MISS = -1
#: Entries up to which the lists are broadcast.
MAX_ENTRIES = 20_000
MAX_EDITS = 2
TASKS_PER_CORE = 4
#: Costs of the weighted distance.
ACCENT_COST, SPACE_COST, EDIT_COST = 0.3, 0.5, 1.0
#: A spelling of at most this cost has all its telling words in full, so that edits are sought near it.
FULL_COST = 0.1

#: What typists put around a value.
DECORATION = re.compile(r"^\s*(?:[^\W\d_][^:]{0,18}:\s+|[-–(\[•*]+\s*)|\s*(?:[;.,*)\]]+|\((?:cập nhật|cap nhat)\)|-\s*bản điện tử|-\s*ban dien tu)\s*$", re.I)


def compose(s: str) -> str:
    return re.sub(r"\s+", " ", re.sub("[​-‍⁠﻿­]", "", unicodedata.normalize("NFKC", s))).strip()


def plain(s: str) -> str:
    """Lower case, without accents."""
    s = unicodedata.normalize("NFD", s.lower().replace("đ", "d"))
    return "".join(c for c in s if not unicodedata.combining(c))


def key(s: str) -> str:
    """Letters and digits of the plain form."""
    return re.sub(r"[^a-z0-9]", "", plain(s))


def untelex(s: str) -> str:
    """The plain key of a value typed in Telex without an input method."""
    words = []
    for w in re.findall(r"[a-z]+", s.lower()):
        w = re.sub(r"(?<=[a-z])[sfrxj]$", "", w)
        words.append(w.replace("dd", "d").replace("aa", "a").replace("ee", "e").replace("oo", "o").replace("aw", "a").replace("ow", "o").replace("uw", "u"))
    return "".join(words)


def untelex_text(s: str) -> str:
    """The words of a value typed in Telex without an input method, without accents."""
    return " ".join(untelex(w) for w in s.split())


def distance(a: str, b: str, bound: float) -> float:
    """Weighted Damerau-Levenshtein distance of two lower-case strings, at most about ``bound``.

    Characters change places over others too, which are then deleted or inserted between them.
    """
    if a == b:
        return 0.0
    pa, pb = plain(a), plain(b)
    if len(pa) != len(a) or len(pb) != len(b):  # a character that is several without its accent
        pa, pb = [plain(c) for c in a], [plain(c) for c in b]
    price = lambda c: SPACE_COST if c == " " else EDIT_COST
    gone, come = [0.0], [0.0]
    for c in a:
        gone.append(gone[-1] + price(c))
    for c in b:
        come.append(come[-1] + price(c))
    rows = [list(come)]
    last_row: dict[str, int] = {}
    for i in range(1, len(a) + 1):
        row, above = [gone[i]], rows[-1]
        last_column = 0
        for j in range(1, len(b) + 1):
            alike = pa[i - 1] == pb[j - 1]
            v = min(above[j - 1] + (0 if a[i - 1] == b[j - 1] else ACCENT_COST if alike else EDIT_COST), above[j] + gone[i] - gone[i - 1], row[j - 1] + come[j] - come[j - 1])
            k = last_row.get(pb[j - 1], 0)
            if k and last_column:
                v = min(v, rows[k - 1][last_column - 1] + gone[i - 1] - gone[k] + EDIT_COST + come[j - 1] - come[last_column])
            if alike:
                last_column = j
            row.append(v)
        if min(row) > bound + 1:
            return bound + 1
        last_row[pa[i - 1]] = i
        rows.append(row)
    return rows[-1][-1]


def deletes(s: str, n: int) -> set[str]:
    out = frontier = {s}
    for _ in range(n):
        frontier = {x[:i] + x[i + 1 :] for x in frontier for i in range(len(x))}
        out = out | frontier
    return out


def edits_allowed(k: str) -> int:
    return 0 if len(k) < 4 else 1 if len(k) < 10 else MAX_EDITS


def spaced(s: str) -> str:
    """Lower case, without signs, with single blanks: what distances are taken of."""
    return " ".join(re.sub(r"[^\w\s]", " ", s.lower().replace(".", "")).split())


def spellings(entry: str) -> dict[str, tuple[float, str]]:
    """Plain keys under which an entry is written in full or abbreviated, with what each costs and how it reads with accents.

    Any run of words may shrink to its initials ("UBND", "HL"), one word to its initial and
    its end ("T.tư"), a conjunction may go, "tỉnh" may go once the body before it is
    abbreviated, and "một" may be a digit.
    """
    words = spaced(compose(entry)).split()
    out: dict[str, tuple[float, str]] = {}

    def add(parts: list[str], cost: float) -> None:
        k = key("".join(parts))
        if len(k) > 1 and (k not in out or cost < out[k][0]):
            out[k] = (cost, " ".join(parts))

    def initials(part: list[str]) -> str:
        return "".join(w[0] for w in part)

    bare = [plain(w) for w in words]
    add(words, 0.0)
    bases = [words] + ([[w for w, b in zip(words, bare) if b != "va"]] if "va" in bare else [])
    if "mot" in bare:
        bases.append(["1" if b == "mot" else w for w, b in zip(words, bare)])
    for base in bases:
        n = len(base)
        add(base, 0.05 if base is not words else 0.0)
        spans = [(i, j) for i in range(n) for j in range(i + 2, n + 1)]
        for i, j in spans:
            short = initials(base[i:j])
            head, tail = base[:i], base[j:]
            cost = 0.1 if i == 0 and len(tail) >= 2 else 0.12
            add([*head, short, *tail], cost)
            if tail and plain(tail[0]) == "tinh" and i == 0:
                add([short, *tail[1:]], cost)
                add([short, "t", *tail[1:]], cost)
            for k, m in spans:
                if k >= j:
                    add([*head, short, *base[j:k], initials(base[k:m]), *base[m:]], 0.15)
        if n > 1:
            add([base[0][0] + base[1], *base[2:]], 0.12)
            for i in range(2, n):
                add([base[0][0] + "".join(base[1:i]) + initials(base[i:])], 0.15)
    return out


def readings(raw: str) -> list[tuple[str, str]]:
    """(plain key, text to compare) of every way to read a value: without its decoration, turned around, as Telex."""
    forms = [compose(raw)]
    for _ in range(3):
        cut = DECORATION.sub("", forms[-1]).strip()
        if cut == forms[-1] or not cut:
            break
        forms.append(cut)
    s = forms[-1]
    tries = [s]
    if " - " in s:
        a, _, b = s.partition(" - ")
        tries.append(f"{b} {a}")
    out = []
    for t in tries:
        out.append((key(t), spaced(t)))
        if plain(t) == t.lower():
            out.append((untelex(t), untelex_text(spaced(t))))
    return [(k, t) for k, t in out if k]


def weigh(text: str, written: str) -> float:
    """The distance of a value's text from a spelling; a text without any accent is compared without them."""
    return distance(text, written if plain(text) != text else plain(written), max(len(text), len(written)))


class Dictionary:
    """The symmetric-delete dictionary of one list."""

    def __init__(self, entries: Iterable[tuple[int, str]], counts: dict[int, int] | None = None):
        self.counts = counts or {}
        self.full: dict[str, list[tuple[int, float, str]]] = defaultdict(list)
        self.near: dict[str, set[str]] = defaultdict(set)
        self.longest = 0
        seen: set[str] = set()
        for i, e in sorted(entries):
            if e in seen:
                continue
            seen.add(e)
            for k, (c, w) in spellings(e).items():
                self.longest = max(self.longest, len(k))
                self.full[k].append((i, c, w))
                # initials stand no edit: too many words share them
                for x in deletes(k, edits_allowed(k)) if c <= FULL_COST else ():
                    self.near[x].add(k)

    def candidates(self, k: str) -> dict[int, list[tuple[float, str]]]:
        """Entries within the bound of edits, with the spellings that are near: their costs and how they read."""
        if not k or len(k) > self.longest + MAX_EDITS:
            return {}  # longer than any spelling can become
        near = {k} if k in self.full else {f for x in deletes(k, edits_allowed(k)) for f in self.near.get(x, ()) if accepted(k, f)}
        out: dict[int, list[tuple[float, str]]] = defaultdict(list)
        for f in near:
            for i, c, w in self.full[f]:
                out[i].append((c, w))
        return out

    def resolve(self, raw: str) -> int:
        found = [(k not in self.full, t, i, ways) for k, t in readings(raw) for i, ways in self.candidates(k).items()]
        if len({i for _, _, i, _ in found}) < 2:
            return found[0][2] if found else MISS
        return min((off, round(min(c + weigh(t, w) for c, w in ways), 3), -self.counts.get(i, 0), i) for off, t, i, ways in found)[3]


def accepted(k: str, spelling: str) -> bool:
    """Whether a key is within the bound of edits of a spelling's."""
    return distance(k, spelling, MAX_EDITS) <= min(edits_allowed(k), edits_allowed(spelling))


def _broadcast_lookup(distinct: DataFrame, entries: list, counts: dict[int, int]) -> DataFrame:
    """(list_name, value, canon_id) of distinct values, each task with the dictionary of all lists."""
    lists: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for r in entries:
        lists[r.list_name].append((r.canon_id, r.canon_value))
    shipped = distinct.sparkSession.sparkContext.broadcast((dict(lists), counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, n = shipped.value
        built: dict[str, Dictionary] = {}
        for b in batches:
            ids = []
            for name, v in zip(b["list_name"], b["value"]):
                if name not in built:
                    built[name] = Dictionary(known.get(name, []), n)
                ids.append(built[name].resolve(v))
            yield b[["list_name", "value"]].assign(canon_id=ids)

    return distinct.mapInPandas(run, "list_name string, value string, canon_id bigint")


def _joined_lookup(distinct: DataFrame, canon: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join of the deletions of the values with those of the spellings, for lists of any length."""

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, i, e in zip(b["list_name"], b["canon_id"], b["canon_value"]):
                for k, (c, w) in spellings(e).items():
                    for x in deletes(k, edits_allowed(k)) if c <= FULL_COST else (k,):
                        rows.append((name, x, k, int(i), c, w))
            yield pd.DataFrame(rows, columns=["list_name", "cut", "spelling", "canon_id", "cost", "written"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(name, v, k, t, x) for name, v in zip(b["list_name"], b["value"]) for k, t in readings(v) if len(k) <= longest for x in deletes(k, edits_allowed(k))]
            yield pd.DataFrame(rows, columns=["list_name", "value", "k", "text", "cut"])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            near = [k != f for k, f in zip(b["k"], b["spelling"])]
            ok = pd.Series([not n or (c <= FULL_COST and accepted(k, f)) for n, k, f, c in zip(near, b["k"], b["spelling"], b["cost"])], index=b.index, dtype=bool)
            score = [round(c + weigh(t, w), 3) if o else 0.0 for o, c, t, w in zip(ok, b["cost"], b["text"], b["written"])]
            yield b[["list_name", "value", "k", "canon_id"]].assign(near=near, score=score)[ok]

    entries = canon.where("canon_value is not null").groupBy("list_name", "canon_value").agg(F.min("canon_id").alias("canon_id"))
    ways = stage(entries.mapInPandas(spelled, "list_name string, cut string, spelling string, canon_id bigint, cost double, written string"), "canonical-spellings")
    longest = (ways.agg(F.max(F.length("spelling")).alias("n")).first()["n"] or 0) + MAX_EDITS  # no longer value is near any spelling
    asked = distinct.mapInPandas(read, "list_name string, value string, k string, text string, cut string")
    met = asked.join(ways, ["list_name", "cut"]).drop("cut").distinct()
    found = met.mapInPandas(judge, "list_name string, value string, k string, canon_id bigint, near boolean, score double")
    found = found.withColumn("exact", F.min("near").over(W.partitionBy("list_name", "value", "k"))).where("near = exact")  # a key that is a spelling has no near ones
    rank = F.struct("near", "score", (-F.coalesce("n", F.lit(0))).alias("n"), "canon_id")
    best = found.join(counts, "canon_id", "left").groupBy("list_name", "value").agg(F.min_by("canon_id", rank).alias("canon_id"))
    return distinct.join(best, ["list_name", "value"], "left").withColumn("canon_id", F.coalesce("canon_id", F.lit(MISS).cast("bigint")))


def resolve_values(values: DataFrame, canon: DataFrame) -> DataFrame:
    """``values`` (list_name, value, and any other columns but canon_id) with ``canon_id`` of the entry meant."""
    sc = values.sparkSession.sparkContext
    # read several times: counted, resolved
    distinct = stage(values.where("value is not null").groupBy("list_name", "value").agg(F.count("*").alias("n")), "canonical-values")
    canon = canon.select("list_name", "canon_id", "canon_value").where("canon_value is not null and canon_id is not null")
    exact = distinct.join(canon.select("list_name", F.col("canon_value").alias("value"), "canon_id").distinct(), ["list_name", "value"])
    counts = exact.groupBy("canon_id").agg(F.sum("n").alias("n"))
    # tasks by number, not by size: the values are few bytes and much work
    spread = distinct.select("list_name", "value").repartition(TASKS_PER_CORE * max(1, sc.defaultParallelism), "list_name", "value")
    entries = canon.limit(MAX_ENTRIES + 1).collect()
    if len(entries) <= MAX_ENTRIES:
        mapped = _broadcast_lookup(spread, entries, {r.canon_id: r.n for r in counts.collect()})  # at most one row an entry
    else:
        mapped = _joined_lookup(spread, canon, counts)
    return values.drop("canon_id").join(mapped, ["list_name", "value"], "left")


def typed_fields(vbpl: DataFrame, tvpl: DataFrame) -> DataFrame:
    """The five freely typed fields as rows (src, row_key, field, list_name, value)."""

    def rows(df: DataFrame, src: str, row_key: str, fields: list[tuple[str, str, object]]) -> DataFrame:
        items = [F.struct(F.lit(f).alias("field"), F.lit(name).alias("list_name"), c.alias("value")) for f, name, c in fields]
        return df.select(F.lit(src).alias("src"), F.col(row_key).alias("row_key"), F.explode(F.array(*items)).alias("x")).select("src", "row_key", "x.*").where("value is not null")

    return rows(
        vbpl, "vbpl_records", "record_id",
        [("co_quan_ban_hanh", "issuer", F.col("metadata")["co_quan_ban_hanh"]), ("tinh_trang", "status", F.col("metadata")["tinh_trang"])],
    ).unionByName(rows(
        tvpl, "tvpl_documents", "row_id",
        [("noi_ban_hanh", "issuer", F.col("attributes.noi_ban_hanh")), ("loai_van_ban", "doc_type", F.col("attributes.loai_van_ban")), ("tinh_trang", "status", F.col("attributes.tinh_trang"))],
    ))


def unliteral_values(vbpl: DataFrame, tvpl: DataFrame, canon: DataFrame) -> DataFrame:
    """Each non-null value that doesn't literally equal an entry, with the entry meant or -1."""
    values = typed_fields(vbpl, tvpl)
    literal = canon.select("list_name", F.col("canon_value").alias("value")).where("value is not null").distinct()
    return resolve_values(values, canon).join(literal, ["list_name", "value"], "left_anti").select("src", "row_key", "field", "canon_id")
