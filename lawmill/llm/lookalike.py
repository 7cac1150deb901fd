"""Visually identical text with different characters, brought to one plain spelling.

Method: full-width and mathematical forms, special blanks, hyphens and slashes, invisible
characters and decomposed accents have one plain form each and are replaced wherever they
stand. Greek and Cyrillic look-alikes are a matter of the token: its dominant script is
determined, the one that has most of its letters and into which all the others can go, and in tokens of mixed script the look-alikes of the other
script are substituted, either way ("Νghị" and "Mосква"), and only when the result exists in the corpus vocabulary; where it doesn't, the other
script is tried. A token that is
look-alikes throughout is taken as Latin if it has two letters or more (this project's data hold such), so that "α" and
«Ладья» stay as they are.

Whether a value has an unusual character is asked in Python, over whole Arrow batches: its
regular expressions test a large class of characters by bitmap, the JVM's one range after another.

The vocabulary is distributed: the distinct words of every partition, of which only those
that some repair asks for are kept, by a semi-join. Values without an unusual character are
passed over; the others are written once to the shared folder and read twice.

Defined results: null values and values without a key give no row; an empty value is plain; superscripts, fractions,
units, emoji, ellipses, replacement signs, words of other scripts, line ends, tabs and
repeated blanks stay; a look-alike whose repair the corpus doesn't know stays.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawmill.llm.mojibake import VOWELS
from lawmill.session import stage

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip(
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχ" "АВЕЗКМНОРСТУХІЈЅаекорсухіјѕԁһԛԝԍ",
    "ABEZHIKMNOPTYXaikvoptux" "AB" "E3KMHOPCTYXIJSaekopcyxijsdhqwg",
))
#: The look-alikes of Latin letters in either script.
TO_GREEK = {v: k for k, v in LOOKALIKES.items() if k < "Ѐ"}
TO_CYRILLIC = {v: k for k, v in LOOKALIKES.items() if k >= "Ѐ"}
#: Latin letters that stand for the Vietnamese Đ.
BARRED = {"Ð": "Đ", "ð": "đ", "Ɖ": "Đ", "ɖ": "đ"}
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‎‏‪‫‬‭‮⁠⁡⁢⁣⁤﻿"
BLANKS = "               　"
SIGNS = {"‐": "-", "‑": "-", "⁄": "/", "∕": "/"}

_DIRECT = {ord(c): None for c in INVISIBLE} | {ord(c): " " for c in BLANKS} | {ord(k): v for k, v in SIGNS.items()}
_DIRECT |= {c: unicodedata.normalize("NFKC", chr(c)) for r in (range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800), range(0xFB00, 0xFB07)) for c in r if unicodedata.name(chr(c), "")}
_FOREIGN = re.compile("[Ͱ-ϿЀ-ԯἀ-῿]")
_LATIN = re.compile("[A-Za-zÀ-ɏḀ-ỿ]")
_STRAY_JOINER = re.compile("(?<![\u2600-\u27bf\U0001f000-\U0001faff\ufe0f])\u200d|\u200d(?![\u2600-\u27bf\U0001f000-\U0001faff])")

#: Characters of plain Vietnamese text and the signs writers mean: values of these alone are plain.
PLAIN = "".join(sorted(set(VOWELS + VOWELS.upper()))) + "«»–—“”‘’…°±²³µ½¼¾©·▲"
ODD = re.compile(f"[^{re.escape(PLAIN)}\\x20-\\x7e\\t\\r\\n]")


def direct(s: str) -> str:
    """The value with everything replaced that has one plain form whatever the token."""
    if "\u200d" in s:
        s = _STRAY_JOINER.sub("", s)  # those between emoji are part of them
    return unicodedata.normalize("NFC", s.translate(_DIRECT))


def _tokens(s: str) -> Iterator[re.Match]:
    return re.finditer(r"[^\s«»\"(),;:]+", s)


def readings(token: str) -> list[str]:
    """The token in each script that it may be meant in, the dominant one first; none if it isn't mixed."""
    foreign, latin = _FOREIGN.findall(token), _LATIN.findall(token)
    if not foreign or not latin and len(foreign) < 2:
        return []
    out = []
    if all(c in LOOKALIKES for c in foreign):
        out.append((len(latin), unicodedata.normalize("NFC", "".join(LOOKALIKES.get(c, BARRED.get(c, c)) for c in token))))
    cyrillic = [c >= "Ѐ" for c in foreign]
    if latin and (all(cyrillic) or not any(cyrillic)):
        into = TO_CYRILLIC if cyrillic[0] else TO_GREEK
        if all(c in into for c in latin):
            out.append((len(foreign), "".join(into.get(c, c) for c in token)))
    return [t for _, t in sorted(out, key=lambda x: -x[0])]  # of equals Latin


def pieces(token: str, fixed: str) -> list[str]:
    """The words of a repaired token whose letters were changed, folded, as the vocabulary has them."""
    if len(fixed) == len(token):
        return [m[0].casefold() for m in re.finditer(r"\w+", fixed) if token[m.start() : m.end()] != m[0]]
    return [w.casefold() for w in re.findall(r"\w+", fixed)]


def wanted_pieces(s: str) -> list[str]:
    d = direct(s)
    if not _FOREIGN.search(d):
        return []
    return sorted({p for m in _tokens(d) for fixed in readings(m[0]) for p in pieces(m[0], fixed)})


def plain_spelling(s: str, known: Iterable[str]) -> str:
    """The plain spelling of a value, given which wanted words the corpus vocabulary has."""
    known = set(known)
    d = direct(s)

    def token(m: re.Match) -> str:
        t = m[0]
        for fixed in readings(t):
            if all(p in known for p in pieces(t, fixed)):
                return fixed
        if any(c in BARRED for c in t) and not _FOREIGN.search(t):
            return "".join(BARRED.get(c, c) for c in t)
        return t

    if not _FOREIGN.search(d) and not any(c in d for c in BARRED):
        return d
    return re.sub(r"[^\s«»\"(),;:]+", token, d)


def _odd_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b = b.loc[[ODD.search(v) is not None for v in b["value"]], ["src", "row_key", "field", "value"]]
        yield b.assign(wanted=pd.Series([wanted_pieces(v) for v in b["value"]], index=b.index, dtype=object))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[str] = set()
    for b in batches:
        fresh: set[str] = set()
        for v in b["value"]:
            if v:
                fresh.update(v.split())
        fresh -= seen
        if len(seen) > 500_000:  # a word may then come twice; the join doesn't mind
            seen.clear()
        seen |= fresh
        out = {w.casefold() for t in fresh if not (_FOREIGN.search(t) and _LATIN.search(t)) for w in re.findall(r"\w+", t)}
        yield pd.DataFrame({"piece": pd.Series(sorted(out), dtype=object)})


def plain_forms(values: DataFrame) -> DataFrame:
    """Of ``values`` (src, row_key, field, value), those whose plain spelling differs, with it in column ``plain``."""
    values = values.select("src", "row_key", "field", "value").where("value is not null and row_key is not null")
    odd = stage(
        values.mapInPandas(_odd_rows, "src string, row_key bigint, field string, value string, wanted array<string>"),
        "lookalike-odd",
    )
    asks = odd.select("src", "row_key", "field", F.explode("wanted").alias("piece")).distinct()
    words = values.mapInPandas(_words, "piece string")
    known = asks.select("piece").distinct().join(words, "piece", "left_semi")
    got = asks.join(known, "piece").groupBy("src", "row_key", "field").agg(F.collect_set("piece").alias("known"))
    full = odd.drop("wanted").join(got, ["src", "row_key", "field"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            none: list[str] = []
            b["plain"] = [plain_spelling(v, none if k is None else k) for v, k in zip(b["value"], b["known"])]
            yield b.loc[b["plain"] != b["value"], ["src", "row_key", "field", "value", "plain"]]

    return full.mapInPandas(run, "src string, row_key bigint, field string, value string, plain string")


def written_fields(vbpl: DataFrame, documents: DataFrame, tvpl: DataFrame) -> DataFrame:
    items = [F.struct(F.lit("so_hieu").alias("field"), F.col("attributes.so_hieu").alias("value")), F.struct(F.lit("title").alias("field"), F.col("title").alias("value"))]
    return (
        vbpl.select(F.lit("vbpl_records").alias("src"), F.col("record_id").alias("row_key"), F.lit("text").alias("field"), F.col("text").alias("value"))
        .unionByName(documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("row_key"), F.lit("text").alias("field"), F.col("text").alias("value")))
        .unionByName(tvpl.select(F.lit("tvpl_documents").alias("src"), F.col("row_id").alias("row_key"), F.explode(F.array(*items)).alias("x")).select("src", "row_key", "x.*"))
    )
