"""Mixed timestamp formats and time zones: one UTC instant, or one calendar day.

Method: raw strings are deduplicated with their kind and zone into a dictionary of
distinct values; each is parsed exhaustively once (every format that matches is
tried, and a value that reads as two different instants determines none); the
dictionary is a Parquet table that later runs extend by the keys it lacks; the
normalised values are joined back to the rows.

Values already in the field's usual form never enter the dictionary: they are
recognised and copied inside the JVM, so that the shuffle carries only the odd ones.

Defined results: a null value gives a null; an empty or blank string, a value that
doesn't exist (30 February, a clock reading skipped or repeated by a change of
clocks, a local time without a known zone) gives the empty string; fractions
beyond microseconds are cut, not rounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawmill.session import stage_path

INSTANT, DAY = "instant", "day"
DAY_ZONE = timezone(timedelta(hours=7))
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

#: Zone abbreviations that stand for one offset, in minutes; those of several zones (CST, BST, IST) determine none.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "ICT": 420, "CET": 60, "CEST": 120, "EST": -300, "EDT": -240, "AEST": 600, "AEDT": 660, "JST": 540,
    "EET": 120, "EEST": 180, "MSK": 180, "WIB": 420, "SGT": 480, "HKT": 480, "KST": 540, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?)?"
_ZONE = r"(?P<z>Z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Z]{3,4})?(?:\[(?P<region>[A-Za-z_/+\-0-9]+)\])?"
_YMD = r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})"
_DMY = r"(?P<a>\d{1,2})\s*(?P<sep>[-/.])\s*(?P<b>\d{1,2})\s*(?P=sep)\s*(?P<y>\d{4})"
_VI = r"(?:ngày\s+)?(?P<d>\d{1,2})\s+tháng\s+(?P<m>\d{1,2})\s+năm\s+(?P<y>\d{4})"
_FORMS = [
    re.compile(p, re.I if "tháng" in p or "ngày" in p else 0)
    for p in (
        rf"{_YMD}(?:[T ]\s*{_CLOCK}\s*{_ZONE})?",
        r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?:T(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?(?P<z>Z|[+-]\d{2}:?\d{2})?)?",
        rf"{_DMY}(?:[T ,]\s*{_CLOCK}\s*(?P<half>SA|CH|AM|PM)?\s*{_ZONE})?",
        rf"{_CLOCK}\s*(?P<half>SA|CH|AM|PM)?,?\s+ngày\s+{_DMY}",
        rf"{_VI}(?:[ ,]\s*{_CLOCK})?",
        r"(?P<d>\d{1,2})-Th(?P<m>\d{1,2})-(?P<y>\d{4})",
        rf"(?:(?P<wd>[A-Za-z]{{3}}),?\s+)?(?P<d>\d{{1,2}})\s+(?P<mon>[A-Za-z]{{3}})[a-z]*\.?,?\s+(?P<y>\d{{4}})(?:\s+{_CLOCK}\s*{_ZONE})?",
        rf"(?P<mon>[A-Za-z]{{3}})[a-z]*\.?\s+(?P<d>\d{{1,2}}),?\s+(?P<y>\d{{4}})(?:\s+{_CLOCK}\s*(?P<half>SA|CH|AM|PM)?\s*{_ZONE})?",
    )
]
_NUMBER = re.compile(r"/Date\((?P<ms>-?\d{1,16})\)/|(?P<n>-?\d{9,19})(?:\.(?P<f>\d+))?")


@lru_cache(maxsize=512)
def _region(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except Exception:
        return None


def _offset(z: str) -> timedelta | None:
    if z in ABBREVIATIONS:
        return timedelta(minutes=ABBREVIATIONS[z])
    m = re.fullmatch(r"([+-])(\d{2}):?(\d{2})?", z)
    if not m or int(m[2]) > 14 or int(m[3] or 0) > 59:
        return None
    return (1 if m[1] == "+" else -1) * timedelta(hours=int(m[2]), minutes=int(m[3] or 0))


def _of_clock(local: datetime, region: ZoneInfo | None) -> datetime | None:
    """The one instant at which a clock of the region showed this reading, or None."""
    if region is None:
        return None
    seen = set()
    for fold in (0, 1):
        utc = local.replace(tzinfo=region, fold=fold).astimezone(timezone.utc)
        if utc.astimezone(region).replace(tzinfo=None) == local:
            seen.add(utc)
    return seen.pop() if len(seen) == 1 else None


def _days(g: dict) -> list[date]:
    y = int(g["y"])
    if g.get("mon"):
        pairs = [(MONTHS.get(g["mon"].lower(), 0), int(g["d"]))]
    elif g.get("a"):
        a, b = int(g["a"]), int(g["b"])
        pairs = [(b, a), (a, b)]  # the day comes first wherever that gives a date
    else:
        pairs = [(int(g["m"]), int(g["d"]))]
    for m, d in pairs:
        try:
            return [date(y, m, d)]
        except ValueError:
            continue
    return []


def _readings(raw: str, kind: str, zone: str | None) -> set:
    """Every instant (kind instant) or day (kind day) that some form reads from the value."""
    out: set = set()
    if m := _NUMBER.fullmatch(raw):
        n = int(m["ms"] or m["n"])
        digits = len((m["n"] or "").lstrip("-"))
        scale = 3 if m["ms"] else 0 if digits <= 10 else 3 if digits <= 13 else 6 if digits <= 16 else 9
        us = n * 10 ** (6 - scale) if scale <= 6 else n // 10 ** (scale - 6)
        if m["f"] and scale == 0:
            part = int(m["f"][:6].ljust(6, "0"))
            us += -part if n < 0 else part
        try:
            at = EPOCH + timedelta(microseconds=us)
            out.add(at if kind == INSTANT else at.astimezone(DAY_ZONE).date())
        except OverflowError:
            pass
        return out
    for form in _FORMS:
        if not (m := form.fullmatch(raw)):
            continue
        g = m.groupdict()
        for day in _days(g):
            if g.get("wd") and WEEKDAYS[day.weekday()] != g["wd"].lower():
                continue
            if g.get("h") is None:
                if kind == DAY:
                    out.add(day)
                continue  # a day alone is no instant
            h, mi, s = int(g["h"]), int(g["mi"]), int(g.get("s") or 0)
            if half := (g.get("half") or "").upper():
                if not 1 <= h <= 12:
                    continue
                h = h % 12 + (12 if half in ("CH", "PM") else 0)
            if h > 23 or mi > 59 or s > 59:
                continue
            local = datetime(day.year, day.month, day.day, h, mi, s, int((g.get("f") or "0")[:6].ljust(6, "0")))
            z, region = g.get("z"), g.get("region")
            if z:
                off = _offset(z)
                if off is None:
                    continue
                at = (local - off).replace(tzinfo=timezone.utc)
                if region:
                    r = _region(region)
                    if r is None or at.astimezone(r).utcoffset() != off:
                        continue
            elif region:
                at = _of_clock(local, _region(region))
            elif kind == DAY:
                out.add(day)
                continue
            else:
                at = _of_clock(local, _region(zone))
            if at is not None:
                out.add(at if kind == INSTANT else at.astimezone(DAY_ZONE).date())
    return out


def parse_value(raw: str | None, kind: str, zone: str | None = None) -> str | None:
    """The normal form of one raw value; "" if it determines none, None for None."""
    if raw is None:
        return None
    try:
        got = _readings(raw.strip(), kind, zone)
    except (ValueError, OverflowError):
        got = set()
    if len(got) != 1:
        return ""
    x = got.pop()
    return x.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if kind == INSTANT else x.isoformat()


def usual_instant(c: Column) -> Column:
    """True where the value is a valid ``yyyy-MM-ddTHH:mm:ss[.ffffff]+00:00``."""
    shaped = c.rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{6})?\+00:00\z")
    return shaped & F.try_to_timestamp(F.substring(c, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()


def usual_day(c: Column) -> Column:
    """True where the value is a valid ``dd/MM/yyyy`` day."""
    return c.rlike(r"\A\d{2}/\d{2}/\d{4}\z") & F.try_to_timestamp(c, F.lit("dd/MM/yyyy")).isNotNull()


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        zones = b["zone"].astype(object).where(b["zone"].notna(), None)
        b["norm"] = [parse_value(r, k, z) for r, k, z in zip(b["raw"], b["kind"], zones)]
        yield b[["kind", "raw", "zone", "norm"]]


class TimestampDictionary:
    """The persisted table of distinct (kind, raw, zone) and their normal form.

    ``extend`` parses only the keys that the table lacks and appends them as new files,
    so a rerun over a grown corpus parses the new spellings only.
    """

    SCHEMA = "kind string, raw string, zone string, norm string"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or stage_path(spark, "timestamp-dictionary")

    def table(self) -> DataFrame | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.schema(self.SCHEMA).parquet(self.path) if fs.exists(hadoop) else None

    def extend(self, raw: DataFrame) -> DataFrame:
        keys = raw.select("kind", "raw", "zone").distinct()
        known = self.table()
        if known is not None:
            k, n = known.alias("k"), keys.alias("n")
            same = (F.col("k.kind") == F.col("n.kind")) & (F.col("k.raw") == F.col("n.raw")) & F.col("k.zone").eqNullSafe(F.col("n.zone"))
            keys = n.join(k, same, "left_anti")
        keys.mapInPandas(_parse_batches, self.SCHEMA).write.mode("append").parquet(self.path)
        return self.table()


def normalise_times(values: DataFrame, dictionary: TimestampDictionary) -> DataFrame:
    """``values`` (kind, raw, zone, and any other columns) with column ``norm`` added and
    ``usual`` telling whether the value was in the usual form already.

    Only the odd values are keyed and joined; columns named norm or usual are replaced.
    """
    values = values.drop("norm", "usual")
    usual = F.when(F.col("kind") == INSTANT, usual_instant(F.col("raw"))).otherwise(usual_day(F.col("raw")))
    values = values.withColumn("usual", F.coalesce(usual, F.lit(False)))
    odd = values.where(~F.col("usual") & F.col("raw").isNotNull())
    # two runs that append at once may both bring a key: one row of it joins
    found = dictionary.extend(odd).groupBy(F.col("kind").alias("_k"), F.col("raw").alias("_r"), F.col("zone").alias("_z")).agg(F.min("norm").alias("_norm"))
    # usual values carry no key into the join: they can't gather in one task
    on = (F.when(~F.col("usual"), F.col("raw")) == F.col("_r")) & (F.col("kind") == F.col("_k")) & F.coalesce("zone", F.lit("")).eqNullSafe(F.coalesce("_z", F.lit("")))
    hit = odd.join(found, on, "left").withColumn("norm", F.col("_norm")).drop("_k", "_r", "_z", "_norm")
    instant = F.concat(F.substring("raw", 1, 19), F.lit("."), F.when(F.length("raw") > 25, F.substring("raw", 21, 6)).otherwise("000000"), F.lit("Z"))
    day = F.concat(F.substring("raw", 7, 4), F.lit("-"), F.substring("raw", 4, 2), F.lit("-"), F.substring("raw", 1, 2))
    rest = values.where(F.col("usual") | F.col("raw").isNull()).withColumn("norm", F.when(F.col("kind") == INSTANT, instant).otherwise(day))
    return hit.unionByName(rest)


def time_fields(vbpl: DataFrame, tvpl: DataFrame, workers: DataFrame) -> DataFrame:
    """The four time fields as rows (src, row_key, field, kind, raw, zone).

    The zone is kept only where a reading can depend on it, so that one spelling of an
    instant with a zone of its own is one dictionary entry. A worker that is null, or
    listed twice with different zones, has no known zone.
    """
    zones = workers.where(F.col("worker_id").isNotNull()).groupBy("worker_id").agg(F.when(F.countDistinct("tz_name") == 1, F.max("tz_name")).alias("zone"))

    def of(df: DataFrame, src: str, key: str, fetch: str, day: str) -> DataFrame:
        d = df.select(
            F.col(key).alias("row_key"), "worker_id",
            F.posexplode(F.array(F.struct(F.lit(fetch.rsplit(".", 1)[-1]).alias("field"), F.lit(INSTANT).alias("kind"), F.col(fetch).alias("raw")), F.struct(F.lit(day.rsplit(".", 1)[-1]).alias("field"), F.lit(DAY).alias("kind"), F.col(day).alias("raw")))).alias("_p", "_v"),
        ).select(F.lit(src).alias("src"), "row_key", "_v.*", "worker_id")
        d = d.where(F.col("raw").isNotNull())
        return d.join(zones, "worker_id", "left").select("src", "row_key", "field", "kind", "raw", F.when(F.col("kind") == INSTANT, F.col("zone")).alias("zone"))

    return of(vbpl, "vbpl_records", "record_id", "downloaded_timestamp", "created_timestamp").unionByName(
        of(tvpl, "tvpl_documents", "row_id", "fetched_at_utc", "attributes.ngay_ban_hanh")
    )


def odd_times(spark: SparkSession, vbpl: DataFrame, tvpl: DataFrame, workers: DataFrame, dictionary_path: str | None = None) -> DataFrame:
    """Each non-null value that isn't a valid value in its field's usual form, with its normal form."""
    done = normalise_times(time_fields(vbpl, tvpl, workers), TimestampDictionary(spark, dictionary_path))
    return done.where(~F.col("usual")).select("src", "row_key", "field", "norm")
