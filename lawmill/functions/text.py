"""Text, number and time expressions of extraction, retry and reporting; all of them JVM columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of the attribute block and the fields they fill.
ATTRIBUTE_LABELS = {
    "số hiệu": "so_hieu",
    "loại văn bản": "loai_van_ban",
    "nơi ban hành": "noi_ban_hanh",
    "người ký": "nguoi_ky",
    "ngày ban hành": "ngay_ban_hanh",
    "ngày hiệu lực": "ngay_hieu_luc",
    "ngày công báo": "ngay_cong_bao",
    "số công báo": "so_cong_bao",
    "tình trạng": "tinh_trang",
}
#: Statuses after which a request is tried again.
RETRYABLE = (429, 500, 502, 503, 504)
#: How a challenge page and a missing page show.
CHALLENGE_HEAD = 1200
NOT_FOUND = ("không tìm thấy", "not found")


def collapse(c: Column) -> Column:
    """Runs of blanks, the Unicode ones included, made one blank, and the ends stripped."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def strip_bom(c: Column) -> Column:
    """Without a byte-order mark, read right or read as Latin-1."""
    return F.regexp_replace(c, "^(﻿|ï»¿)", "")


def normalise_label(c: Column) -> Column:
    return F.regexp_replace(F.lower(collapse(c)), ":+$", "")


def trim_value(c: Column) -> Column:
    """Without colons, hyphens and blanks at either end."""
    return F.regexp_replace(c, "^[:\\- ]+|[:\\- ]+$", "")


def safe_decode(b: Column) -> Column:
    """UTF-8 with broken sequences replaced."""
    return F.make_valid_utf8(b.cast("string"))


def safe_int(c: Column) -> Column:
    return c.try_cast("int")


def after_label(value: Column, label: Column) -> Column:
    return F.substr(value, F.length(label) + 1)


def looks_like_challenge(html: Column) -> Column:
    head = F.lower(F.substring(html, 1, CHALLENGE_HEAD))
    return (head.contains("just a moment") & head.contains("cloudflare")) | head.contains("cf-challenge")


def looks_missing(html: Column) -> Column:
    low = F.lower(html)
    return low.contains(NOT_FOUND[0]) | low.contains(NOT_FOUND[1])


def looks_like_html(xml: Column) -> Column:
    head = F.lower(F.substring(strip_bom(xml), 1, 200))
    return head.contains("<html") | head.contains("<!doctype html")


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE)


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Seconds to wait by a Retry-After header: a number, or an HTTP date against ``now``; never below 0, null if neither."""
    at = F.try_to_timestamp(F.substring(F.trim(value), 6, 25), F.lit("dd MMM yyyy HH:mm:ss z"))
    seconds = F.coalesce(F.trim(value).try_cast("double"), (F.unix_micros(at) - F.unix_micros(now)) / 1e6)
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0)))  # greatest alone passes over nulls


def backoff_seconds(status: Column, attempt: Column, retry_after: Column | None = None) -> Column:
    """Doubling from 8, 5 or 1 s for 429, 403 and other failures, 120 s at most, unless the server asked for longer. No jitter."""
    floor = F.when(status == 429, 8.0).when(status == 403, 5.0).otherwise(1.0)
    wait = F.least(F.lit(120.0), floor * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0))))
    return wait if retry_after is None else F.greatest(wait, F.coalesce(retry_after, F.lit(0.0)))


def exponential_delay(attempt: Column) -> Column:
    return F.lit(2.0) * F.pow(F.lit(2.0), attempt)


def duration_text(seconds: Column) -> Column:
    """mm:ss, or hh:mm:ss from an hour on; "unknown" for null, negative and infinite."""
    s = F.floor(seconds).cast("bigint")
    h = F.floor(s / 3600).cast("int")
    m = F.floor((s % 3600) / 60).cast("int")
    r = (s % 60).cast("int")
    bad = seconds.isNull() | F.isnan(seconds) | (seconds < 0) | (seconds == float("inf"))
    return F.when(bad, "unknown").when(s >= 3600, F.format_string("%02d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def utc_iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def shard_name(url: Column, index: Column) -> Column:
    """A sitemap's shard: by the number in its URL, else by its index."""
    n = F.nullif(F.regexp_extract(url, r"resitemap(\d+)\.xml", 1), F.lit(""))
    return F.when(n.isNotNull(), F.concat(F.lit("resitemap_"), F.lpad(n, 4, "0"))).otherwise(F.format_string("sitemap_%04d", index.cast("int")))


def retry_shard(index: Column) -> Column:
    return F.when(index >= 1, F.format_string("resitemap_%04d", index.cast("int"))).otherwise("retry_unmapped")


def job_key(slug: Column, unit: Column, doc_type: Column) -> Column:
    return F.concat_ws("|", slug, unit.cast("string"), doc_type.cast("string"))


def percent(part: Column, whole: Column) -> Column:
    """A share in percent with one decimal; 0 of nothing."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, 0.0).otherwise(F.round(part.cast("double") * 100.0 / whole, 1))


def labelled_fields(text: Column, labels: dict[str, str] = ATTRIBUTE_LABELS) -> Column:
    """The struct of values that follow "label:" in a text, each up to the next label.

    A label may be written in any case and with any blanks; of a repeated one the last
    non-empty value counts; a label without a value gives null.
    """
    flexible = {k: r"\s*".join(k.split()) for k in labels}
    stop = "|".join(flexible.values())
    fields = []
    for k, f in labels.items():
        found = F.regexp_extract_all(text, F.lit(rf"(?iuUs){flexible[k]}\s*:(.*?)(?=(?:{stop})\s*:|$)"), F.lit(1))
        kept = F.filter(F.transform(found, lambda v: trim_value(collapse(v))), lambda v: v != "")
        fields.append(F.try_element_at(kept, F.lit(-1)).alias(f))
    return F.struct(*fields)
