import pytest
from pyspark.sql import functions as F

from lawmill.operators.timestamps import DAY, INSTANT, TimestampDictionary, normalise_times, odd_times, parse_value

HCM, BERLIN, NY = "Asia/Ho_Chi_Minh", "Europe/Berlin", "America/New_York"


@pytest.mark.parametrize(
    "raw, zone, want",
    [
        ("2025-10-14T01:30:28Z", None, "2025-10-14T01:30:28.000000Z"),
        ("2025-05-11T22:44:22.976407999Z", None, "2025-05-11T22:44:22.976407Z"),
        ("2025-04-10T10:45:46+05:30", None, "2025-04-10T05:15:46.000000Z"),
        ("2026-03-21T07:01:39+07:00[Asia/Ho_Chi_Minh]", None, "2026-03-21T00:01:39.000000Z"),
        ("2026-03-21T07:01:39+08:00[Asia/Ho_Chi_Minh]", None, ""),
        ("20251101T122117Z", None, "2025-11-01T12:21:17.000000Z"),
        ("1763965141.17", None, "2025-11-24T06:19:01.170000Z"),
        ("1771660810210", None, "2026-02-21T08:00:10.210000Z"),
        ("/Date(1762800498746)/", None, "2025-11-10T18:48:18.746000Z"),
        ("/Date(-1)/", None, "1969-12-31T23:59:59.999000Z"),
        ("Thu, 27 Feb 2025 23:19:25 GMT", None, "2025-02-27T23:19:25.000000Z"),
        ("Fri, 27 Feb 2025 23:19:25 GMT", None, ""),
        ("2025-08-28 05:08:49 EDT", None, "2025-08-28T09:08:49.000000Z"),
        ("21/10/2025 19:24:28", NY, "2025-10-21T23:24:28.000000Z"),
        ("27/10/2025 12:53:27 CH", HCM, "2025-10-27T05:53:27.000000Z"),
        ("07/10/2025 12:40:28 SA", HCM, "2025-10-06T17:40:28.000000Z"),
        ("10:23:49 ngày 31/07/2025", HCM, "2025-07-31T03:23:49.000000Z"),
        ("2026-02-10 23:20", HCM, "2026-02-10T16:20:00.000000Z"),
        ("2025-03-30T02:30:00", BERLIN, ""),  # the clock never showed it
        ("2025-10-26T02:30:00", BERLIN, ""),  # twice
        ("2025-10-26T02:30:00", None, ""),
        ("2025-10-26T02:30:00", "No/Zone", ""),
        ("2025-02-30T11:20:00Z", None, ""),
        ("31/06/2025 08:15:00", HCM, ""),
        ("0000-00-00 00:00:00", HCM, ""),
        ("NaN", HCM, ""),
        ("", HCM, ""),
        ("x" * 200_000, HCM, ""),
        (None, HCM, None),
    ],
)
def test_instants(raw, zone, want):
    assert parse_value(raw, INSTANT, zone) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2021-06-28", "2021-06-28"), ("ngày 20 tháng 11 năm 2002", "2002-11-20"), ("Ngày 1 tháng 6 năm 2001", "2001-06-01"), ("2018-07-01T00:00:00", "2018-07-01"),
        ("2022-02-12T17:00:00.000Z", "2022-02-13"), ("20220122", "2022-01-22"), ("12/05/2020 00:00:00", "2020-05-12"), ("13-01-2023", "2023-01-13"), ("10 / 06 / 2021", "2021-06-10"),
        ("2006-05-27T00:00:00+07:00", "2006-05-27"), ("1414688400000", "2014-10-31"), ("815418000000", "1995-11-04"), ("22-Th8-2016", "2016-08-22"), ("16.5.2012", "2012-05-16"), ("6/4/2004", "2004-04-06"),
        ("12/28/2003", "2003-12-28"), ("Sep 24, 2022", "2022-09-24"), ("28 Jul 2005", "2005-07-28"), ("30/02/2011", ""), ("tháng 8 năm 2001", ""), ("12/2009", ""), ("2004", ""), ("...", ""),
    ],
)
def test_days(raw, want):
    assert parse_value(raw, DAY) == want


def test_rows_keep_their_columns_and_repeats(spark):
    v = spark.createDataFrame([(1, INSTANT, "2025-01-01T00:00:00+00:00", None, "a"), (1, INSTANT, "hôm qua", None, "b"), (1, INSTANT, "hôm qua", None, "b"), (2, DAY, None, None, "c"), (3, DAY, "01/02/2020", None, "d")], "k int, kind string, raw string, zone string, norm string")
    got = sorted(normalise_times(v, TimestampDictionary(spark)).select("k", F.coalesce("norm", F.lit("null")), "usual").collect())
    assert [tuple(r) for r in got] == [(1, "", False), (1, "", False), (1, "2025-01-01T00:00:00.000000Z", True), (2, "null", False), (3, "2020-02-01", True)]


def test_dictionary_grows_by_what_it_lacks(spark, tmp_path):
    d = TimestampDictionary(spark, f"file://{tmp_path}/dict")
    one = spark.createDataFrame([(DAY, "2021-06-28", None)], "kind string, raw string, zone string")
    two = one.unionByName(spark.createDataFrame([(DAY, "20220122", None)], "kind string, raw string, zone string"))
    assert d.extend(one).count() == 1
    assert d.extend(two).count() == 2
    assert d.extend(two).count() == 2


def test_keys_appended_twice_join_once(spark, tmp_path):
    d = TimestampDictionary(spark, f"file://{tmp_path}/dict")
    v = spark.createDataFrame([(DAY, "20220122", None, 1)], "kind string, raw string, zone string, k int")
    d.extend(v)
    d.table().write.mode("append").parquet(f"file://{tmp_path}/twice")
    d.table().write.mode("append").parquet(f"file://{tmp_path}/twice")
    twice = TimestampDictionary(spark, f"file://{tmp_path}/twice")
    assert [(r.k, r.norm) for r in normalise_times(v, twice).collect()] == [(1, "2022-01-22")]


@pytest.mark.parametrize("raw, want", [("2025-01-01 00:00:00 MSK", "2024-12-31T21:00:00.000000Z"), ("2025-01-01 00:00:00 PDT", "2025-01-01T07:00:00.000000Z"), ("2025-01-01 00:00:00 CST", "")])
def test_abbreviations_of_one_offset(raw, want):
    assert parse_value(raw, INSTANT, "Asia/Ho_Chi_Minh") == want


def test_unknown_and_contradictory_workers(spark):
    vb = spark.createDataFrame([(1, "2025-05-05 10:00", "x", 1), (2, "2025-05-05 10:00", None, 9), (3, "2025-05-05 10:00", None, None)], "record_id bigint, downloaded_timestamp string, created_timestamp string, worker_id int")
    tv = spark.createDataFrame([], "row_id bigint, fetched_at_utc string, attributes struct<ngay_ban_hanh: string>, worker_id int")
    workers = spark.createDataFrame([(1, HCM), (9, HCM), (9, NY), (None, NY)], "worker_id int, tz_name string")
    got = {(r.row_key, r.field): r.norm for r in odd_times(spark, vb, tv, workers).collect()}
    assert got == {(1, "downloaded_timestamp"): "2025-05-05T03:00:00.000000Z", (1, "created_timestamp"): "", (2, "downloaded_timestamp"): "", (3, "downloaded_timestamp"): ""}
