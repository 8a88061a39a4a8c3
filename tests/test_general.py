"""Packed fields and timestamps: cases, empty and hostile input, brute force."""

import datetime as dt
import zoneinfo

import pytest
from pyspark.sql import functions as F

from rolodar.operators import instants, packed
from rolodar.operators.graph import connected_components

KINDS = packed.FIELD_TYPES


def rows_of(spark, values, field="emails"):
    schema = "rec_id long, source string, emails string, phones string, invalid_emails string, k string, s string"
    data = [(i, "a" if i % 3 else None, *(v if f == field else None for f in KINDS), "x", "y") for i, v in enumerate(values)]
    return spark.createDataFrame(data, schema)


def unpacked(spark, values, field="emails"):
    out = packed.unpack_fields(rows_of(spark, values, field), "rec_id", [field]).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["rec_id"], r["pos"])):
        got.setdefault(r["rec_id"], []).append(r["item_value"])
    return got


MANY = ["a@x.example;b@x.example", "c@x.example, d@x.example", "e@x.example|f@x.example", "g@x.example\nh@x.example", "i@x.example ::: j@x.example",
        "k@x.example / l@x.example", "m@x.example\tn@x.example", "o@x.example p@x.example"] * 3


def test_packed_emails(spark):
    hard = ['"Last, First" <a@x.example>;b@x.example', "a@x.example::work | b@x.example::home", "<a@x.example>\r\n\r\n<b@x.example>", ' "a@x.example" ',
            "a@x.example (work), a@x.example (home)", ";;", " ", "", None, '"open, a@x.example'] + ["z" * 20000 + "@x.example"]
    got = unpacked(spark, MANY + hard)
    n = len(MANY)
    assert all(len(got[i]) == 2 for i in range(n))
    assert got[n] == got[n + 1] == got[n + 2] == ["a@x.example", "b@x.example"]
    assert got[n + 3] == ["a@x.example"] and got[n + 4] == ["a@x.example"] * 2
    assert not {n + 5, n + 6, n + 7, n + 8} & set(got)
    assert len(got[n + 10]) == 1


def test_packed_phones_keep_extensions(spark):
    values = ["415-555-0100;415-555-0101", "415-555-0100 or 415-555-0101", "415-555-0100, 415-555-0101"] * 2 + ['"+1 415 555 0100, ext. 7", "415.555.0101;ext=12"', "(415) 555-0100 x12::main"]
    got = unpacked(spark, values, "phones")
    assert got[6] == ["+1 415 555 0100, ext. 7", "415.555.0101;ext=12"] and got[7] == ["(415) 555-0100 x12"]
    assert got[1] == ["415-555-0100", "415-555-0101"]


def test_packed_empty_table(spark):
    assert unpacked(spark, []) == {}


def instant(spark, values):
    df = spark.createDataFrame([(i, t, z, "extra") for i, (t, z) in enumerate(values)], "rec_id long, t string, z string, local string")
    timed = instants.parse_instants(df, "t", "z").select("rec_id", instants.micros_to_text(F.col("utc_us")).alias("u"))
    return [r["u"] for r in timed.orderBy("rec_id").collect()]


def test_instants(spark):
    ny = "America/New_York"
    cases = [
        (("2021-11-07 01:30:00", ny), "2021-11-07 05:30:00.000000"),  # twice: the first
        (("2021-03-14 02:30:00", ny), "2021-03-14 07:30:00.000000"),  # skipped: the offset before
        (("04 Aug 2016", ny), "2016-08-04 04:00:00.000000"),
        (("3/4/2020 12:05 AM", None), "2020-03-04 00:05:00.000000"),
        (("03.04.2020 12:05", ""), "2020-04-03 12:05:00.000000"),
        (("Tue, 27 Dec 2022 06:54:49 -0500", "UTC"), "2022-12-27 11:54:49.000000"),
        (("2019-10-08T04:55:29.244683584Z", ny), "2019-10-08 04:55:29.244683"),
        (("2024-08-02T10:27:47+01:00[Europe/London]", "UTC"), "2024-08-02 09:27:47.000000"),
        (("2020-06-29 12:36:32 EDT", "Asia/Kolkata"), "2020-06-29 16:36:32.000000"),
        (("1473219241", ny), "2016-09-07 03:34:01.000000"),
        (("1749520761110", None), "2025-06-10 01:59:21.110000"),
        (("Oct 9, 2021, 11:35:23 AM", "No/Where"), "2021-10-09 11:35:23.000000"),
        (("08-APR-18 11:05", None), "2018-04-08 11:05:00.000000"),
        (("20170404T003944Z", ny), "2017-04-04 00:39:44.000000"),
        (("1969-12-31T23:59:59.5Z", None), "1969-12-31 23:59:59.500000"),
    ]
    bad = ["2023-02-30T10:00:00Z", "0000-00-00 00:00:00", "13/45/2021 10:00 AM", "last spring", "", None, "2020-01-01 25:00:00", "2020-01-01 10:00:00 XYZT", "9" * 40]
    got = instant(spark, [c for c, _ in cases] + [(b, ny) for b in bad])
    assert got[: len(cases)] == [e for _, e in cases]
    assert got[len(cases) :] == [None] * len(bad)


def test_instants_against_zoneinfo(spark):
    zone = "Europe/Berlin"
    times = [dt.datetime(2021, 3, 28) + dt.timedelta(minutes=30 * i) for i in range(8)] + [dt.datetime(2021, 10, 31) + dt.timedelta(minutes=30 * i) for i in range(8)]
    want = [t.replace(tzinfo=zoneinfo.ZoneInfo(zone), fold=0).astimezone(dt.UTC).strftime("%Y-%m-%d %H:%M:%S.%f") for t in times]
    assert instant(spark, [(t.isoformat(), zone) for t in times]) == want


CLOCKS = ["UTC", "America/New_York", "America/Los_Angeles", "Europe/Berlin", "Asia/Tokyo"]


def clock_rows(zone, days, lag_minutes=10, start=dt.datetime(2024, 1, 1, 9)):
    """Local times of a zone's clock, one a day, ingested some minutes later."""
    out = []
    for i in range(days):
        utc = start + dt.timedelta(days=i, minutes=7 * i)
        local = utc.replace(tzinfo=dt.UTC).astimezone(zoneinfo.ZoneInfo(zone)).replace(tzinfo=None)
        out.append((zone, local.isoformat(), None, utc + dt.timedelta(minutes=lag_minutes), utc))
    return out


@pytest.mark.parametrize("lag", [10, 50])
def test_zone_history_finds_zones_east_and_west(spark, lag):
    # Half a year each, over a daylight-saving change; nothing is known but the times of ingestion.
    rows = [r for z in CLOCKS for r in clock_rows(z, 180, lag)]
    df = spark.createDataFrame([r[:4] for r in rows], "source string, t string, z string, seen timestamp_ntz")
    out = instants.zone_history(df, "source", "t", "z", "seen", CLOCKS).collect()
    assert {(r["key"], r["zone"]) for r in out} == {(z, z) for z in CLOCKS}
    assert sum(r["n_rows"] for r in out) == len(rows) and all(r["violations"] == 0 for r in out)


def test_zone_history_changes_and_converts(spark):
    moved = clock_rows("America/New_York", 90) + clock_rows("Asia/Tokyo", 90, start=dt.datetime(2024, 4, 1, 9))
    rows = [("dev", *r[1:]) for r in moved]
    # Rows with a known zone tell the usual lag; they are converted by it.
    rows += [("dev", "2024-02-01T12:00:00Z", None, dt.datetime(2024, 2, 1, 12, 20), dt.datetime(2024, 2, 1, 12)), ("dev", "no time", "", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, source string, t string, z string, seen timestamp_ntz, want timestamp_ntz")
    out = instants.with_estimated_zones(df, "source", "t", "z", "seen", CLOCKS).collect()
    assert len(out) == len(rows)
    for r in out:
        want = None if r["want"] is None else int(r["want"].replace(tzinfo=dt.UTC).timestamp() * 1e6)
        # In the month of the move the change may come some rows off.
        assert r["utc_us"] == want or r["t"][:7] in ("2024-03", "2024-04")
    assert sum(r["utc_us"] is not None for r in out) == len(rows) - 2
    assert instants.zone_history(df.limit(0), "source", "t", "z", "seen", CLOCKS).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    import random

    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(0, i) for i in range(100, 140)] + [(None, 3), (5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    want = {x: find(x) for x in parent}
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
