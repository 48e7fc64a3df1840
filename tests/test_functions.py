"""Column functions against the Python functions they stand for."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillstream.functions.draws import (
    digest,
    draw,
    money_between,
    one_of,
    whole_between,
    wide_draw,
)
from tillstream.functions.ids import canonical_uuid, derived_uuid
from tillstream.functions.isotime import iso_seconds, iso_text, moment_at, moment_of, wall_seconds


def as_uuid(text):
    try:
        return str(uuid.UUID(text))
    except (ValueError, AttributeError, TypeError):
        return None


def test_canonical_uuid_reads_what_python_reads(spark):
    plain = "00004c14-49e3-3a03-0704-c9cb4fcbe117"
    spellings = [
        plain,
        plain.upper(),
        plain.replace("-", ""),
        "{" + plain + "}",
        "urn:uuid:" + plain,
        "{urn:uuid:" + plain + "}",
        "0-0-0-0-4c1449e33a030704c9cb4fcbe117",
        plain + "\n",
        plain + "0",
        plain[:-1],
        "g" + plain[1:],
        "nope",
        "",
        None,
    ]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(spellings)], "i int, s string")
    got = [r[0] for r in rows.orderBy("i").select(canonical_uuid(F.col("s"))).collect()]
    assert got == [as_uuid(s) if s is None or "\n" not in s else None for s in spellings]


def test_derived_uuids_are_unique_and_valid(spark):
    ids = spark.range(20_000).select(derived_uuid("order", F.col("id")).alias("u"))
    assert ids.distinct().count() == 20_000
    assert ids.filter(canonical_uuid(F.col("u")) != F.col("u")).count() == 0


def test_iso_text_is_isoformat(spark):
    start = datetime(1999, 12, 31, 23, 59, 59)
    moments = [start + timedelta(microseconds=n) for n in (0, 1, 10, 500_000, 999_999, 1_000_000)]
    rows = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    got = rows.select("t", iso_text(F.col("t")), iso_seconds(F.col("t"))).collect()
    for moment, text, seconds in got:
        assert text == moment.isoformat()
        assert seconds == moment.strftime("%Y-%m-%dT%H:%M:%S")


def test_wall_clock_times_are_printed_as_they_are(spark):
    """Half past two does not exist in Berlin on that day; the text has it anyway."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30, 0, 120_000),)], "t timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = rows.select(iso_text(F.col("t")), iso_seconds(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(got) == ("2024-03-31T02:30:00.120000", "2024-03-31T02:30:00")


def test_moment_of_cuts_the_fraction(spark):
    texts = ["2024-01-02T03:04:05.999999", "2024-01-02T03:04:05", "2024-01-02", "soon", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(moment_of(F.col("t"))).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [datetime(2024, 1, 2), None, None]


def test_wall_seconds_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    moments = [datetime(2024, 3, 31, 1, 59, 59), datetime(2024, 3, 31, 2, 30), datetime(1969, 1, 1)]
    rows = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        seconds = wall_seconds(F.col("t"))
        got = rows.select("t", seconds.alias("s"), moment_at(seconds).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for row in got:
        assert row.s == int((row.t - datetime(1970, 1, 1)).total_seconds())
        assert row.back == row.t


def test_draws_stay_in_range_and_reach_the_ends(spark):
    hashed = digest("t", 1, F.col("id"))
    row = (
        spark.range(50_000)
        .select(
            whole_between(draw(hashed, 0), 1, 5).alias("n"),
            money_between(draw(hashed, 1), 5, 6).alias("m"),
            one_of(draw(hashed, 2), ("a", "b", "c")).alias("c"),
            draw(hashed, 3).alias("d"),
            wide_draw(hashed).alias("w"),
        )
        .agg(
            F.min("n"), F.max("n"), F.min("m"), F.max("m"), F.count_distinct("m"),
            F.count_distinct("c"), F.min("d"), F.max("d"), F.max("w"),
        )
        .first()
    )
    assert tuple(row)[:6] == (1, 5, 5.0, 6.0, 101, 3)
    assert row[6] >= 0 and row[7] < 2**32 and 2**59 < row[8] < 2**60


def test_draws_do_not_depend_on_partitioning(spark):
    def total(parts):
        value = draw(digest("t", 1, F.col("id")), 0)
        return spark.range(0, 10_000, 1, parts).agg(F.sum(value)).first()[0]

    assert total(1) == total(7)
