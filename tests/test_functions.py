"""Scalar functions against values worked out by hand and by Python."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremorline.functions import (
    area_of,
    as_bigint,
    as_double,
    local_second,
    local_subsecond,
    strip,
    utc_second,
)
from tremorline.functions.place import BLANKS

ZONE = "America/Los_Angeles"


def apply(spark, values, convert):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = frame.select("i", convert(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in rows]


def times(spark, values, convert, pattern="yyyy-MM-dd HH:mm:ss"):
    return apply(spark, values, lambda v: F.date_format(convert(v), pattern))


def test_utc_second(spark):
    cases = {
        "1729842930123": "2024-10-25 07:55:30",
        "1729842930123.0": "2024-10-25 07:55:30",
        "1.729842930123E12": "2024-10-25 07:55:30",
        "1729842930999": "2024-10-25 07:55:30",
        " 1729842930123 ": "2024-10-25 07:55:30",
        "1": "1970-01-01 00:00:00",
        "999": "1970-01-01 00:00:00",
        "0.5": "1970-01-01 00:00:00",
        "1000": "1970-01-01 00:00:01",
        "253402300799999": "9999-12-31 23:59:59",
        "253402300800000": None,
        "1e300": None,
        "0": None,
        "-5000": None,
        "zz": None,
        "": None,
        "NaN": None,
        "Infinity": None,
        "-Infinity": None,
        None: None,
    }
    assert times(spark, cases, utc_second) == list(cases.values())


def test_local_second(spark):
    cases = {
        "1729842930123": "2024-10-25 00:55:30",
        "1705315200999": "2024-01-15 02:40:00",
        "0": "1969-12-31 16:00:00",
        "-1500": "1969-12-31 15:59:58",
        "NaN": None,
        "zz": None,
        None: None,
    }
    assert times(spark, cases, lambda v: local_second(v, ZONE)) == list(cases.values())


def test_local_subsecond(spark):
    cases = {
        "1729842930123": "2024-10-25 00:55:30.123000",
        "1729842930123.25": "2024-10-25 00:55:30.123250",
        "-1500": "1969-12-31 15:59:58.500000",
        "1": "1969-12-31 16:00:00.001000",
        "0": None,
        "0.0": None,
        "NaN": None,
        None: None,
    }
    found = times(spark, cases, lambda v: local_subsecond(v, ZONE), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert found == list(cases.values())


epochs = st.lists(
    st.integers(min_value=-(10**13), max_value=10**13), min_size=100, max_size=200
)
few = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large],
)


@few
@given(values=epochs)
def test_times_equal_python(spark, values):
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    moments = [start + timedelta(milliseconds=v) for v in values]
    tokens = [str(v) for v in values]
    pattern = "%Y-%m-%d %H:%M:%S"
    assert times(spark, tokens, utc_second) == [
        m.strftime(pattern) if v > 0 else None for v, m in zip(values, moments)
    ]
    assert times(spark, tokens, lambda v: local_second(v, "Asia/Kolkata")) == [
        m.astimezone(ZoneInfo("Asia/Kolkata")).strftime(pattern) for m in moments
    ]


def test_lenient_numbers(spark):
    doubles = {"1": 1.0, "1.5": 1.5, "1e3": 1000.0, " 2 ": 2.0, "abc": None, "": None, None: None}
    assert apply(spark, doubles, as_double) == list(doubles.values())
    wholes = {
        "3": 3,
        "3.0": 3,
        "-3.0": -3,
        "1e3": 1000,
        "9223372036854775807": 9223372036854775807,
        "9007199254740993": 9007199254740993,
        "1e300": None,
        "NaN": None,
        "abc": None,
        None: None,
    }
    assert apply(spark, wholes, as_bigint) == list(wholes.values())


def test_blanks_are_pythons_blanks():
    assert sorted(BLANKS) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


@pytest.mark.parametrize("fallback", ["place", "null"])
def test_area(spark, fallback):
    cases = {
        "5 km NNE of Saanichton, Canada": "Saanichton, Canada",
        "South of the Fiji Islands": "the Fiji Islands",
        "A of of B": "of B",
        "A of B of C": "B of C",
        " of X": "X",
        "A of ": "",
        "A of    ": "",
        "A of \t X  ": "X",
        "A of \x1cX\x1f": "X",
        "A of X y　": "X y",
    }
    without = ["of X", "a OF b", "Aof B", "A ofB", "  Alaska  ", "", "Alaska\t"]
    for place in without:
        cases[place] = place if fallback == "place" else None
    cases[None] = None
    assert apply(spark, cases, lambda v: area_of(v, fallback)) == list(cases.values())


pieces = st.sampled_from([" of ", "of", " ", "\t", " ", " ", "\x1c", "é", "x", "日本"])
texts = st.lists(
    st.lists(st.one_of(pieces, st.text(max_size=3)), max_size=8).map("".join),
    min_size=100,
    max_size=200,
)


@few
@given(values=texts)
def test_area_and_strip_equal_python(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]

    def expected(place):
        _, found, after = place.partition(" of ")
        return after.strip() if found else place

    assert apply(spark, values, area_of) == [expected(v) for v in values]
    assert apply(spark, values, strip) == [v.strip() for v in values]


@pytest.mark.parametrize("text", ["5d", "5f", "0x1p3", "NaN", "Infinity", "-Infinity", "1e999", "1_0", ""])
def test_spellings_that_are_no_numbers(spark, text):
    token = F.lit(text)
    row = spark.range(1).select(as_double(token).alias("d"), as_bigint(token).alias("n")).first()
    assert (row.d, row.n) == (None, None)
