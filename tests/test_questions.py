"""Every question against plain Python over a small table with ties, nulls and a hot region."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from tremorline import analyse, show_answers
from tremorline import operators as ops
from tremorline.sources import append_table, read_table

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    made = []
    for i in range(3000):
        # One region and the missing region hold most rows.
        area = random.choice(["hot"] * 12 + [None] * 6 + [f"r{n}" for n in range(12)])
        mag = random.choice([None, *[n / 4 for n in range(29)]])
        time = None if i % 50 == 0 else START + timedelta(minutes=random.randrange(20 * 24 * 60))
        made.append((area, mag, time))
    made.append(("lonely", None, None))
    return made


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, "area string, mag double, time timestamp").cache()


def found(frame):
    return Counter(tuple(row) for row in frame.collect())


def by_region(rows):
    groups = defaultdict(list)
    for area, mag, time in rows:
        groups[area].append((mag, time))
    return groups


def test_counts_and_values(events, rows):
    groups = by_region(rows)
    assert found(ops.count_by_region(events)) == Counter(
        (area, len(group)) for area, group in groups.items()
    )
    assert found(ops.magnitudes_by_region(events)) == Counter(
        (area, mag, n) for (area, mag), n in Counter((a, m) for a, m, _ in rows).items()
    )
    assert found(ops.area_and_magnitude(events)) == Counter((a, m) for a, m, _ in rows)


def test_means(events, rows):
    expected = {}
    for area, group in by_region(rows).items():
        mags = [mag for mag, _ in group if mag is not None]
        expected[area] = pytest.approx(sum(mags) / len(mags)) if mags else None
    answer = {row.area: row.avg_mag for row in ops.average_magnitude_by_region(events).collect()}
    assert answer == expected
    assert answer["lonely"] is None


def test_days(events, rows):
    days = Counter(time.date() for _, _, time in rows if time)
    both = Counter((time.date(), area) for area, _, time in rows if time)
    assert found(ops.count_by_day(events)) == Counter((d, n) for d, n in days.items())
    assert found(ops.count_by_day_and_region(events)) == Counter(
        (d, a, n) for (d, a), n in both.items()
    )
    [row] = ops.average_daily_count(events).collect()
    assert row.avg_n == pytest.approx(sum(days.values()) / len(days))
    per_area = defaultdict(list)
    for (_, area), n in both.items():
        per_area[area].append(n)
    answer = {row.area: row.avg_n for row in ops.average_daily_count_by_region(events).collect()}
    assert answer == {a: pytest.approx(sum(ns) / len(ns)) for a, ns in per_area.items()}
    assert "lonely" not in answer


def strongest(rows, start, end):
    recent = [
        (area, mag)
        for area, mag, time in rows
        if time and start < time <= end and area is not None and mag is not None
    ]
    peak = max((mag for _, mag in recent), default=None)
    return Counter({pair for pair in recent if pair[1] == peak})


def test_strongest(spark, events, rows, tmp_path):
    latest = max(time for _, _, time in rows if time)
    week = timedelta(days=7)
    expected = strongest(rows, latest - week, latest)
    assert len(expected) > 1, "the fixture should have ties"
    append_table(events, f"{tmp_path}/by-day", by_day=True)
    for table in (events, read_table(spark, f"{tmp_path}/by-day")):
        assert found(ops.strongest_regions(table)) == expected
        for as_of in (START + timedelta(days=10, hours=5), START + timedelta(minutes=1)):
            answer = ops.strongest_regions(table, as_of)
            assert found(answer) == strongest(rows, as_of - week, as_of)
        day = timedelta(days=1)
        naive = (START + 3 * day).replace(tzinfo=None)
        answer = ops.strongest_regions(table, naive, days=1)
        assert found(answer) == strongest(rows, START + 2 * day, START + 3 * day)
        assert found(ops.strongest_regions(table, START - day)) == Counter()


def test_period_is_open_at_its_start_and_closed_at_its_end(spark):
    end = START + timedelta(days=7)
    rows = [("start", 9.0, START), ("end", 1.0, end), ("after", 9.0, end + timedelta(seconds=1))]
    events = spark.createDataFrame(rows, "area string, mag double, time timestamp")
    assert found(ops.strongest_regions(events, end)) == Counter([("end", 1.0)])


def test_above_and_top(events, rows):
    groups = by_region(rows)
    groups.pop(None)
    above = {
        area: [mag for mag, _ in group if mag is not None and mag > 5]
        for area, group in groups.items()
    }
    assert found(ops.regions_above(events)) == Counter(
        (area, max(mags), len(mags)) for area, mags in above.items() if mags
    )
    ranked = []
    for area, group in groups.items():
        mags = [mag for mag, _ in group if mag is not None]
        ranked.append((area, len(group), max(mags, default=None)))
    ranked.sort(key=lambda r: (-r[1], -(r[2] if r[2] is not None else float("-inf")), r[0]))
    assert [tuple(row) for row in ops.top_regions(events, 5).collect()] == ranked[:5]
    assert [tuple(row) for row in ops.top_regions(events, 100).collect()] == ranked


def test_top_breaks_ties(spark):
    rows = [("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None), ("e", 1.0), ("e", 0.5)]
    events = spark.createDataFrame(rows, "area string, mag double")
    assert [row.area for row in ops.top_regions(events).collect()] == ["e", "c", "a", "b", "d"]


def test_empty_table(spark):
    events = spark.createDataFrame([], "area string, mag double, time timestamp")
    for question, answer in analyse(events).items():
        expected = [(None,)] if question == "avg_daily_count" else []
        assert [tuple(row) for row in answer.collect()] == expected


def test_answers_are_printed(events, capsys):
    show_answers(events)
    printed = capsys.readouterr().out
    for question in analyse(events):
        assert question in printed
    assert "hot" in printed


def test_shown_answers_tell_how_many_rows_there_are(spark, capsys):
    rows = [(f"r{i:03}", float(i % 7), datetime(2024, 1, 1 + i % 9)) for i in range(300)]
    events = spark.createDataFrame(rows, "area string, mag double, time timestamp")
    show_answers(events, 5)
    printed = capsys.readouterr().out
    assert "295 more rows" in printed and "r004\t1" in printed and "r005\t1" not in printed
    show_answers(events)
    printed = capsys.readouterr().out
    assert "more rows" not in printed and printed.count("r299") == 4
    show_answers(events.where("false"), 5)


def test_latest_version_of_each_event(spark):
    schema = "net string, code string, updated timestamp, insert_date timestamp, mag double, geometry struct<depth double>"
    day = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        ("us", "a", day[1], day[1], 1.0, (1.0,)),
        ("us", "a", day[2], day[0], 2.0, None),
        ("us", "a", None, day[4], 9.0, (1.0,)),
        ("ci", "a", day[0], day[0], 3.0, (1.0,)),
        ("us", "b", None, day[0], 4.0, (1.0,)),
        ("us", "b", None, day[1], None, (2.0,)),
        ("us", "c", day[0], day[0], 5.0, (1.0,)),
        ("us", "c", day[0], day[0], 6.0, (0.0,)),
        (None, "d", day[0], day[0], 7.0, None),
        (None, "d", day[0], day[0], 7.0, None),
        ("us", None, day[0], day[0], 8.0, None),
        ("us", None, day[0], day[0], 8.0, None),
    ]
    events = spark.createDataFrame(rows, schema)
    latest = ops.latest_events(events)
    assert latest.columns == events.columns
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window " not in plan and plan.count("Exchange") == 1
    found = sorted(((r.net, r.code, r.mag) for r in latest.collect()), key=repr)
    assert found == sorted(
        [("us", "a", 2.0), ("ci", "a", 3.0), ("us", "b", None), ("us", "c", 6.0), (None, "d", 7.0),
         ("us", None, 8.0), ("us", None, 8.0)],
        key=repr,
    )
