"""Every registered query against its SQL."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from compare import assert_same, duck

from tremorline.plans.registry import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query(spark, sf_dir, connection, name):
    answer = contract.queries()[name](spark, sf_dir)
    assert assert_same(answer, connection, contract.oracle_sql()[name]) > 0


@pytest.mark.parametrize(
    "setting, value, names",
    [
        ("spark.sql.session.timeZone", "Asia/Kolkata", ["incremental_ingest", "time_utc"]),
        ("spark.sql.ansi.enabled", "false", ["clean_nested", "lenient_numbers"]),
        ("spark.sql.caseSensitive", "true", ["clean_nested", "typed_table"]),
        ("spark.sql.adaptive.enabled", "false", ["strongest_region_partitioned"]),
        ("spark.sql.autoBroadcastJoinThreshold", "-1", ["incremental_ingest"]),
    ],
)
def test_session_settings_change_nothing(spark, sf_dir, connection, setting, value, names):
    before = spark.conf.get(setting)
    try:
        for name in names:
            spark.conf.set(setting, value)
            answer = contract.queries()[name](spark, sf_dir)
            assert_same(answer, connection, contract.oracle_sql()[name])
    finally:
        spark.conf.set(setting, before)


def test_entry(spark, sf_dir):
    assert contract.entry(spark).columns == ["area", "n"]
