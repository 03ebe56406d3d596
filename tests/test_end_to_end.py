"""The derived feed through landing and clean, against plain Python over the same lines."""

from __future__ import annotations

from collections import Counter

from plain import clean_rows

from tremorline.operators import clean, explode_features
from tremorline.sources import read_landing, write_landing
from tremorline.sources.derived_feed import feed_rows, to_documents, to_features


def test_feed(spark, sf_dir, tmp_path):
    documents = to_documents(to_features(feed_rows(spark, sf_dir)), per_document=64)
    write_landing(documents, f"{tmp_path}/landing")
    lines = [row.value for row in spark.read.text(f"{tmp_path}/landing").collect()]
    expected = Counter(clean_rows(lines))

    events = clean(explode_features(read_landing(spark, f"{tmp_path}/landing")))
    rows = events.select(*events.columns[:-1], "geometry.*").collect()
    assert Counter(tuple(row) for row in rows) == expected
    assert sum(expected.values()) == spark.read.parquet(f"{sf_dir}/events.parquet").count()
