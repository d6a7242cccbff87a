"""Queries over tables that are folders of several files."""

import pytest
from compare import TABLES

from pulselog.plans import QUERIES


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(4).write.parquet(
            f"{root}/{name}.parquet"
        )
    return str(root)


@pytest.mark.parametrize(
    ("stream", "batch"),
    [("latest_samples_stream", "latest_samples"), ("scrape_samples_stream", "scrape_samples_15s")],
)
def test_streams_over_folders_equal_batch(spark, sf_dir, folders, stream, batch):
    got = QUERIES[stream](spark, folders)
    expected = QUERIES[batch](spark, sf_dir).select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("name", ["word_count", "stage_metrics", "tasks_ended", "stage_rollup"])
def test_batch_over_folders(spark, sf_dir, folders, name):
    one, many = QUERIES[name](spark, sf_dir), QUERIES[name](spark, folders)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
