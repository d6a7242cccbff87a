"""The written log: no shuffle on the way, files per application, small enough for many tasks."""

from pyspark.sql import functions as F

from pulselog.plans import queries
from pulselog.session import configured, tune
from pulselog.sources.event_log import app_id_from_path


def test_lines_are_written_where_they_arise(spark, monkeypatch):
    monkeypatch.setattr(queries, "LOG_FILE_LINES", 40)
    lines = spark.range(0, 600, numPartitions=3).select(
        F.concat(F.spark_partition_id(), F.lit(" "), "id").alias("value"),
        F.concat(F.lit("app-"), F.col("id") % 4).alias("appId"),
    )
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    log = queries._written_log(spark, lines)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    found = spark.read.option("recursiveFileLookup", "true").text(log).select(
        "value", app_id_from_path(F.col("_metadata.file_path")).alias("appId"),
        F.col("_metadata.file_path").alias("file"),
    )
    assert sorted(found.select("value", "appId").collect()) == sorted(lines.collect())
    origin = F.substring_index("value", " ", 1)
    files = found.groupBy("file").agg(F.countDistinct(origin).alias("origins"), F.count("*").alias("n"))
    assert {tuple(r) for r in files.select("origins").distinct().collect()} == {(1,)}
    assert files.agg(F.max("n")).first()[0] <= 40 and files.count() == 3 * 4 * 2


def test_records_are_stored_by_zstd_unless_told_otherwise(spark, tmp_path):
    codec = "spark.sql.parquet.compression.codec"
    with configured(spark, codec, "snappy"):
        tune(spark).range(5).write.parquet(str(tmp_path / "a"))
        assert all(".zstd." in p.name for p in (tmp_path / "a").glob("part*"))
    with configured(spark, codec, "gzip"):
        assert tune(spark).conf.get(codec) == "gzip"


def test_records_of_a_written_log_are_stored_at_a_higher_level(spark, sf_dir):
    """Log and result lie on disk together. The level ends with the next query; one's own stays."""
    key = "parquet.compression.codec.zstd.level"
    tune(spark)
    queries.QUERIES["event_files_records"](spark, sf_dir)
    assert spark.conf.get(key) == "9"
    queries.QUERIES["executor_added"](spark, sf_dir)
    assert spark.conf.get(key) == "3"
    with configured(spark, key, "7"):
        queries.QUERIES["executor_added"](spark, sf_dir)
        assert spark.conf.get(key) == "7"


def test_a_batch_has_work_for_all_cores(spark, sf_dir, monkeypatch):
    """Files of a batch follow the cores, and the streamed log isn't packed at the slowest level."""
    asked, levels = [], []
    read, write = queries.read_event_stream, queries._written_log
    monkeypatch.setattr(queries, "LOG_FILES_PER_BATCH", 1)
    monkeypatch.setattr(queries, "read_event_stream", lambda *a, **k: asked.append(k) or read(*a, **k))
    monkeypatch.setattr(queries, "_written_log", lambda s, rows, level: levels.append(level) or write(s, rows, level))
    assert queries.event_stream_records(spark, sf_dir).count() > 0
    assert asked[0]["max_files_per_trigger"] == 2 * spark.sparkContext.defaultParallelism
    assert levels == ["DEFAULT_COMPRESSION"]
