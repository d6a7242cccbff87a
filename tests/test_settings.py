import pytest

from pulselog import Settings


def test_defaults():
    assert Settings.read({}) == Settings()
    assert Settings().extended is False
    assert Settings().job == "no-job-name"


def test_extended_mode():
    assert Settings.read({"spark.pulselog.extendedmode": "true"}).extended
    assert not Settings.read({"spark.pulselog.extendedmode": "false"}).extended
    with pytest.raises(ValueError):
        Settings.read({"spark.pulselog.extendedmode": "maybe"})


def test_numbers():
    settings = Settings.read({"spark.pulselog.connections": "2", "spark.pulselog.instance": "box"})
    assert (settings.connections, settings.instance, settings.max_files) == (2, "box", 64)
    for bad in ("0", "-1", "many"):
        with pytest.raises(ValueError):
            Settings.read({"spark.pulselog.maxFilesPerTrigger": bad})


def test_other_prefix_and_session_conf(spark):
    spark.conf.set("spark.mine.jobname", "nightly")
    spark.conf.set("spark.mine.pushgateway", "gw:9091")
    settings = Settings.read(spark.conf.get, "spark.mine")
    assert (settings.job, settings.require("push_gateway")) == ("nightly", "gw:9091")
    with pytest.raises(ValueError):
        settings.require("kafka_broker")
