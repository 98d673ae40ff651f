from types import SimpleNamespace

import pytest

from tidegauge import config_table, configure, shared_dir


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_follows_the_session():
    named = session("spark://host:7077", spark_checkpoint_dir="hdfs://name/ck/")
    one, two = shared_dir(named, "a"), shared_dir(named, "a")
    assert one.startswith("hdfs://name/ck/tidegauge/a-") and one != two


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(session("spark://host:7077"), "a")
    assert "tidegauge" in shared_dir(session("local[2]"), "a")


def test_configure_pins_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_config_table_keeps_nested_types(spark):
    rows = [{"k": "a", "dims": [{"name": "x", "value": "1"}]}]
    table = config_table(spark, rows, "k string, dims array<struct<name:string,value:string>>")
    assert table.first().dims[0].value == "1"
