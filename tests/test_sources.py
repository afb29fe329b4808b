from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import instant
from pyspark.sql import functions as F

from streamlookup.sources.dimensions import jdbc_options, read_dim, read_jdbc, write_dim, write_jdbc
from streamlookup.sources.messages import MESSAGE, message_rows, normalise, read_messages, write_messages
from streamlookup.sources.shared import open_folder, qualified, temporary, work_folder, written


def test_broker_rows_become_messages(spark):
    row = (b"k", "http://hö.com".encode(), instant(5))
    rows = spark.createDataFrame([row], "key binary, value binary, timestamp timestamp")
    messages = normalise(rows)
    assert messages.schema == MESSAGE
    assert messages.select("url", F.unix_millis("ts")).first() == ("http://hö.com", 5)


def test_messages_from_memory(spark):
    rows = message_rows(spark, ["a", None, ("b", instant(1))])
    assert rows.schema == MESSAGE
    assert [(r["url"], r["ts"] is None) for r in rows.collect()] == [("a", True), (None, True), ("b", False)]


def test_messages_out_and_in(spark, tmp_path):
    folder = str(tmp_path / "out")
    write_messages(message_rows(spark, ["a", "b"]), "text", F.upper("url"), {"path": folder})
    write_messages(message_rows(spark, ["c"]), "text", "url", {"path": folder})
    bounded = read_messages(spark, "text", {"path": folder}, ts=None, streaming=False)
    assert sorted(r["url"] for r in bounded.collect()) == ["A", "B", "c"]

    stream = read_messages(spark, "text", {"path": folder}, ts=None)
    assert stream.isStreaming and stream.schema == MESSAGE
    again = str(tmp_path / "again")
    writer = write_messages(stream, "text", "url", {"path": again}, checkpoint=str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["value"] for r in spark.read.text(again).collect()) == ["A", "B", "c"]
    with pytest.raises(ValueError, match="checkpoint"):
        write_messages(stream, "text", "url", {"path": again})


def test_table_is_replaced(spark, tmp_path, affiliate):
    path = str(tmp_path / "affiliate")
    write_dim(affiliate, "parquet", path)
    write_dim(affiliate.where("id = 2"), "parquet", path)
    assert [r["id"] for r in read_dim(spark, "parquet", path).collect()] == [2]


def test_database_options():
    plain = jdbc_options("jdbc:x", "affiliate", driver="d.Driver", properties={"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "affiliate", "driver": "d.Driver", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "affiliate", partition_column="id", lower=0, upper=100, partitions=4)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4" and split["upperBound"] == "100"
    with pytest.raises(ValueError, match="partitioned read"):
        jdbc_options("jdbc:x", "affiliate", partition_column="id")


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls.setdefault(name, []).append(args or kwargs)
            return self

        return note


def test_database_table_is_read_in_parts():
    reader = Recorder()
    bounds = {"partition_column": "id", "lower": 0, "upper": 100, "partitions": 4}
    read_jdbc(SimpleNamespace(read=reader), url="jdbc:x", table="affiliate", **bounds)
    assert reader.calls["format"] == [("jdbc",)] and reader.calls["load"] == [{}]
    assert reader.calls["options"] == [jdbc_options("jdbc:x", "affiliate", **bounds)]


def test_database_table_is_loaded():
    writer = Recorder()
    types = "source_domain VARCHAR(256)"
    write_jdbc(SimpleNamespace(write=writer), types, url="jdbc:x", table="affiliate", truncate=True)
    assert writer.calls["mode"] == [("overwrite",)] and writer.calls["save"] == [{}]
    assert writer.calls["option"] == [("batchsize", 10_000), ("truncate", "true"), ("createTableColumnTypes", types)]


def test_work_folders(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_folder(spark, "a") != work_folder(spark, "a")
    assert work_folder(spark, "a").startswith(f"file:{shared}")


def test_work_folders_are_named_with_their_file_system(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and qualified(spark, "s3a://b/x") == "s3a://b/x"
    files, path = open_folder(qualified(spark, str(tmp_path)))
    assert files.type_name == "local" and path == str(tmp_path)
    assert open_folder(str(tmp_path))[1] == str(tmp_path)


def test_a_warehouse_on_this_machine_is_refused_on_a_cluster():
    for warehouse, master, fine in (("file:/w", "local[2]", True), ("file:/w", "yarn", False), ("hdfs://w", "yarn", True)):
        settings = {"spark.sql.warehouse.dir": warehouse}
        conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
        session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app", master=master), conf=conf)
        if fine:
            assert work_folder(session, "a").startswith(f"{warehouse}/work/streamlookup/app/a-")
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                work_folder(session, "a")


def test_work_folder_without_a_setting():
    settings = {"spark.sql.warehouse.dir": "hdfs://tables"}
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app", master="yarn"), conf=conf)
    assert work_folder(session, "a").startswith("hdfs://tables/work/streamlookup/app/a-")


def test_temporary_tables_are_deleted(spark):
    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    outer = written(spark.range(3), "outer")
    with pytest.raises(ZeroDivisionError), temporary(spark):
        assert written(spark.range(3), "inner").count() == 3
        assert len(list(shared.glob("**/inner-*"))) == 1
        1 / 0
    assert not list(shared.glob("**/inner-*"))
    assert outer.count() == 3


def test_a_written_table_is_not_worked_out_again(spark):
    table = written(spark.range(3).withColumn("x", F.rand()), "random")
    assert table.collect() == table.collect()
