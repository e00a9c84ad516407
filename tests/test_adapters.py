"""Code for packages that are absent here, against small stand-ins for them."""

import sys
import types
from types import SimpleNamespace

import pytest

from changetide.sources import kafka_messages
from changetide.spec import MESSAGE_SCHEMA, ORDERS
from changetide.streaming.delta import make_delta_writer

from helpers import ITEMS, messages_of, payload


class Reader:
    """Records options; loads a batch frame in the columns of the Kafka source."""

    def __init__(self, spark):
        self.spark, self.settings = spark, {}

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **settings):
        self.settings.update(settings)
        return self

    def load(self):
        return self.spark.sql(
            "SELECT CAST('k' AS BINARY) AS key, CAST('{}' AS BINARY) AS value, 't' AS topic, "
            "3 AS partition, 7L AS offset, TIMESTAMP '2024-01-01' AS timestamp, 0 AS timestampType")


def test_kafka_frame_and_options(spark):
    reader = Reader(spark)
    frame = kafka_messages(SimpleNamespace(readStream=reader), "h:1", "a.b.orders",
                           {"minPartitions": "64", "startingOffsets": "latest"})
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in MESSAGE_SCHEMA]
    row = frame.first()
    assert (row.value, row.topic, row.partition, row.offset) == ("{}", "t", 3, 7)
    assert reader.settings == {
        "format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "a.b.orders",
        "startingOffsets": "latest", "failOnDataLoss": "false", "minPartitions": "64",
        "kafka.session.timeout.ms": "30000", "kafka.heartbeat.interval.ms": "10000"}


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "h:1", "t")


class Merge:
    """Records the clauses of a merge and the rows of its source."""

    def __init__(self, calls, source, condition):
        self.calls = calls
        calls["condition"] = condition
        calls["rows"] = sorted((r["k"], r["v"], r["__kind"]) for r in source.collect())

    def whenMatchedDelete(self, condition):
        self.calls["delete"] = condition
        return self

    def whenMatchedUpdate(self, set):
        self.calls["update"] = set
        return self

    def whenNotMatchedInsert(self, condition, values):
        self.calls["insert"] = (condition, values)
        return self

    def execute(self):
        self.calls["done"] = True


def test_delta_merge_gets_one_row_per_key(spark, monkeypatch):
    calls = {}

    class DeltaTable:
        @staticmethod
        def createIfNotExists(session):
            builder = SimpleNamespace(execute=lambda: calls.setdefault("created", True))
            builder.location = lambda path: calls.update(path=path) or builder
            builder.addColumns = lambda schema: calls.update(schema=schema) or builder
            return builder

        @staticmethod
        def forPath(session, path):
            table = SimpleNamespace(merge=lambda source, on: Merge(calls, source, on))
            table.alias = lambda name: table
            return table

    module = types.ModuleType("delta.tables")
    module.DeltaTable = DeltaTable
    monkeypatch.setitem(sys.modules, "delta", types.ModuleType("delta"))
    monkeypatch.setitem(sys.modules, "delta.tables", module)
    make_delta_writer(ITEMS, "somewhere")(messages_of(spark, [
        payload(1, 1, ts=1), payload(1, 2, ts=2), payload(2, 5, ts=3), payload(2, 6, "d", ts=4),
        "{bad"]), 0)
    assert calls["rows"] == [(1, 2, "upsert"), (2, 6, "delete")]
    assert calls["condition"] == "target.`k` = source.`k`"
    assert calls["delete"] == "source.__kind = 'delete'"
    assert calls["update"] == {"k": "source.`k`", "v": "source.`v`"}
    assert calls["insert"] == ("source.__kind = 'upsert'", calls["update"])
    assert (calls["path"], calls["schema"], calls["done"]) == ("somewhere", ITEMS.schema, True)


def test_delta_without_its_package_says_so(spark):
    with pytest.raises(ImportError, match="delta"):
        make_delta_writer(ORDERS, "x")
