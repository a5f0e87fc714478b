"""Small helpers not exercised through the models."""

import datetime as dt

from pyspark.sql import functions as F

from larder.functions import dates as D
from larder.functions.nested import array_size, first_item
from larder.functions.predicates import if_, require, require_nonempty
from larder.operators.dedup import dedup, distinct_rows, one_per_key_max
from larder.operators.joins import bridge_lookup
from larder.sources import io as IO


def test_bridge_lookup_two_hops(spark):
    fact = spark.createDataFrame([("p1", "fr"), ("p2", "fr"), ("p3", "es")], "code string, country string")
    bridge = spark.createDataFrame([("p1", "en:a"), ("p2", "en:zz")], "code string, tag string")
    dim = spark.createDataFrame([("en:a", 7)], "tag string, sk int")
    got = {r.code: r.sk for r in bridge_lookup(fact, "code", bridge, "tag", dim, ["sk"]).collect()}
    assert got == {"p1": 7, "p2": None, "p3": None}


def test_if_size_first_item(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    rows = df.select(array_size("a").alias("n"), first_item("a").alias("f"),
                     if_(F.col("a").isNotNull(), "a").alias("same")).collect()
    assert [(r.n, r.f, r.same) for r in rows] == [(2, 1, [1, 2]), (0, None, []), (None, None, None)]


def test_run_id_format(spark):
    ts = spark.createDataFrame([(dt.datetime(2024, 6, 10, 8, 5, 9),)], "t timestamp")
    assert ts.select(D.run_id("PL", "t")).first()[0] == "PL_20240610_080509"


def test_require_and_dedup(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("b", "", 2), (None, "y", 3), ("c", None, 4)],
                               "k string, s string, n int")
    assert require(df, "k").count() == 4
    assert require_nonempty(df, "k", "s").count() == 2
    assert distinct_rows(df, ["k", "s"]).count() == 4
    assert dedup(df, ["k"]).count() == 4
    assert {r.k: r.max_n for r in one_per_key_max(df, "k", "n", "max_n").collect()} == \
        {"a": 1, "b": 2, None: 3, "c": 4}


def test_materialize_view(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    IO.materialize(df, "view", "tiny_view")
    assert spark.sql("SELECT sum(x) FROM tiny_view").first()[0] == 3


class _FakeContext:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _FakeSession:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _FakeContext(master, ckpt)
        self.conf = _FakeConf(conf or {})


def test_cluster_session_needs_a_shared_checkpoint_folder():
    import pytest
    from larder.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_FakeSession("yarn"))
    assert ensure_checkpoint_dir(_FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"
    assert ensure_checkpoint_dir(_FakeSession("yarn", ckpt="s3a://b/ckpt")) == "s3a://b/ckpt"
    assert ensure_checkpoint_dir(_FakeSession("local[2]", {"spark.sql.warehouse.dir": "/wh"})) == "/wh/larder-checkpoints"


def test_session_settings():
    """What a session of the library is set to (S19), without starting one."""
    import os
    from unittest import mock

    from larder import session

    class Builder:
        def __init__(self):
            self.conf = {}

        def appName(self, name):
            return self

        master = appName

        def config(self, k, v):
            self.conf[k] = v
            return self

        def getOrCreate(self):
            return self.conf

    env = {"LARDER_S3_ENDPOINT": "http://store:9000", "AWS_ACCESS_KEY_ID": "id", "AWS_SECRET_ACCESS_KEY": "secret"}
    with mock.patch.object(session, "SparkSession", mock.Mock(builder=Builder())), mock.patch.dict(os.environ, env):
        conf = session.get_session("x", shuffle_partitions=7, extra={"spark.sql.ansi.enabled": "true"})
    assert conf["spark.sql.adaptive.enabled"] == conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.session.timeZone"] == "UTC" and conf["spark.ui.enabled"] == "false"
    assert conf["spark.sql.shuffle.partitions"] == "7" and conf["spark.sql.ansi.enabled"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000" and conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any("secret" in str(v) for v in conf.values())  # credentials stay in the environment


def test_struct_arrays_filter_and_transform(spark, tmp_path):
    from larder.functions.nested import keep_items, map_items
    path = str(tmp_path / "items")
    spark.createDataFrame([(1, [("a", 1.0, "u"), ("b", 6.0, "u"), (None, 7.0, "u"), ("c", None, "u")]), (2, []), (3, None)],
                          "id int, items array<struct<name:string,v:double,unit:string>>").write.parquet(path)
    df = spark.read.parquet(path)
    out = df.select("id", keep_items("items", ["name", "v"], lambda i: i["v"] > 5).alias("kept"), map_items("items", ["name", "v"], lambda i: F.concat(i["name"], i["v"].cast("string"))).alias("made"))
    got = {r.id: ([tuple(x) for x in r.kept] if r.kept is not None else None, r.made) for r in out.collect()}
    assert got == {1: ([("b", 6.0), (None, 7.0)], ["a1.0", "b6.0", None, None]), 2: ([], []), 3: (None, None)}
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "items:array<struct<name:string,v:double>>" in plan.split("ReadSchema")[1].splitlines()[0]
