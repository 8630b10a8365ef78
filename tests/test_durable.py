import pytest
from pyspark.sql import functions as F

from listenlake.operators.durable import materialise, scratch_root
from listenlake.operators.star import hot_keys


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_the_cluster_names_the_folder():
    named = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_root(named) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        scratch_root(Session(spark_master="yarn"))
    local = Session(spark_master="local[2]")
    assert scratch_root(local) == scratch_root(local) != ""


def test_layout_values_are_frozen(spark):
    df = spark.range(0, 1000, 1, 5).withColumn("part", F.spark_partition_id())
    kept = materialise(df)
    assert kept.schema["part"].dataType == df.schema["part"].dataType
    counts = sorted(r["count"] for r in kept.repartition(2).groupBy("part").count().collect())
    assert counts == [200] * 5


def test_no_rows_have_no_hot_keys(spark):
    empty = spark.createDataFrame([], "k long")
    assert hot_keys(empty, ["k"]) == {"k": []}
    nulls = spark.createDataFrame([(None,), (None,)], "k long")
    assert hot_keys(nulls, ["k"]) == {"k": []}
