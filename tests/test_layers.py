import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

import frames as T
from frames import rows
from tillworks import schemas
from tillworks.operators import merge
from tillworks.sources import layers as Y


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, part string, v string")


def test_replace_and_versions(spark, store):
    for i in range(5):
        store.replace(frame(spark, (i, "a", "x")), "gold.t")
    assert rows(store.read("gold.t"), "k") == [(4,)]
    kept = sorted(os.listdir(f"{store.root}/gold/t"))
    assert len(kept) == 5  # replaced versions stay for a while
    for version in (2, 3):  # replaced two days ago by these
        os.utime(f"{store.root}/gold/t/version={version}/_SUCCESS", (time.time() - 172_800,) * 2)
    store.replace(frame(spark, (9, "a", "x")), "gold.t")
    kept = sorted(os.listdir(f"{store.root}/gold/t"))
    assert kept == ["version=3", "version=4", "version=5", "version=6"]


@pytest.mark.parametrize("name,parts", [("gold.follow_a", []), ("gold.follow_b", ["part"])])
def test_registered_tables_follow_every_write(spark, store, name, parts):
    store.replace(frame(spark, (0, "a", "x")), name, parts)
    store.register(name, parts)
    before = spark.table(name)
    columns = ["k", "part", "v"]
    for i in range(1, 6):
        store.replace(frame(spark, (i, "a", "x"), (i, "b", "y")), name, parts)
        assert sorted(rows(spark.table(name), *columns)) == [(i, "a", "x"), (i, "b", "y")]
    store.append(frame(spark, (7, "c", "z")), name, parts)
    assert sorted(rows(spark.table(name), *columns)) == sorted(rows(store.read(name), *columns))
    if parts:
        store.overwrite_partitions(frame(spark, (8, "d", "z"), (9, "a", "w")), name, parts)
        assert sorted(rows(spark.table(name), *columns)) == [(5, "b", "y"), (7, "c", "z"), (8, "d", "z"), (9, "a", "w")]
    assert rows(before.sparkSession.read.parquet(f"{store.root}/{name.replace('.', '/')}/version=1"), "k") == [(0,)]
    spark.sql(f"DROP TABLE {name}")


def test_updates_with_a_key_twice_are_refused(spark, store):
    store.replace(frame(spark, (1, "a", "x")), "gold.t", ["part"])
    twice = frame(spark, (1, "a", "y"), (1, "a", "z"))
    with pytest.raises(ValueError, match="more than once"):
        store.upsert(twice, "gold.t", ["k"])
    with pytest.raises(ValueError, match="more than once"):
        store.upsert_partitions(twice, "gold.t", ["k"], ["part"])
    assert rows(store.read("gold.t"), "v") == [("x",)]


def test_a_table_can_be_rewritten_from_itself(spark, store):
    store.replace(frame(spark, (1, "a", "x")), "gold.t")
    store.replace(store.read("gold.t").withColumn("v", F.lit("y")), "gold.t")
    assert rows(store.read("gold.t")) == [(1, "a", "y")]


def test_a_version_without_success_marker_is_ignored(spark, store):
    store.replace(frame(spark, (1, "a", "x")), "gold.t")
    os.makedirs(f"{store.root}/gold/t/version=2")
    assert rows(store.read("gold.t"), "k") == [(1,)]
    store.replace(frame(spark, (3, "a", "x")), "gold.t")
    assert store.location("gold.t").endswith("version=3") and rows(store.read("gold.t"), "k") == [(3,)]


def test_missing_table(spark, store):
    assert not store.exists("gold.t")
    with pytest.raises(FileNotFoundError):
        store.read("gold.t")
    assert store.read_or_empty("ops.processed_dates").columns == schemas.PROCESSED_DATES.names


def test_partition_overwrite_leaves_the_others(spark, store):
    store.overwrite_partitions(frame(spark, (1, "a", "x"), (2, "b", "x")), "gold.t", ["part"])
    new = frame(spark, (3, "b", "y"), (4, "c", "y"))
    for _ in range(2):  # a rerun replaces
        store.overwrite_partitions(new, "gold.t", ["part"])
    assert sorted(rows(store.read("gold.t"), "k", "part", "v")) == [(1, "a", "x"), (3, "b", "y"), (4, "c", "y")]


def test_append(spark, store):
    for _ in range(2):
        store.append(frame(spark, (1, "a", "x")), "ops.t")
    assert store.read("ops.t").count() == 2


def test_upsert(spark, store):
    store.upsert(frame(spark, (1, "a", "x"), (2, "a", "x")), "gold.t", ["k"])
    store.upsert(frame(spark, (2, "b", "y"), (3, "b", "y")), "gold.t", ["k"])
    assert sorted(rows(store.read("gold.t"))) == [(1, "a", "x"), (2, "b", "y"), (3, "b", "y")]


def test_upsert_partitions_touches_only_its_partitions(spark, store):
    store.upsert_partitions(
        frame(spark, (1, "a", "x"), (2, "b", "x"), (3, "b", "x")), "gold.t", ["k"], ["part"]
    )
    untouched = sorted(os.listdir(f"{store.location('gold.t')}/part=a"))
    store.upsert_partitions(frame(spark, (3, "b", "y"), (4, "c", "y")), "gold.t", ["k"], ["part"])
    assert sorted(rows(store.read("gold.t"), "k", "v")) == [(1, "x"), (2, "x"), (3, "y"), (4, "y")]
    assert sorted(os.listdir(f"{store.location('gold.t')}/part=a")) == untouched


def test_hot_partition_is_split_on_write(spark, store):
    """A month with nearly all rows does not end in one task."""
    df = spark.range(0, 400_000, 1, 8).select(
        F.col("id").alias("k"), F.when(F.col("id") < 8, "b").otherwise("a").alias("part"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        store.replace(df, "gold.t", ["part"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(f"{store.location('gold.t')}/part=a") if f.endswith("parquet")]
    assert len(files) > 1 and store.read("gold.t").count() == 400_000


def test_catalog(spark, store):
    store.ensure_layers()
    store.ensure_layers()  # again: nothing changes
    assert spark.table("silver.dim_date").columns == schemas.DIM_DATE.names
    assert spark.table("bronze.raw_transactions").count() == 0
    fact = T.fact(spark, [(dt.date(2010, 12, 1), 1, "UK", 1, 1, 1, "5.00"), (dt.date(2011, 1, 1), 1, "UK", 1, 1, 1, "5.00")])
    store.replace(fact, "silver.fact_sales_daily")
    store.register("silver.fact_sales_daily")
    assert spark.table("silver.fact_sales_daily").columns[-2:] == ["year", "month"]
    assert spark.sql("SELECT month FROM silver.fact_sales_daily WHERE year = 2010").collect() == [(12,)]
    for name in schemas.TABLES:
        spark.sql(f"DROP TABLE {name}")


def test_write_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    for _ in range(2):
        Y.write_table(frame(spark, (1, "a", "x")), "marts.t")
    assert spark.table("marts.t").count() == 1
    spark.sql("DROP DATABASE marts CASCADE")


def test_merge_operators(spark):
    a, b = frame(spark, (1, "a", "x"), (2, "a", "x")), frame(spark, (2, "b", "y"), (3, "b", "y"))
    assert sorted(rows(merge.upsert(a, b, ["k"]))) == [(1, "a", "x"), (2, "b", "y"), (3, "b", "y")]
    assert sorted(rows(merge.insert_absent(a, b, ["k"]))) == [(1, "a", "x"), (2, "a", "x"), (3, "b", "y")]
    assert rows(merge.find_duplicate_keys(a.union(b), ["k"])) == [(2, 2)]
    assert sorted(rows(merge.keep_latest(a.union(b), ["k"], ["part"]))) == [(1, "a", "x"), (2, "b", "y"), (3, "b", "y")]
