"""Audited outputs and checked layouts."""

from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from verdigris.operators import quality
from verdigris.sources import storage
from verdigris.sources.layout import Layout, misplaced, read_layout, write_layout
from verdigris.sources.publish import Published


@pytest.fixture
def checks(spark):
    return [quality.not_null("k"), quality.unique("k"), quality.accepted_range("v", low=0)]


def test_a_failed_audit_leaves_the_old_version(spark, tmp_path, checks):
    target = str(tmp_path / "out")
    output = Published(spark, target)
    with pytest.raises(quality.QualityError):
        output.read()
    good = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    assert output.publish(good, checks) == {"rows": 2, "not_null:k": 0, "unique:k": 0, "accepted_range:v": 0}
    for bad, reason in (
        ([(1, 1.0), (1, 2.0), (3, 1.0)], "unique:k: 1"),
        ([(None, 1.0)], "not_null:k: 1"),
        ([(None, -1.0), (4, -1.0)], "not_null:k: 1; accepted_range:v: 2"),
        ([], "rows: 0"),
    ):
        with pytest.raises(quality.QualityError, match=f"^{reason}$"):
            output.publish(spark.createDataFrame(bad, "k int, v double"), checks)
        assert rows(output.read(), "k") == [(1, 2.0), (2, 3.0)] and output.versions() == [0]
        assert storage.names(spark, f"{target}/data") == ["version=0"]
    broken = good.withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        output.publish(broken, checks)
    assert storage.names(spark, f"{target}/data") == ["version=0"]
    output.publish(good.withColumn("v", F.col("v") * 10), checks)
    assert rows(output.read(), "k") == [(1, 20.0), (2, 30.0)] and rows(output.read(0), "k") == [(1, 2.0), (2, 3.0)]
    output.publish(good.filter("k = 1"), checks)
    assert output.versions() == [1, 2] and storage.names(spark, f"{target}/data") == ["version=1", "version=2"]
    assert output.metrics()["rows"] == 1
    # rows that were written without a manifest are not seen, and the next version takes their place
    good.write.parquet(f"{target}/data/version=3")
    assert output.read().count() == 1
    output.publish(good, [])
    assert output.read().count() == 2


def test_enforce_reports_the_first_in_order(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0)], "k int, v double")
    with pytest.raises(quality.QualityError, match="^unique:k: 1$"):
        quality.enforce(df, [quality.not_null("k"), quality.unique("k"), quality.accepted_range("v", low=0)])
    with pytest.raises(quality.QualityError, match="^accepted_range:v: 1$"):
        quality.enforce(df, [quality.accepted_range("v", low=0), quality.unique("k")])
    with pytest.raises(quality.QualityError, match="^unique:k: 1; accepted_range:v: 1$"):
        quality.enforce(df, [quality.unique("k"), quality.accepted_range("v", low=0)], fail_fast=False)


@pytest.fixture
def by_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_and_group_without_an_exchange(spark, tmp_path, by_exchange):
    df = spark.range(500).select((F.col("id") % 37).cast("int").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT CAST(NULL AS INT), 7L"))
    layout = Layout(("k", "v"), ("k",), 5)
    keys = [f"staging.t{uuid.uuid4().hex}" for _ in range(2)]
    for i, key in enumerate(keys):
        write_layout(df, key, layout, str(tmp_path / f"t{i}"))
    one, two = (read_layout(spark, key, layout, verify=True) for key in keys)
    joined = one.join(two.withColumnRenamed("v", "w"), "k").groupBy("k").agg(F.count("*").alias("n"))
    assert "Exchange" not in _plan(joined)
    assert sorted(rows(joined)) == sorted(rows(df.join(df.withColumnRenamed("v", "w"), "k").groupBy("k").agg(F.count("*").alias("n"))))
    assert len(one.inputFiles()) == 5
    with pytest.raises(quality.QualityError, match="not as"):
        read_layout(spark, keys[0], Layout(("k", "v"), ("k",), 6))
    with pytest.raises(quality.QualityError, match="None"):
        name = f"plain{uuid.uuid4().hex}"
        df.write.option("path", str(tmp_path / name)).saveAsTable(f"staging.{name}")
        read_layout(spark, f"staging.{name}", layout)
    # rows of another bucket or order in a file of the table
    files = sorted(p for p in storage.names(spark, str(tmp_path / "t0")) if p.startswith("part-"))
    storage.rename(spark, str(tmp_path / "t0" / files[0]), str(tmp_path / "kept"))
    spark.read.parquet(str(tmp_path / "t0" / files[1])).coalesce(1).write.parquet(str(tmp_path / "other"))
    other = next(p for p in storage.names(spark, str(tmp_path / "other")) if p.startswith("part-"))
    storage.rename(spark, str(tmp_path / "other" / other), str(tmp_path / "t0" / files[0]))
    spark.catalog.refreshTable(keys[0])
    with pytest.raises(quality.QualityError, match="not where"):
        read_layout(spark, keys[0], layout, verify=True)


def test_ranges_of_files_don_t_meet(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v")).repartition(6)
    key, layout = f"staging.r{uuid.uuid4().hex}", Layout(("k",))
    write_layout(df, key, layout, str(tmp_path / "r"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    stored = read_layout(spark, key, layout, verify=True)
    assert stored.count() == 1000 and len(stored.inputFiles()) > 1
    spark.range(400, 600).select(F.col("id").alias("k"), F.lit("y").alias("v")).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
    spark.catalog.refreshTable(key)
    assert misplaced(spark.table(key), layout) > 0
