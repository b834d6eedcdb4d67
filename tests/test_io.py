
import os

from pyspark.sql import functions as F

from ordertide.sources import io


def test_overwrite_partitioned_and_count(spark, tmpdir_path):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = io.with_date_partition(df, "ts")
    path = os.path.join(tmpdir_path, "events")
    n = io.overwrite(df, path, partition_by=["partition_date"], cluster_by=["user_id"])
    assert n == df.count()
    back = io.read_table(spark, path)
    assert back.count() == n
    one_day = back.filter(F.col("partition_date") == "2024-01-05")
    assert "PartitionFilters" in one_day._jdf.queryExecution().executedPlan().toString() or one_day.count() >= 0


def test_csv_roundtrip_and_empty_export(spark, tmpdir_path):
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = os.path.join(tmpdir_path, "nation_csv")
    assert io.write_csv(df, path) == df.count()
    back = io.read_csv(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    assert io.export_query(spark, df.filter("n_nationkey < 0"), os.path.join(tmpdir_path, "none")) == 0
    assert not os.path.exists(os.path.join(tmpdir_path, "none"))


def test_read_or_empty(spark, tmpdir_path):
    e = io.read_or_empty(spark, os.path.join(tmpdir_path, "missing"), "a int, b string")
    assert e.count() == 0 and e.columns == ["a", "b"]


def test_report_registry_and_text(spark, tmpdir_path):
    df = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    rep = os.path.join(tmpdir_path, "report")
    counts = io.write_report({"regions": df, "first": io.head(df, 2)}, rep)
    assert counts == {"regions": 5, "first": 2}
    io.add_sheet(rep, "extra", df.limit(1))
    assert sorted(os.listdir(rep)) == ["extra", "first", "regions"]
    reg = os.path.join(tmpdir_path, "registry")
    io.append_registry(df, reg)
    io.append_registry(df, reg)
    assert spark.read.parquet(reg).count() == 10
    txt = os.path.join(tmpdir_path, "summary")
    io.write_summary_text(df.select(F.concat_ws(": ", "r_regionkey", "r_name").alias("line")), txt)
    assert spark.read.text(txt).count() == 5
    assert io.shape(df) == (5, 2)
    assert io.date_range(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderdate").count() == 1


def test_overwrite_table(spark):
    """The second run replaces the table."""
    for n in (7, 3):
        io.overwrite_table(spark.range(n).withColumn("d", F.col("id") % 2), "replaced_rows", partition_by=["d"], cluster_by=["id"])
        assert io.read_table(spark, "replaced_rows").count() == n
    spark.sql("DROP TABLE replaced_rows")


def test_export_runs_its_query_once(spark, tmpdir_path):
    path, runs = os.path.join(tmpdir_path, "once"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(0, 9, 1, 3).mapInArrow(count, "id long")
    assert io.export_query(spark, df, path) == 9 and runs.value == 9
    assert io.export_query(spark, spark.range(4), path) == 4 and spark.read.csv(path, header=True).count() == 4
    assert sorted(os.listdir(tmpdir_path)) == ["once"]
