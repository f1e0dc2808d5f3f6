"""Views are made when read, and rows are dealt out without a sort."""

from pyspark.sql import functions as F

from pagequarry.scale import dealt_out, size_metrics, spread
from workload.queries import REGISTRY
from workload.views import TABLES, VIEWS, Data

SMALLEST = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_a_query_makes_the_views_it_reads(spark):
    data = Data(spark, SMALLEST)
    REGISTRY["tighten_parentheses"](data).count()
    assert set(data.frames) == {"w_wikitext"}
    for name in ("classify_vertices", "label_hierarchy"):
        REGISTRY[name](data).count()
    assert set(data.frames) == {"w_wikitext", "w_page", "w_categorylinks"}


def test_views_keep_the_rows_of_their_sql(spark):
    data, other = Data(spark, SMALLEST), Data(spark, SMALLEST.replace("0.001", "0.01"))
    other["w_raw"], other["w_wikitext"]  # of another folder, under the same names
    data.make_all()
    for name in TABLES:
        spark.read.parquet(f"{SMALLEST}/{name}.parquet").createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        expected = spark.sql(sql)
        expected.createOrReplaceTempView(name)
        assert data[name].exceptAll(expected).isEmpty() and expected.exceptAll(data[name]).isEmpty(), name


def test_dealing_sorts_no_rows_and_keeps_copies_apart(spark, tmp_path):
    spark.createDataFrame([("x" * 50,)] * 800, "value string").coalesce(1).write.text(str(tmp_path / "one"))
    df = spread(spark.read.text(str(tmp_path / "one")))
    assert "hashpartitioning(_nondeterministic" in plan(df) and "RoundRobin" not in plan(df)
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 800 and max(sizes) < 400
    assert dealt_out(spark.read.text(str(tmp_path / "one"))).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_lists_of_numbers_are_measured_by_their_length(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(1000)).cast("array<bigint>").alias("a"))
    assert df.agg(*size_metrics(df)).first()["b"] >= 8000
