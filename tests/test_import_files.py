"""Tables of a streaming import: files of a batch follow its rows."""

from pathlib import Path

from pyspark.sql import functions as F

from pagequarry.operators.importing import narrowed
from pagequarry.session import scratch_path
from pagequarry.sources.dump import PAGE_END, parse_pages, well_formed
from pagequarry.streaming.dumps import _taken, imported_table, read_page_stream, start_import

PAGE = (
    "<page>\n<title>T{n}</title><id>{n}</id><revision><id>{n}1</id><timestamp>2009-01-01T00:00:00Z</timestamp>"
    "<contributor><ip>10.0.0.1</ip></contributor><text>x {n}</text></revision>\n</page>"
)


def test_a_batch_writes_few_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for part in (0, 1):
            (tmp_path / f"dump-{part}.xml").write_text("".join(PAGE.format(n=n) for n in range(part * 30, part * 30 + 60)))
        base = scratch_path(spark, "files")
        names = spark.createDataFrame([(0, "")], "ns_id int, ns_name string")
        raw = read_page_stream(spark, str(tmp_path), files_per_batch=1)
        start_import(raw, names, base, scratch_path(spark, "state")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for name in ("page", "revision", "text", "state", "rejected", "counts"):
        for batch in (0, 1):
            files = list(Path(base.removeprefix("file:"), name, f"batch={batch}").glob("part-*"))
            assert 0 < len(files) <= 12, (name, len(files))
    assert sorted(r.page_id for r in imported_table(spark, base, "page").collect()) == list(range(90))
    assert imported_table(spark, base, "text").count() == 90


def test_pages_of_a_small_batch_are_not_shuffled(spark, tmp_path):
    (tmp_path / "dump.xml").write_text("".join(PAGE.format(n=n) for n in range(20)))
    raw = well_formed(parse_pages(spark.read.option("lineSep", PAGE_END).text(str(tmp_path))))
    stored = scratch_path(spark, "held")
    narrowed(raw).withColumn("_row", F.monotonically_increasing_id()).write.parquet(stored)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # sizes are measured, not guessed
    try:
        taken, state, _ = _taken(spark.read.parquet(stored), None)
        plan = taken._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert taken.count() == 20 and state.count() == 20
