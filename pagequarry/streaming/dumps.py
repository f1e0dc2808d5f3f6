"""Dump files that keep arriving in a folder."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pagequarry.operators.importing import (
    NUMBER_FORM, is_number, is_timestamp, narrowed, number, page_rows, rejected_rows, revision_rows, statistics_columns,
    text_rows,
)
from pagequarry.scale import broadcast_if_small, materialise
from pagequarry.session import drop_scratch, scratch_path
from pagequarry.sources.dump import PAGE_END, corrupt_pages, parse_pages, well_formed


def read_page_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Raw pages of the dump files that appear in ``folder``, those that are no
    well-formed XML included (:func:`start_import` sets them aside)."""
    records = (
        spark.readStream.option("lineSep", PAGE_END).option("maxFilesPerTrigger", files_per_batch).text(folder)
    )
    return parse_pages(records)


#: Name of the metrics that an import observes in every batch.
METRICS = "import_progress"


@dataclass(frozen=True)
class Progress:
    """What an import had read when a batch ended: pages as they arrive, those
    skipped later included, and the seconds its batches took."""

    batch: int
    pages: int
    revisions: int
    text_bytes: int
    seconds: float

    def rates(self) -> dict[str, float]:
        """Pages, revisions and bytes a second since the query started."""
        seconds = max(self.seconds, 1e-3)
        return {name: getattr(self, name) / seconds for name in ("pages", "revisions", "text_bytes")}

    def line(self) -> str:
        rate = self.rates()
        return (
            f"batch {self.batch}: {self.pages} pages ({rate['pages']:.3f}/s), {self.revisions} revisions "
            f"({rate['revisions']:.3f}/s), {self.text_bytes} bytes of text in {self.seconds:.1f} seconds"
        )


def log_progress(progress: Progress) -> None:
    logging.getLogger(__name__).info(progress.line())


class ImportProgress(StreamingQueryListener):
    """Tells the running totals of every import of a session as its batches end.

    The figures are metrics observed by the tasks that parse the batch, so no
    job is run for them; the driver keeps one total for each running query.
    Add it with ``spark.streams.addListener``. Totals begin anew when a query is
    started again, as the seconds do.
    """

    def __init__(self, tell: Callable[[Progress], None] = log_progress) -> None:
        self._tell = tell
        self._totals: dict[str, Progress] = {}

    def onQueryStarted(self, event) -> None:
        self._totals[str(event.runId)] = Progress(-1, 0, 0, 0, 0.0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if seen is None or not progress.numInputRows:
            return
        run = str(progress.runId)
        before = self._totals.get(run, Progress(-1, 0, 0, 0, 0.0))
        total = Progress(
            progress.batchId, before.pages + seen["pages"], before.revisions + seen["revisions"],
            before.text_bytes + seen["text_bytes"], before.seconds + progress.batchDuration / 1000,
        )
        self._totals[run] = total
        self._tell(total)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._totals.pop(str(event.runId), None)


#: Batches whose state is merged into one table.
MERGED = 16


def start_import(
    raw: DataFrame, namespaces: DataFrame, base: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Import every batch into ``base``: page, revision and text, the rejected
    rows, the source of pages that are no well-formed XML (``corrupt``), and how
    many pages were ``new``, ``updated`` and ``skipped`` (``counts``).

    The state of the import is the greatest accepted revision of each page, two
    numbers a page. A page that comes again brings its revisions beyond that one
    and a new page row; without such it is skipped, and so is a repeat within a
    batch. A batch writes the state of the pages it took; every ``MERGED``
    batches the states become one table, so a batch reads no table of pages or
    bodies that another wrote. A batch has its own folder and replaces it as a
    whole, so a batch run again after a failure leaves no row twice. Its pages
    are staged as Parquet in the shared folder, for the tables read them more
    than once. ``once`` takes what is there and ends. What a batch read is
    observed as ``METRICS``, which :class:`ImportProgress` tells.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # The caller's session: a stream's own may have adaptive execution off.
        spark = raw.sparkSession
        staged = scratch_path(spark, "batch")
        narrowed(batch).withColumn("_row", F.monotonically_increasing_id()).write.parquet(staged)
        held = spark.read.parquet(staged)
        taken, state, counts = _taken(well_formed(held), _state(spark, base, batch_id))
        tables = {
            "page": page_rows(taken.where("_page"), namespaces),
            "revision": revision_rows(taken),
            "text": text_rows(taken),
            "rejected": rejected_rows(taken),
            "corrupt": corrupt_pages(held),
            "counts": counts,
        }
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")
        state.write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")
        if batch_id % MERGED == MERGED - 1:
            _state(spark, base, batch_id + 1).write.mode("overwrite").parquet(f"{base}/merged/{batch_id}")
        drop_scratch(spark, staged)

    writer = raw.observe(METRICS, *statistics_columns()).writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()


def _taken(new: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pages of a batch with the revisions to import (``_page``: gives the
    page row), the state of those pages, and the counts.

    Settled on ids: bodies are moved once, to the pages taken.
    """
    ids = new.select("_row", number(F.col("id")).alias("page_id"), F.col("revision.id").alias("rev"), F.col("revision.timestamp").alias("at"))
    pages = ids.where(F.col("page_id").isNotNull())
    known = state if state is not None else new.sparkSession.range(0).select(F.col("id").alias("page_id"), F.col("id").alias("known"))
    pairs = pages.join(known, "page_id", "left").select(
        "_row", "page_id", "known", F.explode_outer(F.arrays_zip("rev", "at")).alias("r")
    )
    accepted = is_number(F.col("r.rev")) & is_timestamp(F.col("r.at"))
    pairs = pairs.select("_row", "page_id", "known", F.when(accepted, number(F.col("r.rev"))).alias("rev"))
    fresh = pairs.where(F.col("rev") > F.coalesce("known", F.lit(-1)))
    # A revision sent twice in a batch is that of the first row.
    fresh = fresh.groupBy("page_id", "rev").agg(F.min("_row").alias("_row"), F.max("known").alias("known"))
    rows = fresh.groupBy("page_id", "_row").agg(F.collect_list("rev").alias("_revs"), F.max("rev").alias("greatest"), F.max("known").alias("known"))
    # A page not met before is taken without a revision too, once.
    bare = pairs.where(F.col("known").isNull()).groupBy("page_id").agg(F.min("_row").alias("_row"))
    bare = bare.join(rows.select("page_id").distinct(), "page_id", "left_anti").select(
        "page_id", "_row", F.array().cast("array<bigint>").alias("_revs"), F.lit(-1).cast("long").alias("greatest"), F.lit(None).cast("long").alias("known")
    )
    newest = F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("greatest").desc(), "_row"))
    chosen, size = materialise(rows.unionByName(bare).withColumn("_page", newest == 1))
    # Revisions that a check drops stay with the page, which lists them.
    checked = lambda r: r["id"].rlike(NUMBER_FORM) & is_timestamp(r["timestamp"])
    wanted = lambda r: ~F.coalesce(checked(r), F.lit(False)) | F.array_contains("_revs", number(r["id"]))
    texts = F.filter("texts", lambda _, n: wanted(F.get("revision", n)))
    own = new.join(broadcast_if_small(chosen.select("_row", "_revs", "_page"), size), "_row")
    own = own.withColumns({"revision": F.filter("revision", wanted), "texts": texts}).drop("_revs")
    nameless = new.where(~is_number(F.col("id"))).withColumn("_page", F.lit(True))
    taken = own.unionByName(nameless.select(own.columns)).drop("_row")
    fold = chosen.groupBy("page_id").agg(F.max("greatest").alias("known"), F.max("known").alias("before"))
    all_pages = pages.agg(F.countDistinct("page_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    met = fold.agg(F.count_if(F.col("before").isNull()).alias("new"), F.count_if(F.col("before").isNotNull()).alias("updated"))
    skipped = all_pages.join(met, F.lit(True)).select("new", "updated", (F.col("n") - F.col("new") - F.col("updated")).alias("skipped"), (F.col("rows") - F.col("n")).alias("repeated"))
    return taken, fold.select("page_id", "known"), skipped


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _state(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    """``(page_id, known)`` before a batch: the last merged table and the states
    of the batches since."""
    merged = (batch_id // MERGED) * MERGED - 1
    parts = []
    if merged >= 0 and _exists(spark, f"{base}/merged/{merged}/_SUCCESS"):
        parts.append(spark.read.parquet(f"{base}/merged/{merged}"))
        since = merged + 1
    else:
        since = 0
    parts += [spark.read.parquet(p) for n in range(since, batch_id) if _exists(spark, p := f"{base}/state/batch={n}")]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).groupBy("page_id").agg(F.max("known").alias("known"))


def imported_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """All batches of one table; of a page that came again, its newest row."""
    rows = spark.read.parquet(f"{base}/{name}")
    if name == "page":
        newest = F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("batch").desc()))
        # Rows without a valid id are not one page.
        rows = rows.withColumn("_place", F.when(F.col("page_id").isNotNull(), newest)).where("_place is null or _place = 1").drop("_place")
    return rows.drop("batch")
