"""Temperature mixing of sources, with DataFrame functions only.

A source's share of all tokens (blank-separated words) is raised to an exponent
between 0 (all sources alike) and 1 (shares as they are) and normalised. The
exponent is bisected to the flattest mixture that keeps every source within
``max_repetition`` passes, or to the steepest one whose entropy reaches
``target_entropy`` (nats). A weight becomes a budget of tokens: whole passes
over the source, then a part of one more. Every pass is a permutation of the
source's blocks (``BLOCK_DOCS`` neighbouring doc_ids) by a hash of seed, pass,
source and block; the partial pass takes the blocks that begin before the
budget is used up, so it is met to within a block.

Without a ``budget`` it is the smallest that drops no document: that of the
least repeated source, once. With one, less favoured sources are cut to it.

Offsets along a permutation are prefix sums on two levels (4,096 ranges of the
hash, then the blocks within one), so a source with a third of all rows is no
single task. Totals of sources are a small table that is measured before it is
broadcast.

Cases: a null source is a source; null and empty texts have no tokens; a source
without tokens has no weight and is passed over once (not at all with a
budget); rows of a source with the same doc_id go together, as do those with a
null one; an empty table gives an empty result; other columns are kept by
``mix`` and not read by ``mixture``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm.common import stage
from pagequarry.scale import broadcast_if_small

BLOCK_DOCS = 64
STEPS, POINTS = 20, 3  # each step evaluates three exponents: two bisections
SEED = "mix"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long")


def block_number(doc_id: str = "doc_id") -> Column:
    return F.floor(F.col(doc_id) / F.lit(BLOCK_DOCS))


def counted_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, t, block)``, written: later steps read no text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), token_count().alias("t"))
    return stage(narrow.withColumn("block", block_number()), "counted")


def exponent(totals: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> float:
    """The exponent that meets the repetition limit or the entropy."""
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give max_repetition or target_entropy")
    some = totals.where("tokens > 0")
    total = some.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    log = F.log(F.col("tokens") / F.lit(total))
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        tried = [low + (high - low) * n / (POINTS + 1) for n in range(1, POINTS + 1)]
        columns = []
        for t in tried:
            raised = F.exp(log * t)
            if target_entropy is not None:
                columns.append((F.log(F.sum(raised)) - F.lit(t) * F.sum(raised * log) / F.sum(raised)) >= target_entropy)
            else:
                passes = F.exp(log * (t - 1))  # passes over a source, but for a factor
                most = F.max(passes) / F.min(passes) if budget is None else F.max(passes) / F.sum(raised) * F.lit(budget / total)
                columns.append(most <= max_repetition)
        met = list(some.agg(*columns).first())
        # The entropy falls as the exponent grows, and so do the passes.
        flags = met if target_entropy is not None else [not m for m in met]
        n = flags.index(False) if False in flags else POINTS
        edges = [low, *tried, high]
        low, high = edges[n], edges[n + 1]
    return low if target_entropy is not None else high


def source_plan(counted: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """``(source, tokens, weight, budget, passes, rest)``: the tokens each
    source gets, as whole passes and what is left over."""
    totals = stage(counted.groupBy("source").agg(F.sum("t").alias("tokens")), "totals")
    t = exponent(totals, max_repetition, target_entropy, budget)
    some = totals.where("tokens > 0")
    one = some.agg(F.sum("tokens").alias("all")).first()["all"] or 1
    raised = F.exp(F.log(F.col("tokens") / F.lit(one)) * t)
    norm, least = some.agg(F.sum(raised), F.min(raised / F.col("tokens"))).first()
    # The smallest whole budget in which no source gets less than one pass.
    whole = float(budget) if budget is not None else (norm / least if least else 0.0)
    weight = F.when(F.col("tokens") > 0, raised / F.lit(norm or 1.0)).otherwise(0.0)
    planned = totals.withColumn("weight", weight).withColumn("budget", F.floor(F.col("weight") * whole + 1e-6).cast("long"))
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(0 if budget is not None else 1)
    planned = planned.withColumn("passes", passes.cast("long"))
    return stage(planned.withColumn("rest", F.greatest(F.col("budget") - F.col("passes") * F.col("tokens"), F.lit(0))), "plan")


def block_key(epoch: Column) -> Column:
    """Place of a block in a pass's permutation, as 32 hex digits."""
    return F.md5(F.concat_ws("|", F.lit(SEED), epoch.cast("string"), F.coalesce("source", F.lit("")), F.coalesce(F.col("block").cast("string"), F.lit(""))))


def partial_blocks(counted: DataFrame, plan: DataFrame) -> DataFrame:
    """``(source, block)`` of the blocks in the last, partial pass of each
    source, from ``counted(source, block, t)``."""
    blocks = counted.groupBy("source", "block").agg(F.sum("t").alias("t"))
    known = plan.where("rest > 0").select(F.col("source").alias("_source"), "passes", "rest")
    blocks = blocks.join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    keyed = blocks.withColumn("key", block_key(F.col("passes") + 1)).withColumn("range", F.substring("key", 1, 3))
    ranges = keyed.groupBy("source", "range").agg(F.sum("t").alias("range_t"))
    before = F.sum("range_t").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(F.col("source").alias("_source"), F.col("range").alias("_range"), F.coalesce(before, F.lit(0)).alias("range_start"))
    inside = F.sum("t").over(Window.partitionBy("source", "range").orderBy("key", "block").rowsBetween(Window.unboundedPreceding, -1))
    placed = keyed.withColumn("start", F.coalesce(inside, F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))
    return placed.join(ranges.hint("merge"), same).where(F.col("range_start") + F.col("start") < F.col("rest")).select("source", "block")


def _copies(rows: DataFrame, plan: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows(source, block, ...)`` with the number of passes they are in."""
    known = plan.select(F.col("source").alias("_source"), F.col("passes").alias("_passes"), F.col("weight").alias("_weight"))
    extra = chosen.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.lit(1).alias("_extra"))
    same = F.col("source").eqNullSafe(F.col("_s")) & F.col("_block").eqNullSafe(F.col("_b"))
    out = rows.join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source"))).join(extra.hint("merge"), same, "left")
    return out.withColumn("_copies", F.col("_passes") + F.coalesce("_extra", F.lit(0)))


def mixture(docs: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, weight, epoch, block, block_key)``: one row
    for each document and pass it is in. Order by epoch, block_key, block and
    doc_id to read the mixture of a source in its permuted order."""
    narrow = counted_rows(docs)
    plan = source_plan(narrow, max_repetition, target_entropy, budget)
    chosen = partial_blocks(narrow, plan)
    copied = _copies(narrow.withColumn("_block", F.col("block")), plan, chosen).where("_copies > 0")
    spread = copied.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return spread.select("doc_id", "source", F.col("t").alias("n_tokens"), F.round("_weight", 6).alias("weight"), "epoch", "block", block_key(F.col("epoch")).alias("block_key"))


def mix(docs: DataFrame, max_repetition: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """Rows of ``docs``, each as often as the mixture has it, columns as given."""
    narrow = counted_rows(docs)
    plan = source_plan(narrow, max_repetition, target_entropy, budget)
    chosen = partial_blocks(narrow, plan)
    named = docs.select(F.struct("*").alias("_row"), F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("_doc"))
    copied = _copies(named.withColumn("_block", block_number("_doc")), plan, chosen).where("_copies > 0")
    return copied.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")
