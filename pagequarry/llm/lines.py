"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line's tokens are its distinct blank-separated words. Two lines are alike if
the Jaccard similarity of their token sets is at least ``threshold``; a line
like an earlier one (smaller doc_id, or the same document and a smaller number)
is removed.

Lines with equal sets form a class, and all but the first are removed at once.
For the classes, tokens are put in one global order, long words first, as these
are seldom met; any one order keeps the join exact. Of two alike sets with ``d``
tokens in only one of them, each such token parts at most one pair of shared
tokens that are neighbours in the order; so one of the first ``d + 1`` such
pairs (the end counts as a last token) is a pair of neighbours in both sets. In
a set of ``n`` tokens it is among the first ``2 (n - threshold n) + 1`` pairs of
neighbours, whose hashes are the set's entries: few entries meet by chance.

Entries of a single class are dropped by one aggregation. A class goes as soon
as one earlier class is like it. So first, every class is held only against the
earliest open class of each of its entries. Classes found alike are settled and
look no further, and the next round takes the earliest of those left, while
rounds settle many. What is still open is joined by entry with *all* earlier
classes, settled ones too. Join conditions are the length filter and a bound on
``d``: tokens flip bits of a 64-bit word (of long sets, of two), and words of alike
sets differ in at most ``d`` bits. Pairs that pass are verified on the whole sets. So a group of
like lines costs its size, not its square; the rounds only save work, and the
last join makes the result exact.

Lines are tokenised once, when they are written with numbers in the order of
their places; what follows reads hashes, and the texts of lines in pairs to verify.

Cases: null and empty texts have one empty line; lines without tokens are kept;
lines of rows with one doc_id are ordered by number and then by text, and equal
ones are one line; a null doc_id comes first; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import staged
from pagequarry.llm.url_rules import filter_size, filter_words, may_hold
from pagequarry.scale import BROADCAST_ROWS
from pagequarry.session import drop_scratch

THRESHOLD = 0.8
ROUNDS = 1  # at most, of settling before the full join
WORTHWHILE = 0.1  # a round that settles less than this share of the first is the last
LONG = 64  # tokens: sets above it flip bits of two words
ID_RANGE = 1 << 32
PLAIN = {"parquet.enable.dictionary": "false"}  # most columns are hashes
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _staged(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """As :func:`staged`; the shuffle files of the write go with it, not when the
    driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREED, None)
    conf.set(FREED, "true")
    try:
        return staged(df, name, **options)
    finally:
        conf.unset(FREED) if before is None else conf.set(FREED, before)


def words(line: str = "line") -> Column:
    blank = F.lit(" ")
    blanked = F.replace(F.replace(F.col(line), F.lit("\t"), blank), F.lit("\r"), blank)  # translate goes by single characters
    return F.split(blanked, " ")


def tokens(line: str = "line") -> Column:
    return F.array_distinct(F.array_remove(words(line), ""))


def split_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` of every line, numbered from 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def keyed_lines(lines: DataFrame, share: int) -> DataFrame:
    """``lines`` with ``(n, k1, k2, entries, bits, odd_bits)``. The keys tell token sets apart
    by two 64-bit hashes of their sorted hashes, and are null without tokens; sets
    too small for a different one to be alike have no entries. ``odd_bits`` are
    the flips of half the tokens, of sets above ``LONG``."""
    # The length in front of the hash, so that its order is from long to short.
    ranked = lambda t: F.shiftleft((F.lit(31) - F.least(F.octet_length(t), F.lit(31))).cast("long"), 58).bitwiseOR(F.shiftrightunsigned(F.xxhash64(t), 6))
    ids = F.sort_array(F.array_distinct(F.array_remove(F.transform(words(), ranked), ranked(F.lit("")))))
    lines = lines.withColumn("ids", ids).withColumn("n", F.size("ids"))
    n = F.col("n")
    pair = lambda t, i: F.xxhash64(t, F.get("ids", i + 1))
    entries = F.transform(F.slice("ids", F.lit(1), F.floor(n * 2 * (100 - share) / F.lit(100)).cast("int") + 1), pair)
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))
    none, odd = F.lit(0).cast("long"), lambda t: t.bitwiseAND(F.lit(64)) != 0
    bits = F.aggregate("ids", none, lambda held, t: held.bitwiseXOR(bit(t)))
    odd_bits = F.aggregate("ids", none, lambda held, t: F.when(odd(t), held.bitwiseXOR(bit(t))).otherwise(held))
    some, enough = n > 0, n * (100 - share) >= share
    return lines.select(
        *(c for c in lines.columns if c not in ("ids", "n", "line")), n,
        F.when(some, F.xxhash64("ids")).alias("k1"), F.when(some, F.xxhash64(F.lit("second"), "ids")).alias("k2"),
        F.when(enough, entries).alias("entries"), F.when(enough, bits).alias("bits"),
        F.when(enough & (n > LONG), odd_bits).alias("odd_bits"), "line",
    )


def similar_classes(firsts: DataFrame, share: int) -> DataFrame:
    """``(number,)`` of classes with a different, earlier class that is alike, of
    ``firsts(number, n, entries, bits, odd_bits, line)``, numbered in the order of their places."""
    spark = firsts.sparkSession
    heads, folder = _shared_entries(firsts)
    found, still_open = [], heads
    for _ in range(ROUNDS):
        pivots = still_open.where("number = one")
        pairs, pairs_folder = _staged(_met(pivots, still_open, share), "pairs")
        settled = _alike(pairs, firsts, share)
        drop_scratch(spark, pairs_folder)
        found.append((settled, settled.count()))
        still_open = _without(still_open, *found[-1])
        if found[-1][1] <= WORTHWHILE * found[0][1]:
            break
        earliest = still_open.groupBy("entry").agg(F.min("number").alias("one"))
        still_open = still_open.drop("one").join(earliest.hint("merge"), "entry")
    pairs, pairs_folder = _staged(_met(heads, still_open, share), "pairs")
    drop_scratch(spark, folder)
    later = _alike(pairs, firsts, share)
    drop_scratch(spark, pairs_folder)
    # A class is settled once, and not met in the last join again.
    for settled, _ in found:
        later = later.unionByName(settled)
    return later


def _shared_entries(firsts: DataFrame) -> tuple[DataFrame, str]:
    """``(entry, number, n, bits, odd_bits, one)``, stored, and its folder: the entries met
    in two classes at least, with the earliest of these."""
    entries = firsts.select("number", F.explode("entries").alias("entry"))
    shared = entries.groupBy("entry").agg(F.min("number").alias("one"), F.count(F.lit(1)).alias("met")).where("met > 1")
    shared, shared_folder = _staged(shared.select("entry", "one"), "shared")
    words_ = filter_size(shared.count())
    bloom = filter_words(shared.select(F.col("entry").alias("key")), words_).scalar()
    again = firsts.select("number", "n", "bits", "odd_bits", F.explode("entries").alias("entry")).where(may_hold(bloom, F.col("entry"), words_))
    heads, folder = _staged(again.join(shared.hint("merge"), "entry"), "heads")
    drop_scratch(firsts.sparkSession, shared_folder)
    return heads, folder


def _met(earlier: DataFrame, still_open: DataFrame, share: int) -> DataFrame:
    """Pairs ``(one, two)`` that share an entry and may be alike by their sizes and bits."""
    x, y = earlier.alias("x"), still_open.alias("y")
    shorter, longer = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    differing = F.floor((F.col("x.n") + F.col("y.n")) * (100 - share) / F.lit(100 + share))
    unlike = lambda c: F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))
    odd = unlike("odd_bits")  # null unless both sets are long
    flipped = F.coalesce(F.bit_count(odd) + F.bit_count(unlike("bits").bitwiseXOR(odd)), F.bit_count(unlike("bits")))
    fits = (
        (F.col("x.entry") == F.col("y.entry")) & (F.col("x.number") < F.col("y.number")) & (shorter * 100 >= longer * share)
        & (flipped <= differing)
    )
    return x.join(y.hint("merge"), fits).select(F.col("x.number").alias("one"), F.col("y.number").alias("two")).distinct()


def _without(heads: DataFrame, settled: DataFrame, count: int) -> DataFrame:
    """``heads`` of other classes; few settled ones (counted) are broadcast."""
    few = F.broadcast(settled) if count <= BROADCAST_ROWS else settled.hint("merge")
    return heads.join(few, "number", "left_anti")


def _alike(pairs: DataFrame, firsts: DataFrame, share: int) -> DataFrame:
    """``(number,)``, stored: each ``two`` of stored pairs whose whole set is like that of its ``one``."""
    ids = pairs.select(F.col("one").alias("number")).union(pairs.select("two"))
    asked, asked_folder = _staged(_possibly(firsts, ids).select("number", "n", "line"), "asked")
    one = asked.select(F.col("number").alias("one"), F.col("n").alias("n1"), F.col("line").alias("line1"))
    two = asked.select(F.col("number").alias("two"), F.col("n").alias("n2"), F.col("line").alias("line2"))
    joined = pairs.join(one.hint("merge"), "one").join(two.hint("merge"), "two")
    shared = F.size(F.array_remove(F.array_intersect(words("line1"), words("line2")), ""))
    alike = joined.where(shared * (100 + share) >= (F.col("n1") + F.col("n2")) * share)
    found = _staged(alike.select(F.col("two").alias("number")).distinct(), "settled")[0]
    drop_scratch(firsts.sparkSession, asked_folder)
    return found


def _possibly(firsts: DataFrame, ids: DataFrame) -> DataFrame:
    """``firsts`` without most lines that are not in ``ids(number)``, by a blocked
    Bloom filter of bounded size, so that their texts are not shuffled."""
    words = filter_size(ids.count())
    bloom = filter_words(ids.select(F.col("number").alias("key")), words).scalar()
    return firsts.where(may_hold(bloom, F.col("number"), words))


def numbered(placed: DataFrame, docs: DataFrame) -> DataFrame:
    """``placed(doc_id, line_no, mark, ...)`` with a ``number`` in the order of the
    places. Distinct ids of a range below ``ID_RANGE`` make it with the line's
    number, which has 31 bits; of others the lines are sorted, and ids grow along them."""
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    seen = ids.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.max("rows").alias("rows"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    if seen["rows"] == 1 and not seen["nulls"] and seen["high"] - seen["low"] < ID_RANGE:
        return placed.withColumn("number", F.shiftleft(F.col("doc_id") - seen["low"], 31).bitwiseOR(F.col("line_no").cast("long")))
    return placed.orderBy("doc_id", "line_no", "mark").withColumn("number", F.monotonically_increasing_id())


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, line_no, mark, removed)`` of every line; ``mark`` is a hash of it."""
    share = round(100 * threshold)
    if share <= 50:
        raise ValueError("the threshold must be above a half")
    placed = numbered(split_lines(docs).withColumn("mark", F.xxhash64("line")), docs)
    lines, _ = _staged(keyed_lines(placed, share), "lines", **PLAIN)
    classes = lines.where("k1 is not null").groupBy("k1", "k2").agg(F.min("number").alias("one"), F.count(F.lit(1)).alias("held")).where("held > 1")
    places = lines.select("number", "k1", "k2", F.struct("doc_id", "line_no", "mark").alias("place"))
    members, members_folder = _staged(places.join(classes.hint("merge"), ["k1", "k2"]).select("number", "one", "place"), "members")
    first = members.where("number = one").select("one", F.col("place").alias("first"))
    copies = members.where("number > one").join(first.hint("merge"), "one")
    copies, _ = _staged(copies.select("number", "one", (F.col("place") == F.col("first")).alias("twin")), "copies")
    drop_scratch(docs.sparkSession, members_folder)
    later = similar_classes(_without(lines, copies.select("number"), copies.count()), share)
    # Equal lines of one place stay or go with the first.
    twins = copies.where("twin").join(later.withColumnRenamed("number", "one").hint("merge"), "one").select("number")
    gone = copies.where("not twin").select("number").union(later).union(twins).withColumn("gone", F.lit(True))
    both = lines.select("number", "doc_id", "line_no", "mark").join(gone.hint("merge"), "number", "left")
    return both.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "mark", F.coalesce("gone", F.lit(False)).alias("removed"))


def without_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text)`` with the removed lines taken out; rows with the same
    doc_id lose the lines removed from any of them."""
    gone = removed_lines(docs, threshold).where("removed").groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "mark")).alias("gone"))
    named = gone.withColumnRenamed("doc_id", "_doc").hint("merge")
    kept = F.expr(
        """array_join(transform(filter(transform(split(coalesce(text, ''), '\n'), (l, n) -> struct(l, n)),
             p -> gone is null or not array_contains(gone, struct(cast(p.n as bigint) as line_no, xxhash64(p.l) as mark))), p -> p.l), '\n')"""
    )
    return docs.select("doc_id", "text").join(named, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select("doc_id", kept.alias("text"))
