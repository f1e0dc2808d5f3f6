"""URL filter by listed host and path rules, with DataFrame functions only.

A rule names a host and the beginning of a path. It fits the URLs of that host
and of all its subdomains whose path starts with the rule's; the longest rule
wins, of those as long the one of the longer host. A URL's candidates are therefore the ends of its host, at the dots, each
with the beginnings of its path of the lengths that the list has.

A blocked Bloom filter of the listed keys, one 64-bit word for a key, is made
first and goes to every task as a value of at most ``MOST_WORDS`` words; it
drops nearly all candidates that are not listed where the URL is read. The
longest candidate that passes is looked up in the list by a hash join on the
whole key. Only where that one is a false positive the row's other candidates
are joined too, and the longest that is listed is taken. So rows of URLs are
not shuffled while the list is small, and a larger filter is never needed: past
its bound it passes more candidates, and the join decides the same.

A measured small list is broadcast. A larger one is dealt by key, with
``COPIES`` copies of each rule, so a rule that a third of all URLs fit is as
many groups; URLs without a candidate are spread by their own hash.

Cases: a null URL or one without ``://`` has an empty host and path and no rule;
no rule gives the default verdict; rows with one page_id or URL are judged one
by one, none is merged; a rule without a host is ignored, of equal rules the
smaller verdict counts; an empty list or table works; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry import scale
from pagequarry.llm.common import stage

BITS = 24  # of the filter for each listed key, about
HASHES = 4  # bits of a key in its word
LEAST_WORDS, MOST_WORDS = 64, 1 << 20
COPIES = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda n: F.coalesce(F.regexp_extract(url, _PARTS, n), F.lit(""))
    return lower(part(1)), part(2)


def listed_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` of a few rules given by the caller."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def canonical(rules: DataFrame) -> DataFrame:
    """``(key, path_length, verdict)``, one row for each rule."""
    host, path = lower(F.col("host")), F.coalesce("path", F.lit(""))
    named = rules.where(F.coalesce(F.col("host"), F.lit("")) != "").select(
        F.concat(host, path).alias("key"), F.length(path).alias("path_length"), "verdict"
    )
    return named.groupBy("key", "path_length").agg(F.min("verdict").alias("verdict"))


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """The key's bits in its word, from a second hash of it."""
    second = F.xxhash64(F.lit("bits"), key)
    place = lambda n: F.shiftrightunsigned(second, 6 * n).bitwiseAND(F.lit(63)).cast("int")
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), place(n))
    mask = bit(0)
    for n in range(1, HASHES):
        mask = mask.bitwiseOR(bit(n))
    return mask


def filter_size(keys: int) -> int:
    """Words of a filter of so many keys."""
    words = LEAST_WORDS
    while words * 64 < keys * BITS and words < MOST_WORDS:
        words *= 2
    return words


def may_hold(bloom: Column, key: Column, words: int) -> Column:
    """Whether the key's bits are set: true of every key of the filter."""
    return F.get(bloom, _word(key, words)).bitwiseAND(_mask(key)) == _mask(key)


def filter_words(keys: DataFrame, words: int) -> DataFrame:
    """One row, one array: the filter's words in order."""
    set_bits = keys.groupBy(_word(F.col("key"), words).alias("word")).agg(F.bit_or(_mask(F.col("key"))).alias("bits"))
    dense = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word")).join(set_bits, "word", "left")
    in_order = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return dense.agg(F.transform(in_order, lambda w: w["bits"]).alias("words"))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys that would fit, the longest first."""
    labels = F.split(host, r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    ends = F.filter(ends, lambda e: e != "")
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    starts = F.filter(starts, lambda s: s.isNotNull())
    keys = F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda s: F.struct(
        (-F.length(e) - F.length(s)).alias("rank"), (-F.length(e)).alias("host"), F.concat(e, s).alias("key")
    ))))
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of ``pages(page_id, url)`` under
    ``rules(host, path, verdict)``; ``rule`` is the host and path of the rule."""
    listed = stage(canonical(rules), "rules")
    size = scale.measure(listed)
    words = filter_size(size[0])
    # At most as many lengths as a path has characters.
    lengths = sorted(r[0] for r in listed.select("path_length").distinct().collect())
    bloom = filter_words(listed.select("key"), words).scalar()

    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))

    def passes(key: Column) -> Column:
        return may_hold(F.col("_bloom"), key, words)

    narrowed = parts.withColumn("_bloom", bloom).withColumn(
        "possible", F.filter(candidates(F.col("host"), F.col("path"), lengths), passes)
    ).select("page_id", "url", "host", "path", "possible")

    first = narrowed.withColumn("key", F.get("possible", F.lit(0)))
    met = _looked_up(first, listed, size)
    # A false positive in front of other candidates: rare, and settled apart.
    again = F.col("rule").isNull() & (F.size("possible") > 1)
    settled = met.where(~again).select("page_id", "host", "path", "rule", "verdict")
    rest = met.where(again).select(
        "page_id", "url", "host", "path", F.size("possible").alias("n"), F.explode("possible").alias("key")
    )
    # The longest rule and, of those as long, the one of the longest host.
    order = F.struct((-F.length("rule")).alias("rank"), (-F.length(F.substring_index("rule", "/", 1))).alias("host"), "rule", "verdict")
    best = _looked_up(rest, listed, size).groupBy("page_id", "url", "host", "path", "n").agg(
        F.min(F.when(F.col("rule").isNotNull(), order)).alias("best"),
        F.count(F.lit(1)).alias("rows"),
    )
    # Rows alike in page_id and URL were one group, and are as many rows again.
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.expr("rows div n")))
    others = best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"), copies.alias("copy"))
    return settled.unionByName(others.drop("copy")).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _looked_up(rows: DataFrame, listed: DataFrame, size: scale.Size) -> DataFrame:
    """``rows`` with the listed ``rule`` equal to their key and its verdict."""
    named = listed.select(F.col("key").alias("rule"), "verdict")
    if scale.fits_broadcast(size):
        return rows.join(F.broadcast(named), F.col("key") == F.col("rule"), "left").drop("key")
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    dealt = named.select("rule", "verdict", copies.alias("_copy")).withColumn("_slot", F.xxhash64("rule", "_copy")).drop("_copy")
    own = F.pmod(F.xxhash64("url", "page_id"), F.lit(COPIES)).cast("int")
    slot = F.when(F.col("key").isNull(), F.xxhash64("url", "page_id")).otherwise(F.xxhash64("key", own))
    join = (F.col("_slot") == F.col("_own")) & (F.col("key") == F.col("rule"))
    return rows.withColumn("_own", slot).join(dealt.hint("shuffle_hash"), join, "left").drop("key", "_own", "_slot")
