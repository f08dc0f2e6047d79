"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target: its weight's share of all words, never more than ``most`` times its own
words, what exceeds that going to the others by weight. Inside a source the same rule spreads the target
over length classes (one per binary digit of the word count), longer documents being preferred, so each
document has an expected number of copies between 0 and ``most``. Its whole part is certain. For the rest
documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)) with u a hash of the
id, and taken from the smallest on until the source's remaining words are reached: the sample size is
fixed in words. What the last whole document leaves open is closed with the one that comes nearest to it.

The cut is found on a histogram of the ranks of bounded size per source; rows are ordered only inside
the one bin that holds the cut, so a source with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import word_count

BINS = 4096


def _fill(df: DataFrame, by: list[str], weight: str, limit: str, total: str, tie: list[str]) -> DataFrame:
    """Adds ``level``: with shares ``least(limit, weight * level)`` the shares of a group add up to ``total``.

    Closed form of giving away by weight and resharing what is above a limit until nothing is: in order
    of limit / weight the groups members at their limit are a prefix.
    """
    order = Window.partitionBy(*by).orderBy("ratio", *tie)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    return (
        df.withColumn("ratio", F.when(F.col(weight) > 0, F.col(limit) / F.col(weight)).otherwise(F.lit(0.0)))
        .withColumn("left", F.col(total) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("wsum", F.sum(weight).over(after))
        .withColumn("rate", F.when(F.col("wsum") > 0, F.col("left") / F.col("wsum")))
        .withColumn("level", F.min(F.when(F.col("rate") <= F.col("ratio"), F.struct("ratio", *tie, "rate")))
                    .over(Window.partitionBy(*by))["rate"])
        .drop("ratio", "left", "wsum", "rate"))


def targets(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` (double); sources by code point, null last, weigh ``weights`` in turn."""
    one = Window.partitionBy("all")
    per = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("all", F.lit(1))
        .withColumn("nth", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("limit", F.col("source_size") * most).withColumn("total", F.sum("source_size").over(one)))
    filled = _fill(per, ["all"], "weight", "limit", "total", ["nth"])
    share = F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level"))
    return filled.select("source", "source_size", F.coalesce(share, F.col("limit").cast("double")).alias("target"))


def _uniform(key: Column, seed: int) -> Column:
    """A hash of the key in (0, 1): 52 bits of its MD5 and a half."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7, columns: list[str] | None = None) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` (int) to the documents.

    Columns of those names are replaced; other columns (or those named in ``columns``) pass through. Null texts have
    size 0, and rows of size 0 are taken 0 times. Rows equal in id, source and size share their rank and are taken
    together. An empty table gives no rows; a null source is a source of its own. The same rows always give the same copies.

    Texts are read once for their sizes, and once more only if they are among the columns. What is kept per source and
    length class is written first, so Spark knows its size and broadcasts it only where it is small.
    """
    keep = [c for c in (columns or docs.columns) if c not in ("size", "source_size", "target", "copies")]
    size = word_count(F.col("text"))
    rows = docs.select(F.struct(*keep).alias("row"), "doc_id", "source", size.alias("size")).withColumn(
        "cls", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(F.lit(0)))
    narrow = stored(rows.drop("row") if "text" in keep else rows, "mix-sizes")
    goal = targets(narrow, weights, most)

    classes = narrow.groupBy("source", "cls").agg(F.sum("size").alias("class_size"))
    classes = classes.join(goal, classes["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    filled = _fill(
        classes.withColumn("cw", F.col("class_size") * F.col("cls")).withColumn("cl", F.col("class_size") * most),
        ["source"], "cw", "cl", "target", ["cls"])
    expected = F.least(F.lit(float(most)), F.coalesce(F.col("cls") * F.col("level"), F.lit(float(most))))
    plan = (
        filled.withColumn("expected", F.when(F.col("class_size") > 0, expected).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("expected").cast("int")).withColumn("p", F.col("expected") - F.col("whole"))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.sum(
            F.col("class_size") * F.col("whole")).over(Window.partitionBy("source"))))
        .select("source", "cls", "source_size", "target", "whole", "p", "rest"))
    plan = stored(plan, "mix-plan")  # one row per source and class

    def ranked(sized: DataFrame) -> DataFrame:
        s, p = sized.alias("s"), plan.alias("p")
        odds, u = F.col("p") / (1 - F.col("p")), _uniform(F.col("doc_id"), seed)
        return (
            s.join(p, F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.cls") == F.col("p.cls")))
            .select("s.*", "source_size", "target", "whole", "p", "rest")
            .withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), (u / (1 - u)) / odds))
            .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int")))

    drawn = ranked(narrow).select("source", "doc_id", "size", "rest", "rank", "bin").filter(F.col("rank").isNotNull())

    # where the running sum of words over the bins passes the remaining target
    bins = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    so_far = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cut_bin = stored(
        bins.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
        .filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .select("source", F.col("bin").alias("cut_bin"), "before"), "mix-bins")
    # equal rows of the bin are one with a count: the first ``fit`` of them still find room
    equal = (
        drawn.alias("r").join(cut_bin.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("bin") == F.col("cut_bin")))
        .groupBy("r.source", "rank", "doc_id", "size", "rest", "bin", "before").agg(F.count("*").alias("n")))
    earlier = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = stored(
        equal.withColumn("start", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(earlier), F.lit(0)))
        .withColumn("fit", F.least(F.col("n"), F.floor((F.col("rest") - F.col("start")) / F.col("size"))))
        .withColumn("upto", F.when(F.col("fit") > 0, F.col("start") + F.col("fit") * F.col("size")))
        .groupBy("source").agg(
            F.max(F.when(F.col("fit") > 0, F.struct("rank", "doc_id", "size"))).alias("cut"), F.max("upto").alias("upto"),
            F.first("before").alias("before"), F.first("bin").alias("cut_bin"), F.first("rest").alias("rest"))
        .withColumn("gap", F.col("rest") - F.coalesce("upto", "before")).drop("upto", "before", "rest"), "mix-cuts")
    row = F.struct("rank", "doc_id", "size")
    in_sample = F.col("rank").isNotNull() & F.coalesce(
        (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & F.coalesce(row <= F.col("cut"), F.lit(False))),
        F.lit(True))
    off = F.abs(F.col("size") - F.col("gap"))
    l = last.alias("l")
    closing = (
        drawn.alias("r").join(l, F.col("r.source").eqNullSafe(F.col("l.source")))
        .filter(~in_sample & (F.col("size") < 2 * F.col("gap")))
        .groupBy("r.source").agg(F.min(F.struct(off.alias("off"), "rank", "doc_id")).alias("closing")))
    ends = stored(l.join(closing.alias("k"), F.col("l.source").eqNullSafe(F.col("k.source")), "left").select("l.*", "closing"), "mix-ends")
    closes = F.coalesce(F.struct(off.alias("off"), "rank", "doc_id") == F.col("closing"), F.lit(False)) & ~in_sample
    extra = (in_sample | closes).cast("int")
    return (
        ranked(rows if "text" in keep else narrow).alias("r").join(ends.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")), "left")
        .select("r.row", "r.size", "source_size", "target", F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(F.lit(0)).alias("copies"))
        .select("row.*", "size", "source_size", "target", "copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document repeated as often as it is taken, with the columns of ``docs``."""
    out = mix(docs, **options)
    return out.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)
