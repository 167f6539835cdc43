"""The N best items of every group, with a safe threshold from score histograms.

Groups are counted first (a map-side aggregate of one column). A group above
``1 / MAX_LARGE`` of all rows is *large*; there are fewer than ``MAX_LARGE`` of
them, which bounds all that is broadcast. For the large groups alone a
histogram of scores is built; each bin holds a bitmap into which the items are
hashed, so a repeated item sets the same bit again and the number of bits set
never exceeds the number of distinct items. Going down from the highest bin,
the first bin at which N bits are set is a threshold that keeps at least N
distinct items; rows below it are dropped before anything is shuffled. What is
left is reduced per (group, shard of the item), ranked there, and ranked again
per group, so that a large group whose scores are all equal isn't ranked by one
task either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.session import stage


MAX_LARGE = 1 << 14
BINS = 256
#: Bits of a bin's bitmap for each item wanted; with 6 a threshold is found after about 1.1 N items.
BITS_PER_ITEM = 6
SHARDS = 64


def _words(n: int) -> int:
    return max(1, -(-n * BITS_PER_ITEM // 64))


def large_groups(df: DataFrame, group: str, score: str, max_large: int = MAX_LARGE) -> DataFrame:
    """Groups above 1/max_large of all rows, with their score range; fewer than max_large rows."""
    per = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.min(score).alias("_low"), F.max(score).alias("_high"))
    total = per.agg(F.sum("_n").alias("_total"))
    return per.join(F.broadcast(total), F.col("_n") * max_large > F.col("_total")).select(group, "_n", "_low", "_high")


def thresholds(df: DataFrame, large: DataFrame, group: str, item: list[str], score: str, n: int, bins: int = BINS) -> DataFrame:
    """(group, _floor): the lowest score that can be among the n best of a large group."""
    words = _words(n)
    bit = F.pmod(F.xxhash64(*item), F.lit(words * 64)).cast("int")
    scaled = F.when(F.col("_high") > F.col("_low"), (F.col(score) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(F.lit(0.0))
    mine = large.withColumnRenamed(group, "_lg")
    binned = df.join(F.broadcast(mine), F.col(group).eqNullSafe(F.col("_lg"))).select(
        group, F.least(F.lit(bins - 1), F.floor(scaled * bins)).cast("int").alias("_bin"), F.col(score), bit.alias("_bit")
    )
    one = [F.when(F.floor(F.col("_bit") / 64) == w, F.expr("shiftleft(1L, _bit % 64)")).otherwise(F.lit(0).cast("bigint")) for w in range(words)]
    hist = binned.groupBy(group, "_bin").agg(F.min(score).alias("_edge"), *[F.bit_or(one[w]).alias(f"_w{w}") for w in range(words)])
    down = Window.partitionBy(group).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)
    filled = sum((F.bit_count(F.bit_or(f"_w{w}").over(down)) for w in range(words)), F.lit(0))
    return hist.withColumn("_filled", filled).where(F.col("_filled") >= n).groupBy(group).agg(F.max("_edge").alias("_floor"))


def top_n_per_group(df: DataFrame, group: str, item: str, score: Column, n: int, score_name: str = "score", max_large: int = MAX_LARGE) -> DataFrame:
    """The n best items of each group: columns group, item, score_name and rank (from 1).

    An item scored several times counts once, with its best score. A null or NaN
    score counts as 0. At equal score the smaller item is better, so the result
    is the same at every run. Groups with fewer than n items keep all; a null
    group is a group, a null item an item that sorts first. Other columns of df
    are not read. An empty frame gives an empty result.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if len({group.lower(), item.lower(), score_name.lower(), "rank"}) < 4:
        raise ValueError("group, item, score and rank need different names")
    s = score.cast("double")
    rows = df.select(F.col(f"`{group}`").alias("_g"), F.col(f"`{item}`").alias("_i"), (F.when(s.isNull() | F.isnan(s), 0.0).otherwise(s) + F.lit(0.0)).alias("_s"))
    large = stage(large_groups(rows, "_g", "_s", max_large), "large-groups")
    floors = thresholds(rows, large, "_g", ["_i"], "_s", n)
    # every large group, with its floor where one was found: a row of a large group is spread over shards
    marks = large.select("_g", F.lit(True).alias("_large")).join(floors, "_g", "left")
    marks = marks.withColumnRenamed("_g", "_mg")
    kept = (
        rows.join(F.broadcast(marks), F.col("_g").eqNullSafe(F.col("_mg")), "left")
        .where(F.col("_floor").isNull() | (F.col("_s") >= F.col("_floor")))
        .withColumn("_shard", F.when(F.col("_large"), F.pmod(F.xxhash64("_i"), F.lit(SHARDS)).cast("int")).otherwise(F.lit(0)))
    )
    best = kept.repartition("_g", "_shard").groupBy("_g", "_shard", "_i").agg(F.max("_s").alias("_s"))
    order = [F.desc("_s"), F.asc_nulls_first("_i")]
    local = best.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_shard").orderBy(*order))).where(F.col("_r") <= n).drop("_r", "_shard")
    final = local.withColumn("rank", F.row_number().over(Window.partitionBy("_g").orderBy(*order))).where(F.col("rank") <= n)
    return final.select(F.col("_g").alias(group), F.col("_i").alias(item), F.col("_s").alias(score_name), "rank")
