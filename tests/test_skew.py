import pytest
from pyspark.sql import functions as F

from lodestone.operators.skew import balanced_aggregate, balanced_join, fragment, pack, plan_placement


def test_packing_balances():
    where, loads = pack([(10.0, "a"), (6.0, "b"), (5.0, "c"), (4.0, "d")], 2)
    assert sorted(loads) == [11.0, 14.0] and set(where) == {"a", "b", "c", "d"}


def test_a_hot_key_is_spread(spark):
    df = spark.range(8000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), "id")
    plan = plan_placement(df, ["k"], 8)
    sizes = [r["count"] for r in fragment(df, ["k"], plan, "task").groupBy("task").count().collect()]
    assert max(sizes) < 1.5 * 8000 / 8


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_equal_the_plain_ones(spark, how):
    left = spark.createDataFrame([(k, i, "p") for i, k in enumerate(["a"] * 300 + ["b", None, "c"])], "k string, _pkey int, _shards string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4), ("z", 5)], "k string, v int")
    got, want = balanced_join(left, right, ["k"], how=how, tasks=4), left.join(right, "k", how)
    assert sorted(map(repr, got.select(sorted(want.columns)).collect())) == sorted(map(repr, want.select(sorted(want.columns)).collect()))
    assert balanced_join(left.limit(0), right, ["k"], how=how, tasks=4).count() == 0


def test_aggregate_with_null_keys_and_an_empty_table(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [(None, 2), ("b", None)], "k string, n_rows int")
    aggs = {"n": ("count", F.lit(1)), "s": ("sum", F.col("n_rows")), "lo": ("min", F.col("n_rows")), "hi": ("max", F.col("n_rows"))}
    got = {r["k"]: (r["n"], r["s"], r["lo"], r["hi"]) for r in balanced_aggregate(df, ["k"], aggs, 4).collect()}
    assert got == {"a": (50, 50, 1, 1), None: (1, 2, 2, 2), "b": (1, None, None, None)}
    assert balanced_aggregate(df.limit(0), ["k"], aggs, 4).count() == 0


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both sides"):
        balanced_join(df, df, ["k"])
