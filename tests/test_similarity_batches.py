import random
import time

from pyspark.sql import functions as F

from lodestone.functions import similarity as S
from lodestone.operators import pairs


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(rng.choice(("abcd ", " ab", "aé中𝒳 b"))) for _ in range(rng.choice((0, 1, 3, 12, 30, 63, 64, 65, 90)))) for _ in range(n)]


def test_batches_give_the_numbers_of_single_pairs():
    a, b = _texts(600, 1), _texts(600, 2)
    b[::5] = [x[::-1] for x in a[::5]]
    assert S.lcs_lengths(a, b).tolist() == [S.lcs_length(x, y) for x, y in zip(a, b)]
    for one, many in S.BATCHES.items():
        assert many(a, b).tolist() == [one(x, y) for x, y in zip(a, b)]
        assert len(many([], [])) == 0


def test_windows_of_a_batch_cost_a_fraction_of_single_pairs():
    rng = random.Random(3)
    a, b = (["".join(rng.choice("abcdefghijklm ") for _ in range(25)) for _ in range(3000)] for _ in "ab")
    t0 = time.process_time()
    one = [S.partial_ratio(x, y) for x, y in zip(a, b)]
    t1 = time.process_time()
    many = S.partial_ratios(a, b)
    assert many.tolist() == one and time.process_time() - t1 < (t1 - t0) / 3


def test_features_of_some_queries_are_those_of_all(spark):
    cand = spark.createDataFrame([(1, 10, 0.5, 0.25, 0.5), (1, 11, 0.75, 0.5, 0.25), (2, 10, 1.0, 0.5, 0.5), (3, 11, 0.5, 0.5, 1.0)], "q long, r long, cos_blob double, cos_addr double, cos_name double")
    record = "key long, name_norm string, addr_norm string, skel string, digits string, src int"
    left = spark.createDataFrame([(k, f"blue mill {k}", f"{k} oak road", f"blml{k}", str(k), 1) for k in (1, 2, 3)], record)
    right = spark.createDataFrame([(10, "mill blue", "", "mlbl", "", 2), (11, "blue mills", "1 oak street", "blmls", "1", 3)], record)
    every = pairs.pair_features(cand, left, right)
    only = spark.createDataFrame([(1,), (1,)], "q long")
    some = pairs.pair_features(cand, left, right, only)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.where(F.col("q") == 1).collect()))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.index("ArrowEvalPython") < plan.index("LeftSemi")  # the join is beneath
