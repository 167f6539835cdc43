import random

from pyspark.sql import functions as F

from lodestone.llm.topn import top_n_per_group


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.4 else None if rng.random() < 0.1 else f"g{rng.randrange(40)}", rng.randrange(60), rng.choice([None, float("nan"), 0.0, 0.5, 0.5, 1.0, rng.random()])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, i long, s double")
    best: dict = {}
    for g, i, s in rows:
        s = 0.0 if s is None or s != s else s
        best.setdefault(g, {})[i] = max(best.get(g, {}).get(i, s), s)
    want = sorted((str(g), k, i, s) for g, items in best.items() for k, (i, s) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:5], 1))
    for limit in (4, 1 << 14):
        got = sorted((str(r["g"]), r["rank"], r["i"], r["score"]) for r in top_n_per_group(df, "g", "i", F.col("s"), 5, max_large=limit).collect())
        assert got == want
    assert top_n_per_group(df.limit(0), "g", "i", F.col("s"), 5).count() == 0
