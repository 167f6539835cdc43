"""Samples, splits, the gradient-boosted classifier and the search for its decision rule."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.operators.metrics import entity_scores

THRESHOLDS = [round(0.30 + 0.05 * i, 2) for i in range(14)]
MARGINS = [1.01, 0.5, 0.35, 0.25, 0.15]


def uniform(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) from a key and a seed, the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def stratified_sample(df: DataFrame, key: str, stratum: str, n: int, seed: int = 42) -> DataFrame:
    """About n rows, each stratum by its share and with one row at least: those with the least hash."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_total"))
    quota = sizes.crossJoin(F.broadcast(total)).select(F.col(stratum).alias("_stratum"), F.least(F.col("_n"), F.greatest(F.lit(1), F.round(F.lit(n) * F.col("_n") / F.col("_total")).cast("bigint"))).alias("_quota"))
    order = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key)
    ranked = df.withColumn("_place", F.row_number().over(order)).join(quota, F.col(stratum).eqNullSafe(F.col("_stratum")))
    return ranked.where(F.col("_place") <= F.col("_quota")).drop("_place", "_quota", "_stratum")


def is_holdout(key: Column, fraction: float = 0.2, seed: int = 42) -> Column:
    """Whether an entity is held out; all its pairs are on one side."""
    return uniform(key, seed) < fraction


def downsample_negatives(pairs: DataFrame, fraction: float = 0.25, holdout: str = "is_holdout", seed: int = 7) -> DataFrame:
    """All pairs held out, all positives, and of the other negatives the given fraction."""
    return pairs.where(F.col(holdout) | (F.col("label") == 1) | (uniform(F.concat_ws("|", "q", "r"), seed) < fraction))


def fit_classifier(pairs: DataFrame, features: list[str], holdout: str = "is_holdout", rounds: int = 40, depth: int = 5, least: int = 100, seed: int = 42) -> GBTClassificationModel:
    """Gradient-boosted trees with early stopping on the pairs held out."""
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(pairs)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=0.05, maxDepth=depth, minInstancesPerNode=least, subsamplingRate=0.8, featureSubsetStrategy="0.9", validationIndicatorCol=holdout, validationTol=1e-4, seed=seed)
    return gbt.fit(rows.select("features", F.col("label").cast("double").alias("label"), holdout))


def score_pairs_with(model: GBTClassificationModel, pairs: DataFrame, features: list[str]) -> DataFrame:
    """(q, r, p)."""
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(pairs)
    return model.transform(rows).select("q", "r", vector_to_array("probability")[1].alias("p"))


def importances(model: GBTClassificationModel, features: list[str], top: int = 10) -> list[tuple[str, float]]:
    return sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))[:top]


def sweep(pairs: DataFrame, p: str, links: DataFrame, entities: DataFrame, thresholds: list[float] = THRESHOLDS, margins: list[float] = MARGINS) -> DataFrame:
    """(thr, margin, score): the macro-averaged score of every rule, over all entities.

    The grid multiplies pairs only after those below the least threshold and
    beyond the widest margin are gone, and each entity is reduced to one row a
    rule. links: (q, r); entities: (q).
    """
    spark = pairs.sparkSession
    grid = spark.createDataFrame([(t, m) for t in thresholds for m in margins], "thr double, margin double")
    hits = pairs.withColumn("_best", F.max(p).over(Window.partitionBy("q"))).where(F.col(p) >= min(thresholds))
    hits = hits.where(F.round(F.col("_best") - F.col(p), 8) <= max(margins)).join(links.select("q", "r", F.lit(1).alias("_hit")).distinct(), ["q", "r"], "left")
    chosen = hits.join(F.broadcast(grid), (F.col(p) >= F.col("thr")) & (F.round(F.col("_best") - F.col(p), 8) <= F.col("margin")))
    per = chosen.groupBy("thr", "margin", "q").agg(F.count(F.lit(1)).alias("n_pred"), F.count("_hit").alias("n_hit"))
    truth = entities.select("q").distinct().join(links.select("q", "r").distinct().groupBy("q").agg(F.count(F.lit(1)).alias("n_true")), "q", "left")
    every = truth.join(F.broadcast(grid)).join(per, ["thr", "margin", "q"], "left").na.fill(0, ["n_true", "n_pred", "n_hit"])
    return every.groupBy("thr", "margin").agg(F.round(F.avg(entity_scores(F.col("n_pred"), F.col("n_true"), F.col("n_hit"))), 6).alias("score"))


def best_rule(rules: DataFrame) -> DataFrame:
    """The rule with the best score; of equal ones the lowest threshold, then the widest margin."""
    return rules.orderBy(F.desc("score"), "thr", F.desc("margin")).limit(1)
