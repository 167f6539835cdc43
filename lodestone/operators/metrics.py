"""Scores of matchings and of blocking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    """(1 + b2) p r / (b2 p + r); 0 where both are 0 or less."""
    b2 = beta * beta
    low = b2 * p + r
    return F.when((p <= 0) & (r <= 0) | (low <= 0), F.lit(0.0)).otherwise((1 + b2) * p * r / F.when(low == 0, F.lit(1.0)).otherwise(low))


def entity_scores(n_pred: Column, n_true: Column, n_hit: Column, beta: float = 0.5) -> Column:
    """Score of one entity: 1 if both lists are empty, 0 if one is or nothing is right, else F beta."""
    safe = lambda n: F.greatest(n, F.lit(1)).cast("double")
    return F.when((n_pred == 0) & (n_true == 0), F.lit(1.0)).when((n_pred == 0) | (n_true == 0) | (n_hit == 0), F.lit(0.0)).otherwise(f_beta(n_hit / safe(n_pred), n_hit / safe(n_true), beta))


def macro_score(predicted: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row (score): the average of the scores of all entities of truth.

    predicted, truth: (q, ids), one row an entity. An entity without prediction
    counts as predicted empty; repeated ids count once.
    """
    both = truth.select("q", F.array_distinct("ids").alias("t")).join(predicted.select("q", F.array_distinct("ids").alias("p")), "q", "left")
    p = F.coalesce(F.col("p"), F.array().cast("array<string>"))
    return both.agg(F.avg(entity_scores(F.size(p), F.size("t"), F.size(F.array_intersect(p, F.col("t"))), beta)).alias("score"))


def blocking_report(candidates: DataFrame, truth: DataFrame, queries: DataFrame, references: DataFrame) -> DataFrame:
    """Recall of candidates by partition and over all (part null): counts and rates.

    candidates: (q, r); truth: (q, ids), entities without a row are skipped;
    queries, references: (part, key). Entities with an empty list count as found.
    """
    known = truth.join(queries.select(F.col("key").alias("q"), "part"), "q")
    links = known.select("q", F.explode(F.array_distinct("ids")).alias("r"))
    hits = links.join(candidates.select("q", "r").distinct(), ["q", "r"]).groupBy("q").agg(F.count(F.lit(1)).alias("hits"))
    per = known.select("q", "part", F.size(F.array_distinct("ids")).alias("links")).join(hits, "q", "left").na.fill(0, ["hits"])
    found = per.groupBy("part").agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.col("hits") == F.col("links")).alias("full"), F.count_if(F.col("links") == 0).alias("singles"), F.sum("links").alias("links"), F.sum("hits").alias("hits")
    )
    n_pairs = candidates.select("q").join(queries.select(F.col("key").alias("q"), "part"), "q").groupBy("part").agg(F.count(F.lit(1)).alias("pairs"))
    n_q = queries.groupBy("part").agg(F.count(F.lit(1)).alias("n_queries"))
    n_r = references.groupBy("part").agg(F.count(F.lit(1)).alias("n_refs"))
    table = n_q.join(n_r, "part", "left").join(found, "part", "left").join(n_pairs, "part", "left").na.fill(0).withColumn("all_pairs", F.col("n_queries") * F.col("n_refs"))
    sums = ["n_queries", "n_refs", "entities", "full", "singles", "links", "hits", "pairs", "all_pairs"]
    rolled = table.rollup("part").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
    safe = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 6))
    return rolled.select("part", *sums, safe("hits", "links").alias("pair_recall"), safe("full", "entities").alias("entity_recall"), F.round(1 - F.col("pairs") / F.nullif(F.col("all_pairs"), F.lit(0)), 6).alias("reduction"), safe("pairs", "n_queries").alias("per_query"))
