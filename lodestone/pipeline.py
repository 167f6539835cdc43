"""The linkage pipeline as stages, each of which reads the tables of the one before and writes its own.

    python -m lodestone.pipeline STAGE [train|test ...] [options]

Stages: prepare, block, evaluate, features, train, predict, validate. Folders
come from LODESTONE_DATA_DIR, LODESTONE_OUT_DIR and LODESTONE_WORK_DIR, or from
the options. A stage that is run again overwrites its table.
"""

from __future__ import annotations

import argparse

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import learning, metrics, pairs, retrieval, validation
from lodestone.sources import tables

NORMALIZED = "key string, name_norm string, addr_norm string, skel string, digits string, src tinyint, country string, side string"


def _fields() -> dict:
    return {"blob": (T.blob("name_norm", "addr_norm"), 200), "addr": (F.col("addr_norm"), 200), "name": (F.col("name_norm"), 60)}


def prepare(spark: SparkSession, data: str, work: str, split: str) -> None:
    """Normalized records of all sources, in folders by side and country."""
    rows = tables.scan_records(spark, data, split, (1, 2, 3))
    named = T.normalize_records(rows.withColumnRenamed("entity_id", "key"), "business_name", "business_address")
    side = F.when(F.col("src") == 1, F.lit("s1")).otherwise(F.lit("ref"))
    tables.write_partitioned(named.select("key", "name_norm", "addr_norm", "skel", "digits", "src", "country", side.alias("side")), f"{work}/{split}/records", ["side", "country"])


def records(spark: SparkSession, work: str, split: str, side: str, countries: list[str] | None = None) -> DataFrame:
    df = tables.read_partition(spark, f"{work}/{split}/records", NORMALIZED, side=side)
    return df.where(F.col("country").isin(countries)) if countries else df


def block(spark: SparkSession, work: str, split: str, countries: list[str] | None = None, sample: int = 0, max_df: float = retrieval.MAX_DF, keep: int = 60) -> None:
    """The `keep` best candidates of every record of source 1; for training a stratified sample of them if sample > 0."""
    left, right = records(spark, work, split, "s1", countries), records(spark, work, split, "ref", countries)
    if sample and split == "train":
        left = learning.stratified_sample(left, "key", "country", sample)
    found = retrieval.retrieve(left, right, "country", "key", "key", _fields(), max_df)
    pairs.rerank(found, left, right, keep).write.mode("overwrite").parquet(f"{work}/{split}/candidates")


def evaluate(spark: SparkSession, data: str, work: str) -> DataFrame:
    """Recall of the candidates of the training split."""
    part = lambda side: records(spark, work, "train", side).select(F.col("country").alias("part"), "key")
    return metrics.blocking_report(spark.read.parquet(f"{work}/train/candidates"), tables.scan_truth(spark, data), part("s1"), part("ref"))


def features(spark: SparkSession, data: str, work: str, split: str) -> None:
    """The features of all candidates, with labels in the training split."""
    cand = spark.read.parquet(f"{work}/{split}/candidates")
    out = pairs.pair_features(cand.drop("rerank"), records(spark, work, split, "s1"), records(spark, work, split, "ref"))
    if split == "train":
        out = pairs.pair_labels(out, tables.scan_truth(spark, data).select("q", F.explode("ids").alias("r")))
    out.write.mode("overwrite").parquet(f"{work}/{split}/features")


def train(spark: SparkSession, data: str, work: str, negatives: float = 0.25, holdout: float = 0.2, rounds: int = 100) -> tuple[float, float, float]:
    """Fits the classifier and finds its decision rule on the entities held out: (threshold, margin, score)."""
    rows = spark.read.parquet(f"{work}/train/features").withColumn("is_holdout", learning.is_holdout(F.col("q"), holdout))
    model = learning.fit_classifier(learning.downsample_negatives(rows, negatives), pairs.FEATURES, rounds=rounds)
    model.write().overwrite().save(f"{work}/model")
    held = learning.score_pairs_with(model, rows.where("is_holdout"), pairs.FEATURES)
    known = tables.scan_truth(spark, data).join(rows.where("is_holdout").select("q").distinct(), "q", "left_semi")
    best = learning.best_rule(learning.sweep(held, "p", known.select("q", F.explode("ids").alias("r")), known.select("q"))).first()
    rule = (best["thr"], best["margin"], best["score"])
    tables.write_rule(spark, f"{work}/rule", *rule, pairs.FEATURES, negatives=negatives, holdout=holdout, rounds=rounds, importances=learning.importances(model, pairs.FEATURES))
    return rule


def predict(spark: SparkSession, data: str, work: str, out: str, split: str = "test") -> None:
    """Both result files: chosen references and candidates of every record of source 1, in the order of its file."""
    rule = tables.read_rule(spark, f"{work}/rule")
    cand = spark.read.parquet(f"{work}/{split}/features")
    scored = learning.score_pairs_with(GBTClassificationModel.load(f"{work}/model"), cand, pairs.FEATURES)
    order = tables.scan_tsv(spark, tables.source_path(data, split, 1), tables.RECORD_FIELDS).select(F.col("entity_id").alias("q")).withColumn("place", F.monotonically_increasing_id())
    chosen = pairs.id_lists(pairs.decide(scored, "p", rule["thr"], rule["margin"]), order, [-F.col("p"), F.col("r")])
    listed = pairs.id_lists(scored, order, [F.col("r")])
    for name, lists in (("matching", chosen), ("candidates", listed)):
        tables.write_result(order.join(lists, "q"), f"{out}/{name}", "place", "q", "ids", validation.HEADERS[name])


def validate(spark: SparkSession, data: str, out: str, split: str = "test", check_ids: bool = False) -> tuple[bool, list[dict]]:
    required = tables.scan_tsv(spark, tables.source_path(data, split, 1), tables.RECORD_FIELDS).select(F.col("entity_id").alias("q"))
    valid = tables.scan_records(spark, data, split, (2, 3)).select(F.col("entity_id").alias("r")) if check_ids else None
    return validation.validate(spark, f"{out}/matching", required, f"{out}/candidates", valid)


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    a.add_argument("stage", choices=["prepare", "block", "evaluate", "features", "train", "predict", "validate"])
    a.add_argument("splits", nargs="*", default=[])
    a.add_argument("--data", default=tables.folder("data"))
    a.add_argument("--out", default=tables.folder("out"))
    a.add_argument("--work", default=tables.folder("work"))
    a.add_argument("--countries", default="")
    a.add_argument("--train-sample", type=int, default=0)
    a.add_argument("--max-df", type=float, default=retrieval.MAX_DF)
    a.add_argument("--neg-frac", type=float, default=0.25)
    a.add_argument("--holdout-frac", type=float, default=0.2)
    a.add_argument("--rounds", type=int, default=100)
    a.add_argument("--check-ids", action="store_true")
    o = a.parse_args(argv)
    spark = SparkSession.builder.appName(f"lodestone {o.stage}").getOrCreate()
    countries = [c for c in o.countries.split(",") if c]
    splits = o.splits or ["train", "test"]
    if o.stage == "prepare":
        if missing := tables.missing_inputs(spark, o.data, tuple(splits)):
            raise FileNotFoundError(", ".join(missing))
        for s in splits:
            prepare(spark, o.data, o.work, s)
    elif o.stage == "block":
        for s in splits:
            block(spark, o.work, s, countries or None, o.train_sample, o.max_df)
    elif o.stage == "evaluate":
        evaluate(spark, o.data, o.work).show(1000, False)
    elif o.stage == "features":
        for s in splits:
            features(spark, o.data, o.work, s)
    elif o.stage == "train":
        print("threshold, margin, score:", *train(spark, o.data, o.work, o.neg_frac, o.holdout_frac, o.rounds))
    elif o.stage == "predict":
        for s in o.splits or ["test"]:
            predict(spark, o.data, o.work, o.out, s)
    else:
        passed, findings = validate(spark, o.data, o.out, (o.splits or ["test"])[0], o.check_ids)
        for f in findings:
            print(f["severity"], f["file"], f["rule"], f["n"], *f["examples"])
        return int(not passed)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
