"""Sources and sinks of the linkage pipeline: delimited files, partitioned tables, result lists, decision rule."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestone.functions.text import split_ids

RECORD_FIELDS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_FIELDS = ["source1_entity_id", "matched_entity_ids"]
#: Environment variables that name the folders of inputs, outputs and stages.
FOLDERS = {"data": "LODESTONE_DATA_DIR", "out": "LODESTONE_OUT_DIR", "work": "LODESTONE_WORK_DIR"}


def folder(kind: str, default: str = ".") -> str:
    return os.environ.get(FOLDERS[kind], default)


def source_path(root: str, split: str, source: int) -> str:
    """Where the records of a split (train or test) and source (1 to 3) lie."""
    return f"{root}/{split}/{split}_source{source}.tsv"


def truth_path(root: str) -> str:
    return f"{root}/train/train_ground_truth.tsv"


def missing_inputs(spark: SparkSession, root: str, splits: tuple[str, ...] = ("train", "test")) -> list[str]:
    """The input files that aren't there."""
    paths = [source_path(root, s, n) for s in splits for n in (1, 2, 3)] + ([truth_path(root)] if "train" in splits else [])
    return [p for p in paths if not path_exists(spark, p)]


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan_tsv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """All rows of a tab-separated file with a header: quotes and line ends inside them are honoured, blank rows skipped, short rows padded, nothing is null."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = spark.read.csv(path, schema=schema, sep="\t", header=True, quote='"', escape='"', multiLine=True, mode="PERMISSIVE", enforceSchema=True)
    return rows.select(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields]).where(F.concat(*[F.trim(F.col(f)) for f in fields]) != "")


def scan_records(spark: SparkSession, root: str, split: str, sources: tuple[int, ...]) -> DataFrame:
    """Records of several sources of a split, with src."""
    out = None
    for n in sources:
        part = scan_tsv(spark, source_path(root, split, n), RECORD_FIELDS).withColumn("src", F.lit(n).cast("tinyint"))
        out = part if out is None else out.unionByName(part)
    return out


def parse_truth(rows: DataFrame, key: str = TRUTH_FIELDS[0], ids: str = TRUTH_FIELDS[1], order: Column | None = None) -> DataFrame:
    """(q, ids): the list of each entity; of repeated entities the last row by `order` counts (by default the greatest list text)."""
    last = Window.partitionBy("q").orderBy(F.desc_nulls_last("_o"))
    got = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("q"), split_ids(ids).alias("ids"), (order if order is not None else F.col(ids)).alias("_o"))
    return got.withColumn("_n", F.row_number().over(last)).where(F.col("_n") == 1).select("q", "ids")


def scan_truth(spark: SparkSession, root: str) -> DataFrame:
    return parse_truth(scan_tsv(spark, truth_path(root), TRUTH_FIELDS), order=F.monotonically_increasing_id())


def scan_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id): the trimmed first fields of the rows after the header, distinct and not empty."""
    lines = numbered_lines(spark, path).where(F.col("line_no") > 1)
    return lines.select(F.trim(F.split("value", "\t")[0]).alias("id")).where(F.col("id") != "").distinct()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no from 1, value): the lines of one text file; the number comes from the order of the file, without a sort of the lines.

    Lines are counted per partition first, so that each partition knows where it
    begins.
    """
    lines = spark.read.text(path).withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    before = lines.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_m").alias("_first"))
    before = before.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return lines.join(F.broadcast(before.select("_p", "_first", "_before")), "_p").select((F.col("_before") + F.col("_m") - F.col("_first") + 1).alias("line_no"), "value")


def slug(c: Column) -> Column:
    """A label as part of a file name."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", "_")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """A table in one folder per label; each folder is written by several tasks if its label is large."""
    df.write.mode("overwrite").partitionBy(*by).option("compression", "zstd").parquet(path)


def read_partition(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None, **labels: str) -> DataFrame:
    """Columns of the folders with the given labels; an absent table or label gives an empty frame."""
    df = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    for name, value in labels.items():
        df = df.where(F.col(name) == value)
    return df.select(*(columns or df.columns))


def labels_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def row_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def result_lines(lists: DataFrame, key: str, ids: str) -> DataFrame:
    """(value): a line per entity with its id, a tab and its list."""
    return lists.select(F.concat(F.col(key), F.lit("\t"), F.array_join(ids, ",")).alias("value"))


def write_result(lists: DataFrame, path: str, order: str, key: str, ids: str, header: list[str]) -> None:
    """A header and a line per entity in the given order, unquoted; the part files follow each other."""
    lines = lists.select(F.col(order).alias("_o"), F.concat(F.col(key), F.lit("\t"), F.array_join(ids, ",")).alias("value"))
    head = lists.sparkSession.createDataFrame([("\t".join(header),)], "value string")
    ordered = head.select(F.lit(0).alias("_h"), F.lit(None).cast(lines.schema["_o"].dataType).alias("_o"), "value").unionByName(lines.select(F.lit(1).alias("_h"), "_o", "value"))
    ordered.orderBy("_h", "_o").select("value").write.mode("overwrite").text(path)


def write_rule(spark: SparkSession, path: str, threshold: float, margin: float, score: float, features: list[str], **run: object) -> None:
    """The decision rule and the parameters of its run as one line of JSON."""
    text = json.dumps({"thr": threshold, "margin": margin, "holdout_f05": score, "features": features, "run": run})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_rule(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
