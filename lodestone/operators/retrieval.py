"""Retrieval of candidates: tf-idf weighted character n-grams in inverted indexes, one partition at a time.

All text fields go through one plan. What is shuffled are the texts and the
document frequencies of grams, never grams of records or products of weights: a
shard of the queries of a partition and all its references come to one task, where
grams are cut, weighted and summed up in blocks (see postings). A gram in more
than a share of a partition's references is pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions.text import char_grams
from lodestone.operators import postings
from lodestone.session import parallelism, stage

#: A gram in more than this share of the references of a partition is pruned.
MAX_DF = 0.01
#: Decimals to which cosines are rounded, so that ties are the same at every run.
DIGITS = 6
#: Hits that a shard of queries holds, and tasks for each of the session's shuffle partitions.
HITS, TASKS = 1 << 23, 4


def term_counts(records: DataFrame, part: str, key: str, fields: dict[str, Column], low: int = 4, high: int = 5) -> DataFrame:
    """(part, field, key, gram, tf): how often each gram stands in each field of each record; an empty or null text has none."""
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(c, F.lit("")).alias("text")) for f, c in fields.items()])
    rows = records.select(F.col(part).alias("part"), F.col(key).alias("key"), F.explode(texts).alias("t")).select("part", "t.field", "key", char_grams(F.col("t.text"), low, high).alias("g"))
    return rows.select("part", "field", "key", F.explode("g").alias("gram")).groupBy("part", "field", "key", "gram").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame, records: DataFrame, part: str, max_df: float = MAX_DF) -> DataFrame:
    """(part, field, gram, df, n, idf, pruned) over the references."""
    sizes = records.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    df = counts.groupBy("part", "field", "gram").agg(F.count(F.lit(1)).alias("df")).join(sizes, "part")
    return df.withColumn("idf", F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1.0).withColumn("pruned", F.col("df") > F.lit(max_df) * F.col("n"))


def weighted_terms(counts: DataFrame, frequency: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(part, field, key, gram, w): log1p(tf) * idf, each record of length 1 in each field; pruned grams count in no length.

    sizes: (part, n) of the references, for queries: a gram that no reference has
    makes a query longer though it can't match.
    """
    seen = frequency.select("part", "field", "gram", "idf", "pruned")
    if sizes is None:
        rows = counts.join(seen, ["part", "field", "gram"]).where(~F.col("pruned"))
    else:
        rows = counts.join(seen, ["part", "field", "gram"], "left").join(sizes, "part").where(F.col("pruned").isNull() | ~F.col("pruned"))
        rows = rows.withColumn("idf", F.coalesce("idf", F.log(F.lit(1.0) + F.col("n")) + 1.0))
    raw = rows.withColumn("raw", F.log1p(F.col("tf").cast("double")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("part", "field", "key")))
    return raw.withColumn("w", F.col("raw") / norm).select("part", "field", "key", "gram", "w")


def documents(records: DataFrame, part: str, key: str, texts: list[Column]) -> DataFrame:
    """(part, key, rows, t0, t1, ...): one row a key of a partition; the texts of repeated keys are taken together, rows tells how many."""
    cols = [F.translate(F.coalesce(c, F.lit("")), "\t\n\x0b\f\r", " " * 5).alias(f"t{i}") for i, c in enumerate(texts)]
    rows = records.select(F.col(part).alias("part"), F.col(key).alias("key"), *cols).where(F.col("part").isNotNull())
    return rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("rows"), *[F.concat_ws(" ", F.collect_list(f"t{i}")).alias(f"t{i}") for i in range(len(texts))])


def _merged(scored: DataFrame, split: DataFrame, k: dict[str, int]) -> DataFrame:
    """scored, where the queries of split, which stand in several partitions, keep the best over all of them."""
    cosines = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"cos_{f}").alias("cos")) for f in k])).alias("h")
    hits = scored.join(split, "q", "left_semi").select("q", "r", cosines).select("q", "r", "h.*").where(F.col("cos") > 0)
    order = Window.partitionBy("field", "q").orderBy(F.desc("cos"), "r")
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in k.items() for x in kv]), F.col("field"))
    kept = hits.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
    pivoted = kept.groupBy("q", "r").agg(*[F.coalesce(F.max(F.when(F.col("field") == f, F.col("cos"))), F.lit(0.0)).alias(f"cos_{f}") for f in k])
    return scored.join(split, "q", "left_anti").unionByName(pivoted)


def retrieve(queries: DataFrame, references: DataFrame, part: str, query_id: str, reference_id: str, fields: dict[str, tuple[Column, int]], max_df: float = MAX_DF) -> DataFrame:
    """(q, r, cos_<field>...): for every query the k most similar references of its partition by each field.

    fields: {name: (text, k)}; the texts are Columns of both frames. Records of a
    null partition meet none. A partition of fewer than 1 / max_df references
    prunes every gram it has, so nothing is retrieved there unless max_df is
    larger. An empty frame on either side gives no rows.
    """
    texts, limits = [c for c, _ in fields.values()], [k for _, k in fields.values()]
    asked = stage(documents(queries, part, query_id, texts), "queries")
    refs = stage(documents(references, part, reference_id, texts), "references")
    sizes = refs.groupBy("part").agg(F.sum("rows").alias("n"))
    # each shard of queries holds a bounded number of hits and meets all references of its partition
    most = max(1, HITS // sum(limits))
    shards = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("shards")).join(sizes, "part")
    copies = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    fields_n, part_type = len(texts), refs.schema["part"].dataType.simpleString()
    packed = f"part {part_type}, field int, grams string, counts string"
    each = refs.select("part", *[f"t{i}" for i in range(fields_n)]).sortWithinPartitions("part").mapInArrow(lambda batches: postings.count_grams(batches, fields_n), packed)
    frequencies = stage(each.repartition("part", "field").sortWithinPartitions("part", "field").mapInArrow(postings.merge_counts, packed), "frequencies")
    rows = frequencies.join(shards, "part").select("part", copies, F.lit(postings.FREQUENCY).alias("kind"), "field", "n", "grams", "counts")
    for side, kind, shard in ((asked, postings.QUERY, F.pmod(F.xxhash64("key"), F.col("shards")).cast("int").alias("shard")), (refs, postings.REFERENCE, copies)):
        rows = rows.unionByName(side.join(shards, "part").select("part", shard, F.lit(kind).alias("kind"), "key", *[f"t{i}" for i in range(len(texts))]), allowMissingColumns=True)
    spread = rows.repartition(TASKS * parallelism(rows.sparkSession), "part", "shard").sortWithinPartitions("part", "shard", "kind", "key")
    types = {"q": queries.schema[query_id].dataType, "r": references.schema[reference_id].dataType}
    schema = ", ".join([*(f"{c} {t.simpleString()}" for c, t in types.items()), *(f"c{i} double" for i in range(len(texts)))])
    scored = spread.mapInArrow(lambda batches: postings.score_shards(batches, limits, max_df, DIGITS), schema)
    scored = scored.select("q", "r", *[F.col(f"c{i}").alias(f"cos_{f}") for i, f in enumerate(fields)])
    split = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.col("key").alias("q"))
    return scored if split.isEmpty() else _merged(stage(scored, "hits"), split, {f: k for f, (_, k) in fields.items()})
