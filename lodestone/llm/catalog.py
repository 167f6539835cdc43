"""Queries of the problems tagged llm, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.leaks import find_leaks
from lodestone.llm.lookalike import normalize_lookalikes
from lodestone.llm.linkage import link_records, read_sources
from lodestone.llm.names import link_names
from lodestone.llm.places import match_addresses
from lodestone.llm.packing import CAPACITY, count_tokens, pack_items
from lodestone.llm.personal import find_personal_data, mask_personal_data
from lodestone.llm.topn import top_n_per_group
from lodestone.session import read_table, stage

#: The members are a fixed table; a longer one is refused rather than shipped.
MAX_MEMBERS = 100_000


def _best_cosine() -> list:
    return [F.when(F.col(c).isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.col(c)).cast("float") for c in ("cos_blob", "cos_addr", "cos_name")]


def _sources(spark: SparkSession, d: str, *numbers: int) -> DataFrame:
    return read_sources({f"s{i}": read_table(spark, d, f"train_source{i}") for i in numbers})


def _known(spark: SparkSession, d: str) -> DataFrame:
    """The labelled links: one row for each, and one without a right id for a record that has none."""
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    return read_table(spark, d, "train_matches").where(F.col("source1_entity_id").isNotNull()).select(F.col("source1_entity_id").alias("left_id"), F.explode_outer(ids).alias("right_id")).distinct()


def p1_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Records of sources 2 and 3 for every record of source 1, each with its confidence."""
    records = _sources(spark, d, 1, 2, 3)
    links = link_records(records.where(F.col("source") == "s1"), records.where(F.col("source") != "s1"), _known(spark, d))
    return links.select(F.col("left_id").alias("s1_entity_id"), F.col("right_id").alias("ref_entity_id"), "confidence")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The links of the records without label; a record whose business is labelled is taken."""
    known = _known(spark, d)
    taken = known.where(F.col("right_id").isNotNull()).select(F.col("right_id").alias("ref_entity_id")).distinct()
    labelled = known.select(F.col("left_id").alias("s1_entity_id")).distinct()
    return p1_confidence(spark, d).join(labelled, "s1_entity_id", "left_anti").join(taken, "ref_entity_id", "left_anti").select("s1_entity_id", "ref_entity_id").distinct()


def p3_names(spark: SparkSession, d: str) -> DataFrame:
    """Records of sources 1 and 3 whose names are spellings of one organisation's, with the similarity."""
    records = _sources(spark, d, 1, 3)
    links = link_names(records.where(F.col("source") == "s1"), records.where(F.col("source") == "s3"))
    return links.select(F.col("left_id").alias("s1_entity_id"), F.col("right_id").alias("s3_entity_id"), "similarity")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Those whose names are not equal as stored."""
    pairs = p3_names(spark, d).select("s1_entity_id", "s3_entity_id")
    for source, key in (("train_source1", "s1_entity_id"), ("train_source3", "s3_entity_id")):
        stored = read_table(spark, d, source).select(F.col("entity_id").alias(key), F.col("business_name").alias(source)).dropDuplicates()
        pairs = pairs.join(stored, key)
    return pairs.where(F.col("train_source1") != F.col("train_source3")).select("s1_entity_id", "s3_entity_id").distinct()


def p4_places(spark: SparkSession, d: str) -> DataFrame:
    """Records of sources 1 and 2 at the same place, with the likeness of their addresses."""
    left = read_table(spark, d, "train_source1").select(F.col("entity_id").alias("s1_entity_id"), "business_address")
    right = read_table(spark, d, "train_source2").select(F.col("entity_id").alias("s2_entity_id"), "business_address")
    return match_addresses(left, right, "s1_entity_id", "s2_entity_id", "business_address")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs at the same place whose addresses are not equal as stored."""
    pairs = p4_places(spark, d).select("s1_entity_id", "s2_entity_id")
    for source, key in (("train_source1", "s1_entity_id"), ("train_source2", "s2_entity_id")):
        stored = read_table(spark, d, source).select(F.col("entity_id").alias(key), F.col("business_address").alias(source)).dropDuplicates()
        pairs = pairs.join(stored, key)
    return pairs.where(F.col("train_source1") != F.col("train_source2")).select("s1_entity_id", "s2_entity_id").distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The ten best references of each source 1 record."""
    return p6_ranked(spark, d).select("s1_idx", "ref_idx")


def p6_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The same with score and rank."""
    return top_n_per_group(read_table(spark, d, "train_cand"), "s1_idx", "ref_idx", F.greatest(*_best_cosine()), 10).withColumn("rank", F.col("rank").cast("bigint"))


def p7_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Every record of source 2 with the consistent form of name and address."""
    return normalize_lookalikes(read_table(spark, d, "train_source2").select("entity_id", "business_name", "business_address"), ["business_name", "business_address"])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Records and fields of source 2 that are not in the consistent form."""
    fields = [F.when(F.col(f) != F.col(f"{f}_plain"), F.lit(f)) for f in ("business_name", "business_address")]
    found = p7_normalized(spark, d).select("entity_id", F.explode(F.array_compact(F.array(*fields))).alias("field_name"))
    return found.distinct()


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Held-out items in speeches, with the length of the stretch."""
    return find_leaks(read_table(spark, d, "documents"), "doc_id", "text", read_table(spark, d, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Held-out items in speeches."""
    return p9_leaks(spark, d).select("item_id", "doc_id")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every speech with the container it is in; one row for each piece of a speech that exceeds a container by itself."""
    sizes = count_tokens(read_table(spark, d, "documents").select("doc_id", "source", "text"), "text")
    return pack_items(sizes, "doc_id", "source", "n_tokens").select("doc_id", "piece", "first_token", F.col("size").alias("n_tokens"), "source", "container")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every container with its items, tokens and share of space used."""
    per = p8_packed(spark, d).where(F.col("container").isNotNull()).groupBy("container").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_tokens"))
    return per.withColumn("filled", F.col("n_tokens") / F.lit(float(CAPACITY)))


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every speech with tokens, and whether it lies in containers without gap, repetition or overfull container, undivided if it fits."""
    packed = stage(p8_packed(spark, d).where(F.col("container").isNotNull()), "packed")
    over = packed.groupBy("container").agg(F.sum("n_tokens").alias("n")).where(F.col("n") > CAPACITY).select("container", F.lit(1).alias("over"))
    per = packed.join(over, "container", "left").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pieces"), F.countDistinct("piece").alias("different"), F.max("piece").alias("last"), F.sum("n_tokens").alias("tokens"), F.sum("over").alias("over")
    )
    ok = (F.col("pieces") == F.col("different")) & (F.col("last") + 1 == F.col("pieces")) & F.col("over").isNull() & (F.ceil(F.col("tokens") / F.lit(CAPACITY)) == F.col("pieces"))
    return per.select("doc_id", ok.alias("whole"))


def _members(spark: SparkSession, d: str) -> list[str]:
    rows = read_table(spark, d, "members").where(F.col("full_name").isNotNull()).select("full_name").distinct().limit(MAX_MEMBERS + 1).collect()
    if len(rows) > MAX_MEMBERS:
        raise ValueError(f"more than {MAX_MEMBERS} members")
    return sorted(r[0] for r in rows)


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of personal data in a speech, with its end."""
    return find_personal_data(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", _members(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of personal data in a speech."""
    return p10_spans(spark, d).select("doc_id", "pii_type", "start_pos").distinct()


def p10_masked(spark: SparkSession, d: str) -> DataFrame:
    """Speeches in which each piece of personal data is replaced by its type."""
    return mask_personal_data(read_table(spark, d, "documents").select("doc_id", "text"), "text", "masked", _members(spark, d)).select("doc_id", "masked")


QUERIES = {"p1_confidence": p1_confidence, "p1_found": p1_found, "p3_names": p3_names, "p3_found": p3_found, "p4_places": p4_places, "p4_found": p4_found, "p6_found": p6_found, "p6_ranked": p6_ranked, "p7_normalized": p7_normalized, "p7_found": p7_found, "p8_packed": p8_packed, "p8_containers": p8_containers, "p8_whole": p8_whole, "p9_leaks": p9_leaks, "p9_found": p9_found, "p10_spans": p10_spans, "p10_found": p10_found, "p10_masked": p10_masked}

_P6 = """
    with scored as (
      select s1_idx, ref_idx, max(greatest(
        case when cos_blob is null or isnan(cos_blob) then 0 else cos_blob end,
        case when cos_addr is null or isnan(cos_addr) then 0 else cos_addr end,
        case when cos_name is null or isnan(cos_name) then 0 else cos_name end)) as s
      from train_cand group by all
    ), ranked as (select *, row_number() over (partition by s1_idx order by s desc, ref_idx) as rank from scored)
"""

ORACLES = {
    "p8_whole": "select doc_id, true as whole from documents where length(text) > 0",
    "p6_found": _P6 + "select s1_idx, ref_idx from ranked where rank <= 10",
    "p6_ranked": _P6 + "select s1_idx, ref_idx, s::double as score, rank from ranked where rank <= 10",
}
