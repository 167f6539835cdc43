"""Queries of the two general problems: skewed keys and lines that fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.skew import balanced_aggregate, balanced_join
from lodestone.session import read_table
from lodestone.sources.delimited import parse_lines

FIELDS = ["entity_id", "business_name", "business_address", "country"]
FEEDS = {"train_source1.tsv": "S1-[0-9]{9}", "train_source2.tsv": "S2-[0-9]{9}"}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Labels that hold at least 5 % of all rows of source 1."""
    s1 = read_table(spark, d, "train_source1").select("country")
    per = balanced_aggregate(s1, ["country"], {"n_rows": ("count", F.lit(1))})
    total = per.agg(F.sum("n_rows").alias("total"))
    return per.join(F.broadcast(total), F.col("n_rows") * 20 >= F.col("total")).where(F.col("country").isNotNull()).select("country")


def p2_country_profile(spark: SparkSession, d: str) -> DataFrame:
    """Complete figures of every country of source 1."""
    s1 = read_table(spark, d, "train_source1").select("country", "business_name", "business_address", "updated_at")
    return balanced_aggregate(
        s1,
        ["country"],
        {
            "n_rows": ("count", F.lit(1)),
            "n_addresses": ("count", F.col("business_address")),
            "name_chars": ("sum", F.length("business_name").cast("bigint")),
            "first_name": ("min", F.col("business_name")),
            "last_seen": ("max", F.col("updated_at")),
        },
    )


def p2_shared_names(spark: SparkSession, d: str) -> DataFrame:
    """Per country, the records of source 1 whose name also stands in source 2 of that country."""
    s1 = read_table(spark, d, "train_source1").select("country", "entity_id", "business_name")
    s2 = read_table(spark, d, "train_source2").select("country", F.lower("business_name").alias("other_name")).distinct()
    hit = balanced_join(s1, s2, ["country"], extra=F.lower("business_name") == F.col("other_name"), how="left_semi")
    return hit.groupBy("country").agg(F.count(F.lit(1)).alias("n_shared"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    raw = read_table(spark, d, "raw_lines").select("line_id", "source_file", "line_text")
    return parse_lines(raw, "line_text", "source_file", FEEDS, FIELDS, "entity_id", "country", read_table(spark, d, "country_labels").select("country"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that fail, with the first reason."""
    return _parsed(spark, d).where(F.col("reason").isNotNull()).select("line_id", "reason")


def p5_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The valid lines as records."""
    return _parsed(spark, d).where(F.col("reason").isNull()).select("line_id", *FIELDS)


QUERIES = {
    "p2_found": p2_found,
    "p2_country_profile": p2_country_profile,
    "p2_shared_names": p2_shared_names,
    "p5_found": p5_found,
    "p5_loaded": p5_loaded,
}

_FIELD = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
_PARSED = rf"""
    with lines as (
      select line_id, source_file,
             case when line_text like '%' || chr(13) then left(line_text, length(line_text) - 1) else line_text end as t
      from raw_lines
    ), cut as (
      select line_id, source_file, t,
             regexp_full_match(t, '{_FIELD}(?:\t{_FIELD})*', 's') as quoted_well,
             regexp_extract_all(chr(9) || t, '\t({_FIELD})', 1, 's') as f
      from lines
    ), plain as (
      select line_id, source_file, t, quoted_well,
             list_transform(f, lambda x: case when x like '"%' then replace(x[2:-2], '""', '"') else x end) as f
      from cut
    ), judged as (
      select line_id, f,
             case when t is null then 'column_count'
                  when not quoted_well then 'quoting'
                  when len(f) <> 4 then 'column_count'
                  when not regexp_full_match(f[1], 'S' || substr(source_file, 13, 1) || '-[0-9]{{9}}') then 'entity_id'
                  when f[4] not in (select country from country_labels where country is not null) then 'country' end as reason
      from plain
    )
"""

ORACLES = {
    "p2_found": """
        select country from (select country, count(*) as n, sum(count(*)) over () as total from train_source1 group by country)
        where country is not null and n * 20 >= total""",
    "p2_country_profile": """
        select country, count(*)::bigint as n_rows, count(business_address)::bigint as n_addresses, sum(length(business_name))::bigint as name_chars,
               min(business_name) as first_name, max(updated_at) as last_seen
        from train_source1 group by country""",
    "p2_shared_names": """
        select country, count(*)::bigint as n_shared from train_source1 a
        where exists (select 1 from train_source2 b where b.country = a.country and lower(b.business_name) = lower(a.business_name))
        group by country""",
    "p5_found": _PARSED + "select line_id, reason from judged where reason is not null",
    "p5_loaded": _PARSED + "select line_id, f[1] as entity_id, f[2] as business_name, f[3] as business_address, f[4] as country from judged where reason is null",
}
