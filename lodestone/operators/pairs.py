"""Candidate pairs: rerank, context and competition, text features, labels, decision rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions.similarity import safe_ratio, score_pairs
from lodestone.functions.text import blob, char_length

COSINES = ["cos_blob", "cos_addr", "cos_name"]
#: The order of the features of a pair is part of the contract.
FEATURES = (
    "cos_blob cos_addr cos_name cos_max n_idx_hit cos_rank cos_best cos_margin n_cands name_ratio name_tsort name_tset name_partial skel_ratio skel_partial addr_ratio addr_tsort addr_tset blob_tset digits_tset "
    "name_len_ratio addr_len_ratio ref_addr_empty s1_addr_empty ref_name_len s1_name_len src_is_s3 ref_best_cos ref_cos_margin ref_n_s1"
).split()


def clean_candidates(cand: DataFrame, q: str, r: str) -> DataFrame:
    """(q, r, cosines): one row a pair with its best scores; a null or NaN cosine counts as 0."""
    score = [F.max(F.when(F.col(c).isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.col(c).cast("double"))).alias(c) for c in COSINES]
    return cand.groupBy(F.col(q).alias("q"), F.col(r).alias("r")).agg(*score)


def rerank(pairs: DataFrame, left: DataFrame, right: DataFrame, keep: int = 60) -> DataFrame:
    """(q, r, cosines, rerank): of the pairs of each query the `keep` best by name, address and cosine likeness.

    left, right: normalized records with the column `key`. Equal scores are
    ordered by the reference. A query with fewer pairs keeps all; a pair whose
    record is missing is dropped.
    """
    scored = with_texts(pairs, left, right).withColumn(
        "s",
        score_pairs(
            {
                "ntset": ("token_set_ratio", F.col("x.name_norm"), F.col("y.name_norm")),
                "nratio": ("ratio", F.col("x.name_norm"), F.col("y.name_norm")),
                "ntsort": ("token_sort_ratio", F.col("x.name_norm"), F.col("y.name_norm")),
                "sratio": ("ratio", F.col("x.skel"), F.col("y.skel")),
                "atset": ("token_set_ratio", F.col("x.addr_norm"), F.col("y.addr_norm")),
                "aratio": ("ratio", F.col("x.addr_norm"), F.col("y.addr_norm")),
            }
        ),
    )
    total = (F.greatest("s.ntset", "s.nratio", "s.ntsort", "s.sratio") + F.greatest("s.atset", "s.aratio")) / 100.0 + F.col("cos_blob") + F.col("cos_addr") + F.col("cos_name")
    ranked = scored.withColumn("rerank", F.round(total, 6)).withColumn("_rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("rerank"), "r")))
    return ranked.where(F.col("_rank") <= keep).select("q", "r", *COSINES, "rerank")


def with_texts(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs with the records of both sides as structs x and y."""
    x = left.select(F.col("key").alias("q"), F.struct(*[c for c in left.columns if c != "key"]).alias("x"))
    y = right.select(F.col("key").alias("r"), F.struct(*[c for c in right.columns if c != "key"]).alias("y"))
    return pairs.join(x, "q").join(y, "r")


def _best() -> Column:
    return F.greatest(*COSINES)


def query_context(pairs: DataFrame) -> DataFrame:
    """pairs with cos_max, n_idx_hit, cos_rank (from 0), cos_best, cos_margin and n_cands of the query."""
    per = Window.partitionBy("q")
    rows = pairs.withColumn("cos_max", _best()).withColumn("n_idx_hit", sum(((F.col(c) > 0).cast("int") for c in COSINES), F.lit(0)))
    return rows.withColumns(
        {
            "cos_rank": F.row_number().over(per.orderBy(F.desc("cos_max"), "r")) - 1,
            "cos_best": F.max("cos_max").over(per),
            "cos_margin": F.col("cos_max") - F.max("cos_max").over(per),
            "n_cands": F.count(F.lit(1)).over(per),
        }
    )


def reference_competition(pairs: DataFrame) -> DataFrame:
    """pairs with ref_best_cos, ref_cos_margin and ref_n_s1: the best cosine over all pairs of the reference (the pair itself included), the distance to it, and how many queries retrieved it."""
    per = Window.partitionBy("r")
    best = F.max(_best()).over(per)
    return pairs.withColumns({"ref_best_cos": best, "ref_cos_margin": _best() - best, "ref_n_s1": F.count(F.lit(1)).over(per)})


def text_features(pairs: DataFrame) -> DataFrame:
    """pairs (with structs x and y) with the text features."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    s = score_pairs(
        {
            "name_ratio": ("ratio", x("name_norm"), y("name_norm")),
            "name_tsort": ("token_sort_ratio", x("name_norm"), y("name_norm")),
            "name_tset": ("token_set_ratio", x("name_norm"), y("name_norm")),
            "name_partial": ("partial_ratio", x("name_norm"), y("name_norm")),
            "skel_ratio": ("ratio", x("skel"), y("skel")),
            "skel_partial": ("partial_ratio", x("skel"), y("skel")),
            "addr_ratio": ("ratio", x("addr_norm"), y("addr_norm")),
            "addr_tsort": ("token_sort_ratio", x("addr_norm"), y("addr_norm")),
            "addr_tset": ("token_set_ratio", x("addr_norm"), y("addr_norm")),
            "blob_tset": ("token_set_ratio", blob(x("name_norm"), x("addr_norm")), blob(y("name_norm"), y("addr_norm"))),
            "digits_tset": ("token_set_ratio", x("digits"), y("digits")),
        }
    )
    return length_features(pairs.withColumn("_s", s).select("*", "_s.*").drop("_s"))


def length_features(pairs: DataFrame) -> DataFrame:
    """pairs (with structs x and y) with length ratios, lengths, flags of empty addresses and of the source."""
    n = {k: char_length(F.col(c)) for k, c in (("xn", "x.name_norm"), ("yn", "y.name_norm"), ("xa", "x.addr_norm"), ("ya", "y.addr_norm"))}
    return pairs.withColumns(
        {
            "name_len_ratio": safe_ratio(n["xn"], n["yn"]),
            "addr_len_ratio": safe_ratio(n["xa"], n["ya"]),
            "ref_addr_empty": (n["ya"] == 0).cast("int"),
            "s1_addr_empty": (n["xa"] == 0).cast("int"),
            "ref_name_len": n["yn"],
            "s1_name_len": n["xn"],
            "src_is_s3": (F.col("y.src") == 3).cast("int"),
        }
    )


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(q, r, the 30 features) of every pair; pairs holds one row a pair with the three cosines.

    Context and competition are taken over all pairs before records are joined.
    only: (q) whose pairs are wanted; the texts of other pairs aren't compared.
    """
    rows = reference_competition(query_context(pairs))
    if only is not None:
        rows = rows.join(only.select("q").distinct(), "q", "left_semi")
    return text_features(with_texts(rows, left, right)).select("q", "r", *[F.col(f).cast("double").alias(f) for f in FEATURES])


def pair_labels(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """pairs with label 1 if (q, r) is a link, else 0."""
    hit = links.select("q", "r", F.lit(1).alias("_hit")).distinct()
    return pairs.join(hit, ["q", "r"], "left").withColumn("label", F.coalesce("_hit", F.lit(0))).drop("_hit")


def decide(pairs: DataFrame, p: str, threshold: float, margin: float) -> DataFrame:
    """The pairs whose probability reaches the threshold and lies within the margin of the best of their query.

    The best is taken over all pairs of the query. Eight decimals are compared,
    so that a difference of exactly the margin counts on every machine.
    """
    best = F.max(p).over(Window.partitionBy("q"))
    return pairs.withColumn("_best", best).where((F.col(p) >= threshold) & (F.round(F.col("_best") - F.col(p), 8) <= margin)).drop("_best")


def id_lists(pairs: DataFrame, queries: DataFrame, order: list[Column], name: str = "ids") -> DataFrame:
    """(q, ids): for every query its references as a list in the given order, empty if it has none."""
    lists = pairs.groupBy("q").agg(F.transform(F.array_sort(F.collect_list(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col("r").alias("r")))), lambda s: s["r"]).alias(name))
    kind = dict(pairs.dtypes)["r"]
    return queries.select("q").distinct().join(lists, "q", "left").withColumn(name, F.coalesce(name, F.array().cast(f"array<{kind}>")))
