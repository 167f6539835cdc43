"""Queries of the linkage operators over the business records, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions.lookups import LEGAL_SUFFIX, ORDINAL_ENDS, STATE_MAP, STOP_TOKENS, STREET_ABBR
from lodestone.functions.similarity import score_pairs
from lodestone.operators import learning, metrics, pairs, retrieval, validation
from lodestone.session import read_table, stage
from lodestone.sources import tables

PART = "country"
KEEP = {"blob": 200, "addr": 200, "name": 60}


# ------------------------------------------------------------------ inputs
def records(spark: SparkSession, d: str, *sources: int) -> DataFrame:
    """(key, name, addr, country, src): records of the sources; repeated rows once, nulls as empty texts."""
    out = None
    for n in sources:
        rows = read_table(spark, d, f"train_source{n}").select(F.col("entity_id").alias("key"), *[F.coalesce(c, F.lit("")).alias(a) for c, a in (("business_name", "name"), ("business_address", "addr"), ("country", "country"))]).distinct()
        rows = rows.withColumn("src", F.lit(n))
        out = rows if out is None else out.unionByName(rows)
    return out


def truth(spark: SparkSession, d: str) -> DataFrame:
    return tables.parse_truth(read_table(spark, d, "train_matches"))


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return pairs.clean_candidates(read_table(spark, d, "train_cand"), "s1_idx", "ref_idx")


def _links(spark: SparkSession, d: str) -> DataFrame:
    """(q, r) by position."""
    number = lambda c: F.substring(c, 4, 9).cast("bigint")
    return truth(spark, d).select(number(F.col("q")).alias("q"), F.explode("ids").alias("r")).select("q", number(F.col("r")).alias("r"))


def plain(c: str) -> Column:
    """A light fold for retrieval: lower case, everything but ASCII letters, digits and underscore to a blank."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", " "))


def _fields() -> dict[str, Column]:
    return {"blob": F.concat(plain("name"), F.lit(" "), plain("addr")), "addr": plain("addr"), "name": plain("name")}


# ------------------------------------------------------------------ sources
def scan_records(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "train_source1").where(F.col("country").isin("US", "India")).select("entity_id", "business_name")


def country_counts(spark: SparkSession, d: str) -> DataFrame:
    return tables.row_counts(records(spark, d, 1, 2, 3), PART)


def country_slugs(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 1, 2, 3).select(PART, tables.slug(F.col(PART)).alias("slug")).distinct()


def reference_union(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 2, 3).groupBy("src").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_keys"))


def truth_parse(spark: SparkSession, d: str) -> DataFrame:
    return truth(spark, d).select(F.col("q").alias("source1_entity_id"), F.size("ids").cast("bigint").alias("n_ids"), F.array_join("ids", ";").alias("ids"))


def result_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the result file: every entity of source 1 once, with its labelled list or an empty one."""
    s1 = records(spark, d, 1).select(F.col("key").alias("q"))
    return tables.result_lines(s1.join(truth(spark, d), "q", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>"))), "q", "ids")


# ------------------------------------------------------------------ normalization
def fold_text(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 1).select("key", T.fold("name").alias("folded"), T.is_ascii("name").alias("ascii"))


def canon_name(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 1).select("key", T.fold("name").alias("f")).select("key", T.canon_name(F.col("f")).alias("name_norm"))


def canon_addr(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 1).select("key", T.fold("addr").alias("f")).select("key", T.canon_address(F.col("f")).alias("addr_norm"))


def normalized_records(spark: SparkSession, d: str) -> DataFrame:
    """All derived texts of source 1."""
    return T.normalize_records(records(spark, d, 1), "name", "addr").select("key", "name_norm", "addr_norm", "skel", "digits", T.char_length(T.blob("name_norm", "addr_norm")).cast("bigint").alias("blob_len"))


def normalized_references(spark: SparkSession, d: str) -> DataFrame:
    """The same for sources 2 and 3, where scripts other than Latin are romanized."""
    return T.normalize_records(records(spark, d, 2, 3), "name", "addr").select("key", "name_norm", "addr_norm", "skel", "digits", "src", PART)


ROMANIZED = {"कर्नाटक": "krnatk", "प्राइवेट": "praivet", "एलएलपी": "elelpi", "Énterprises": "Enterprises", "straße": "strasse", "Иван": "Ivan"}


def romanize(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(x,) for x in ROMANIZED], "native string").select("native", F.lower(T.romanize("native")).alias("roman"))


# ------------------------------------------------------------------ retrieval
def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    counts = retrieval.term_counts(records(spark, d, 1), PART, "key", {"name": plain("name")})
    return counts.groupBy("gram").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


def _frequency(spark: SparkSession, d: str) -> DataFrame:
    refs = records(spark, d, 2, 3)
    return retrieval.document_frequency(retrieval.term_counts(refs, PART, "key", _fields()), refs, PART)


def doc_freq_idf(spark: SparkSession, d: str) -> DataFrame:
    return _frequency(spark, d).select("part", "field", "gram", "df", F.round("idf", 6).alias("idf"), "pruned")


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    """Weights of the references by name."""
    refs = records(spark, d, 2, 3)
    counts = retrieval.term_counts(refs, PART, "key", {"name": plain("name")})
    return retrieval.weighted_terms(counts, retrieval.document_frequency(counts, refs, PART)).select("part", "key", "gram", F.round("w", 6).alias("w"))


def _block(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    texts = {f: (c, KEEP[f]) for f, c in _fields().items() if f in fields}
    return retrieval.retrieve(records(spark, d, 1), records(spark, d, 2, 3), PART, "key", "key", texts)


def block_name(spark: SparkSession, d: str) -> DataFrame:
    """The 60 references most similar by name to each record of source 1."""
    return _block(spark, d, "name").withColumnsRenamed({"q": "s1_id", "r": "ref_id"})


def block_addr(spark: SparkSession, d: str) -> DataFrame:
    return _block(spark, d, "addr").withColumnsRenamed({"q": "s1_id", "r": "ref_id"})


def block_all(spark: SparkSession, d: str) -> DataFrame:
    """The union of the three retrievals, one row a pair."""
    return _block(spark, d, "blob", "addr", "name").withColumnsRenamed({"q": "s1_id", "r": "ref_id"})


def blocking_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of the retrieval against the labels, by country and over all."""
    found = stage(_block(spark, d, "blob", "addr", "name").select("q", "r"), "candidates")
    part = lambda *n: records(spark, d, *n).select(F.col(PART).alias("part"), "key")
    return metrics.blocking_report(found, truth(spark, d), part(1), part(2, 3))


def rerank_topk(spark: SparkSession, d: str) -> DataFrame:
    """The 60 best of each record of source 1 after comparing the texts."""
    found = stage(_block(spark, d, "blob", "addr", "name"), "candidates")
    left, right = (stage(T.normalize_records(records(spark, d, *n), "name", "addr"), "normalized") for n in ((1,), (2, 3)))
    return pairs.rerank(found, left, right).withColumnsRenamed({"q": "s1_id", "r": "ref_id"})


# ------------------------------------------------------------------ similarity
def _part_names(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of the fixed list of part names (64)."""
    names = read_table(spark, d, "part").select("p_name").distinct()
    return names.select(F.col("p_name").alias("a")).crossJoin(names.select(F.col("p_name").alias("b")))


def lcs_ratio(spark: SparkSession, d: str) -> DataFrame:
    s = score_pairs({"ratio": ("ratio", F.col("a"), F.col("b"))})
    return _part_names(spark, d).withColumn("s", s).select("a", "b", F.round("s.ratio", 6).alias("ratio"))


def token_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Token sort, token set and window scores of labelled pairs of names."""
    named = records(spark, d, 1, 2, 3).select("key", plain("name").alias("name"))
    links = truth(spark, d).select("q", F.explode("ids").alias("r"))
    rows = links.join(named.select(F.col("key").alias("q"), F.col("name").alias("a")), "q").join(named.select(F.col("key").alias("r"), F.col("name").alias("b")), "r")
    s = score_pairs({k: (k, F.col("a"), F.col("b")) for k in ("token_sort_ratio", "token_set_ratio", "partial_ratio")})
    return rows.withColumn("s", s).select("q", "r", *[F.round(f"s.{k}", 6).alias(k) for k in ("token_sort_ratio", "token_set_ratio", "partial_ratio")])


def length_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Length features of labelled pairs."""
    left = records(spark, d, 1).select(F.col("key").alias("q"), F.struct(F.col("name").alias("name_norm"), F.col("addr").alias("addr_norm")).alias("x"))
    right = records(spark, d, 2, 3).select(F.col("key").alias("r"), F.struct(F.col("name").alias("name_norm"), F.col("addr").alias("addr_norm"), "src").alias("y"))
    links = truth(spark, d).select("q", F.explode("ids").alias("r"))
    rows = pairs.length_features(links.join(left, "q").join(right, "r"))
    whole = ["ref_addr_empty", "s1_addr_empty", "ref_name_len", "s1_name_len", "src_is_s3"]
    return rows.select("q", "r", F.round("name_len_ratio", 6).alias("name_len_ratio"), F.round("addr_len_ratio", 6).alias("addr_len_ratio"), *[F.col(c).cast("bigint").alias(c) for c in whole])


# ------------------------------------------------------------------ pairs
def cos_context(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs.query_context(candidates(spark, d))
    return rows.select("q", "r", "cos_max", F.col("n_idx_hit").cast("bigint").alias("n_idx_hit"), F.col("cos_rank").cast("bigint").alias("cos_rank"), "cos_best", F.round("cos_margin", 6).alias("cos_margin"), "n_cands")


def ref_competition(spark: SparkSession, d: str) -> DataFrame:
    return pairs.reference_competition(candidates(spark, d)).select("q", "r", "ref_best_cos", F.round("ref_cos_margin", 6).alias("ref_cos_margin"), "ref_n_s1")


def pair_labels(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_labels(candidates(spark, d), _links(spark, d)).select("q", "r", F.col("label").cast("bigint").alias("label"))


def label_stats(spark: SparkSession, d: str) -> DataFrame:
    return pair_labels(spark, d).agg(F.sum("label").alias("n_links"), F.round(F.avg("label"), 6).alias("rate"), F.count(F.lit(1)).alias("n_pairs"))


def _indexed(spark: SparkSession, d: str, *sources: int) -> DataFrame:
    return T.normalize_records(records(spark, d, *sources), "name", "addr").withColumn("key", F.substring("key", 4, 9).cast("bigint"))


def _features(spark: SparkSession, d: str, only: DataFrame | None = None) -> DataFrame:
    left, right = (stage(_indexed(spark, d, *n), "normalized") for n in ((1,), (2, 3)))
    return pairs.pair_features(stage(candidates(spark, d), "candidates"), left, right, only)


def pair_features(spark: SparkSession, d: str) -> DataFrame:
    """The 30 features of every candidate pair."""
    return _features(spark, d)


# ------------------------------------------------------------------ decision
def _probable(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with the mean of their cosines in place of a probability."""
    return candidates(spark, d).select("q", "r", F.round((F.col("cos_blob") + F.col("cos_addr") + F.col("cos_name")) / 3, 4).alias("p"))


def decision_rule(spark: SparkSession, d: str) -> DataFrame:
    return pairs.decide(_probable(spark, d), "p", 0.5, 0.15)


def match_lists(spark: SparkSession, d: str) -> DataFrame:
    """For every record of source 1 its chosen references, the most probable first."""
    queries = records(spark, d, 1).select(F.substring("key", 4, 9).cast("bigint").alias("q"))
    lists = pairs.id_lists(decision_rule(spark, d), queries, [-F.col("p"), F.col("r")])
    return lists.select("q", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


def matched_entities(spark: SparkSession, d: str) -> DataFrame:
    return match_lists(spark, d).agg(F.count(F.lit(1)).alias("n_entities"), F.count_if(F.col("ids") != "").alias("n_matched"))


F_VALUES = [(2 / 3, 1.0), (1.0, 1.0), (0.0, 0.0), (0.5, 0.25), (0.0, 1.0)]


def f_beta(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(F_VALUES, "p double, r double").select(F.round("p", 6).alias("p"), "r", F.round(metrics.f_beta(F.col("p"), F.col("r")), 6).alias("f"))


def _lists_of_text(df: DataFrame) -> DataFrame:
    return df.groupBy("q").agg(F.collect_set(F.col("r").cast("string")).alias("ids"))


def macro_f05(spark: SparkSession, d: str) -> DataFrame:
    """Score of the decision rule over the labelled entities."""
    number = F.substring("q", 4, 9).cast("bigint")
    known = truth(spark, d).select(number.alias("q"), F.transform("ids", lambda x: F.substring(x, 4, 9).cast("bigint").cast("string")).alias("ids"))
    return metrics.macro_score(_lists_of_text(decision_rule(spark, d)), known).select(F.round("score", 6).alias("score"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return truth(spark, d).select(F.substring("q", 4, 9).cast("bigint").alias("q"))


def grid_sweep(spark: SparkSession, d: str) -> DataFrame:
    known = _entities(spark, d)
    return learning.sweep(_probable(spark, d).join(known, "q", "left_semi"), "p", _links(spark, d), known)


def best_rule(spark: SparkSession, d: str) -> DataFrame:
    return learning.best_rule(grid_sweep(spark, d))


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return learning.stratified_sample(records(spark, d, 1), "key", PART, 300).select("key", PART)


def holdout_split(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, 1).select("key", learning.is_holdout(F.col("key")).alias("is_holdout"))


def neg_downsample(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs.pair_labels(candidates(spark, d), _links(spark, d)).withColumn("is_holdout", learning.is_holdout(F.col("q")))
    return learning.downsample_negatives(rows).select("q", "r", F.col("label").cast("bigint").alias("label"), "is_holdout")


def gbdt_scores(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities of all labelled candidates from trees learned on the entities that aren't held out."""
    known = _entities(spark, d)
    rows = stage(pairs.pair_labels(_features(spark, d, known), _links(spark, d)).withColumn("is_holdout", learning.is_holdout(F.col("q"))), "features")
    model = learning.fit_classifier(learning.downsample_negatives(rows), pairs.FEATURES, rounds=20, least=20)
    return learning.score_pairs_with(model, rows, pairs.FEATURES)


# ------------------------------------------------------------------ validation
def _label_lines(spark: SparkSession, d: str) -> DataFrame:
    """The label table as the lines of a result file, with repeated entities as they stand."""
    rows = read_table(spark, d, "train_matches").select(F.concat(F.coalesce("source1_entity_id", F.lit("")), F.lit("\t"), F.coalesce("matched_entity_ids", F.lit(""))).alias("value"))
    return rows.withColumn("line_no", F.monotonically_increasing_id() + 2)


def validation_report(spark: SparkSession, d: str) -> DataFrame:
    """Violations of the label table as a result file that ought to hold every record of source 1."""
    required = records(spark, d, 1).select(F.col("key").alias("q"))
    valid = records(spark, d, 2, 3).select(F.col("key").alias("r"))
    return validation.report(validation.violations(_label_lines(spark, d), required, valid)).select("severity", "rule", "n", F.array_join("examples", ";").alias("examples"))


BAD_LINES = ["S1-1\tS2-1,S3-1", "no tab here", "", "S1-2\tS2-1,S2-1", "S1-2\t", "S1-3\tS1-1,S2-9", "S1-4\tX-1,S3-77", "S1-9\tS2-1"]


def validation_cases(spark: SparkSession, d: str) -> DataFrame:
    """One violation of each rule."""
    lines = spark.createDataFrame([(i + 2, x) for i, x in enumerate(BAD_LINES)], "line_no bigint, value string")
    required = spark.createDataFrame([(f"S1-{i}",) for i in (1, 2, 3, 4, 5)], "q string")
    valid = spark.createDataFrame([("S2-1",), ("S2-9",), ("S3-1",)], "r string")
    found = validation.violations(lines, required, valid)
    chosen = spark.createDataFrame([(2, "S1-1\tS2-1"), (3, "S1-2\tS2-5")], "line_no bigint, value string")
    return validation.report(found.unionByName(validation.not_among_candidates(lines, chosen))).select("severity", "rule", "n", F.array_join("examples", ";").alias("examples"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_records, country_counts, country_slugs, reference_union, truth_parse, result_rows, fold_text, canon_name, canon_addr, normalized_records, normalized_references, romanize, char_ngrams, doc_freq_idf, tfidf_weights, block_name, block_addr, block_all,
        blocking_recall, rerank_topk, lcs_ratio, token_ratios, length_ratios, cos_context, ref_competition, pair_labels, label_stats, pair_features, decision_rule, match_lists, matched_entities, f_beta, macro_f05, grid_sweep, best_rule, stratified_sample, holdout_split,
        neg_downsample, gbdt_scores, validation_report, validation_cases,
    )
}

# ------------------------------------------------------------------ SQL
_REC = "select distinct entity_id as key, coalesce(business_name, '') as name, coalesce(business_address, '') as addr, coalesce(country, '') as country, {n} as src from train_source{n}"
_S1 = f"s1 as ({_REC.format(n=1)})"
_REFS = f"refs as ({_REC.format(n=2)} union all {_REC.format(n=3)})"
_TRUTH = "truth as (select source1_entity_id as q, list_filter(string_split(coalesce(max(matched_entity_ids), ''), ','), lambda x: x <> '') as ids from train_matches where source1_entity_id is not null group by 1)"
_NUM = "cast(substr({c}, 4, 9) as bigint)"
_LINKS = f"links as (select distinct {_NUM.format(c='q')} as q, {_NUM.format(c='r')} as r from (select q, unnest(ids) as r from truth))"
_CAND = "cand as (select s1_idx as q, ref_idx as r, " + ", ".join(f"max(case when {c} is null or isnan({c}) then 0 else {c}::double end) as {c}" for c in pairs.COSINES) + " from train_cand group by all)"
_PROB = "prob as (select q, r, round((cos_blob + cos_addr + cos_name) / 3, 4) as p from cand)"
_DECIDED = "decided as (select q, r, p from (select *, max(p) over (partition by q) as best from prob) where p >= 0.5 and round(best - p, 8) <= 0.15)"


def _sql_fold(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(replace(strip_accents({c}), 'ß', 'ss')), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _sql_map(table: dict[str, str]) -> str:
    return "map {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _sql_canon(c: str, table: dict[str, str], drop_stop: bool) -> str:
    a = f"list_filter(string_split({_sql_fold(c)}, ' '), lambda x: x <> '')"
    if drop_stop:
        a = f"list_filter({a}, lambda x: x not in ({', '.join(repr(s) for s in STOP_TOKENS)}))"
    a = rf"list_filter({a}, lambda x: not regexp_full_match(x, '\d{{7,}}'))"
    a = rf"list_transform({a}, lambda x: regexp_replace(x, '^(\d+)(?:{'|'.join(ORDINAL_ENDS)})$', '\1'))"
    a = rf"flatten(list_transform({a}, lambda x: regexp_extract_all(x, '\d+|\D+')))"
    a = rf"list_transform({a}, lambda x: case when regexp_full_match(x, '\d+') then case when ltrim(x, '0') = '' then '0' else ltrim(x, '0') end else x end)"
    for t in (table, STATE_MAP):
        a = f"list_transform({a}, lambda x: coalesce({_sql_map(t)}[x], x))"
    return f"array_to_string({a}, ' ')"


def _sql_plain(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9_]+', ' ', 'g'))"


_FIELD_SQL = {"blob": f"{_sql_plain('name')} || ' ' || {_sql_plain('addr')}", "addr": _sql_plain("addr"), "name": _sql_plain("name")}


def _sql_terms(name: str, source: str, fields: list[str]) -> str:
    texts = " union all ".join(f"select country as part, '{f}' as field, key, {_FIELD_SQL[f]} as t from {source}" for f in fields)
    words = f"select part, field, key, ' ' || w || ' ' as w from (select part, field, key, unnest(string_split(t, ' ')) as w from ({texts})) where w <> ''"
    grams = "case when length(w) < 4 then [w] else list_concat(list_transform(range(1, length(w) - 2), lambda i: substr(w, i, 4)), list_transform(range(1, length(w) - 3), lambda i: substr(w, i, 5))) end"
    return f"{name} as (select part, field, key, gram, count(*)::bigint as tf from (select part, field, key, unnest({grams}) as gram from ({words})) group by all)"


def _sql_index(fields: list[str]) -> str:
    return ", ".join(
        [
            _REFS,
            _sql_terms("rt", "refs", fields),
            "sizes as (select country as part, count(*)::bigint as n from refs group by 1)",
            f"freq as (select part, field, gram, df, n, ln((1.0 + n) / (1.0 + df)) + 1.0 as idf, df > {retrieval.MAX_DF}::double * n as pruned from (select part, field, gram, count(*)::bigint as df from rt group by all) join sizes using (part))",
            "rraw as (select part, field, key, gram, ln(1.0 + tf) * idf as raw from rt join freq using (part, field, gram) where not pruned)",
            "rw as (select part, field, key, gram, raw / sqrt(sum(raw * raw) over (partition by part, field, key)) as w from rraw)",
        ]
    )


def _sql_block(fields: list[str]) -> str:
    limit = "case field " + " ".join(f"when '{f}' then {KEEP[f]}" for f in fields) + " end"
    return ", ".join(
        [
            _S1,
            _sql_index(fields),
            _sql_terms("qt", "s1", fields),
            "qraw as (select part, field, key, gram, ln(1.0 + tf) * coalesce(idf, ln(1.0 + s.n) + 1.0) as raw from qt left join freq f using (part, field, gram) join sizes s using (part) where coalesce(not pruned, true))",
            "qw as (select part, field, key, gram, raw / sqrt(sum(raw * raw) over (partition by part, field, key)) as w from qraw)",
            "hits as (select field, q.key as q, r.key as r, round(sum(q.w * r.w), 6) as cos from qw q join rw r using (part, field, gram) group by all)",
            f"best as (select * from (select *, row_number() over (partition by field, q order by cos desc, r) as k from hits) where k <= {limit})",
            "found as (select q, r, " + ", ".join(f"coalesce(max(case when field = '{f}' then cos end), 0.0) as cos_{f}" for f in fields) + " from best group by q, r)",
        ]
    )


_LCS = """list_reduce(list_concat([list_transform(range(0, length(b) + 1), lambda j: 0::bigint)], list_transform(string_split(a, ''), lambda c: [unicode(c)::bigint])),
    lambda row, c: list_reduce(list_concat([[0::bigint]], list_transform(range(1, length(b) + 1), lambda j: [row[j + 1], row[j] + (unicode(substr(b, j, 1)) = c[1])::bigint])), lambda acc, e: list_append(acc, greatest(acc[len(acc)], e[1], e[2]))))[-1]"""
_UNIFORM = "(('0x' || left(md5({key} || ':{seed}'), 8))::bigint / 4294967296.0)"
_GRID = "grid as (select t.thr, m.margin from (select unnest([" + ", ".join(map(str, learning.THRESHOLDS)) + "])::double as thr) t cross join (select unnest([" + ", ".join(map(str, learning.MARGINS)) + "])::double as margin) m)"
_FBETA = "case when {p} <= 0 and {r} <= 0 then 0.0 else 1.25 * {p} * {r} / (0.25 * {p} + {r}) end"
_SCORE = f"case when n_pred = 0 and n_true = 0 then 1.0 when n_pred = 0 or n_true = 0 or n_hit = 0 then 0.0 else {_FBETA.format(p='(n_hit::double / n_pred)', r='(n_hit::double / n_true)')} end"
_SWEEP = f"""with {_TRUTH}, {_LINKS}, {_CAND}, {_PROB}, {_GRID},
    ents as (select distinct {_NUM.format(c='q')} as q from truth),
    mine as (select prob.*, max(p) over (partition by q) as best from prob where q in (select q from ents)),
    per as (select thr, margin, m.q, count(*) as n_pred, count(l.r) as n_hit from mine m join grid on m.p >= thr and round(best - p, 8) <= margin left join links l on l.q = m.q and l.r = m.r group by all),
    truths as (select q, count(links.r) as n_true from ents left join links using (q) group by q),
    every as (select g.thr, g.margin, t.q, n_true, coalesce(n_pred, 0) as n_pred, coalesce(n_hit, 0) as n_hit from truths t cross join grid g left join per on per.thr = g.thr and per.margin = g.margin and per.q = t.q)
    select thr, margin, round(avg({_SCORE}), 6) as score from every group by thr, margin"""
_RULES = """rows as (select line_no, trim(string_split(value, chr(9))[1]) as q, list_filter(string_split(coalesce(string_split(value, chr(9))[2], ''), ','), lambda x: x <> '') as ids from lines where contains(value, chr(9))),
    ids as (select q, unnest(ids) as r from rows),
    found as (
      select 'error' as severity, 'malformed_row' as rule, 'line ' || line_no as example from lines where not contains(value, chr(9)) and trim(value) <> ''
      union all select 'error', 'duplicate_entity', q from rows group by q having count(*) > 1
      union all select 'error', 'duplicate_in_list', q from rows where len(ids) <> len(list_distinct(ids))
      union all select 'error', 'entity_in_list', q || ' ' || r from ids where r like 'S1-%'
      union all select 'error', 'bad_prefix', q || ' ' || r from ids where r not like 'S1-%' and r not like 'S2-%' and r not like 'S3-%'
      union all select 'error', 'unknown_id', q || ' ' || r from ids where (r like 'S2-%' or r like 'S3-%') and r not in (select r from valid)
      union all select 'error', 'missing_entity', q from (select distinct q from required) where q not in (select q from rows)
      union all select 'error', 'extra_entity', q from (select distinct q from rows) where q not in (select q from required)
      {more})
    select severity, rule, count(*)::bigint as n, array_to_string(list_sort(list_distinct(list(example)))[1:5], ';') as examples from found group by severity, rule"""

ORACLES = {
    "scan_records": "select entity_id, business_name from train_source1 where country in ('US', 'India')",
    "country_counts": f"with {_S1}, {_REFS} select country, count(*)::bigint as n_rows from (select * from s1 union all select * from refs) group by country",
    "country_slugs": f"with {_S1}, {_REFS} select distinct country, case when country = '' then 'unknown' else regexp_replace(country, '[^\\p{{L}}\\p{{N}}]', '_', 'g') end as slug from (select * from s1 union all select * from refs)",
    "reference_union": f"with {_REFS} select src, count(*)::bigint as n_rows, count(distinct key)::bigint as n_keys from refs group by src",
    "truth_parse": f"with {_TRUTH} select q as source1_entity_id, len(ids)::bigint as n_ids, array_to_string(ids, ';') as ids from truth",
    "result_rows": f"with {_S1}, {_TRUTH} select s1.key || chr(9) || coalesce(array_to_string(ids, ','), '') as value from s1 left join truth on truth.q = s1.key",
    "fold_text": rf"with {_S1} select key, {_sql_fold('name')} as folded, regexp_full_match(name, '[\x00-\x7F]*') as ascii from s1",
    "canon_name": f"with {_S1} select key, {_sql_canon('name', LEGAL_SUFFIX, False)} as name_norm from s1",
    "canon_addr": f"with {_S1} select key, {_sql_canon('addr', STREET_ABBR, True)} as addr_norm from s1",
    "normalized_records": rf"""with {_S1}, n as (select key, {_sql_canon('name', LEGAL_SUFFIX, False)} as name_norm, {_sql_canon('addr', STREET_ABBR, True)} as addr_norm from s1)
        select key, name_norm, addr_norm, regexp_replace(name_norm, '[aeiou ]', '', 'g') as skel,
               array_to_string(list_sort(list_distinct(list_filter(string_split(addr_norm, ' '), lambda x: regexp_full_match(x, '\d+')))), ' ') as digits, length(name_norm || ' ' || addr_norm)::bigint as blob_len from n""",
    "romanize": "select * from (values " + ", ".join(f"('{k}', '{v.lower()}')" for k, v in ROMANIZED.items()) + ") t(native, roman)",
    "char_ngrams": f"with {_S1}, {_sql_terms('qt', 's1', ['name'])} select gram, sum(tf)::bigint as tf, count(*)::bigint as df from qt group by gram",
    "doc_freq_idf": f"with {_sql_index(['blob', 'addr', 'name'])} select part, field, gram, df, round(idf, 6) as idf, pruned from freq",
    "tfidf_weights": f"with {_sql_index(['name'])} select part, key, gram, round(w, 6) as w from rw",
    "block_name": f"with {_sql_block(['name'])} select q as s1_id, r as ref_id, cos_name from found",
    "block_addr": f"with {_sql_block(['addr'])} select q as s1_id, r as ref_id, cos_addr from found",
    "block_all": f"with {_sql_block(['blob', 'addr', 'name'])} select q as s1_id, r as ref_id, cos_blob, cos_addr, cos_name from found",
    "blocking_recall": f"""with {_sql_block(['blob', 'addr', 'name'])}, {_TRUTH},
        known as (select t.q, s1.country as part, list_distinct(ids) as ids from truth t join s1 on s1.key = t.q),
        l as (select q, unnest(ids) as r from known), h as (select q, count(*) as hits from l join found using (q, r) group by q),
        per as (select part, len(ids) as links, coalesce(hits, 0) as hits from known left join h using (q)),
        f as (select part, count(*) as entities, count(*) filter (hits = links) as "full", count(*) filter (links = 0) as singles, sum(links) as links, sum(hits) as hits from per group by part),
        p as (select s1.country as part, count(*) as pairs from found join s1 on s1.key = found.q group by 1),
        t as (select nq.part, n_queries, coalesce(n_refs, 0) as n_refs, coalesce(entities, 0) as entities, coalesce("full", 0) as "full", coalesce(singles, 0) as singles, coalesce(links, 0) as links, coalesce(hits, 0) as hits, coalesce(pairs, 0) as pairs,
                     n_queries * coalesce(n_refs, 0) as all_pairs
              from (select country as part, count(*) as n_queries from s1 group by 1) nq left join (select country as part, count(*) as n_refs from refs group by 1) using (part) left join f using (part) left join p using (part)),
        s as (select part, sum(n_queries)::bigint as n_queries, sum(n_refs)::bigint as n_refs, sum(entities)::bigint as entities, sum("full")::bigint as "full", sum(singles)::bigint as singles, sum(links)::bigint as links, sum(hits)::bigint as hits, sum(pairs)::bigint as pairs,
                     sum(all_pairs)::bigint as all_pairs from t group by rollup (part))
        select *, case when links > 0 then round(hits / links, 6) end as pair_recall, case when entities > 0 then round("full" / entities, 6) end as entity_recall, case when all_pairs > 0 then round(1 - pairs / all_pairs, 6) end as reduction,
               case when n_queries > 0 then round(pairs / n_queries, 6) end as per_query from s""",
    "lcs_ratio": f"with n as (select distinct p_name from part), t as (select x.p_name as a, y.p_name as b from n x cross join n y) select a, b, round(case when length(a) + length(b) = 0 then 100.0 else 200.0 * ({_LCS}) / (length(a) + length(b)) end, 6) as ratio from t",
    "length_ratios": f"""with {_S1}, {_REFS}, {_TRUTH}, l as (select q, unnest(ids) as r from truth),
        n as (select q, l.r, length(s1.name) as xn, length(refs.name) as yn, length(s1.addr) as xa, length(refs.addr) as ya, refs.src from l join s1 on s1.key = l.q join refs on refs.key = l.r)
        select q, r, round(case when greatest(xn, yn) > 0 then least(xn, yn) / greatest(xn, yn) else 0.0 end, 6) as name_len_ratio, round(case when greatest(xa, ya) > 0 then least(xa, ya) / greatest(xa, ya) else 0.0 end, 6) as addr_len_ratio,
               (ya = 0)::bigint as ref_addr_empty, (xa = 0)::bigint as s1_addr_empty, yn::bigint as ref_name_len, xn::bigint as s1_name_len, (src = 3)::bigint as src_is_s3 from n""",
    "cos_context": f"""with {_CAND}, c as (select *, greatest(cos_blob, cos_addr, cos_name) as cos_max from cand)
        select q, r, cos_max, ((cos_blob > 0)::int + (cos_addr > 0)::int + (cos_name > 0)::int)::bigint as n_idx_hit, (row_number() over (partition by q order by cos_max desc, r) - 1)::bigint as cos_rank, max(cos_max) over (partition by q) as cos_best,
               round(cos_max - max(cos_max) over (partition by q), 6) as cos_margin, count(*) over (partition by q) as n_cands from c""",
    "ref_competition": f"""with {_CAND}, c as (select *, greatest(cos_blob, cos_addr, cos_name) as cos_max from cand)
        select q, r, max(cos_max) over (partition by r) as ref_best_cos, round(cos_max - max(cos_max) over (partition by r), 6) as ref_cos_margin, count(*) over (partition by r) as ref_n_s1 from c""",
    "pair_labels": f"with {_TRUTH}, {_LINKS}, {_CAND} select c.q, c.r, (l.q is not null)::bigint as label from cand c left join links l on l.q = c.q and l.r = c.r",
    "label_stats": f"with {_TRUTH}, {_LINKS}, {_CAND} select count(l.q)::bigint as n_links, round(count(l.q) / count(*), 6) as rate, count(*)::bigint as n_pairs from cand c left join links l on l.q = c.q and l.r = c.r",
    "decision_rule": f"with {_CAND}, {_PROB}, {_DECIDED} select * from decided",
    "match_lists": f"with {_S1}, {_CAND}, {_PROB}, {_DECIDED}, e as (select distinct {_NUM.format(c='key')} as q from s1) select e.q, coalesce(string_agg(r::varchar, ',' order by p desc, r), '') as ids from e left join decided using (q) group by e.q",
    "matched_entities": f"with {_S1}, {_CAND}, {_PROB}, {_DECIDED}, e as (select distinct {_NUM.format(c='key')} as q from s1) select count(*)::bigint as n_entities, count(*) filter (q in (select q from decided))::bigint as n_matched from e",
    "f_beta": "select round(p, 6) as p, r, round(" + _FBETA.format(p="p", r="r") + ", 6) as f from (values " + ", ".join(f"({p}::double, {r}::double)" for p, r in F_VALUES) + ") t(p, r)",
    "macro_f05": f"""with {_TRUTH}, {_LINKS}, {_CAND}, {_PROB}, {_DECIDED}, ents as (select distinct {_NUM.format(c='q')} as q from truth),
        t as (select q, count(links.r) as n_true from ents left join links using (q) group by q), p as (select d.q, count(*) as n_pred, count(l.r) as n_hit from decided d left join links l on l.q = d.q and l.r = d.r group by d.q),
        e as (select n_true, coalesce(n_pred, 0) as n_pred, coalesce(n_hit, 0) as n_hit from t left join p using (q)) select round(avg({_SCORE}), 6) as score from e""",
    "grid_sweep": _SWEEP,
    "best_rule": f"select * from ({_SWEEP}) order by score desc, thr, margin desc limit 1",
    "stratified_sample": f"""with {_S1}, n as (select country, count(*) as n, sum(count(*)) over () as total from s1 group by country),
        k as (select key, s1.country, row_number() over (partition by s1.country order by md5(key || ':42'), key) as k, least(n, greatest(1, round(300 * n / total)::bigint)) as quota from s1 join n on n.country = s1.country) select key, country from k where k <= quota""",
    "holdout_split": f"with {_S1} select key, {_UNIFORM.format(key='key', seed=42)} < 0.2 as is_holdout from s1",
    "neg_downsample": f"""with {_TRUTH}, {_LINKS}, {_CAND}, x as (select c.q, c.r, (l.q is not null)::bigint as label, {_UNIFORM.format(key='c.q::varchar', seed=42)} < 0.2 as is_holdout from cand c left join links l on l.q = c.q and l.r = c.r)
        select * from x where is_holdout or label = 1 or {_UNIFORM.format(key="(q || '|' || r)", seed=7)} < 0.25""",
    "validation_report": f"""with {_S1}, {_REFS}, lines as (select row_number() over () + 1 as line_no, coalesce(source1_entity_id, '') || chr(9) || coalesce(matched_entity_ids, '') as value from train_matches),
        required as (select key as q from s1), valid as (select key as r from refs), {_RULES.format(more='')}""",
    "validation_cases": "with lines as (select * from (values " + ", ".join(f"({i + 2}::bigint, '{x}')" for i, x in enumerate(BAD_LINES)) + ") t(line_no, value)), required as (select * from (values ('S1-1'), ('S1-2'), ('S1-3'), ('S1-4'), ('S1-5')) t(q)), valid as (select * from (values ('S2-1'), ('S2-9'), ('S3-1')) t(r)), chosen as (select * from (values ('S1-1', 'S2-1'), ('S1-2', 'S2-5')) t(q, r)), "
    + _RULES.format(more="union all select distinct 'warning', 'match_not_candidate', i.q from (select q, unnest(ids) as r from (select *, row_number() over (partition by q order by line_no desc) as k from rows) where k = 1) i where not exists (select 1 from chosen c where c.q = i.q and c.r = i.r)"),
}
