"""Rules that result lists must keep, each a query over the lines of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions.text import has_prefix, header_names, split_ids
from lodestone.sources.tables import numbered_lines, path_exists

EXAMPLES = 5
HEADERS = {"matching": ["source1_entity_id", "matched_entity_ids"], "candidates": ["source1_entity_id", "candidate_entity_ids"]}


def list_rows(lines: DataFrame) -> DataFrame:
    """(line_no, q, ids) of the lines (line_no, value) that have a tab; ids inside lists aren't trimmed."""
    fields = F.split("value", "\t")
    return lines.where(F.instr("value", "\t") > 0).select("line_no", F.trim(F.get(fields, F.lit(0))).alias("q"), split_ids(F.get(fields, F.lit(1))).alias("ids"))


def malformed(lines: DataFrame) -> DataFrame:
    """Lines that have no tab and aren't blank."""
    return lines.where((F.instr("value", "\t") == 0) & (F.trim("value") != ""))


def _named(df: DataFrame, rule: str, severity: str, example: Column) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), example.cast("string").alias("example"))


def violations(lines: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(severity, rule, example) of every violation in the lines after the header.

    required: (q), the entities that must stand in the file once. valid: (r), the
    ids that exist; without it unknown ids aren't looked for.
    """
    rows = list_rows(lines)
    ids = rows.select("q", F.explode("ids").alias("r"))
    own, foreign = has_prefix(F.col("r"), "S1-"), has_prefix(F.col("r"), "S2-", "S3-")
    found = [
        _named(malformed(lines), "malformed_row", "error", F.format_string("line %d", "line_no")),
        _named(rows.groupBy("q").count().where(F.col("count") > 1), "duplicate_entity", "error", F.col("q")),
        _named(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), "duplicate_in_list", "error", F.col("q")),
        _named(ids.where(own), "entity_in_list", "error", F.concat_ws(" ", "q", "r")),
        _named(ids.where(~own & ~foreign), "bad_prefix", "error", F.concat_ws(" ", "q", "r")),
        _named(required.select("q").distinct().join(rows, "q", "left_anti"), "missing_entity", "error", F.col("q")),
        _named(rows.select("q").distinct().join(required, "q", "left_anti"), "extra_entity", "error", F.col("q")),
    ]
    if valid is not None:
        found.append(_named(ids.where(foreign).join(valid.select("r").distinct(), "r", "left_anti"), "unknown_id", "error", F.concat_ws(" ", "q", "r")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def not_among_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Violations (warnings) of entities with a match that isn't one of their candidates; of a repeated entity the last line counts."""
    ids = _last(matching).select("q", F.explode("ids").alias("r")).distinct()
    known = _last(candidates).select("q", F.explode("ids").alias("r")).distinct()
    return _named(ids.join(known, ["q", "r"], "left_anti").select("q").distinct(), "match_not_candidate", "warning", F.col("q"))


def _last(lines: DataFrame) -> DataFrame:
    rows = list_rows(lines)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("line_no")))).where(F.col("_n") == 1)


def report(found: DataFrame) -> DataFrame:
    """(severity, rule, n, examples): per rule the number of violations and the first examples in order.

    The examples are taken by a rank inside the rule, so no list of all of them is built.
    """
    first = Window.partitionBy("severity", "rule").orderBy("example")
    few = found.distinct().withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= EXAMPLES).groupBy("severity", "rule").agg(F.array_sort(F.collect_list("example")).alias("examples"))
    return found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n")).join(few, ["severity", "rule"])


def file_problem(spark: SparkSession, path: str, header: list[str]) -> str | None:
    """Why a file can't be a result list at all: missing, empty, unreadable, no tab in its header, or another header."""
    if not path_exists(spark, path):
        return "file_missing"
    try:
        head = spark.read.text(path).head()
    except Exception as e:  # noqa: BLE001 - any read error is the finding
        return f"unreadable: {type(e).__name__}"
    if head is None:
        return "file_empty"
    if "�" in head[0]:
        return "not_utf8"
    if "\t" not in head[0]:
        return "header_is_comma_separated" if "," in head[0] else "header_has_no_tab"
    names = spark.range(1).select(header_names(F.lit(head[0])).alias("h")).first()["h"]
    return None if names == header else f"wrong_header: {names}"


def validate(spark: SparkSession, matching: str, required: DataFrame, candidates: str | None = None, valid: DataFrame | None = None) -> tuple[bool, list[dict]]:
    """(whether the files have no error, the findings), for result files given by their paths."""
    findings: list[dict] = []
    lines: dict[str, DataFrame] = {}
    for kind, path in (("matching", matching), ("candidates", candidates)):
        if path is None or kind == "candidates" and not path_exists(spark, path):
            findings.append({"file": kind, "severity": "warning", "rule": "no_candidate_file", "n": 1, "examples": []})
            continue
        if problem := file_problem(spark, path, HEADERS[kind]):
            findings.append({"file": kind, "severity": "error", "rule": problem, "n": 1, "examples": []})
            continue
        lines[kind] = numbered_lines(spark, path).where(F.col("line_no") > 1)
        findings += [{"file": kind, **r.asDict()} for r in report(violations(lines[kind], required, valid)).collect()]
    if valid is None:
        findings.append({"file": "all", "severity": "warning", "rule": "ids_not_checked", "n": 1, "examples": []})
    if len(lines) == 2:
        findings += [{"file": "matching", **r.asDict()} for r in report(not_among_candidates(lines["matching"], lines["candidates"])).collect()]
    return not any(f["severity"] == "error" for f in findings), findings
