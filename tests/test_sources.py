from pyspark.sql import functions as F

from lodestone import pipeline
from lodestone.operators import validation
from lodestone.sources import tables
from lodestone.sources.delimited import LineRules, diagnose, parse_block, parse_lines, split_strict


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_tsv_scan_with_quotes_short_rows_and_blank_lines(spark, tmp_path):
    _write(tmp_path / "a.tsv", 'entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b""\nc"\tx\tUS\n\nS1-2\tonly\n')
    rows = sorted(tuple(r) for r in tables.scan_tsv(spark, str(tmp_path / "a.tsv"), tables.RECORD_FIELDS).collect())
    assert rows == [("S1-1", 'a "b"\nc', "x", "US"), ("S1-2", "only", "", "")]
    assert [r["id"] for r in tables.scan_ids(spark, str(tmp_path / "a.tsv")).orderBy("id").collect()][:1] != []


def test_partitions_results_and_rule(spark, tmp_path):
    df = spark.createDataFrame([("a", "x y"), ("b", "x y"), ("c", "z")], "id string, country string")
    tables.write_partitioned(df, str(tmp_path / "t"), ["country"])
    assert tables.read_partition(spark, str(tmp_path / "t"), "id string, country string", ["id"], country="x y").count() == 2
    assert tables.read_partition(spark, str(tmp_path / "none"), "id string, country string").count() == 0
    lists = spark.createDataFrame([(2, "S1-00003", []), (1, "S1-00001", ["S2-00047", "S3-00812"])], "o int, q string, ids array<string>")
    tables.write_result(lists, str(tmp_path / "r"), "o", "q", "ids", ["source1_entity_id", "matched_entity_ids"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("part-*")))
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-00001\tS2-00047,S3-00812\nS1-00003\t\n"
    tables.write_rule(spark, str(tmp_path / "rule"), 0.5, 0.15, 0.9, ["f"], rounds=3)
    assert tables.read_rule(spark, str(tmp_path / "rule"))["run"] == {"rounds": 3}


def test_truth_keeps_the_last_row_and_empty_lists(spark):
    rows = spark.createDataFrame([("a", "x,,y", 1), ("a", "z", 2), ("b", None, 1), (None, "q", 1)], "source1_entity_id string, matched_entity_ids string, n int")
    got = {r["q"]: r["ids"] for r in tables.parse_truth(rows, order=F.col("n")).collect()}
    assert got == {"a": ["z"], "b": []}


def test_file_problems(spark, tmp_path):
    cases = {"comma": "source1_entity_id,matched_entity_ids\n", "no_tab": "x\n", "other": "a\tb\n", "empty": ""}
    want = {"comma": "header_is_comma_separated", "no_tab": "header_has_no_tab", "other": "wrong_header: ['a', 'b']", "empty": "file_empty"}
    for name, text in cases.items():
        _write(tmp_path / name, text)
        assert validation.file_problem(spark, str(tmp_path / name), validation.HEADERS["matching"]) == want[name]
    assert validation.file_problem(spark, str(tmp_path / "absent"), []) == "file_missing"


def test_pipeline_end_to_end(spark, tmp_path):
    names = ["acme tools", "north bakery", "blue harbour shipping", "quiet garden hotel", "silver mining works", "green valley farms", "old town printing", "rapid river rafting"]
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for split in ("train", "test"):
        for n in (1, 2, 3):
            lines = "".join(f"S{n}-{i}\t{x.title()}{' Ltd' if n > 1 else ' Limited'}\t{i} Main Street\tUS\n" for i, x in enumerate(names * 4))
            _write(tmp_path / f"data/{split}/{split}_source{n}.tsv", head + lines)
    _write(tmp_path / "data/train/train_ground_truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(32)))
    data, work, out = (str(tmp_path / x) for x in ("data", "work", "out"))
    assert tables.missing_inputs(spark, data) == []
    for split in ("train", "test"):
        pipeline.prepare(spark, data, work, split)
        pipeline.block(spark, work, split, max_df=0.6, keep=10)
        pipeline.features(spark, data, work, split)
    total = pipeline.evaluate(spark, data, work).where("part is null").first()
    assert total["links"] == 64 and total["pair_recall"] > 0.9
    pipeline.train(spark, data, work, holdout=0.3, rounds=5)
    pipeline.predict(spark, data, work, out)
    passed, findings = pipeline.validate(spark, data, out, check_ids=True)
    assert passed, findings


RULES = LineRules(4, "S1-[0-9]{9}", 0)
GOOD = "S1-000000001\tname\taddress\tUS"


def test_strict_split():
    assert split_strict('"a\tb"\t"c""d"\te"f\t') == ["a\tb", 'c"d', 'e"f', ""]
    assert split_strict('"a') is None and split_strict('"a"b') is None and split_strict("") == [""]


def test_blocks_agree_with_the_strict_reader():
    import random

    import pyarrow as pa

    rng = random.Random(3)
    parts = ["S1-000000001", "S1-1", '"q""x"', '"open', 'in"side', "", "US", '"a\tb"', "x\ny", "\r"]
    lines = [None, "", "\r", GOOD, GOOD + "\r", GOOD + "\r\r"] + ["\t".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 4, 4, 4, 5]))) for _ in range(400)] + [GOOD] * 300
    rng.shuffle(lines)
    reasons, fields = parse_block(pa.array(lines, pa.string()), RULES)
    for i, line in enumerate(lines):
        reason, values = diagnose(line, RULES)
        assert reasons[i].as_py() == reason, line
        assert [f[i].as_py() for f in fields] == (values or [None] * 4), line


def test_lines_with_reasons(spark):
    rows = [(1, "f1", GOOD), (2, "f1", GOOD.replace("US", "XX")), (3, "f1", "S1-1\ta\tb\tUS"), (4, "f1", "a\tb"), (5, "f1", '"a\tb\tc\td'), (6, "f1", None), (7, None, GOOD), (8, "other", GOOD), (1, "f1", GOOD)]
    df = spark.createDataFrame(rows, "line_id long, feed string, line string")
    labels = spark.createDataFrame([("US",), (None,), ("US",)], "country string")
    args = ("line", "feed", {"f1": "S1-[0-9]{9}"}, ["entity_id", "name", "addr", "country"], "entity_id", "country", labels)
    got = sorted((r["line_id"], r["reason"]) for r in parse_lines(df, *args).collect() if r["reason"])
    assert got == [(2, "country"), (3, "entity_id"), (4, "column_count"), (5, "quoting"), (6, "column_count"), (7, "entity_id"), (8, "entity_id")]
    assert parse_lines(df, *args).where("reason is null").count() == 2
    assert parse_lines(df.limit(0), *args).count() == 0
