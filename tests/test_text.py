import pytest

from lodestone.functions import text as T
from pyspark.sql import functions as F


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("native, roman", [("कर्नाटक", "krnatk"), ("प्राइवेट", "praivet"), ("एलएलपी", "elelpi"), ("straße", "strasse"), ("", "")])
def test_romanize(native, roman):
    assert T.romanize_text(native) == roman


@pytest.mark.parametrize("value, folded", [("Énterprises", "enterprises"), ("A & B", "a b"), ("a_b-c", "a_b c"), ("  x \t y ", "x y"), (None, ""), ("ＡＢ", "ab")])
def test_fold(spark, value, folded):
    assert one(spark, value, T.fold) == folded


@pytest.mark.parametrize(
    "value, canon",
    [("Af-684", "af 684"), ("AF-0684", "af 684"), ("FREMONT SAINT", "fremont st"), ("Fremont Street", "fremont st"), ("null 12th Road near 5551234567", "12 rd"), ("no5 000", "no 5 0"), ("", ""), (None, "")],
)
def test_canon_address(spark, value, canon):
    assert one(spark, value, lambda c: T.canon_address(T.fold(c))) == canon


@pytest.mark.parametrize("value, canon", [("Acme Pvt Ltd", "acme pvt ltd"), ("Acme Private Limited", "acme pvt ltd"), ("A & B", "a b"), ("A and B", "a & b")])
def test_canon_name(spark, value, canon):
    assert one(spark, value, lambda c: T.canon_name(T.fold(c))) == canon


def test_skeleton_digits_and_grams(spark):
    assert one(spark, "karnataka", T.skeleton) == one(spark, "krnatk", T.skeleton) == "krntk"
    assert one(spark, "9 rd 10 rd 9", T.digit_set) == "10 9"
    assert one(spark, "a ab abc", T.char_grams) == [" a ", " ab ", " abc", "abc ", " abc "]
    assert one(spark, None, T.char_grams) == []
    assert one(spark, "a,,b", T.split_ids) == ["a", "b"] and one(spark, None, T.split_ids) == []
    assert one(spark, " A\tb ", T.header_names) == ["a", "b"]


def test_very_long_text(spark):
    assert one(spark, "Street " * 30_000, lambda c: T.canon_address(T.fold(c))) == " ".join(["st"] * 30_000)


def test_records_of_an_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "name string, addr string, skel string, _x int")
    out = T.normalize_records(df, "name", "addr")
    assert out.count() == 0 and set(out.columns) == {"name", "addr", "skel", "_x", "name_norm", "addr_norm", "digits"}
