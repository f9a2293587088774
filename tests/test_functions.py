import pytest
from pyspark.sql import functions as F

from filingloom import functions as fn

SCALARS = [
    (None, "20230830", None, "null"), ("-", None, None, "empty"), (" 해당없음 ", "20230830", None, "empty"), ("", None, None, "empty"), ("2023년 08월 30일", "20230830", "2023-08-30", "date"),
    ("20230830", None, "2023-08-30", "date"), ("20239999", None, "2023-99-99", "date"), ("1,234,567", None, "1234567", "number"), ("-63,993", None, "-63993", "number"), ("46.85", None, "46.85", "number"),
    ("123", None, "123", "number"), ("1234", None, "1234", "text"), ("1234567", None, "1234567", "text"), ("18991231", None, "18991231", "text"), (" a ", "2023", "a", "text"),
]


def test_normalize_scalar(spark):
    df = spark.createDataFrame([(i, t, u) for i, (t, u, _, _) in enumerate(SCALARS)], "i int, t string, u string")
    got = df.select("i", fn.normalize_scalar(F.col("t"), F.col("u")).alias("n")).orderBy("i").collect()
    assert [(r.n.value, r.n.value_type) for r in got] == [(v, k) for _, _, v, k in SCALARS]
    assert got[6].n.value_date is None and got[7].n.value_num == 1234567.0


@pytest.mark.parametrize(
    ("make", "text", "want"),
    [
        (fn.clean_text, "\xa0 a　\n b\x1f ", "a b"), (fn.clean_text, None, ""), (fn.clean_cell, " a\xa0\t b\n \n\nc ", "a b\nc"), (fn.sanitize_markup, "a&b &amp; &#65; &nbsp;\x01", "a&amp;b &amp; &#65; &amp;nbsp;"),
        (lambda c: fn.escape_cell(c, "periodic"), " a|b\nc ", "a\\|b c"), (lambda c: fn.escape_cell(c, "periodic"), " ", " "), (lambda c: fn.escape_cell(c, "pipeline"), "a|b\nc", "a\\|b<br>c"),
    ],
)
def test_text_functions(spark, make, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(make(F.col("t")).alias("x")).first().x == want


def test_titles_headers_rows_and_codes(spark):
    rows = [(" A co / Report / x ", "1. Name"), ("no slash", "12.5%"), ("/only/", "1. a: b"), ("a/", "9) " + "x" * 80)]
    got = spark.createDataFrame(rows, "t string, h string").select(fn.split_title(F.col("t")).alias("s"), fn.section_header(F.col("h")).alias("h")).collect()
    assert [(r.s.company_name, r.s.report_name, r.h) for r in got] == [("A co", "Report", True), ("", "no slash", True), ("", "/only/", False), ("", "a/", False)]
    cells = [(["- v"],), (["- k", "v"],), (["a", "b", "c"],), ([],)]
    assert [r.x for r in spark.createDataFrame(cells, "c array<string>").select(fn.format_row(F.col("c")).alias("x")).collect()] == ["- v", "- k: v", "a | b | c", None]
    codes = spark.createDataFrame([("12. x", 3), ("x", 3)], "s string, i int").select(fn.section_code(F.col("s"), F.col("i")).alias("x"))
    assert [r.x for r in codes.collect()] == ["12", "3"]


def test_sentences_ids_and_context(spark):
    d = spark.createDataFrame([("a. b! c\nd다 e", "p > q", "10")], "t string, p string, n string")
    r = d.select(fn.split_sentences(F.col("t"), "markdown").alias("m"), fn.split_sentences(F.col("t"), "periodic").alias("p"), fn.embedding_text(F.col("p"), F.col("t")).alias("e"), fn.numbered_id(F.col("n"), F.lit(7)).alias("i")).first()
    assert r.m == ["a.", "b!", "c", "d다", "e"] and r.p == ["a.", "b!", "c\nd다", "e"] and r.e.startswith("[p > q]\na.") and r.i == "10_0007"
