"""The pipeline's stages, each on its own input."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from filingloom.llm.common import cut, table
from filingloom.llm.mixing import mix
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_good_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = cut(stage(spark, docs, SF))
        seen[name] = (docs, out)
        if name != "token_ids":
            assert out.columns == docs.columns
        docs = out
    before, after = seen["quality"]
    good = labels.where("quality = 1")
    assert after.join(good, "doc_id").count() >= 0.95 * before.join(good, "doc_id").count()
    before, after = seen["near_duplicates"]
    want = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80, 100)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, (_, root) in want.items() if root == d)
    assert after.select("text").distinct().count() == after.count() and after.exceptAll(before).count() == 0
    before, after = seen["secrets"]
    assert before.count() == after.count() and not after.where(F.col("text").rlike("AKIA[A-Z0-9]{16}")).count()
    before, after = seen["mixture"]
    copies = {r.doc_id: r.copies for r in mix(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: n for d, n in copies.items() if n})
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3 and after.select("doc_id").subtract(before.select("doc_id")).count() == 0
    before, after = seen["token_ids"]
    assert after.count() == before.count() and after.where("size(ids) <> n_tokens").count() == 0


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id", "en", None, 5), (3, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "t", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("count", F.lit(1)).withColumn("value", F.lit("v"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.collect()
        assert name == "token_ids" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "None"]


def test_rows_without_ids_are_mixed_one_by_one(spark):
    rows = [(None, "a b c d", "en", "s", 7)] * 40 + [(7, f"x y {i}", "en", "t", 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mixture(spark, docs, SF).groupBy("source").count().collect()
    want = {r.source: r.copies for r in mix(docs).groupBy("source").agg(F.sum("copies").alias("copies")).collect()}
    assert {r.source: r["count"] for r in got} == want


def test_rows_of_one_id_are_documents(spark):
    """Different texts of one id all stay; of equal texts the smallest id does, whatever the order of rows."""
    rows = [(7, f"x y {i}", "en", "t", 5) for i in range(40)] + [(None, "a b c d e", "en", "s", 9)] * 5 + [(9, "a b c d e", "en", "s", 9), (8, "a b c d e", "fr", "s", 9), (None, "p q r s t", "en", "s", 9), (None, "p q r s t", "en", "s", 9), (3, "", "en", "s", 0), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit("clash"))
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted([("7", f"x y {i}") for i in range(40)] + [("8", "a b c d e"), ("None", "p q r s t"), ("3", ""), ("3", "None")])
