"""Language identification: held-out accuracy and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from episodica.llm import language
from episodica.llm.queries import op2_language_id

SCHEMA = "doc_id long, text string, lang string, score string, text_ string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    n, right, low, high = (
        out.where("held_out").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    )
    assert n > 200 and right / n > 0.97
    assert 0 <= low <= high <= 1


def predict(spark, rows, train):
    df = spark.createDataFrame([(*r, "s", "t") for r in rows], SCHEMA)
    learned = spark.createDataFrame([(*r, "s", "t") for r in train], SCHEMA)
    model = language.fit(*language.training_rows(learned, F.lit(True)))
    out = language.predict(df, model, ["doc_id"])
    assert out.columns == ["doc_id", "lang_pred", "score"]
    return {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}


TRAIN = [(i, t, k) for i, (t, k) in enumerate([("the and with that", "en"), ("der und die mit", "de"), ("les des une avec", "fr"), ("слово и текст", "ru")] * 8)]


def test_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "123 !? ²", "fr"), (4, "the and " * 50_000, None), (5, "der und die mit", "xx"), (6, "слово текст", None)]
    got = predict(spark, rows, TRAIN + [(99, None, "en"), (98, "text", None)])
    assert [got[i][0] for i in range(1, 7)] == ["und", "und", "und", "en", "de", "ru"]
    assert got[1][1] == 0 and got[4][1] > 0.5


def test_no_labels_one_label_and_no_rows(spark):
    assert predict(spark, [(1, "word", None)], []) == {1: ("und", 0.0)}
    one = predict(spark, [(1, "word", None), (2, "1", None)], TRAIN[:1])
    assert one[1][0] == "en" and one[2][0] == "und"
    assert predict(spark, [], TRAIN) == {}


def test_repeated_rows_are_predicted_each(spark):
    df = spark.createDataFrame([(1, "the and", "en")] * 3, "doc_id long, text string, lang string")
    model = language.fit(np.stack([language.vector("the"), language.vector("der")]), ["en", "de"])
    assert language.predict(df, model, ["doc_id", "text"]).count() == 3
