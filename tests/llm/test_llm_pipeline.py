"""Every stage of the pipeline against a plain version of its decision."""

import base64
import random

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from episodica.llm import language, quality
from episodica.llm.common import crc_mod

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the small corpus."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        made = pipeline.written(stage(spark, docs, SF), name)
        out[name] = docs, made
        docs = made
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_order_and_columns(spark, stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "language", "line_dedup", "near_duplicates", "packing"]
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(stages[n][1].columns == names for n, _ in pipeline.STAGES[:-1])


def test_quality_rejects_junk_and_keeps_clean(spark, stages):
    docs, out = stages["quality"]
    model = quality.fit(*quality.training_rows(docs, spark.read.parquet(f"{SF}/labels.parquet"), crc_mod("doc_id", 3) != 1))
    want = {r.doc_id for r in docs.collect() if model.score(quality.np.array([quality.features(r.text)]))[0] >= 0.5}
    assert ids(out) == want
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert len(good & ids(out)) > 0.97 * len(good)


def test_language_keeps_what_has_one(stages):
    docs, out = stages["language"]
    model = language.fit(*language.training_rows(docs, crc_mod("doc_id", 4) != 2))
    want = set()
    for r in docs.collect():
        if language.has_letter(r.text):
            name, score = model.predict(language.vector(r.text)[None, :])[0]
            if name != "und" and score >= pipeline.LEAST_LANGUAGE_SCORE:
                want.add(r.doc_id)
    assert ids(out) == want and len(want) > 0.97 * docs.count()


def test_language_drops_unlearned_languages_and_junk(spark):
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    junk = [
        "il gatto dorme sulla sedia mentre il cane guarda fuori dalla finestra e aspetta che torni il padrone " * 3,
        "de kat slaapt op de stoel terwijl de hond naar buiten kijkt en wacht tot de baas weer thuis komt " * 3,
        "kissa nukkuu tuolilla ja koira katsoo ulos ikkunasta odottaen että isäntä palaa kotiin " * 3,
        "кошка спит на стуле а собака смотрит в окно и ждёт хозяина " * 3,
        base64.b64encode(rng.randbytes(600)).decode(), letters(600), " ".join(letters(rng.randint(2, 9)) for _ in range(100)),
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)], "doc_id long, text string, lang string")
    kept = ids(pipeline.keep_language(spark, docs.union(planted), SF))
    assert not {i for i in kept if i < 0}
    good = ids(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"))
    assert len(good & kept) > 0.98 * len(good)


def test_line_dedup_leaves_one_of_each_run(stages):
    from test_llm_lines import brute

    docs, out = stages["line_dedup"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {k: (t, len(t)) for (k, t), (_, old) in zip(brute(rows), rows, strict=True) if t or not old}
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == want


def test_near_duplicates_leave_one_of_each_group(stages):
    from test_llm_jaccard import brute

    docs, out = stages["near_duplicates"]
    found = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert ids(out) == {k for k, (_, _, component) in found.items() if k == component}


def test_packing_takes_all(stages):
    from test_llm_coding import check_pieces

    docs, out = stages["packing"]
    assert check_pieces(out.collect(), [(r.doc_id, r.text) for r in docs.collect()]) == 0


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, None, "en"), (2, "", None), (None, "the and of it", "en"), (3, "the and of it", "en"), (3, "the and of it", "en"), (4, "12 !", "de")]
    odd = spark.createDataFrame([(*r, "s", 5, "x", 0.1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, removed string, score double")
    found = {name: stage(spark, odd, SF) for name, stage in pipeline.STAGES}
    for name, out in found.items():
        if name != "packing":
            assert out.columns == odd.columns
    kept = {name: [r.doc_id for r in out.select("doc_id").collect()] for name, out in found.items()}
    whole = sorted(r[0] or 0 for r in rows)
    # Nothing repeats over two lines or more, and repeated rows of one doc_id are one document: all rows stay.
    assert sorted(i or 0 for i in kept["line_dedup"]) == whole
    assert sorted(i or 0 for i in kept["near_duplicates"]) == whole
    # Texts without letters have no language; rows that repeat go or stay together, in the quality stage too.
    assert not set(kept["language"]) & {1, 2, 4}
    assert {kept["language"].count(3), kept["quality"].count(3)} <= {0, 2}
    # Every row has its closing id at least, so a first piece.
    assert sorted(r.doc_id or 0 for r in found["packing"].collect() if r.start == 0) == whole
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd.limit(0), SF)
        assert out.count() == 0 and (name == "packing" or out.columns == odd.columns)
