"""The stages one by one against plain versions, and as a whole."""

import os

import corpus_pipeline as cp
from tidewell.llm import decontam, near_dup, pii

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in cp.STAGES:
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "language_id":
            assert after.count() == before.where("text rlike '\\\\p{L}'").count()
        if name == "near_dedup":
            classes = near_dup.classes(before)
            assert after.count() == classes.select("class_id").distinct().count() < before.count()
        if name == "decontamination":
            bad = {r.doc_id for r in decontam.contained(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert bad and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
        if name == "pii":
            assert after.count() == before.count()
            assert not any(pii.base_spans(r.text) for r in after.collect())
            was = {r.doc_id: r.text for r in before.collect()}
            assert all(r.text == was[r.doc_id] or pii.candidates(was[r.doc_id]) or pii.base_spans(was[r.doc_id]) for r in after.collect())
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
        else:
            assert after.columns == columns
        before = after
    assert cp.run(spark, SF).select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_documents_without_any_language_label(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "é", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in cp.identified(spark, docs, SF).collect()) == [1, 4]


def test_stages_on_odd_rows(spark, tmp_path):
    long = " ".join(f"Word{i} some" for i in range(20000)) + " mail a.b@example.org"
    rows = [(1, "one two three four five six seven", "en", None, 3, "x"), (1, "one two three four five six seven", "en", "s", 3, "x"), (2, None, "en", "s", None, "x"), (3, "", None, "s", 0, None), (4, "12 34 !", "en", "s", 7, "x"), (None, "Some words without a key.", "en", "s", 1, "x"), (5, long, "en", "s", 1, "x"), (6, "one two three four five six seven!", "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, item_id string")
    kept = cp.identified(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 5, 6] and kept.columns == docs.columns
    once = cp.deduplicated(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in once.collect()) == [0, 1, 1, 2, 3, 4, 5] and once.columns == docs.columns
    clean = cp.decontaminated(spark, docs, SF)
    assert clean.count() == len(rows) and clean.columns == docs.columns
    for part in (docs, docs.drop("n_chars")):
        red = cp.redacted(spark, part, SF)
        got = {r.doc_id: r for r in red.collect()}
        assert red.columns == part.columns and got[2].text is None and got[3].text == "" and got[5].text.endswith("mail [EMAIL]")
    assert got[4].text == "12 34 !"
    pieces = cp.packed(spark, docs, SF).collect()
    assert sum(r.length for r in pieces if r.doc_id in (2, 3)) == 2 and {r.doc_id for r in pieces} == {None, 1, 2, 3, 4, 5, 6}
    none = docs.where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0
