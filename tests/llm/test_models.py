"""Trained classifiers by their held-out accuracy."""

from pyspark.sql import functions as F

from hailmeter.llm import language, toxicity

from .conftest import SCHEMA


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.language_id(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_of_awkward_rows(awkward, clashing):
    out = language.language_id(clashing(awkward)).collect()
    assert len(out) == awkward.count()
    by_text = {r.doc_id: r for r in out if r.doc_id is not None}
    for doc_id in (6, 7, 8, 12):
        assert by_text[doc_id].lang_pred == "und" and by_text[doc_id].score == 0
    assert {r.lang_pred for r in out} <= {"en", "de", "und"}


def test_language_id_without_labels_or_rows(spark, nothing):
    rows = spark.createDataFrame([(1, "some words", None, "a", 1)], SCHEMA)
    assert [r.lang_pred for r in language.language_id(rows).collect()] == ["und"]
    assert language.language_id(nothing).count() == 0


def test_families_of_one_language_need_no_machine(spark):
    rows = [(i, ("pan pon pin " if i % 2 else "xur xor xir ") * 9, "en" if i % 2 else "zz", "a", 1) for i in range(60)]
    out = language.language_id(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "zz") for r in out)


def test_undetermined_documents_go(awkward, clashing):
    docs = clashing(awkward)
    kept = language.determined(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & {6, 7, 8, 12} and {0, 1, 4, 13} <= ids


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic = [r for r in held if r.toxic == 1]
    clean = [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.05


def test_toxicity_of_awkward_rows(spark, awkward, clashing, nothing):
    labels = spark.createDataFrame(
        [(0, 1, 1), (1, 1, 0), (2, 1, 1), (3, None, None), (9, 1, 0), (9, 0, 0), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    out = toxicity.toxicity(clashing(awkward), labels).collect()
    assert len(out) == awkward.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    scores = {}
    for r, t in zip(out, out, strict=True):
        scores.setdefault(r.doc_id, set()).add(t.score)
    assert len(scores[0]) == 1
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_toxicity_without_both_labels_is_their_share(spark, awkward):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(awkward, labels).collect()} == {0.0}
    assert toxicity.toxicity(awkward, labels.limit(0)).filter(F.col("predicted") == 1).count() == 0


def test_language_stage_keeps_what_has_letters(given, awkward, nothing):
    """Nothing with a letter goes, labels or not; null languages are filled in."""
    docs = given("documents")
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    lettered = docs.filter(F.col("text").rlike(r"\p{L}")).count()
    for rows in (docs, unlabelled):
        assert language.determined(rows).count() == lettered
    assert not language.determined(unlabelled).filter("lang is not null").count()
    assert language.determined(nothing).columns == nothing.columns
    kept = language.determined(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.filter(F.col("text").rlike(r"\p{L}")).count()


def test_language_stage_hands_the_prediction_on(given):
    docs = given("documents")
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 1, F.col("lang")))
    found = language.determined(hidden).alias("f").join(docs.alias("d"), "doc_id")
    asked = found.filter("doc_id % 5 = 1 and d.lang is not null")
    assert not asked.filter("f.lang is null").count()
    right = asked.filter("f.lang = d.lang").count() / asked.count()
    assert right > 0.9
    assert not found.filter("doc_id % 5 <> 1 and not (f.lang <=> d.lang) and d.lang is not null").count()
