import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.frames import bounded
from tidemark.llm.hyperdim import identify_languages, keep_languages, learn_profiles, letter_triples, remainder, triple_vectors
from tidemark.llm.queries import op5_language_profiles


def test_vectors_bind_rotated_letters():
    triples, text = letter_triples(["Ab", "1"])
    assert text.tolist() == [0, 0]
    vectors = triple_vectors(triples, 64, 7)
    from tidemark.llm.hyperdim import letter_vector

    gap, a, b = (letter_vector(c, 64, 7) for c in (0, ord("a"), ord("b")))
    assert (vectors[0] == np.roll(gap, 2) * np.roll(a, 1) * b).all()
    assert (vectors[1] == np.roll(a, 2) * np.roll(b, 1) * gap).all()


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog of the house", "en") for i in range(9)] + [(20 + i, "der hund und die katze im haus", "de") for i in range(9)]
    rows += [(40, None, "en"), (41, "", "en"), (42, "123 !?", "de"), (None, "the dog", None), (None, "der hund", None), (43, "日本語", None)]
    docs = bounded(spark).createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double").repartition(3)
    model = learn_profiles(docs)
    assert model.languages == ("de", "en")
    got = {(r.doc_id, r.lang_pred): r.score for r in identify_languages(docs, model).collect()}
    assert all((i, "en") in got and (20 + i, "de") in got for i in range(9))
    assert got[40, "und"] == got[41, "und"] == got[42, "und"] == 0
    assert (None, "en") in got and (None, "de") in got
    assert all(0 <= s <= 1 for s in got.values())
    empty = learn_profiles(docs.limit(0))
    assert empty.languages == ()
    assert {r.lang_pred for r in identify_languages(docs, empty).collect()} == {"und"}


def test_held_out_accuracy(spark, sf):
    found = op5_language_profiles(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert found.count() == docs.count()
    joined = found.where("held_out").join(docs, "doc_id")
    assert joined.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98
    joined.groupBy("lang", "lang_pred").agg(F.count("*"), F.min("score"), F.avg("score")).show()


def test_labelled_documents_stay(spark):
    docs = bounded(spark).read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null")
    model = learn_profiles(docs.where(remainder("doc_id", 3) != 1))
    clean = docs.where(r"length(text) < 200 and text rlike '\\p{L}'").select("doc_id", "text")
    low = [r.doc_id for r in identify_languages(clean, model).where("score < 0.1").collect()]
    assert low
    kept = {r.doc_id for r in keep_languages(clean, model).collect()}
    assert kept == {r.doc_id for r in clean.collect()}


def test_unlearned_languages_go_and_labelled_documents_stay(spark):
    pick = random.Random(4)
    docs = bounded(spark).read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null").select("doc_id", "text", "lang")
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem."
    odd = [
        polish, polish * 5, "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3,
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        *("".join(pick.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(n)) for n in (300, 1000, 3000)), "12 34", None,
    ]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], docs.schema)
    learn = remainder("doc_id", 3) != 1
    kept = keep_languages(docs.union(more), learn_profiles(docs.where(learn)), learn=learn)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    want = {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}
    assert not [i for i in ids if i < 0] and ids == want
