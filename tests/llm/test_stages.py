"""Rows that repeat an id, in the stages of the pipeline that drop rows; few labels."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import ngram_join, quality

WORDS = " ".join(f"a{i}" for i in range(60))
OTHER = " ".join(f"b{i}" for i in range(60))


def test_only_copies_go_where_ids_repeat(spark):
    rows = [(1, WORDS, "x"), (2, WORDS, "y"), (2, OTHER, "z"), (3, OTHER + " end", "z"), (4, "few words", "k"), (4, "few words", "k"), (5, None, "n"),
            (5, "", "n"), (5, "", "n"), (None, WORDS, "no id"), (None, WORDS, "no id"), (1, WORDS, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_key string")
    kept = sorted(map(tuple, ngram_join.keep_one(docs, 5, 80).collect()), key=str)
    assert kept == sorted([(1, WORDS, "x"), (2, OTHER, "z"), (4, "few words", "k"), (5, None, "n"), (5, "", "n"), (5, "", "n"), (None, WORDS, "no id"), (None, WORDS, "no id")], key=str)


def test_a_few_labels_of_both_classes_make_a_model():
    x = np.random.default_rng(1).random((45, 12))
    y = np.array([0] * 20 + [1] * 25)
    x[y == 0, 2] += 2
    model = quality.fit(x, y)
    assert (model.probability(x)[y == 1] >= model.threshold).mean() > 0.9 and (model.probability(x)[y == 0] < model.threshold).mean() > 0.8
    assert quality.fit(x[:3], y[:3]) is None and quality.fit(np.vstack([x[:1], x[-1:]]), np.array([0, 1])) is not None


def test_training_sample_is_the_same_on_every_run(spark):
    docs = spark.createDataFrame([(i % 90, " ".join(f"w{(i * j) % 37}" for j in range(20 + i % 50)), "s") for i in range(270)], "doc_id int, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id int, quality int")
    models = [quality.train(d, labels) for d in (docs, docs.orderBy(F.rand(3)).repartition(7))]
    assert all(np.array_equal(getattr(models[0], f), getattr(models[1], f)) for f in ("feature", "cut", "value", "threshold"))
