"""What the language model turns away, and what it keeps."""

import random

import numpy as np
import pytest

from tessera.llm import lang_id

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.filter(lang_id.held_out("doc_id")).select("text", "lang").limit(1500).collect() if r["text"]]
    return lang_id.train(docs, sample_rows=2000), rows


def test_held_out_texts_are_kept_and_scores_are_honest(learned):
    model, rows = learned
    got = [lang_id.Scorer(model).predict(t) for t, _ in rows]
    right = np.array([p[0] == lang for p, (_, lang) in zip(got, rows)])
    assert right.mean() > 0.98 and np.mean([p[2] for p in got]) < 0.01
    assert abs(np.mean([p[1] for p in got]) - right.mean()) < 0.05


def test_junk_and_other_scripts_are_rejected(learned):
    model, rows = learned
    scorer, rng = lang_id.Scorer(model), random.Random(3)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(30)) for _ in range(200)]
    junk += ["".join(rng.sample(t, len(t))) for t, _ in rows[:200] if len(t) > 100]
    junk += ["Привет, это русский текст о погоде и людях", "这是一个关于天气和人的中文文本", "Καλημέρα σε όλους τους ανθρώπους", "これは日本語の文章です"]
    got = [scorer.predict(t) for t in junk]
    assert np.mean([p[2] for p in got]) > 0.9 and np.mean([p[1] for p in got]) < 0.1
    assert all(p[2] for p in got[-4:])


def test_a_language_left_out_is_mostly_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("text is not null")
    model = lang_id.train(docs.filter("lang <> 'fr'"), sample_rows=1500)
    scorer = lang_id.Scorer(model)
    got = [scorer.predict(r["text"])[2] for r in docs.filter("lang = 'fr'").select("text").limit(200).collect()]
    assert np.mean(got) > 0.5


def test_the_sample_is_balanced(spark, monkeypatch):
    rows = [(i, f"text {i} of a language", "big") for i in range(3000)] + [(10_000 + i, f"texte {i} d'une langue", "small") for i in range(60)]
    rows += [(20_000, "lang " * 30_000, "long"), (None, "x", "big"), (20_001, None, "big"), (20_002, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    seen = []
    monkeypatch.setattr(lang_id, "fit", lambda r: seen.append(r))
    for d in (docs, docs.repartition(5)):
        lang_id.train(d, sample_rows=300, sample_chars=1000)
    count = {name: sum(1 for _, x in seen[0] if x == name) for name in ("big", "small", "long")}
    assert 200 < count["big"] <= 300 and 30 <= count["small"] <= 60 and count["long"] <= 1
    assert all(len(t) <= 1000 for t, _ in seen[0]) and seen[0] == seen[1]
