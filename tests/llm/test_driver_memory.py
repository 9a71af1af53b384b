"""What the driver holds of a training sample and of the list of frequent shingles."""

import random
import tracemalloc

from pyspark.sql.classic.dataframe import DataFrame

from tessera.llm import lang_id, ngram_join


def test_training_holds_few_bytes_a_character():
    rng = random.Random(5)
    rows = [(" ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(3000)), "xy"[k % 2]) for k in range(200)]
    tracemalloc.start()
    try:
        lang_id.fit(rows, epochs=0)
        assert tracemalloc.get_traced_memory()[1] < 45e6  # 3.6 million characters; 57 MB as 16 bytes a subword and 4 a character
    finally:
        tracemalloc.stop()


def test_letters_of_made_texts_are_those_of_the_sample(monkeypatch):
    seen = []
    monkeypatch.setattr(lang_id, "made_texts", lambda text, letters, kind, rng: seen.append(letters.tolist()) or text)
    lang_id.fit([("ΟΔΟΣ", "el"), ("Straße 1, İ", "de"), ("\ud800 z?", "x")], epochs=1)
    assert seen[0] == sorted(set(map(ord, "οδσstraßeiz"))) and all(s == seen[0] for s in seen)


def test_memory_of_the_sample_goes_back_after_training(spark, monkeypatch):
    calls, fit = [], lang_id.fit
    monkeypatch.setattr(lang_id, "fit", lambda rows: calls.append("fit") or fit(rows))
    monkeypatch.setattr(lang_id, "trim", lambda: calls.append("trim"), raising=False)
    docs = spark.createDataFrame([(i, f"{'text of a' if i % 2 else 'texte dans une'} langue {i}", "ab"[i % 2]) for i in range(40)], "doc_id int, text string, lang string")
    assert lang_id.train(docs).languages == ["a", "b"] and calls == ["fit", "trim"]


def test_frequent_shingles_do_not_come_as_rows(spark, monkeypatch):
    common = " ".join(f"w{i}" for i in range(12))  # in every text, so on the list
    own = [" ".join(f"t{d}-{i}" for i in range(40)) for d in range(30)]
    rows = [(d, f"{common} {text}") for d, text in enumerate(own)] + [(100 + d, f"{common} {text} end") for d, text in enumerate(own[:10])]
    lists, prefixes = [], ngram_join.prefixes

    def noted(source, frequent, *args):
        lists.append(frequent.value.tolist())
        return prefixes(source, frequent, *args)

    def refused(self):
        raise AssertionError("rows of a frequent list on the driver")

    monkeypatch.setattr(ngram_join, "prefixes", noted)
    monkeypatch.setattr(DataFrame, "toPandas", refused)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.components(docs).collect()}
    assert lists[0] == sorted(lists[0]) and 0 < len(lists[0]) <= 8  # of the shingles of 5 of the 12 words
    assert got == {d: d % 100 for d, _ in rows}
