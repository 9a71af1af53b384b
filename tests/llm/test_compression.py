"""The compression classifier: held-out accuracy, calibration, odd rows."""

import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import catalog, compression

DATA = "/root/testdata/sf0.01"
KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()), T.StructField("quality", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("text", T.StringType())])


def test_held_out_accuracy_and_calibration(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").filter("quality is not null").select("doc_id", "quality")
    rows = catalog.QUERIES["op12_compression"](spark, DATA)
    assert rows.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert rows.filter(~F.col("score").between(0, 1) | (F.col("predicted") != (F.col("score") >= 0.7).cast("int"))).count() == 0
    known = [(r["score"], r["quality"], r["predicted"]) for r in rows.filter("held_out").join(labels, "doc_id").collect()]
    good, bad = [r for r in known if r[1]], [r for r in known if not r[1]]
    assert len(good) > 40 and len(bad) > 8
    assert sum(p for _, _, p in good) > 0.95 * len(good) and sum(p for _, _, p in bad) < 0.2 * len(bad)
    assert abs(sum(s for s, _, _ in known) / len(known) - len(good) / len(known)) < 0.05
    wanted = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows.collect()}
    assert all(r["held_out"] == wanted[r["doc_id"]] for r in rows.collect())


def test_held_out_labels_are_never_learned(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert compression.train(docs, labels) == compression.train(docs, turned)


def test_whole_texts_count():
    good, bad = "the plain words of a good text go on and on with sense ", "%%% $$$ ### &&& !!! *** @@@ ^^^ ~~~ |||| "
    rows = [(good[i % 20 :] * (3 + i % 7) + str(i * 7919), 1) for i in range(200)] + [(bad[i % 20 :] * (3 + i % 5) + str(i * 104729), 0) for i in range(200)]
    scorer = compression.Scorer(compression.fit(rows))
    assert scorer.score(good * 3) > 0.9 and scorer.score(bad * 3) < 0.1
    words = [f"{good[i % 30 : i % 30 + 25]}{i * 7919}" for i in range(4000)]
    junk = [f"{bad[i % 20 : i % 20 + 25]}{i * 7919}" for i in range(12_000)]
    long_ = " ".join(words)
    assert scorer.score(long_ + " ".join(junk)) < scorer.score(long_)  # what comes after 100,000 characters tells


@pytest.mark.parametrize("labels,wanted", [([], 0.5), ([(1, 1), (3, 1)], 3 / 4), ([(1, 0), (3, 0)], 1 / 4)])
def test_one_class_or_none(spark, labels, wanted):
    docs = spark.createDataFrame([(1, "a b c", "s", "q"), (3, None, "s", "q"), (None, "", "s", "q"), (4, "x " * 100_000, "s", "q")], KIND)
    usable = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    assert usable == [i for i, _ in labels]
    got = compression.score(docs, compression.train(docs, spark.createDataFrame([(*r, "clash") for r in labels], LABELS))).collect()
    assert [r["score"] for r in got] == [wanted] * 4


def test_odd_rows(spark):
    rows = [(i, f"word {i} and more words of a text {i * 31}" * 4 if i % 3 else "%%% ### " * 9 + str(i)) for i in range(60)]
    rows += [(1, None), (2, ""), (None, "null id"), (5, rows[5][1]), (61, "tiny"), (62, "w " * 200_000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(60)] + [(1, None, "x"), (None, 1, "x"), (7, 0, "x"), (8, 2, "x")], LABELS)
    docs = spark.createDataFrame([(*r, "s", "q") for r in rows], KIND)
    got = compression.score(docs, compression.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    empty = compression.score(docs.limit(0), compression.train(docs, labels))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "score", "predicted"]
    assert compression.train(docs.limit(0), labels) == 0.5
