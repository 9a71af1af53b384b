"""One key holding a third of all rows: results stay exact and the plans keep the
map-side reductions that make such a key cheap."""

from pyspark.sql import functions as F

from tessera.operators import documents as D
from tessera.operators import quality as Q
from tessera.operators import relational as R


def _skewed(spark, n=3000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("ord"),
        (F.col("id") * 7 % 101).cast("double").alias("v"),
    )


def test_primary_key_on_hot_key(spark):
    df = _skewed(spark)
    kept = Q.enforce_primary_key(df, ["k"], order_by=["ord"]).kept
    got = {r.k: r.ord for r in kept.collect()}
    assert got[0] == 0 and len(got) == df.select("k").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # reduced per map task before the exchange


def test_top_k_on_hot_group(spark):
    df = _skewed(spark)
    top = R.top_k_per_group(df, "k", [F.desc("v"), F.asc("ord")], 3).filter("k = 0").collect()
    want = sorted(((r.v, r.ord) for r in df.filter("k = 0").collect()), key=lambda t: (-t[0], t[1]))[:3]
    assert [(r.v, r.ord) for r in top] == want


def test_foreign_key_with_hot_child_key(spark):
    df = _skewed(spark)
    parent = spark.range(0, 500).withColumnRenamed("id", "k")
    checked = Q.enforce_foreign_key(df, parent, ["k"])
    assert checked.kept.count() + checked.rejects.count() == df.count()
    assert checked.kept.filter("k = 0").count() == 1000


def test_hot_key_document_lists_complete(spark):
    df = _skewed(spark).withColumnRenamed("k", "mid").withColumnRenamed("ord", "pid")
    lists = D.group_to_lists(df.withColumn("ord", F.col("pid")), "mid", ["pid"], ["ord"], ["ids"], page=250)
    hot = lists.filter("mid = 0").orderBy("chunk").collect()
    assert [(r.chunk, len(r.ids)) for r in hot] == [(0, 250), (1, 250), (2, 250), (3, 250)]
    assert [i for r in hot for i in r.ids] == list(range(0, 3000, 3))  # pages keep the order


def test_lookup_reads_all_pages_with_identical_links(spark, monkeypatch):
    monkeypatch.setattr(D.group_to_lists, "__defaults__", ((), None, 250))
    movies = spark.createDataFrame([(1, "Hot", 2000, 1.0), (2, "Hot", 2001, 1.0)], "id long, name string, year int, rank double")
    acts = spark.range(1000).select((F.col("id") % 500).alias("pid"), F.lit(1).cast("long").alias("mid"), F.lit("r").alias("role"), F.col("id").alias("ord"))
    same = spark.range(1000).select(F.lit(7).cast("long").alias("did"), F.lit(1).cast("long").alias("mid"), F.col("id").alias("ord"))
    anchor = D.find_one(D.movie_documents(movies, acts, same, ["ord"], ["ord"]), name="Hot").orderBy("chunk").collect()
    assert [r.movie_id for r in anchor] == [1] * 4
    assert [i for r in anchor for i in r.actor_ids] == [*range(500), *range(500)]
    assert sum(len(r.director_ids) for r in anchor) == 1000
    persons = spark.range(600).select(F.col("id").alias("person_id"))
    found = D.find_related(persons, D.find_one(D.movie_documents(movies, acts, same, ["ord"], ["ord"]), name="Hot"), "actor_ids", "person_id")
    assert found.count() == 500


def test_rejects_of_a_repeated_row_are_spread_and_null_keys_rejected(spark, monkeypatch):
    monkeypatch.setattr(Q, "COPIES", 100)
    df = spark.range(3000).select(F.lit(1).alias("k"), F.lit("x").alias("v")).union(spark.createDataFrame([(None, "n"), (2, "y")], "k int, v string"))
    checked = Q.enforce_primary_key(df, ["k"])
    assert sorted((r.k, r.v) for r in checked.kept.collect()) == [(1, "x"), (2, "y")]
    assert checked.rejects.count() == 3000 and checked.rejects.filter("k is null").count() == 1
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        per_task = checked.rejects.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(coalesce, "true")
    assert len(per_task) > 1


def test_null_key_takes_no_place_in_the_top_k(spark):
    directs = spark.createDataFrame([(None, 1), (None, 2), (None, 3), (1, 1), (1, 2), (2, 1), (3, 1)], "did long, mid long")
    directors = spark.createDataFrame([(i, "f", "l") for i in (1, 2, 3)], "id long, fname string, lname string")
    for assume in (True, False):
        assert [r.id for r in R.top_directors_by_count(directors, directs, 3, assume_fk=assume).collect()] == [1, 2, 3]
