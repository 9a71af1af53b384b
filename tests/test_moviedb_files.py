import os

import pytest

from tessera.operators import documents as D
from tessera.operators import moviedb
from tessera.operators import relational as R
from tessera.operators.quality import ConstraintViolation
from tests.conftest import rows


def _files(tmp_dir):
    content = {
        "movies": ["id,name,year,rank", "1,Old, Film (1890),1890,5.0", "2,Border (1900),1900,",
                   "3,Leap (1996),1996,8.1", "3,Dup (1996),1996,1.0", "4,Méliès (1902),1902,7",
                   "not a movie line"],
        "persons": ["id,fname,lname,gender", "10,Jean, Jr.,Doe,M", "11,Pål,,F", "12,A,B,M"],
        "directors": ["id,fname,lname", "20,D,One", "21,E,"],
        "directs": ["did,mid", "20,1", "20,1", "21,3", "22,3", "20,99"],
        "cast": ["pid,mid,role", "10,1,[Hero]", "11,1,[Villain]", "10,2,", "12,3,[X]",
                 "13,3,[Ghost]", "10,1,[Again]"],
    }
    paths = {}
    for name, lines in content.items():
        paths[name] = os.path.join(tmp_dir, f"{name}.txt")
        with open(paths[name], "w", encoding="latin-1") as f:
            f.write("\n".join(lines) + "\n")
    return paths


def test_constrained_load_from_files_and_queries(spark, tmp_dir):
    paths = _files(tmp_dir)
    t, rej = moviedb.read_movie_files(spark, **paths)
    assert rows(t.movies) == [
        (1, "Old, Film (1890)", 1890, 5.0),
        (2, "Border (1900)", 1900, None),
        (3, "Leap (1996)", 1996, 8.1),
        (4, "Méliès (1902)", 1902, 7.0),
    ]
    assert rows(t.persons, "id", "fname", "lname") == [(10, "Jean, Jr.", "Doe"), (11, "Pål", None), (12, "A", "B")]
    assert rows(t.directors) == [(20, "D", "One"), (21, "E", None)]
    assert rows(t.directs) == [(20, 1), (21, 3)]
    assert rows(rej.directs_fk, "did", "mid") == [(20, 99), (22, 3)]
    assert rows(rej.directs_pk, "did", "mid") == [(20, 1)]
    assert rows(t.acts_in, "pid", "mid", "role") == [(10, 1, "[Hero]"), (10, 2, None), (11, 1, "[Villain]"), (12, 3, "[X]")]
    assert rows(rej.acts_in_fk, "pid", "mid") == [(13, 3)]
    assert rows(rej.acts_in_pk, "pid", "mid", "role") == [(10, 1, "[Again]")]
    assert [r.value for r in rej.parse["movies"].collect()] == ["not a movie line"]

    top = R.top_movies_per_year(t.movies, 1850, 2004, 1).collect()
    assert [(r.year, r.id) for r in top] == [(1890, 1), (1902, 4), (1996, 3)]
    both = R.active_in_both_periods(t.persons, t.acts_in, t.movies, (1850, 1900), (1900, 1949))
    assert [r.id for r in both.collect()] == [10]
    assert [r.id for r in R.leap_year_directors(t.directors, t.directs, t.movies).collect()] == [21]

    docs = D.movie_documents(t.movies, t.acts_in, t.directs, ["ord"])
    first = docs.filter("movie_id = 1").first()
    assert first.actor_ids == [10, 11] and first.actor_roles == ["Hero", "Villain"]
    assert first.director_ids == [20]


def test_strict_cast_load_fails(spark, tmp_dir):
    paths = _files(tmp_dir)
    with pytest.raises(ConstraintViolation):
        moviedb.read_movie_files(spark, **paths, strict_cast=True)


def test_load_and_its_queries_run_in_small_tasks(spark, tmp_dir, monkeypatch):
    from tessera import session
    from tessera.plans import files as PF
    from tessera.plans import movies as PM

    li = "bigint l_orderkey, bigint l_partkey, bigint l_suppkey, int l_linenumber, string l_returnflag"
    li = ", ".join(" ".join(reversed(c.split())) for c in li.split(", "))
    tables = {
        "lineitem": ([(o, 1 + (o + j) % 40, 1 + (o * j) % 9, j, "A") for o in range(1, 60) for j in range(1, 2 + o % 5)], li),
        "orders": ([(o, float(o), "1996-01-02") for o in range(1, 60)], "o_orderkey bigint, o_totalprice double, o_orderdate string"),
        "part": ([(p, "n", "b", "t") for p in range(1, 41)], "p_partkey bigint, p_name string, p_brand string, p_type string"),
        "supplier": ([(s, "s", 1) for s in range(1, 10)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "nation": ([(1, "X")], "n_nationkey int, n_name string"),
    }
    for name, (made, schema) in tables.items():
        df = spark.createDataFrame(made, schema)
        (df.selectExpr("o_orderkey", "o_totalprice", "cast(o_orderdate as timestamp) o_orderdate") if name == "orders" else df).write.parquet(f"{tmp_dir}/{name}.parquet")
    keys = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before, seen = [spark.conf.get(k) for k in keys], []
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    for module, name in ((PM, "store_tables"), (PF.moviedb, "store_tables"), (PM, "stored"), (PF, "stored")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real: (seen.append([int(spark.conf.get(k)) for k in keys]), real(*a))[1])
    for query in (PM.q_fewest_actors, PM.q_most_actors, PM.q_many_directors_actors, PF.q_file_load_most_actors):
        query(spark, tmp_dir)
        assert [spark.conf.get(k) for k in keys] == before
    assert len(seen) == 6
    for parts, *sizes in seen:
        assert parts >= len(tables["lineitem"][0]) // 5 and sizes == [session.TASK_BYTES, session.TASK_FILE_BYTES]
    got = [(r["id"], r["num_actors"]) for r in PM.q_most_actors(spark, tmp_dir).collect()]
    assert got == [(o, 5) for o in range(4, 54, 5)]
