import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tessera.plans import energy
from tessera.streaming import incremental as S
from tests.conftest import SF_SMALL


def _write_raw(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("title,publication_info,cited_by\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")


RUN = """
import sys
from tessera.session import build_session
from tessera.streaming import incremental as S
raw, out, state = sys.argv[1:]
spark = build_session("local[1]", 1)
S.start_article_cleaning(spark, raw, out, 2024, state).awaitTermination()
spark.stop()
"""


def test_article_cleaning_runs_incrementally(spark, tmp_dir):
    """Two separate applications with one state folder clean two files to two rows."""
    raw, out, state = (os.path.join(tmp_dir, d) for d in ("raw", "clean", "state"))

    def run():
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        subprocess.run([sys.executable, "-c", RUN, raw, out, state], check=True, env=os.environ | {"PYTHONPATH": root}, capture_output=True)

    _write_raw(raw, "a.csv", [("T1 [PDF]", "A - V 2020 - P", "Cited by 4"), ("bad", "A - P", "Cited by 1")])
    run()
    assert [r.title for r in spark.read.parquet(out).collect()] == ["T1"]
    _write_raw(raw, "b.csv", [("T2", "B - W, 2022 - Q", "Cited by 9")])
    run()
    got = sorted((r.title, r.citation_count) for r in spark.read.parquet(out).collect())
    assert got == [("T1", 4), ("T2", 9)]


def test_daily_usage_stream_matches_batch_days(spark):
    readings = energy.readings(spark, SF_SMALL)
    schema = readings.schema
    events_schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    stream = (
        spark.readStream.schema(events_schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    )
    usage = stream.filter(F.col("event_type") == "purchase").select("ts", F.col("value").alias("kwh"))
    q = (
        S.daily_usage(usage, "1 day")
        .writeStream.format("memory")
        .queryName("daily_usage_test")
        .outputMode("complete")
        .start()
    )
    q.processAllAvailable()
    q.stop()
    got = {r.label: (r.kwh_sum, r.readings) for r in spark.sql("SELECT * FROM daily_usage_test").collect()}
    batch = readings.groupBy(F.to_date("ts").alias("d")).agg(F.sum("kwh").alias("s"), F.count("*").alias("n"))
    want = {r.d: (r.s, r.n) for r in batch.collect()}
    assert set(got) == set(want)
    for d, (s, n) in want.items():
        assert got[d][1] == n and got[d][0] == pytest.approx(s)
    assert schema["ts"].dataType.typeName() == "timestamp_ntz"
