"""The presentation rounding of the plans equals the oracle's SQL rounding."""

import duckdb

from tessera.plans.common import round_half_away, two_step_round


def test_sql_rewrite():
    sql = "SELECT round(a, 6) AS a, round(sum(round(b, 2)), 9) AS b, ground(c, 6), round(d) FROM t"
    assert two_step_round(sql) == (
        "SELECT round(round(a, 9), 6) AS a, round(round(sum(round(round(b, 5), 2)), 12), 9) AS b, "
        "ground(c, 6), round(d) FROM t"
    )


def test_spark_and_duckdb_round_alike(spark):
    # ties at the 7th decimal (x/24 * 1.8 style), values just around them, negatives
    values = [94.7358125, 94.73581249999999, 94.73581250000001, -29.7358125, 2.675, 1.0049999,
              0.0000005, 123456.7891235, 62.7358125, 1e-12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 6)).collect()]
    con = duckdb.connect()
    want = [
        con.execute(two_step_round("SELECT round(CAST(? AS DOUBLE), 6)"), [v]).fetchone()[0]
        for v in values
    ]
    assert got == want
