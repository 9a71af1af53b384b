"""What a task holds of long texts at once: rows read from Parquet and sent to Python."""

import pyarrow as pa

from tessera.llm.common import small_batches

SENT, READ = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


def test_batches_of_long_texts_are_bounded(spark, tmp_dir):
    path = f"{tmp_dir}/texts"
    spark.range(0, 1500, 1, 1).selectExpr("id", "repeat(cast(id % 10 as string), 3000) as text").write.parquet(path)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [sum(len(t) for t in batch.column(1).to_pylist())]}, pa.schema([("rows", pa.int64()), ("bytes", pa.int64())]))

    before = {k: spark.conf.get(k) for k in (SENT, READ)}
    try:
        for k in before:
            spark.conf.unset(k)
        found = spark.read.parquet(path).transform(small_batches).mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert sum(r["rows"] for r in found) == 1500 and max(r["bytes"] for r in found) <= 1.1 * (1 << 20)
        assert int(spark.conf.get(READ)) <= 256
        spark.conf.set(SENT, "5000"), spark.conf.set(READ, "7")
        small_batches(spark.range(1))
        assert (spark.conf.get(SENT), spark.conf.get(READ)) == ("5000", "7")  # lower ones stay
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
