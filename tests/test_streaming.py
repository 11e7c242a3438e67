"""The map-only builders run unchanged on a streaming frame."""

from arrivals_star.operators.clean import dedupe_by_key
from arrivals_star.operators.fact import arrivals_fact
from arrivals_star.plans import demo

SF001 = "/root/testdata/sf0.001"


def test_arrivals_fact_on_a_stream_equals_batch(spark, scratch):
    staged_path, out_path, ckpt = scratch("staged"), scratch("fact_stream"), scratch("fact_ckpt")
    staged = dedupe_by_key(demo.raw_arrivals(spark, SF001), ["cicid"], demo.ARRIVALS_ORDER)
    staged.write.mode("overwrite").parquet(staged_path)
    batch = arrivals_fact(spark.read.parquet(staged_path))

    stream = spark.readStream.schema(spark.read.parquet(staged_path).schema).parquet(staged_path)
    query = (arrivals_fact(stream).writeStream.format("parquet").option("path", out_path)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination(300)
    assert query.exception() is None

    streamed = spark.read.parquet(out_path)
    assert streamed.columns == batch.columns
    assert sorted(map(tuple, streamed.collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
