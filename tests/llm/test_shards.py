"""One shard for each task in the archives; queries of a shard that come in several batches in the hash forest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tallybook.llm import hash_forest, warc


def test_each_shard_has_its_own_task(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "x" * 2000 + str(i)) for i in range(400)], "page_id long, url string, html string")
    archive = warc.write(pages, f"file://{tmp_path}/w", shard_bytes=20_000)
    names = sorted(r.name for r in archive.manifest.collect())
    assert len({n.split("-")[1] for n in names}) == len(names) > 30
    got = warc.read(archive).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(got) == len(names) and sum(r["count"] for r in got) == 400


def test_a_shard_fits_on_queries_of_several_batches(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 8))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    def found():
        return sorted((r.query_id, r["rank"], r.vec_id) for r in hash_forest.nearest(frame, F.col("vec_id") % 2 == 0, k=5).collect())
    whole = found()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert found() == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
