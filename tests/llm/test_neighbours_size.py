"""What the search for neighbours sends to the driver must not grow with its pairs of blocks, nor with its tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from panelforge.llm import additive_ann

SF = "/root/testdata/sf0.001"


def test_no_block_of_queries_is_broadcast_or_shuffled_to_each_chunk(spark):
    plan = additive_ann.nearest(spark.read.parquet(f"{SF}/embeddings.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" in plan
    assert plan.count("Exchange") == 1  # the best of all tasks, by query


def test_the_sample_is_the_first_rows_by_hash(spark):
    one = lambda some: some.select("id", F.array(F.col("id").cast("double")).alias("v"))
    for rows in (one(spark.range(3000).repartition(8)), one(spark.range(40)), one(spark.range(3000).withColumn("id", F.lit(7).cast("long")))):
        want = [r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(100).collect()]
        assert [list(v) for v in additive_ann._sample(rows, rows.count(), 100)] == want


def test_best_of_several_chunks():
    q, i, s = np.array([4, 4, 2, 2, 2, 4]), np.array([9, 1, 5, 6, 7, 2]), np.array([1.0, 1.0, 3.0, 5.0, 4.0, 0.5])
    assert [x.tolist() for x in additive_ann.keep_best(q, i, s, 2)] == [[2, 2, 4, 4], [6, 7, 1, 9], [5.0, 4.0, 1.0, 1.0]]
    assert [len(x) for x in additive_ann.keep_best(q[:0], i[:0], s[:0], 2)] == [0, 0, 0]
