"""Fits read blocks: a step is one stage, in no more tasks than the cores ask for."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import classify


def test_steps_of_a_fit_shuffle_nothing_and_do_not_grow_with_the_files(spark, monkeypatch):
    cells = F.expr("transform(sequence(0, cast(id % 5 as int)), p -> p)")
    rows = spark.range(0, 400, 1, 100).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"), cells.alias("pos"))
    table = rows.withColumn("x", F.expr("transform(pos, p -> (doc_id % 7 + 1) / 10.0D)"))
    w = np.linspace(-1, 1, 5)
    plain, exact = classify._sums(table.coalesce(1), w, classify.HINGE), classify._exact_sums(table.coalesce(1), w, classify.LOGISTIC)
    monkeypatch.setattr(classify, "BLOCK_WORDS", 16)
    with classify.packed(table) as blocks:
        assert blocks.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        spark.sparkContext.setJobGroup("step", "one step")
        for most in (64, 1):
            monkeypatch.setattr(classify, "FLAT_PARTS", most)
            cost, gradient = classify._sums(blocks, w, classify.HINGE)
            assert abs(cost - plain[0]) < 1e-9
            np.testing.assert_allclose(gradient, plain[1], atol=1e-12)
            again = classify._exact_sums(blocks, w, classify.LOGISTIC)
            assert again[0] == exact[0] and again[1].tolist() == exact[1].tolist()
            if most == 64:
                tracker = spark.sparkContext.statusTracker()
                assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("step")] == [1, 1]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
