"""The sampler's arrays draw what its column functions draw."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.draws import log_gamma
from tidemark.operators import mixture


def test_array_draws_are_the_column_draws(spark):
    shapes = F.element_at(F.array(F.lit(0.1), F.lit(0.4), F.lit(1.0), F.lit(3.5), F.lit(900.1)), (F.col("id") % 5 + 1).cast("int"))
    rows = spark.range(4000).select("id", shapes.alias("shape"))
    rows = rows.withColumn("g", log_gamma(F.col("shape"), F.lit(3), F.col("id") - 1, F.lit(6), seed=9)).orderBy("id").collect()
    got = mixture.drawn_logs(np.array([r["shape"] for r in rows]), 3, np.arange(4000) - 1, 6, 9)
    np.testing.assert_allclose(got, [r.g for r in rows], rtol=1e-12, atol=1e-12)


def test_a_sweep_over_slices_counts_and_draws_as_frames_do(spark):
    counts = spark.range(900).select((F.col("id") % 300).alias("doc_id"), (F.col("id") % 8 - 1).cast("int").alias("pos"), F.when(F.col("id") % 8 == 0, 0).otherwise(F.col("id") % 3 + 1).alias("cnt"))
    rng = np.random.default_rng(3)
    log_mu, log_pi = np.log(rng.dirichlet(np.ones(7), 4)), np.log(np.full(4, 0.25))
    with mixture.sweep_table(counts.groupBy("doc_id", "pos").agg(F.sum("cnt").alias("cnt"))) as data, mixture.packed(data.repartition(50)) as slices:
        assert slices.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        got = mixture._gathered(mixture.swept(slices, log_mu, log_pi, 5, 0.1, 0.1, 7).collect())
        wanted = mixture.drawn_state(spark, mixture.sweep_counts(data, log_mu, log_pi, 5, 7), 7, 4, 0.1, 0.1, 6, 7)
        for a, b in zip(got, mixture._state(wanted.toArrow(), 7, 4)):
            np.testing.assert_allclose(a, b, rtol=1e-12)
