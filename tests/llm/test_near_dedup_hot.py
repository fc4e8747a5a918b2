"""Hot buckets: the last step makes no more rows than there are pairs between classes."""

import pytest
from corpus_fixture import table
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage
from ridewise.llm.near_dedup import _between, near_classes


def test_pairs_between_classes_only(spark):
    big = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("node"), F.lit(0).cast("long").alias("comp"))
    few = spark.createDataFrame([(1, 30_000, 30_000), (1, 30_001, 30_000), (1, 40_000, 40_000), (2, 1, 0), (2, 30_000, 30_000)],
                                "key int, node long, comp long")
    state = cut_lineage(big.unionByName(few), "state")
    size = state.groupBy("key", "comp").agg(F.count(F.lit(1)).cast("double").alias("c"))
    got = _between(state, size)
    assert got.count() == 20_000 * 3 + 2 + 1                       # of 2 x 10^8 in the bucket
    assert got.where("a >= b").count() == 0 and got.distinct().count() == 20_000 * 3 + 2


def test_thresholds_that_the_sketches_do_not_cover_are_refused(spark):
    for t in (0.5, 0.79, 1.01):
        with pytest.raises(ValueError):
            near_classes(table(spark), threshold=t)
