"""Stages deal their shuffles into partitions of bounded size (F2..F10, F14, F15 of round 3)."""
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from otif.functions.reasons import reasons
from otif.plans.registry import context
from otif.plans.stage import Stager
from otif.session import PARTITION_BYTES, SHUFFLES, _bytes, sized_shuffles
from sample_tables import SF0001

NAMES = [*SHUFFLES, "spark.sql.shuffle.partitions"]


def settings(spark):
    return [spark.conf.get(name, None) for name in NAMES]


def test_stages_are_written_with_sized_shuffles(spark, tmp_path):
    before, seen = settings(spark), []

    class Frame:
        write = property(lambda self: self)

        def mode(self, _):
            return self

        def option(self, *_):
            return self

        def parquet(self, path):
            seen.append(settings(spark))
            spark.range(1).write.parquet(path)

    Stager(spark, str(tmp_path), partitions=77)(Frame(), "x")
    assert seen == [[*SHUFFLES.values(), "77"]] and settings(spark) == before


def test_settings_return_after_errors_and_threads(spark):
    before = settings(spark)
    with pytest.raises(ZeroDivisionError), sized_shuffles(spark, 77):
        1 / 0
    assert settings(spark) == before

    def use(_):
        with sized_shuffles(spark, 77):
            return settings(spark)

    with ThreadPoolExecutor(4) as pool:
        assert {x[-1] for x in pool.map(use, range(40))} == {"77"}
    assert settings(spark) == before


def test_what_is_set_finer_stays(spark):
    spark.conf.set(NAMES[0], "1k")
    try:
        with sized_shuffles(spark, 2):
            assert settings(spark) == ["1k", SHUFFLES[NAMES[1]], "8"]
        assert spark.conf.get(NAMES[0]) == "1k"
    finally:
        spark.conf.unset(NAMES[0])
    assert [_bytes(x) for x in (None, "64MB", "16k", "1048576b", "12", "1g")] == [64 << 20, 64 << 20, 16 << 10, 1 << 20, 12, 1 << 30]


def test_partitions_grow_with_the_bound_tables(spark):
    ctx = context(spark, SF0001)
    assert 0 < ctx.table_bytes < PARTITION_BYTES and ctx.stager.partitions == 1
    ctx = type(ctx)(spark, SF0001, 100 * PARTITION_BYTES)
    assert ctx.stager.partitions == 500


def test_reasons_of_few_and_no_broken_rules(spark):
    df = spark.createDataFrame([(1, None), (5, "x"), (None, None), (9, "y")], "n int, t string")
    rules = [(F.col("n") > 3, "BIG"), (F.col("t") == "y", "Y"), (F.col("n") > 4, "BIG")]
    out = df.select(reasons(rules).alias("r"), reasons([]).alias("none"))
    assert [r.r for r in out.collect()] == [[], ["BIG"], [], ["BIG", "Y"]]
    assert {tuple(r.none) for r in out.collect()} == {()}
    assert dict(out.dtypes) == {"r": "array<string>", "none": "array<string>"}
