"""Lookups whose parent keys are named very unevenly."""
from pyspark.sql import functions as F

from otif.model import Reference
from otif.operators import references

REF = Reference("parents", ("A", "B"), "parent", ("NAME",))


def _children(spark):
    """6,000 rows: a third names one parent, a third none, the rest one of 500 keys, of which 250 have a parent."""
    n = F.col("id")
    return spark.range(6000).select(
        n.cast("string").alias("child"), F.when(n % 3 != 1, F.lit("a")).alias("A"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise((n % 500).cast("string")).alias("B"))


def _parents(spark):
    keys = [("a", "hot", "h")] + [("a", str(k), f"n{k}") for k in range(0, 500, 2)]
    return spark.createDataFrame(keys, "A string, B string, NAME string")


def test_frequent_keys_are_found_with_salts_by_their_share(spark):
    salts = references.frequent_keys(_children(spark), [REF], partitions=30)["parent"]
    hot = spark.range(1).select(references.key_hash([F.lit("a"), F.lit("hot")])).first()[0]
    assert salts == {16: [hot]}  # 10 partitions' worth of rows, up to a power of two


def test_even_keys_and_empty_tables_have_no_salts(spark):
    even = spark.range(1000).select(F.lit("a").alias("A"), F.col("id").cast("string").alias("B"))
    assert references.frequent_keys(even, [REF])["parent"] == {}
    assert references.frequent_keys(even.limit(0), [REF])["parent"] == {}
    assert references.frequent_keys(even, []) == {}


def test_lookup_equals_a_plain_join_and_spreads_the_hot_key(spark):
    children, parents = _children(spark), _parents(spark)
    salts = references.frequent_keys(children, [REF], partitions=30)["parent"]
    names = {(r.A, r.B): r.NAME for r in parents.collect()}
    expected = sorted((r.child, names.get((r.A, r.B))) for r in children.collect())
    for chosen in (salts, None):
        rows = references.lookup(children, parents, REF, chosen).collect()
        assert sorted((r.child, r._ref_parent_NAME) for r in rows) == expected
        assert all((r._ref_parent_found is True) == (r._ref_parent_NAME is not None) for r in rows)

    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(kept, ("-1", "false")):
            spark.conf.set(k, v)

        def largest(chosen):
            sizes = (references.lookup(children, parents, REF, chosen).filter("B = 'hot' or A is null")
                     .groupBy(F.spark_partition_id()).count())
            return max(r["count"] for r in sizes.collect())

        assert largest(None) > 2000
        assert largest(salts) < 1600  # 4,000 rows over 8 partitions
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
