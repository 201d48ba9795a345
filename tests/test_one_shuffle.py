"""Work that brings a key's rows together once gives what the ways for crowded keys give (F1..F22 of round 3)."""
import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from otif.operators import metrics, profile, quality, reconcile, versions
from otif.plans.stage import Staged
from otif.sources import csv, records


def rows(df):
    return Counter(map(str, df.collect()))


def test_facts_of_keys_by_windows_and_by_joins(spark):
    day = [None, dt.date(2000, 1, 1), dt.date(2000, 1, 2)]
    df = spark.createDataFrame([(f"k{i % 7}" if i % 5 else None, f"r{i}", day[i % 3 if i % 7 > 2 else 1 + i % 2]) for i in range(60)]
                               + [("alone", "x", None), ("two", "y", day[1]), ("two", "z", day[2])], "k string, r string, v date")
    together = df.repartition("k")
    for facts in (lambda d, t: versions.key_variants(d, ["k"], t), lambda d, t: versions.resolve_versions(d, ["k"], "v", t)):
        near, joined = facts(together, True), facts(df, False)
        assert rows(near.select(*sorted(near.columns))) == rows(joined.select(*sorted(joined.columns)))


def test_file_sets_as_bits(spark):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", "f2", now), ("a", "f1", now), ("a", "f1", now), ("b", "f3", now), ("c", None, now), (None, "f1", now)],
                               "x string, _source_file string, _loaded_at timestamp")
    files = versions.few_files(df)
    assert files == ["f1", "f2", "f3"]
    assert rows(versions.collapse_duplicates(df, ["x"], files)) == rows(versions.collapse_duplicates(df, ["x"]))
    many = spark.range(versions.MOST_FILES + 1).select(F.col("id").cast("string").alias("_source_file"))
    assert versions.few_files(many) is None


def test_validated_rows_of_hot_blank_and_single_keys(spark):
    raw = ([("V1", f" N{i}", "f") for i in range(90)] + [("", f"N{i}", "f") for i in range(30)] + [(" V2", "n", "f"), ("V2", "n", "g")]
           + [("V3", "n ", "f"), ("V3", "n ", "g")] + [(f"W{i}", "n", "f") for i in range(60)])
    bronze = spark.createDataFrame(raw, "LIFNR string, NAME1 string, _source_file string").withColumn("_loaded_at", F.current_timestamp())
    got = quality.validate("lfa1", bronze, {}).rows.collect()
    assert len(got) == 90 + 30 + 2 + 1 + 60
    clean = {r.LIFNR for r in got if not r._dq_errors}
    assert clean == {"V3", *(f"W{i}" for i in range(60))}
    conflicts = Counter(r.LIFNR for r in got if "CONFLICTING_KEY" in r._dq_errors)
    assert conflicts == {"V1": 90, None: 30, "V2": 2}
    assert {r._raw_record for r in got if r.LIFNR == "V2"} == {'{"LIFNR":" V2","NAME1":"n"}', '{"LIFNR":"V2","NAME1":"n"}'}
    assert [(r._source_occurrences, r._source_files) for r in got if r.LIFNR == "V3"] == [(2, ["f", "g"])]
    assert '{"LIFNR":"","NAME1":"N3"}' in {r._raw_record for r in got}


def test_digest_tells_nulls_blanks_and_borders_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-", "abc"), ("1:a", "b"), ("a", "1:b")], "x string, y string")
    assert df.select(reconcile.record_digest(["x", "y"]).alias("d")).distinct().count() == 7


def test_extracts_are_built_once(spark):
    built = []

    def stage(frame, name):
        built.append(name)
        return frame

    staged = Staged({"a": spark.range(1), "b": spark.range(2)}, stage, "bronze")
    assert staged["a"] is staged["a"] and built == ["bronze_a"] and list(staged) == ["a", "b"]


def test_item_keys_are_read_from_a_record_once(spark):
    q = spark.createDataFrame([("eket", '{"MANDT":" 300","EBELN":"1","EBELP":""}', ["x"]), ("likp", "{}", ["x"])],
                              "source_table string, _raw_record string, _dq_errors array<string>")
    found = metrics.recover_item_keys(q)
    assert [(r.MANDT, r.EBELN, r.EBELP) for r in found.collect()] == [("300", "1", None)]
    plan = found.dropna(subset=["MANDT", "EBELN"])._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan


def test_records_over_many_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "CHUNK_BITS", 1)
    text = [f'a{i}\n"q{i}";\n\nz' if i % 3 else f"plain{i}" for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(text)), "k int, t string").select(F.col("k").cast("string").alias("k"), "t").coalesce(1)
    path = str(tmp_path / "x")
    csv.write_extract(frame, path)
    got = csv.read_extract(spark, path, ["k", "t"], multiline=True)
    assert {r.k: r.t for r in got.collect()} == {str(i): t for i, t in enumerate(text)}


def test_profile_counts_with_a_hot_key(spark):
    raw = ([("HOT", f"n{i % 50}") for i in range(150)] + [(" HOT", "n1"), ("x", "a"), ("x ", "a"), ("y", "b"), ("y", "b"), (None, "b"), ("", "c")]
           + [(f"k{i}", "m") for i in range(80)])
    df = spark.createDataFrame(raw, "WERKS string, BRANCH_NAME string").withColumn("_source_file", F.lit("f"))
    got = profile.duplicates({"branch_mapping": df}).first()
    # 100 copies of the hot key's records and one of y; three keys with several rows, the hot one differs in its names
    assert (got.exact_extra_rows_raw, got.duplicate_key_groups, got.conflicting_key_groups, got.unique_records) == (101, 3, 1, 81)
    assert {r.WERKS for r in profile.unique_records(df, ["WERKS"]).collect()} == {"y", *(f"k{i}" for i in range(80))}


def test_extract_written_by_every_task(spark, tmp_path):
    frame = spark.range(0, 90, 1, 3).select(F.col("id").cast("string").alias("k"), F.lit("a\nb").alias("t"))
    csv.write_extract(frame, str(tmp_path / "x"), one_file=False)
    assert len(list((tmp_path / "x").glob("part-*.csv"))) == 3
    got = csv.read_extract(spark, str(tmp_path / "x"), ["k", "t"], multiline=True)
    assert sorted(int(r.k) for r in got.collect()) == list(range(90))
