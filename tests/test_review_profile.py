"""Parameterised review SQL, published views, issue samples and findings."""
import datetime as dt

import pytest

from otif.operators import access, profile, review


@pytest.fixture()
def monthly(spark):
    rows = [(dt.date(2026, 9, 1), "ALL", None, "V1"), (dt.date(2026, 9, 1), "BRANCH", "2000", "V1"),
            (dt.date(2026, 8, 1), "ALL", None, "V2")]
    return spark.createDataFrame(rows, "report_month date, report_scope string, branch_code string, supplier_id string")


def test_parameterized_month_uses_bound_identifier_and_values(spark, monthly):
    policy = access.AccessPolicy("etl")
    access.publish_view(spark, monthly, "otif_test_monthly", policy, access.Viewer("etl"))
    got = review.parameterized_month(spark, "otif_test_monthly", dt.date(2026, 9, 1), "ALL").collect()
    assert [(r.report_scope, r.supplier_id) for r in got] == [("ALL", "V1")]
    assert review.parameterized_month(spark, "otif_test_monthly", dt.date(2026, 9, 1), "2000").count() == 1
    with pytest.raises(ValueError):
        review.parameterized_month(spark, "otif_test_monthly", dt.date(2026, 9, 2), "ALL")


def test_published_view_applies_the_row_filter(spark, monthly):
    policy = access.AccessPolicy("etl", {"2000": "g_hh"})
    view = access.publish_view(spark, monthly, "otif_test_view", policy, access.Viewer("u", frozenset({"g_hh"})))
    assert [r.branch_code for r in view.collect()] == ["2000"]


def test_issue_samples_keep_first_rows_per_issue(spark):
    df = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 1)], "issue string, n int")
    out = profile.issue_samples(df, "issue", ["n"], n=8)
    assert sorted((r.issue, r.n) for r in out.collect()) == [("a", i) for i in range(8)] + [("b", 1)]


def test_findings_sorted_by_records_then_name(spark):
    found = spark.createDataFrame([("x", 3), ("y", 4), ("y", 1), ("w", 3)], "check string, records long")
    assert [(r.check, r.records) for r in profile.findings(found).collect()] == [("y", 5), ("w", 3), ("x", 3)]


def test_a_second_parent_row_stops_the_join(spark):
    child = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    parent = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert child.join(profile.one_row_per_key(parent, ["k"]), "k").count() == 2
    twice = parent.union(parent.filter("k = 'a'"))
    with pytest.raises(Exception, match="more than one row"):
        child.join(profile.one_row_per_key(twice, ["k"]), "k").select("k").collect()


@pytest.mark.parametrize("rows", [[("V1", 1.0), ("V1", 2.0)], [("V1", 1.5)], [("V1", -1.0)]])
def test_threshold_study_stops_on_bad_counts(spark, rows):
    counts = spark.createDataFrame([(dt.date(2026, 9, 1), "ALL", None, v, n) for v, n in rows],
                                   "report_month date, scope string, WERKS string, LIFNR string, n double")
    with pytest.raises(Exception, match="more than one row|whole numbers"):
        profile.threshold_study(counts, "n").collect()


def test_profiler_grammars_and_white_space(spark):
    values = ["2024-02-29", "2023-02-29", "29.02.2024", "12.5", "12,5", "-0.000", "-0.0000001", "+7", "1e3", ".5", "1" * 30, " \u2003x\t"]
    frame = profile.stripped(spark.createDataFrame([(v,) for v in values], "v string"))
    got = frame.select("v", profile.iso_date("v").isNotNull(), profile.is_number("v"), profile.is_zero("v"), profile.is_negative("v")).collect()
    by = {r[0]: tuple(r)[1:] for r in got}
    assert by["2024-02-29"][0] and not by["2023-02-29"][0] and not by["29.02.2024"][0] and "x" in by
    assert [v for v in by if by[v][1]] == ["12.5", "-0.000", "-0.0000001", "+7", "1" * 30]
    assert [v for v in by if by[v][2]] == ["-0.000"] and [v for v in by if by[v][3]] == ["-0.0000001"]


def test_threshold_study_without_cross_join(spark):
    counts = spark.createDataFrame([(dt.date(2026, 9, 1), "ALL", "ALL", "V1", 1), (dt.date(2026, 9, 1), "ALL", "ALL", "V2", 6)],
                                   "report_month date, scope string, WERKS string, LIFNR string, n long")
    out = {r.min_items: r for r in profile.threshold_study(counts, "n").collect()}
    assert set(out) == {1, 5, 10, 20}
    assert (out[1].eligible_suppliers, out[5].eligible_suppliers, out[10].eligible_suppliers) == (2, 1, 0)
    assert out[5].retained_item_pct == round(600 / 7, 1) and out[10].retained_item_pct == 0.0
    assert out[1].median_items == 3.5 and out[1].suppliers_with_1_or_2_items == 1 and out[1].ranking_slots == 2


def test_listings_order_and_select(spark):
    rows = [(dt.date(2026, 9, 1), "ALL", None, "V2", "B", 0.4, 2), (dt.date(2026, 9, 1), "ALL", None, "V1", "A", None, 0),
            (dt.date(2026, 9, 1), "ALL", None, "V3", "C", 0.4, 1)]
    monthly = spark.createDataFrame(rows, "report_month date, report_scope string, branch_code string, "
                                          "supplier_id string, supplier_name string, performance_score double, "
                                          "evaluated_schedule_line_count long")
    listed = [r.supplier_id for r in review.supplier_listing(monthly, "ALL", dt.date(2026, 9, 1)).collect()]
    assert listed == ["V2", "V3", "V1"]  # score ascending, nulls last, then id
    worst = monthly.filter("performance_score IS NOT NULL").selectExpr(
        "*", "CAST(supplier_id = 'V3' AS INT) + 1 AS worst_supplier_rank", "0L AS excluded_schedule_line_count",
        "1.0D AS evaluation_coverage_rate", "0.5D AS on_time_rate", "0.5D AS in_full_rate", "0.5D AS mean_quantity_fill_rate")
    assert [r.worst_supplier_rank for r in review.ranking_listing(worst, "ALL").collect()] == [1, 2]
    quality = spark.createDataFrame([("b", 1), ("a", 2)], "reason string, item_or_record_count long")
    assert [r.reason for r in review.quality_listing(quality).collect()] == ["a", "b"]
