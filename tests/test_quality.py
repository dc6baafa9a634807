import json
import math

import pytest
from pyspark.sql import functions as F

from parlance.operators import cleaning, drift, quality
from parlance.plans import quality_report as reports
from parlance.sources import conversations as conv

CONV = "customer_id string, product_category string, sentiment string, timestamp string, conversation_text string, outcome string"


def one(df):
    return df.collect()[0].asDict()


def test_published_examples(spark):
    # 500 missing of 10,000 cells pass, 300 repeated rows of 10,000 fail
    cells = spark.range(10000).select(F.when(F.col("id") >= 500, F.col("id")).alias("x"))
    assert one(quality.completeness(cells)) == {
        "metric": "completeness", "value": 0.95, "n_bad": 500, "n_total": 10000, "threshold": 0.95, "pass": True,
    }
    copies = spark.range(10000).select(F.greatest(F.col("id"), F.lit(300)).alias("x"))
    assert one(quality.duplicate_rate(copies))["value"] == pytest.approx(0.97)
    assert not one(quality.duplicate_rate(copies))["pass"]


def test_format_rules(spark):
    texts = ["2024-01-01T00:00:00XYZ", "2024-99-99T99:99:99", " 2024-01-01T00:00:00", "INVALID_DATE_1", None]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    got = one(quality.format_validity(df))
    assert (got["value"], got["n_bad"], got["n_total"], got["pass"]) == (0.5, 2, 4, False)
    assert sorted(r[0] for r in cleaning.fix_invalid_timestamps(df).collect()) == sorted(texts[:2])
    no_column = one(quality.format_validity(df.withColumnRenamed("timestamp", "t")))
    assert (no_column["value"], no_column["n_total"], no_column["pass"]) == (1.0, 0, True)
    assert cleaning.fix_invalid_timestamps(df, "other").count() == 5


def test_empty_table(spark):
    empty = spark.createDataFrame([], CONV)
    got = {r["metric"]: (r["value"], r["pass"]) for r in quality.dq_scorecard(empty).collect()}
    assert got == {"completeness": (None, False), "duplicate_rate": (None, False), "format_validity": (0.0, False)}
    assert one(quality.completeness(empty))["value"] is None
    assert one(quality.duplicate_rate(empty))["value"] is None
    assert [r["removed"] for r in cleaning.cleaning_log(empty).collect()] == [0, 0, 0]
    drifted = drift.ddq_scorecard(empty, empty).collect()
    assert len(drifted) == 3 and all(r["value"] is None and not r["pass"] for r in drifted)


def test_duplicates_with_missing_and_nan(spark):
    df = spark.createDataFrame(
        [(None, None), (None, None), (float("nan"), None), (0.0, "a"), (-0.0, "a"), (1.0, None)], "x double, y string"
    )
    assert one(quality.duplicate_rate(df))["n_bad"] == 3
    assert cleaning.remove_duplicates(df).count() == 3
    assert one(quality.completeness(df))["n_bad"] == 3 + 4


def test_fingerprint_separates_cells(spark):
    df = spark.createDataFrame([("a,1:b", "c"), ("a", "1:b,1:c"), ("-", None), (None, "-"), ("", None), (None, "")], "x string, y string")
    assert one(quality.duplicate_rate(df))["n_bad"] == 0


def test_scorecard_equals_single_metrics(spark, rows):
    raw = conv.with_quality_problems(conv.generate_range(spark, 3000), "id")
    single = quality.completeness(raw).unionByName(quality.duplicate_rate(raw)).unionByName(quality.format_validity(raw))
    assert rows(quality.dq_scorecard(raw)) == rows(single)


def test_cleaning_log_equals_stepwise_counts(spark, rows):
    raw = conv.with_quality_problems(conv.generate_range(spark, 3000), "id").cache()
    unique = cleaning.remove_duplicates(raw)
    valid = cleaning.fix_invalid_timestamps(unique)
    whole = cleaning.drop_missing(valid)
    sizes = [d.count() for d in (raw, unique, valid, whole)]
    log = [r["removed"] for r in cleaning.cleaning_log(raw).orderBy("step").collect()]
    assert log == [a - b for a, b in zip(sizes, sizes[1:])]
    assert rows(cleaning.clean(raw)) == rows(whole)
    assert 0 < sizes[3] < sizes[0]


def test_impute(spark):
    df = spark.createDataFrame(
        [("b", 1.0, None), ("a", 2.0, None), ("a", 4.0, None), ("b", None, None), (None, float("nan"), None)],
        "s string, x double, empty string",
    )
    got = cleaning.handle_missing(df, "impute").collect()
    assert sorted(r["s"] for r in got) == ["a", "a", "a", "b", "b"]  # tie goes to the smaller value
    assert sorted(r["x"] for r in got) == [1.0, 2.0, 2.0, 2.0, 4.0]
    assert all(r["empty"] is None for r in got)
    with pytest.raises(ValueError):
        cleaning.handle_missing(df, "guess")


def test_first_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    assert rows(cleaning.first_per_key(df, ["k"], ["n"])) == [("a", 1), ("b", 5)]


def _table(spark, weights, n=10000):
    values = [(k,) for k, w in weights.items() for _ in range(round(w * n))]
    return spark.createDataFrame(values, "c string")


def test_kl_examples(spark):
    kl = lambda p, q: drift.kl_divergence(_table(spark, p), _table(spark, q), ["c"]).collect()[0]["kl"]
    assert kl({"E": 0.4, "C": 0.4, "O": 0.2}, {"E": 0.9, "C": 0.05, "O": 0.05}) == pytest.approx(0.784663, abs=5e-7)
    balanced = {c: 0.25 for c in "ECHS"}
    assert kl(balanced, dict(zip("ECHS", (0.6, 0.3, 0.07, 0.03)))) == pytest.approx(0.583860, abs=5e-7)
    assert kl(balanced, balanced) == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("p,q", [
    ({"a": 3, "b": 1}, {"b": 2, "c": 5}), ({"a": 1}, {"z": 1}), ({"a": 2, "b": 2, "c": 1}, {"a": 7}),
])
def test_kl_against_plain_formula(spark, p, q):
    eps, keys = 1e-10, sorted(set(p) | set(q))
    ps = [p[k] / sum(p.values()) if k in p else eps for k in keys]
    qs = [q[k] / sum(q.values()) if k in q else eps for k in keys]
    ps, qs = [x / sum(ps) for x in ps], [x / sum(qs) for x in qs]
    want = sum(a * math.log(a / b) for a, b in zip(ps, qs))
    make = lambda d: spark.createDataFrame([(k,) for k, n in d.items() for _ in range(n)], "c string")
    assert drift.kl_divergence(make(p), make(q), ["c"]).collect()[0]["kl"] == pytest.approx(want, rel=1e-9)
    aligned = {r["value"]: (r["p"], r["q"]) for r in drift.aligned_distribution(make(p), make(q), ["c"]).collect()}
    assert [aligned[k][0] for k in keys] == pytest.approx(ps)
    assert [aligned[k][1] for k in keys] == pytest.approx(qs)


def test_kl_needs_values_on_both_sides(spark):
    some = spark.createDataFrame([("a",)], "c string")
    none = spark.createDataFrame([(None,)], "c string")
    assert drift.kl_divergence(some, none, ["c"]).collect()[0]["kl"] is None
    assert drift.drift_metrics(drift.kl_divergence(none, none, ["c"]), {"c": "m"}).collect()[0]["pass"] is False


def test_kl_at_threshold_fails(spark):
    kl = spark.createDataFrame([("c", 0.1)], "feature string, kl double")
    assert drift.drift_metrics(kl, {"c": "m"}).collect()[0]["pass"] is False


def test_quarter_labels(spark):
    df = spark.createDataFrame(
        [("2021-08-15T00:00:00",), ("2021-13-01T00:00:00",), ("junk",), ("2020",), (None,)], "t string"
    )
    label = lambda mode: [r[0] for r in df.select(drift.quarter_label(F.col("t"), mode)).collect()]
    assert label("label") == ["2021-Q3", "invalid", "invalid", "invalid", "nan-Qnan"]
    assert label("drop") == ["2021-Q3", None, None, None, None]
    typed = spark.range(1).select(drift.quarter_label(F.to_timestamp(F.lit("2021-08-15")), typed=True)).first()[0]
    assert typed == "2021-Q3"


def test_report(spark, tmp_path):
    from parlance.sources.files import write_json

    raw = conv.with_quality_problems(conv.generate_range(spark, 2000), "id")
    prod = conv.generate_range(spark, 2000, conv.PRODUCTION)
    report = reports.quality_report(raw, prod, generated_at=F.lit("now"))
    write_json(report, str(tmp_path / "r"))
    text = next((tmp_path / "r").glob("part-*.json")).read_text()
    got = json.loads(text)
    assert got["timestamp"] == "now" and got["overall_status"] == "FAIL"
    assert got["dq_assessment"]["status"] == "PASS" and got["ddq_assessment"]["status"] == "FAIL"
    assert set(got["dq_assessment"]["metrics"]) == {"completeness", "duplicate_rate", "format_validity"}
    assert set(got["ddq_assessment"]["metrics"]) == {"category_balance", "sentiment_distribution", "temporal_consistency"}
    assert got["cleaning_summary"]["total_operations"] == 3
    measured = {r["metric"]: r for r in quality.dq_scorecard(cleaning.clean(raw)).collect()}
    for name, metric in got["dq_assessment"]["metrics"].items():
        assert metric["value"] == measured[name]["value"] and metric["n_total"] == measured[name]["n_total"]


def test_report_passes_for_equal_tables(spark):
    prod = conv.generate_range(spark, 500, conv.PRODUCTION)
    assert reports.report_summary(prod, prod).collect()[0]["overall_status"] == "PASS"


def test_generated_rates(spark):
    n = 20000
    raw = conv.generate_range(spark, n)
    shares = {r["value"]: r["share"] for r in drift.value_distribution(raw, ["product_category"]).collect()}
    for name, weight in zip(conv.CATEGORIES, conv.TRAINING.category_weights):
        assert shares[name] == pytest.approx(weight, abs=0.012)
    dirty = conv.with_quality_problems(raw, "id")
    score = {r["metric"]: r["value"] for r in quality.dq_scorecard(dirty).collect()}
    assert score["completeness"] == pytest.approx(0.80, abs=0.01)
    assert score["format_validity"] == pytest.approx(0.97, abs=0.015)
    assert dirty.count() == pytest.approx(n * 1.05, rel=0.01)
    again = conv.with_quality_problems(conv.generate(spark.range(n).repartition(13), "id", conv.TRAINING), "id")
    assert dirty.exceptAll(again).count() == 0


def test_csv_round_trip(spark, tmp_path):
    from parlance.sources.files import read_csv, write_csv

    texts = ['say "hi", ok', "two\nlines", "back\\slash", "  padded  ", "", None, "cr\r\nlf", "ends with quote\"", ","]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    write_csv(df.coalesce(1), str(tmp_path / "c"))
    got = {r["i"]: r["t"] for r in read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=True).collect()}
    assert got == {i: (t or None) for i, t in enumerate(texts)}
