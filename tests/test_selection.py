"""Order statistics by refining histograms against sorted lists."""

import math
import random
import statistics
from decimal import Context, Decimal

import pytest
from pyspark.sql import functions as F

from parlance.operators import cleaning, pairs, ranking, selection

BIG = 12345678901234567890
WIDE = Context(prec=90)
RNG = random.Random(11)
COLUMNS = {
    "uniform": ("double", [RNG.random() for _ in range(3000)]),
    "decades": ("double", [math.exp(RNG.uniform(-700, 700)) * RNG.choice((-1, 1)) for _ in range(3000)]),
    "odd": ("double", [0.0, 5e-324, 1e-323, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, None, math.nan] * 5),
    "hot": ("double", [3.0] * 900 + [float(i) for i in range(1000)]),
    "single": ("float", [2.5, None]),
    "tiny": ("tinyint", [i % 5 for i in range(700)]),
    "long": ("bigint", [9007199254740992 + i for i in range(999)] + [-(2**63), 2**63 - 1]),
    "wide": ("decimal(38,0)", [Decimal(BIG + i) for i in range(2000)] + [Decimal("9" * 38), Decimal("-" + "9" * 38)]),
    "cents": ("decimal(12,2)", [Decimal(RNG.randrange(-10**9, 10**9)).scaleb(-2) for _ in range(2001)]),
    "close": ("decimal(38,10)", [Decimal(f"{10**27}.{i:010d}") for i in range(40)]),
    "none": ("bigint", [None, None]),
}


def table(spark, columns):
    longest = max(len(v) for _, v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for _, v in columns.values()) for i in range(longest)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {kind}" for c, (kind, _) in columns.items())).repartition(5)


def test_medians_of_many_types_at_once(spark):
    df = table(spark, COLUMNS)
    got = selection.medians(df, list(COLUMNS))
    for c, (_, values) in COLUMNS.items():
        present = [v for v in values if v is not None and v == v]
        if not present:
            assert got[c] is None
            continue
        low, high = statistics.median_low(present), statistics.median_high(present)
        half = (low + high) / 2 if isinstance(low, float) else WIDE.divide(WIDE.add(Decimal(low), Decimal(high)), Decimal(2))
        assert got[c] == (low if low == high else half), c


@pytest.mark.parametrize("parts", [16, 64])
def test_any_rank_with_few_parts(spark, monkeypatch, parts):
    monkeypatch.setattr(selection, "PARTS", parts)
    texts = ["", "a", "a\0", "a\0\0", "ab", "äb", "日本", "x" * 50, "x" * 50 + "y", "x" * 49 + "z"] * 3 + [f"k{i:05d}" for i in range(200)]
    columns = {"t": ("string", texts + [None]), "d": COLUMNS["decades"], "w": COLUMNS["wide"], "l": COLUMNS["long"]}
    df = table(spark, columns)
    ranks = {"t": [0, 5, 17, 100, len(texts) - 1, len(texts)], "d": [0, 1, 1500, 2999], "w": [0, 700, 2001], "l": [1, 500, 1000]}
    got = selection.select_ranks(df, {c: selection.ordinal(df, c) for c in columns}, lambda c, n, rows: ranks[c])
    for c, (_, values) in columns.items():
        ordered = sorted((v for v in values if v is not None), key=lambda v: v.encode() if isinstance(v, str) else v)
        assert got[c] == [ordered[r] if r < len(ordered) else None for r in ranks[c]], c


def test_few_passes(spark, monkeypatch):
    passes = []
    whole = selection._pass
    monkeypatch.setattr(selection, "_pass", lambda *a: passes.append(1) or whole(*a))
    df = spark.range(200_000).select(F.xxhash64("id").alias("x"), (F.xxhash64("id") / 7).alias("y"))
    got = selection.medians(df, ["x", "y"])
    assert len(passes) <= 2
    assert got["x"] == statistics.median_low([Decimal(r.x) for r in df.collect()]) / 2 + statistics.median_high([Decimal(r.x) for r in df.collect()]) / 2


def test_median_columns(spark):
    df = table(spark, {"l": ("bigint", [2**62 + 1, 2**62 + 2]), "d": ("decimal(38,0)", [Decimal(BIG), Decimal(BIG + 1)]), "c": ("decimal(5,2)", [Decimal("1.01"), Decimal("1.02")])})
    assert ranking.median_of(df, "l").first()[0] == Decimal(2**62) + Decimal("1.5")
    assert ranking.median_of(df, "d").first()[0] == Decimal(BIG + 1)  # no digit is left for the half
    assert ranking.median_of(df, "c").first()[0] == Decimal("1.015")


def test_imputing_keeps_wide_numbers(spark):
    df = table(spark, {
        "d": ("decimal(38,0)", [Decimal(BIG), Decimal(BIG), None]), "l": ("bigint", [2**62 + 1, 2**62 + 2, None]),
        "whole": ("bigint", [1, 2, 3]), "i": ("int", [1, 2, None]), "c": ("decimal(10,2)", [Decimal("0.10"), Decimal("0.25"), None])})
    got = cleaning.impute_missing(df)
    assert dict(got.dtypes) == {"d": "decimal(38,0)", "l": "decimal(20,1)", "whole": "bigint", "i": "double", "c": "decimal(10,2)"}
    values = {c: sorted(r[c] for r in got.collect()) for c in got.columns}
    assert values["d"] == [Decimal(BIG)] * 3 and values["l"] == [Decimal(2**62 + 1), Decimal(2**62) + Decimal("1.5"), Decimal(2**62 + 2)]
    assert values["i"] == [1.0, 1.5, 2.0] and values["c"] == [Decimal("0.10"), Decimal("0.18"), Decimal("0.25")]


def plain_first(rows, n):
    missing = lambda v: v is None or v != v
    return {r[0] for r in sorted(rows, key=lambda r: (missing(r[1]), 0 if missing(r[1]) else -r[1], r[0]))[:n]}


@pytest.mark.parametrize("few", [0, 4096])
def test_top_n_either_way(spark, monkeypatch, few):
    monkeypatch.setattr(ranking, "FEW", few)
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(10**6)}-{i}", rng.choice([None, math.nan, 1.0, 1.0, 2.0, rng.random()])) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, quality_score double").repartition(4)
    for n in (0, 1, 30, 150, 390, 400, 500):
        got = {r.id for r in pairs.top_n_label(df, "id", n=n).where("is_good").collect()}
        assert got == plain_first(rows, n), n


def test_splits_by_dates_and_texts(spark):
    df = spark.range(101).select(F.expr("date_add(DATE'2020-01-01', cast(id % 10 as int))").alias("day"), F.concat(F.lit("k"), "id").alias("key"))
    split = ranking.ordered_split(df, [("day", False), ("key", True)], 0.5)
    order = sorted(df.collect(), key=lambda r: (-r.day.toordinal(), r.key))
    assert {r.key for r in split.where("split = 'train'").collect()} == {r.key for r in order[:50]}
    assert ranking.ordered_split(df.where("false"), [("day", True)], 0.5).count() == 0


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        selection.ordinal(spark.createDataFrame([([1],)], "a array<int>"), "a")
