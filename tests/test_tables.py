"""Hand-computed cases for columns, rows, nulls, joins, aggregates and calendars."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import dates, text
from larkspur.operators import aggregates, calendar, chartdata, columns, joins, profile, quantiles, repair, rows, sampling
from larkspur.operators.ranking import first_rows_per_group, number_rows, running_weight, top_n


def values(df, *names):
    out = [tuple(r) for r in df.select(*(names or df.columns)).collect()]
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r))


# ---------------------------------------------------------------- text and dates


def test_band_edges_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (80.0,), (80.01,), (640.0,), (640.5,), (None,)], "x double")
    got = {r.x: r.b for r in df.select("x", text.band(F.col("x"), [0, 80, 640], ["low", "high"]).alias("b")).collect()}
    assert got == {0.0: None, 1.0: "low", 80.0: "low", 80.01: "high", 640.0: "high", 640.5: None, None: None}


def test_text_repairs(spark):
    df = spark.createDataFrame([("$1,250.00", 802), ("", 12), (None, 80202), ("n/a", 123456)], "price string, zip int")
    got = df.select(
        text.parse_number(F.col("price")).alias("p"), text.pad_zip(F.col("zip")).alias("z"),
        text.blank_to(F.col("price")).alias("b"), text.flag(F.col("price"), "").alias("f"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (1250.0, "00802", "$1,250.00", 0), (None, "00012", "N/A", 1), (None, "80202", None, 0), (None, "123456", "n/a", 0)
    ]


def test_recode_and_keep_listed(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    got = df.select(text.recode(F.col("v"), {"a": 1}).alias("r"), text.keep_listed(F.col("v"), ["b"]).alias("k")).collect()
    assert [tuple(r) for r in got] == [(1, "others"), (None, "b"), (None, "others")]


def test_week_labels(spark):
    stamps = [dt.datetime(2013, 10, 13, 15), dt.datetime(2013, 10, 14), dt.datetime(2013, 10, 19, 23, 59)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    got = [tuple(r) for r in df.select(
        dates.week_ending_sunday(F.col("ts")), dates.week_starting_monday(F.col("ts")), dates.weekday(F.col("ts")),
    ).collect()]
    d = dt.date
    assert got == [(d(2013, 10, 13), d(2013, 10, 7), 6), (d(2013, 10, 20), d(2013, 10, 14), 0), (d(2013, 10, 20), d(2013, 10, 14), 5)]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("03/04/2020",), ("2020-03-04",), ("soon",)], "t string")
    got = [r[0] for r in df.select(dates.parse_date(F.col("t"), ["MM/dd/yyyy", "yyyy-MM-dd"])).collect()]
    assert got == [dt.date(2020, 3, 4), dt.date(2020, 3, 4), None]


# ---------------------------------------------------------------- calendar


def test_empty_weeks_are_kept(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 2.0), ("a", dt.date(2024, 1, 22), 3.0), ("b", dt.date(2024, 1, 7), None)],
        "k string, d date, v double",
    )
    got = values(calendar.resample(df, "d", "week_sunday", ["v"], ["v"], ["k"]))
    d = dt.date
    assert got == [
        ("a", d(2024, 1, 7), 2.0, 2.0), ("a", d(2024, 1, 14), 0.0, None), ("a", d(2024, 1, 21), 0.0, None),
        ("a", d(2024, 1, 28), 3.0, 3.0), ("b", d(2024, 1, 7), 0.0, None),
    ]


def test_month_ends_and_extension(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), 1.0), (dt.date(2024, 3, 5), 1.0)], "d date, v double")
    got = [r[0] for r in values(calendar.resample(df, "d", "month", ["v"]))]
    assert got == [dt.date(2023, 12, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    more = values(calendar.extend(df, "d", 2, 7))
    assert [r[0] for r in more][-2:] == [dt.date(2024, 3, 12), dt.date(2024, 3, 19)]


# ---------------------------------------------------------------- order and quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties, one group of a single row, nulls, a null key."""
    draw = random.Random(5)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 7}")
        x = None if i % 31 == 0 else (float(draw.randint(0, 40)) if key == "hot" else draw.gauss(0, 100))
        data.append((i, key, x))
    data.append((6000, "single", 4.25))
    return spark.createDataFrame(data, "id long, k string, x double").repartition(5)


@pytest.mark.parametrize("single_task_rows", [1_000_000, 0])
def test_grouped_quantiles_match_brute_force(spark, skewed, monkeypatch, single_task_rows):
    monkeypatch.setattr(quantiles, "SINGLE_TASK_ROWS", single_task_rows)
    monkeypatch.setattr(quantiles, "SMALL_GROUP_ROWS", single_task_rows // 1000)
    monkeypatch.setattr(quantiles, "MARGIN", 0.01)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.k, r.prob): r.value for r in quantiles.exact_quantiles(skewed, ["x"], probs, ["k"]).collect()}
    groups = {}
    for r in skewed.where("x IS NOT NULL").collect():
        groups.setdefault(r.k, []).append(r.x)
    assert len(got) == len(groups) * len(probs)
    for (key, p), value in got.items():
        assert value == pytest.approx(float(np.quantile(groups[key], p)), abs=1e-9)


def test_narrow_brackets_still_exact(spark, skewed, monkeypatch):
    """A coarse sketch leaves most rows outside the bracket; the answer must not change."""
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    monkeypatch.setattr(quantiles, "MARGIN", 5 / 50)
    monkeypatch.setattr(quantiles, "SMALL_GROUP_ROWS", 0)
    xs = [r.x for r in skewed.where("x IS NOT NULL").collect()]
    got = {r.prob: r.value for r in quantiles.exact_quantiles(skewed, ["x", "id"], [0.25, 0.5]).where("column = 'x'").collect()}
    assert got == {p: pytest.approx(float(np.quantile(xs, p)), abs=1e-9) for p in (0.25, 0.5)}


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(empty, ["x"], [0.5]).collect() == []


def test_row_numbers_in_any_layout(spark, skewed):
    for parts in (1, 8):
        got = {r.id: r.row_number for r in number_rows(skewed.repartition(parts), ["x", "id"], ["k"]).collect()}
        groups = {}
        for r in skewed.collect():
            groups.setdefault(r.k, []).append(((r.x is not None, r.x or 0.0), r.id))
        for members in groups.values():
            for place, (_, i) in enumerate(sorted(members), 1):
                assert got[i] == place


def test_running_weight(spark, skewed):
    counted = skewed.where("x IS NOT NULL AND k IS NOT NULL").select("k", "id", F.lit(2).alias("w"))
    got = {(r.k, r.id): r.t for r in running_weight(counted, ["id"], "w", ["k"], "t").collect()}
    seen = {}
    for r in sorted(counted.collect(), key=lambda r: r.id):
        seen[r.k] = seen.get(r.k, 0) + 2
        assert got[(r.k, r.id)] == seen[r.k]


def test_first_rows_per_group(spark, skewed):
    got = first_rows_per_group(skewed, ["k"], ["id"], 100, ["id"], salts=4)
    per = {}
    for r in skewed.collect():
        per.setdefault(r.k, []).append(r.id)
    want = {i for ids in per.values() for i in sorted(ids)[:100]}
    assert {r.id for r in got.collect()} == want


@pytest.mark.parametrize("top_rows", [1_000_000, 0])
def test_slices(spark, monkeypatch, top_rows):
    monkeypatch.setattr(rows, "TOP_ROWS", top_rows)
    df = spark.range(30).toDF("i")
    assert sorted(r.i for r in rows.slice_rows(df, ["i"], 14, 27).collect()) == list(range(14, 27))
    assert {r.i for r in rows.drop_first(df, ["i"], 1).collect()} == set(range(1, 30))
    assert {r.i for r in rows.drop_last(df, ["i"], 25).collect()} == set(range(5))
    assert rows.drop_last(df, ["i"], 30).collect() == []
    assert {r.i for r in rows.drop_first(df, ["i"], 0).collect()} == set(range(30))
    assert [r.i for r in rows.tail(df, ["i"], 3).collect()] == [27, 28, 29]
    assert [r.i for r in top_n(df, "i", 2, ["i"], largest=False).collect()] == [0, 1]


def test_split_equal_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    hit, rest = rows.split_equal(df, "v", "a")
    assert values(hit) == [("a",)] and values(rest) == [("b",), (None,)]


# ---------------------------------------------------------------- nulls


def loop_fill(series):
    """Row by row, using values already repaired."""
    out = list(series)
    for i, v in enumerate(series):
        if v is None:
            near = [x for x in (out[i - 1] if i else None, series[i + 1] if i + 1 < len(series) else None) if x is not None]
            out[i] = sum(near) / len(near) if near else None
    return out


def test_neighbour_fill_equals_loop(spark):
    draw = random.Random(3)
    data, want = [], {}
    for key in range(6):
        series = [None if draw.random() < 0.4 else float(draw.randint(0, 50)) for _ in range(40)]
        series[0] = 1.0
        want[key] = loop_fill(series)
        data += [(key, i, v) for i, v in enumerate(series)]
    df = spark.createDataFrame(data, "k int, i int, y double")
    got = {(r.k, r.i): r.y for r in repair.fill_neighbour_mean(df, "y", "i", ["k"]).collect()}
    assert all(got[(k, i)] == pytest.approx(v) for k, vs in want.items() for i, v in enumerate(vs))


def test_lookup_falls_back_to_prefix_median(spark):
    left = spark.createDataFrame([(1, "80201"), (2, "80209"), (3, "99999")], "id int, zip string")
    lookup = spark.createDataFrame(
        [("80201", 10.0, 1.0), ("80202", 20.0, 2.0), ("80203", None, 9.0)], "z string, income double, homes double"
    )
    got = values(repair.fill_from_lookup(left, lookup, "zip", "z", ["income", "homes"]))
    assert got == [(1, "80201", 10.0, 1.0), (2, "80209", 15.0, 1.5), (3, "99999", None, None)]


def test_regression_fill_keeps_known_values(spark):
    data = [(i, float(i), 2.0 + 3.0 * i if i % 4 else None, 7.0) for i in range(1, 20)] + [(50, 50.0, -1.0, None)]
    df = spark.createDataFrame(data, "id int, x double, y double, z double").where("id < 50")
    got = {r.id: r.y for r in repair.fill_by_regression(df, ["y"], ["x"]).collect()}
    assert all(v == pytest.approx(2 + 3 * i) for i, v in got.items())


def test_fill_mode_mean_nan(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", math.nan), ("a", 3.0), ("b", None), (None, 5.0)], "s string, x double")
    clean = repair.nan_to_null(df)
    assert values(repair.fill_mode(clean, "s"), "s") == [("a",), ("a",), ("a",), ("b",), ("b",)]
    assert [r.x for r in repair.fill_mean(clean, ["x"]).orderBy("x").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, 5.0, None), (3, 5.0, "b")], "i int, x double, s string")
    assert values(profile.null_counts(df)) == [("i", 0), ("s", 1), ("x", 2)]
    assert values(profile.distinct_counts(df)) == [("i", 3), ("s", 2), ("x", 1)]
    assert profile.duplicate_count(df).first()[0] == 1
    assert values(profile.null_patterns(df)) == [("000", 1), ("001", 1), ("010", 2)]
    described = {r.column: r for r in profile.describe(df, ["i", "x"]).collect()}
    assert described["i"].p25 == 1.0 and described["i"].p50 == 1.5 and described["x"]["count"] == 2


# ---------------------------------------------------------------- joins and groups


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    right = spark.createDataFrame([(2, None), (3, "x")], "id int, v string")
    assert values(joins.anti_join(left, right)) == [(1, "a"), (3, "c")]
    assert values(joins.update_rows(left, right, "id", ["v"])) == [(1, "a"), (2, None), (3, "x")]
    top = joins.semi_join_top(spark.createDataFrame([("a", 1), ("b", 5), ("a", 3), ("c", 5)], "k string, n int"), "k", F.sum("n"), 2)
    assert values(top) == [("b", 5), ("c", 5)]


def test_groups(spark):
    df = spark.createDataFrame([("x", 1.0), (None, 2.0), ("y", None)], "k string, v double")
    assert values(aggregates.group_sum(df, ["k"])) == [("x", 1.0), ("y", None)]
    assert values(aggregates.group_sum(df, ["k"], drop_null_keys=False)) == [("x", 1.0), ("y", None), (None, 2.0)]
    levels = aggregates.group_sum_all_levels(df, "k", ["z", "x"], ["v"])
    assert values(levels) == [(0, "z", 0.0), (1, "x", 1.0)]
    with pytest.raises(ValueError):
        aggregates.levels_of(spark.range(20).selectExpr("id"), "id", limit=5)


def test_subtotals_tell_null_regions_apart(spark):
    df = spark.createDataFrame([("q1", "a", 1.0), ("q1", None, 2.0), ("q2", "a", 4.0)], "q string, r string, v double")
    assert values(aggregates.subtotals(df, "q", "r", v=F.col("v"))) == [
        ("q1", "a", 0, 1.0), ("q1", None, 0, 2.0), ("q1", None, 1, 3.0), ("q2", "a", 0, 4.0), ("q2", None, 1, 4.0)
    ]


@pytest.mark.parametrize("pairwise", [12, 0])
def test_correlation_matrix_skips_incomplete_rows(spark, monkeypatch, pairwise):
    monkeypatch.setattr(aggregates, "PAIRWISE_COLUMNS", pairwise)
    data = [(float(i), float(2 * i), float(-i % 3)) for i in range(10)] + [(None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    matrix = aggregates.correlation_matrix(df, digits=6)
    pairs = [tuple(r) for r in aggregates.strongest_pairs(matrix, 1).collect()]
    assert pairs == [("a", "b", 1.0)]
    assert matrix.count() == 9 and {r.corr for r in matrix.where("i = j").collect()} == {1.0}


def test_histogram_maximum_and_flat_column(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    assert [r["count"] for r in chartdata.histogram(df, "x", 4).orderBy("bin").collect()] == [1, 0, 1, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["count"] for r in chartdata.histogram(flat, "x", 5).collect()) == 2


def test_density_integrates_to_one(spark):
    df = spark.range(500).select(F.randn(4).alias("x"))
    points = chartdata.density(df, "x", 200).orderBy("x").collect()
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(1.0, abs=1e-3)


def test_column_helpers(spark):
    df = spark.createDataFrame([("2.5x", 1, 2.346)], "`Total DOLS (000)` string, n int, m double")
    assert columns.rename_pattern(df, r" DOLS \(000\)$").columns == ["Total", "n", "m"]
    assert columns.move_column(df, "m", "n").columns == ["Total DOLS (000)", "n", "m"]
    assert columns.move_column(df, "m").columns[0] == "m"
    assert columns.cast_columns(df, {"Total DOLS (000)": "double"}).first()[0] is None
    assert columns.round_columns(df, 2).first()["m"] == 2.35
    assert columns.numeric_names(df) == ["n", "m"] and columns.text_names(df) == ["Total DOLS (000)"]


# ---------------------------------------------------------------- samples


def test_splits_do_not_depend_on_layout(spark):
    df = spark.range(5000).toDF("i")
    one = {r.i for r in sampling.split_by_key(df.repartition(1), ["i"], 0.8, 7)[0].collect()}
    many = {r.i for r in sampling.split_by_key(df.repartition(8), ["i"], 0.8, 7)[0].collect()}
    assert one == many and 3850 < len(one) < 4150
    train, _ = sampling.split_by_key(df, ["i"], 0.8, 7)
    assert sampling.with_folds(train, ["i"], 10, 7).select("fold").distinct().count() == 10


def test_stratified_split_is_exact(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") < 20, "b").otherwise("c").alias("y"))
    out = sampling.split_stratified(df, "y", 0.7, [F.xxhash64("id"), "id"])
    sizes = {r.y: (r.n, r.k) for r in out.groupBy("y").agg(F.count("id").alias("n"), F.count_if("is_train").alias("k")).collect()}
    assert all(k == math.ceil(round(n * 0.7, 9)) for n, k in sizes.values()) and len(sizes) == 3


def test_sample_per_class(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = {r.y: r["count"] for r in sampling.sample_per_class(df, "y", 150, ["id"], seed=2).groupBy("y").count().collect()}
    assert out == {0: 150, 1: 100}
