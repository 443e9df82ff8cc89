"""Readers on small hand-written files."""

import datetime as dt

from larkspur.operators import aggregates
from larkspur.session import scratch_path
from larkspur.sources import delimited, sinks
from pyspark.sql import functions as F


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_quoted_multi_line_cells(spark, tmp_path):
    path = write(tmp_path, "loans.csv", 'id,note\n1,"two\nlines, and a ""quote"""\n2,\n')
    got = delimited.read_csv(spark, path, "id int, note string", multi_line=True).orderBy("id").collect()
    assert got[0].note == 'two\nlines, and a "quote"' and got[1].note is None


def test_preamble_and_comments(spark, tmp_path):
    path = write(tmp_path, "trend.csv", "Category: All categories\n\nWeek,brand: (Country)\n2013-10-13,77\n2013-10-20,<1\n")
    got = [tuple(r) for r in delimited.read_after_preamble(spark, path, "Week", ["brand"], ["Category: All categories", "Week"]).orderBy("Week").collect()]
    assert got == [(dt.date(2013, 10, 13), 77.0), (dt.date(2013, 10, 20), None)]
    path = write(tmp_path, "c.csv", "a,b\n# skip,1\nx,2\n")
    assert [tuple(r) for r in delimited.read_csv(spark, path, "a string, b int", comment="#").collect()] == [("x", 2)]


def test_tabs_words_and_inference(spark, tmp_path):
    path = write(tmp_path, "t.dat", "lot\tearing\nA\t2.5\nB\t3\n")
    assert [tuple(r) for r in delimited.read_tsv(spark, path, "lot string, earing double").collect()] == [("A", 2.5), ("B", 3.0)]
    assert dict(delimited.read_csv(spark, path, sep="\t").dtypes) == {"lot": "string", "earing": "double"}
    path = write(tmp_path, "w.txt", '1   "New York" 3.5\n\n2 Boston\t"x"\n')
    got = [tuple(r) for r in delimited.read_quoted_words(spark, path, 3).orderBy("V1").collect()]
    assert got == [("1", "New York", "3.5"), ("2", "Boston", "x")]


def test_categories(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "s string")
    got = {r.s: r.s_code for r in delimited.as_categories(df, ["s"]).collect()}
    assert got == {"a": 1, "b": 2, None: None}


def test_ad_spend_table_shape(spark):
    """Week text, unit suffixes in column names, several products per week."""
    from larkspur.functions import dates, text
    from larkspur.operators import columns

    raw = spark.createDataFrame(
        [("WEEK OF OCT 07, 2013 (B)", "shoe", 1.5, 2.0), ("WEEK OF OCT 07, 2013 (B)", "shirt", 0.5, None), ("WEEK OF OCT 14, 2013 (B)", "shoe", 1.0, 1.0)],
        "`TIME PERIOD` string, PRODUCT string, `SPOT TV DOLS (000)` double, `TOTAL DOLS (000)` double",
    )
    clean = columns.rename_pattern(raw, r" DOLS \(000\)$")
    period = text.replace_pattern(text.replace_literal(F.col("TIME PERIOD"), "WEEK OF "), r" \(B\)$")
    weekly = aggregates.pivot_by_date(clean.withColumn("week", dates.parse_date(F.initcap(period), ["MMM dd, yyyy"])), "week")
    assert [tuple(r) for r in weekly.orderBy("week").collect()] == [(dt.date(2013, 10, 7), 2.0, 2.0), (dt.date(2013, 10, 14), 1.0, 1.0)]


def test_written_index(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int")
    path = sinks.write_csv(df, scratch_path(spark, "idx"), index_order=["n"])
    got = delimited.read_csv(spark, path, "row_index long, k string, n int")
    assert sorted(tuple(r) for r in got.collect()) == [(0, "a", 1), (1, "b", 2)]


def test_parquet_and_view(spark):
    path = sinks.write_parquet(spark.range(4).withColumn("part", F.col("id") % 2), scratch_path(spark, "pq"), ["part"])
    again = sinks.register_view(spark.read.parquet(path), "parted")
    assert again.sql("SELECT count(*) AS `all rows` FROM parted WHERE part = 1").first()[0] == 2
