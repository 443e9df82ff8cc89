"""Profiles of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import aggregates as ag
from larkspur.operators import columns as co
from larkspur.operators import profile as pf
from larkspur.plans.registry import query
from larkspur.plans.relational import GAPPY_SQL, gappy_lines


@query("I1", sql="SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def lineitem_shape(t):
    return pf.shape(t.lineitem)


@query("I2", sql=f"""
    SELECT * FROM (VALUES (0, 'l_orderkey', 'bigint'), (1, 'l_linenumber', 'int'), (2, 'l_quantity', 'double'),
      (3, 'l_extendedprice', 'double'), (4, 'l_returnflag', 'string'), (5, 'l_discount', 'double')) AS v(position, "column", type)
    JOIN (UNPIVOT (SELECT count(l_orderkey) AS l_orderkey, count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
      count(l_extendedprice) AS l_extendedprice, count(l_returnflag) AS l_returnflag, count(l_discount) AS l_discount
      FROM {GAPPY_SQL}) ON COLUMNS(*) INTO NAME "column" VALUE non_null) USING ("column")""")
def column_overview(t):
    return pf.column_info(gappy_lines(t))


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS max FROM {table}"""
        for c in columns
    )


@query("I3", sql=_describe_sql(GAPPY_SQL, ["l_quantity", "l_extendedprice", "l_discount"]))
def describe_measures(t):
    described = pf.describe(gappy_lines(t), ["l_quantity", "l_extendedprice", "l_discount"])
    return co.round_columns(described, 6, ["mean", "std", "p25", "p50", "p75"])


@query("I4", sql=f"SELECT DISTINCT l_returnflag, l_discount FROM {GAPPY_SQL}")
def distinct_flag_discount(t):
    return pf.distinct_values(gappy_lines(t), ["l_returnflag", "l_discount"])


@query("I5", sql=f"""
    UNPIVOT (SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_linenumber) AS l_linenumber,
      count(DISTINCT l_quantity) AS l_quantity, count(DISTINCT l_extendedprice) AS l_extendedprice,
      count(DISTINCT l_returnflag) AS l_returnflag, count(DISTINCT l_discount) AS l_discount FROM {GAPPY_SQL})
    ON COLUMNS(*) INTO NAME "column" VALUE "distinct" """)
def distinct_count_per_column(t):
    return pf.distinct_counts(gappy_lines(t))


@query("I6", sql="""
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events)) AS duplicates
    FROM events""")
def duplicate_events(t):
    return pf.duplicate_count(t.events.select("user_id", "event_type", F.to_date("ts").alias("day")))


@query("I7", sql=f"""
    UNPIVOT (SELECT count(*) FILTER (l_orderkey IS NULL) AS l_orderkey, count(*) FILTER (l_linenumber IS NULL) AS l_linenumber,
      count(*) FILTER (l_quantity IS NULL) AS l_quantity, count(*) FILTER (l_extendedprice IS NULL) AS l_extendedprice,
      count(*) FILTER (l_returnflag IS NULL) AS l_returnflag, count(*) FILTER (l_discount IS NULL) AS l_discount
      FROM {GAPPY_SQL}) ON COLUMNS(*) INTO NAME "column" VALUE nulls""")
def null_count_per_column(t):
    return pf.null_counts(gappy_lines(t))


@query("I8", sql=f"""
    SELECT "column" FROM (UNPIVOT (SELECT count(*) FILTER (l_orderkey IS NULL) AS l_orderkey,
      count(*) FILTER (l_quantity IS NULL) AS l_quantity, count(*) FILTER (l_extendedprice IS NULL) AS l_extendedprice,
      count(*) FILTER (l_returnflag IS NULL) AS l_returnflag FROM {GAPPY_SQL})
      ON COLUMNS(*) INTO NAME "column" VALUE nulls) WHERE nulls > 0""")
def columns_having_nulls(t):
    return pf.columns_with_nulls(gappy_lines(t))


@query("I9", sql=f"""
    SELECT "column", flag = 1 AS has_null FROM (UNPIVOT (SELECT max((l_orderkey IS NULL)::INT) AS l_orderkey,
      max((l_linenumber IS NULL)::INT) AS l_linenumber, max((l_quantity IS NULL)::INT) AS l_quantity,
      max((l_extendedprice IS NULL)::INT) AS l_extendedprice, max((l_returnflag IS NULL)::INT) AS l_returnflag,
      max((l_discount IS NULL)::INT) AS l_discount FROM {GAPPY_SQL}) ON COLUMNS(*) INTO NAME "column" VALUE flag)""")
def null_flag_per_column(t):
    return pf.any_null_flags(gappy_lines(t))


@query("I9", "A4", sql=f"""
    SELECT l_quantity IS NULL AS l_quantity, l_returnflag IS NULL AS l_returnflag, count(*) AS cells FROM {GAPPY_SQL} GROUP BY 1, 2""")
def null_mask_counts(t):
    mask = pf.null_mask(gappy_lines(t), ["l_quantity", "l_returnflag"])
    return ag.group_count(mask, ["l_quantity", "l_returnflag"], "cells")


@query("I10", sql=f"""
    SELECT (l_quantity IS NULL)::INT::VARCHAR || (l_extendedprice IS NULL)::INT::VARCHAR || (l_returnflag IS NULL)::INT::VARCHAR AS pattern,
      count(*) AS rows FROM {GAPPY_SQL} GROUP BY 1""")
def null_pattern_counts(t):
    return pf.null_patterns(gappy_lines(t), ["l_quantity", "l_extendedprice", "l_returnflag"])


@query("I11", sql=f"""
    SELECT l_orderkey FROM {GAPPY_SQL} WHERE l_quantity IS NULL OR l_extendedprice IS NULL""")
def orders_with_gaps(t):
    return pf.keys_with_nulls(gappy_lines(t), "l_orderkey", ["l_quantity", "l_extendedprice"])
