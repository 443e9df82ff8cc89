"""Time series: one or many, as (key..., ds, y) tables with at most one row per key and date.

Series are aggregated to that grain first, so a window over one key is bounded
by the calendar however many raw rows the key owns.
"""
