import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.functions import dates, lists, values


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("s"))).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_counts_truncate_toward_zero(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    texts = ["12", "12.7", "-12.7", "1.0E3", "0", "0.9999999", "9007199254740993",
             "99999999999999999999", "n/a", "", None]
    got = column(spark, texts, values.to_long)
    spark.conf.unset("spark.sql.ansi.enabled")
    assert got == [12, 12, -12, 1000, 0, 0, 9007199254740993, None, None, None, None]


def test_doubles_flags_dates(spark):
    assert column(spark, ["5", "1.5", "x", None], values.to_double) == [5.0, 1.5, None, None]
    assert column(spark, ["true", "false", "yes", "1", None], values.to_bool) == [
        True, False, None, None, None]
    assert column(spark, ["2024-02-29", "2023-02-29", "soon", None], values.to_date) == [
        dt.date(2024, 2, 29), None, None, None]


def test_unix_times(spark):
    seconds = lambda s: F.unix_micros(values.unix_time(s))
    assert column(spark, ["0", "1.5", "-1", "9" * 15, "x", None], seconds) == [
        0, 1500000, -1000000, None, None, None]


def test_csv_items(spark):
    assert column(spark, [" 3, ,7,999,3", "", "\ta\n,b"], lists.csv_items) == [
        ["3", "7", "999", "3"], [], ["a", "b"]]


def test_json_access(spark):
    text = '{"a":{"b":"7"},"l":[1,2]}'
    assert column(spark, [text], lambda c: values.json_field(c, "$.a.b")) == ["7"]
    assert column(spark, [text, "no"], lambda c: values.json_typed(c, "$.l[1]", "int")) == [2, None]
    assert column(spark, [text], lambda c: values.json_struct(c, "l array<int>")["l"]) == [[1, 2]]


RUN = dt.date(2024, 3, 15)


@pytest.mark.parametrize("lookback, start, end, want", [
    (None, None, None, ("2024-03-01", "2024-03-14")),
    ("", "", "", ("2024-03-01", "2024-03-14")),
    ("1", None, None, ("2024-03-14", "2024-03-14")),
    ("0", None, None, ("2024-03-15", "2024-03-14")),
    ("7", "2024-01-01", None, ("2024-03-08", "2024-03-14")),
    ("7", None, "2024-01-31", ("2024-03-08", "2024-03-14")),
    ("7", "2024-01-01", "2024-01-31", ("2024-01-01", "2024-01-31")),
])
def test_windows(spark, lookback, start, end, want):
    assert dates.window_of(spark, RUN, lookback, start, end) == want
    text = lambda v: F.lit(v).cast("string")
    first, last = dates.window_columns(F.lit(RUN), text(lookback), text(start), text(end))
    row = spark.range(1).select(first.cast("string"), last.cast("string")).first()
    assert tuple(row) == want


def test_inverted_window_is_empty(spark):
    days = spark.createDataFrame([(RUN,), (dt.date(2024, 3, 14),)], "d date")
    window = dates.window_of(spark, RUN, "0")
    assert days.filter(dates.in_window(F.col("d"), *window)).count() == 0
