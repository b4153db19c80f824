import datetime as dt

from pyspark.sql import functions as F

from tillhouse.functions import (clean_title, day_name, half_even, initcap_alnum, iso_dow, month_label,
                                 norm, strip, surrogate_key, year_month)


def test_initcap_words_start_after_any_non_alnum(spark):
    df = spark.createDataFrame([(" e-wallet ",), ("o'neil_x  y",), ("SOUTH  jakarta",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(clean_title("s")).collect()]
    assert got == ["E-Wallet", "O'Neil_X  Y", "South  Jakarta", None, ""]
    assert df.select(initcap_alnum(F.lit("12ab cd"))).first()[0] == "12ab Cd"


def test_trim_removes_spaces_only(spark):
    df = spark.createDataFrame([("\t a \t",), ("  Completed ",)], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["\t a \t", "Completed"]
    assert [r[0] for r in df.select(norm("s")).collect()] == ["\t a \t", "completed"]


def test_surrogate_key_null_and_separator_are_unambiguous(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("_null_", "x"), ("", "x")],
                               "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 5
    assert all(len(k) == 32 for k in keys)
    # deterministic
    assert keys == [r[0] for r in df.select(surrogate_key("a", "b")).collect()]


def test_calendar_parts(spark):
    days = [dt.date(2024, 2, 29), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(iso_dow("d"), day_name("d"), month_label("d"), year_month("d")).collect()
    assert [tuple(r) for r in rows] == [
        (4, "Thursday", "Feb 2024", "2024-02"), (7, "Sunday", "Dec 2023", "2023-12"),
        (1, "Monday", "Jan 2024", "2024-01")]


def test_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (12.25,)], "x double")
    assert [r[0] for r in df.select(half_even("x")).collect()] == [2.0, 4.0, -2.0, 12.0]
    assert [r[0] for r in df.select(half_even("x", 1)).collect()][3] == 12.2
