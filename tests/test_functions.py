import math
import random
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from clinicmart.functions import dates, measures, parse, text
from clinicmart.schema import NOSHOW_BANDS, NULL_TOKENS, SATURATION_BANDS


def test_whitespace_set_is_the_one_of_python():
    assert all(c.isspace() for c in text.WHITESPACE)
    assert {"\t", "\x1c", "\x85", "\xa0", "　", " "} <= set(text.WHITESPACE)


def test_normalize_text_matches_strip_and_upper(column):
    random.seed(7)
    pool = list(text.WHITESPACE) + list("aZñéßü.,-")
    values = [None, "", "\t áé ", "nan", " 　x　y\x1c"]
    values += ["".join(random.choices(pool, k=random.randint(0, 12))) for _ in range(300)]
    got = column(values, lambda df: text.normalize_text(F.col("v")), "v string")
    assert got == [v if v is None else v.strip().upper() for v in values]


def test_replace_values_keeps_the_rest(column):
    got = column(
        ["A", "B", None, "AB"],
        lambda df: text.replace_values(F.col("v"), {"A": "X", "C": "Y"}),
        "v string",
    )
    assert got == ["X", "B", None, "AB"]
    assert column(["A"], lambda df: text.replace_values(F.col("v"), {}), "v string") == ["A"]


def test_fill_and_url(column):
    values = ["  http://x/y.jpg \t", " nan ", "None", None, "", "nana"]
    got = column(values, lambda df: text.fill_default(text.clean_url(F.col("v"))), "v string")
    assert got == ["http://x/y.jpg", "SIN DATO", "SIN DATO", "SIN DATO", "", "nana"]


def test_null_tokens(column):
    values = [*NULL_TOKENS, " ", "na", "X"]
    got = column(values, lambda df: text.null_tokens(F.col("v")), "v string")
    assert got == [None] * len(NULL_TOKENS) + [" ", "na", "X"]


def test_decode_year_of_text_and_numbers(column):
    values = ["2000", "29170", "x", None, " 1999 ", "2000.7", "2100", "2101", "1899", ""]
    got = column(values, lambda df: parse.decode_year(F.col("v"), StringType()), "v string")
    assert got == [2000, 2000, None, None, 1999, None, 2100, 2101 - 27170, 1899 - 27170, None]
    numbers = [2000.7, 29170.0, float("nan"), None, 1e300]
    got = column(numbers, lambda df: parse.decode_year(F.col("v"), DoubleType()), "v double")
    assert got == [2000, 2000, None, None, None]
    got = column([29170, 1990], lambda df: parse.decode_year(F.col("v"), LongType()), "v bigint")
    assert got == [2000, 1990]


def test_lenient_number(column):
    values = ["12", " 1.5 ", "-3e2", ".5", "5.", "1d", "0x1p3", "n.d.", "", None, "1,5", "NaN"]
    got = column(values, lambda df: parse.lenient_number(F.col("v"), StringType()), "v string")
    assert got == [12.0, 1.5, -300.0, 0.5, 5.0, None, None, None, None, None, None, None]
    got = column(
        [1.5, float("nan"), None], lambda df: parse.lenient_number(F.col("v"), DoubleType()),
        "v double",
    )
    assert got == [1.5, None, None]


def test_lenient_integer(column):
    got = column(
        ["120", " 90.0", "x", None], lambda df: parse.lenient_integer(F.col("v"), StringType()),
        "v string",
    )
    assert got == [120, 90, None, None]
    got = column([5, None], lambda df: parse.lenient_integer(F.col("v"), LongType()), "v bigint")
    assert got == [5, None]


def test_lenient_timestamp(column):
    values = ["2025-12-28", "2025-12-28 10:30:00", "2025-12-28T10:30:00.5", "ayer", "", None]
    got = column(values, lambda df: parse.lenient_timestamp(F.col("v")), "v string")
    assert got == [
        datetime(2025, 12, 28), datetime(2025, 12, 28, 10, 30),
        datetime(2025, 12, 28, 10, 30, 0, 500000), None, None, None,
    ]
    got = column(
        ["28/12/2025", "2025-12-28", "x"],
        lambda df: parse.lenient_timestamp(F.col("v"), "dd/MM/yyyy"),
        "v string",
    )
    assert got == [datetime(2025, 12, 28), datetime(2025, 12, 28), None]


def test_calendar_parts(column):
    days = [date(2025, 12, 29), date(2025, 12, 28), date(2024, 12, 31), date(2025, 1, 1)]
    assert column(days, lambda df: dates.iso_weekday(F.col("d")), "d date") == [1, 7, 2, 3]
    assert column(days, lambda df: dates.date_key(F.col("d")), "d date") == [
        20251229, 20251228, 20241231, 20250101,
    ]
    names = column(days, lambda df: dates.day_name(dates.iso_weekday(F.col("d"))), "d date")
    assert names == ["LUNES", "DOMINGO", "MARTES", "MIERCOLES"]
    names = column(days, lambda df: dates.month_name(F.month("d")), "d date")
    assert names == ["DICIEMBRE", "DICIEMBRE", "DICIEMBRE", "ENERO"]
    period = column(days, lambda df: dates.period(F.year("d"), F.month("d")), "d date")
    assert period == ["2025-12", "2025-12", "2024-12", "2025-01"]


def test_whole_days_floor(column):
    spans = [
        (datetime(2025, 1, 1), datetime(2025, 1, 4)),
        (datetime(2025, 1, 1, 18), datetime(2025, 1, 2, 6)),
        (datetime(2025, 1, 2, 6), datetime(2025, 1, 1, 18)),
        (datetime(1, 1, 1), datetime(9999, 12, 31)),
        (None, datetime(2025, 1, 1)),
    ]
    got = column(
        spans, lambda df: dates.whole_days(F.col("a"), F.col("b")),
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert got == [(b - a).days if a else None for a, b in spans]


def test_age_years(column):
    births = [None, date(2000, 6, 14), date(2000, 6, 16), date(2025, 6, 15), date(2026, 1, 1)]
    as_of = date(2025, 6, 15)
    got = column(
        births, lambda df: dates.age_years(F.col("d"), F.lit(as_of)), "d date"
    )
    assert got == [0 if b is None else int((as_of - b).days / 365.25) for b in births]


def test_rate_decimal_is_half_up_and_null_at_zero(column):
    pairs = [(201, 20000), (1, 800), (0, 5), (1, 3), (5, 0), (None, 3)]
    got = column(
        pairs, lambda df: measures.rate_decimal(F.col("a"), F.col("b")), "a bigint, b bigint"
    )
    want = ["1.01", "0.13", "0.00", "33.33", None, None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_rounding_matches_arrays(column):
    random.seed(3)
    values = [0.125, 0.375, 2.5, -2.5, 1.005, 65.65, None]
    values += [random.randint(-10**6, 10**6) / 1000 for _ in range(500)]
    for digits in (1, 2):
        got = column(values, lambda df: measures.round_half_even(F.col("v"), digits), "v double")
        want = [None if v is None else float(np.round(v, digits)) for v in values]
        assert got == want


def test_rate_float(column):
    pairs = [(1, 3), (1, 8), (0, 4), (3, 0)]
    got = column(
        pairs, lambda df: measures.rate_float(F.col("a"), F.col("b"), 2), "a bigint, b bigint"
    )
    assert got == [33.33, 12.5, 0.0, None]


@pytest.mark.parametrize(
    ("bands", "values", "want"),
    [
        (NOSHOW_BANDS, [14.99, 15.0, 24.99, 25.0], ["Bajo", "Moderado", "Moderado", "Crítico"]),
        (SATURATION_BANDS, [79.9, 80.0, 99.9, 100.0],
         ["Normal", "Elevada", "Elevada", "Sobrecarga"]),
    ],
)
def test_bands(column, bands, values, want):
    assert column(values, lambda df: measures.band(F.col("v"), bands), "v double") == want


def test_flag_of_unknown_is_zero(column):
    got = column(["A", "B", None], lambda df: measures.flag(F.col("v") == "A"), "v string")
    assert got == [1, 0, 0]


def test_mean_decimal(column):
    got = column(
        [(457.0, 8), (1.0, 0), (None, 0)],
        lambda df: measures.mean_decimal(F.col("t"), F.col("n")), "t double, n bigint",
    )
    assert got == [Decimal("57.13"), None, None]
    assert math.isclose(457 / 8, 57.125)


def test_single_numbers_round_by_their_binary_value(spark):
    # Literal results: 0.65, 0.025 and 0.475 are stored a little beside the tie, 6.25 and 0.125 are ties.
    cases = [
        (13, 2000, 1, 0.7), (1, 4000, 2, 0.03), (19, 4000, 2, 0.47), (3, 4000, 2, 0.07),
        (1, 16, 1, 6.2), (1, 800, 2, 0.12), (1, 3, 2, 33.33), (0, 5, 1, 0.0),
    ]
    for part, whole, digits, want in cases:
        row = spark.range(1).select(measures.rate_number(F.lit(part), F.lit(whole), digits).alias("r")).first()
        assert row.r == want, (part, whole, digits)
