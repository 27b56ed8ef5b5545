import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provender.functions import dates, text, typing

def C():
    return F.col("c")


@pytest.mark.parametrize("cell, expected", [
    (' ="007" ', "007"), ("'=1+1", "=1+1"), ("  plain ", "plain"), ('="unclosed', '="unclosed'), ("\t x\n", "x"), ("", "")])
def test_clean_cell(one, cell, expected):
    assert one(text.clean_cell(C()), c=cell) == expected


@pytest.mark.parametrize("value, expected", [("12abc", 12), (" -3.9", -3), ("abc", None), ("", None), (None, None), ("+7", 7)])
def test_leading_int(one, value, expected):
    assert one(text.leading_int(C()), c=value) == expected
    assert one(text.int_or_zero(C()), c=value) == (expected or 0)


def test_report_text(one):
    assert one(text.drop_first_comma(C()), c="a,b,c") == "ab,c"
    assert one(text.drop_commas(C()), c="a,b,c") == "abc"
    assert one(text.drop_first_remark(C()), c="Acme (West) Co (HQ)") == "Acme  Co (HQ)"
    assert one(text.join_present(", ", [F.lit("a"), F.lit(""), F.lit(None).cast("string"), F.lit("b")])) == "a, b"


@pytest.mark.parametrize("cell", [
    "2026-02-04", "2026/02/04", "02/04/2026", "2/4/2026", "02-04-2026", "2-4-2026", "Feb 4, 2026", "Feb 04, 2026",
    "February 4, 2026", "Feb 4 2026", "February 4 2026", "February 4, 2026 1:05pm", "February 4 2026 1:05PM",
    "2026-02-04T10:00:00Z", " 2026-02-04 "])
def test_date_shapes(one, cell):
    assert one(dates.parse_day(C()), c=cell) == dt.date(2026, 2, 4)


@pytest.mark.parametrize("cell", ["2026-02-30", "13/13/2026", "soon", "", None, "20260204x"])
def test_not_a_date(one, cell):
    assert one(dates.parse_day(C()), c=cell) is None


def test_time_of_day_is_kept(one):
    assert one(dates.parse_moment(C()), c="March 1, 2026 1:05pm") == dt.datetime(2026, 3, 1, 13, 5)


def test_iso_day(one):
    assert one(dates.iso_day(C()), c="2026-02-04T23:00:00-05:00") == "2026-02-04"
    assert one(dates.iso_day(C()), c="Feb 4, 2026") == "2026-02-04"


def test_active_counts_placeholder_dates(one):
    as_of = F.lit("2026-01-01").cast("timestamp")
    at = C().cast("timestamp")
    assert one(dates.is_active(at, as_of), c="2026-06-01") is True
    assert one(dates.is_active(at, as_of), c="2025-06-01") is False
    assert one(dates.is_active(at, as_of), c="1900-12-30") is True
    assert one(dates.is_active(at, as_of), c=None) is False


@pytest.mark.parametrize("word, expected", [("YES", True), ("no", False), ("True", True), ("false", False), ("x", None), ("", None), (None, None)])
def test_bit(one, word, expected):
    assert one(typing.as_bit(C()), c=word) is expected


def test_bit_legacy_polarity(one):
    assert one(typing.as_bit(C(), legacy_yes_no=True), c="yes") is False
    assert one(typing.as_bit(C(), legacy_yes_no=True), c="no") is True
    assert one(typing.as_bit(C(), legacy_yes_no=True), c="true") is True


@pytest.mark.parametrize("cell, expected", [
    ("", "0.00"), ("  ", "0.00"), (None, None), ("1,2", None), (" 12.5 ", "12.50"), ("1e3", "1000.00"), ("n/a", None), (".5", "0.50"), ("-4", "-4.00")])
def test_decimal(one, cell, expected):
    assert one(typing.as_decimal(C(), 2), c=cell) == (None if expected is None else Decimal(expected))


def test_large_whole_numbers_stay_exact(one):
    assert one(typing.as_decimal(C(), 0), c="90071992547409930001") == Decimal("90071992547409930001")


@pytest.mark.parametrize("cell, expected", [("", None), ("NA", None), ("n/a", None), (" n/a ", " n/a "), ("ok", "ok")])
def test_text(one, cell, expected):
    assert one(typing.as_text(C()), c=cell) == expected
