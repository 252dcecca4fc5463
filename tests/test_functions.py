from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattledger.functions import amounts, codes, dates, flags, texts


@pytest.mark.parametrize("text, code", [
    ("-1", -1), ("-26-X", -26), ("993 - X", 993), ("102010-X", 102010), ("  7-A", 7),
    ("", None), ("X-5", None), (None, None), ("99999999999-BIG", None)])
def test_leading_code(one, text, code):
    assert one({"t": text}, "t string", codes.leading_code("t")) == (code,)


@pytest.mark.parametrize("text, found", [
    ("AA-PR-311-K", True), ("AA-311-K", False), ("PLAIN", False), (None, False)])
def test_recovery_token(one, text, found):
    assert one({"t": text}, "t string", codes.token_is("t", 1, "PR")) == (found,)


def test_first_token_of_a_negative_code_is_empty(one):
    assert one({"t": "-1"}, "t string", codes.token("t", 0), codes.token("t", 5)) == ("", None)


def test_glue_keeps_the_known_side(one):
    row = {"a": None, "b": "x"}
    got = one(row, "a string, b string", codes.glue("a", F.lit("-"), "b"), codes.glue("a", F.lit("-"), "a"),
              codes.code_text("a", "b"), codes.code_text("b", "a"))
    assert got == ("-x", "-", None, "x-")


def test_special_code_is_bare(one):
    got = one({"c": -1, "d": 74, "n": None, "t": "LOSS"}, "c int, d int, n int, t string",
              codes.bare_code("c", "t"), codes.bare_code("d", "t"), codes.bare_code("n", "t"))
    assert got == ("-1", "74-LOSS", None)


def test_status_text(one):
    names = {"R": "one", "F": "two"}
    got = one({"a": "F", "b": "Z", "c": None}, "a string, b string, c string",
              *[codes.status_text(c, names, "other") for c in "abc"])
    assert got == ("two", "other", "other")


def test_code_in_any_column(one):
    row = {"a": 31, "b": None, "c": None}
    got = one(row, "a int, b int, c int", codes.in_any(31, "a", "b", "c"), codes.in_any(5, "b", "c"),
              codes.in_any(31, "b", "a"))
    assert got == (True, False, True)


def test_any_element(one):
    test = lambda x: codes.leading_code(x) == 5055
    assert one({"a": ["1-N", "5055-I"], "b": [], "c": None}, "a array<string>, b array<string>, c array<string>",
               *[codes.any_element(c, test) for c in "abc"]) == (True, False, False)


def test_texts(one):
    got = one({"t": "a\nb\r\tc|d"}, "t string", texts.clean("t"), texts.drawn_from("t", "a", "b", "d$"))
    assert got == ("abcd", True)


def test_dates(one):
    row = {"a": "2026-01-31 10:00:00", "b": "2026-02-30", "c": None, "y": 2026, "m": 3}
    got = one(row, "a string, b string, c string, y int, m int", dates.text_to_date("a"), dates.text_to_date("b"),
              dates.text_to_date("c"), dates.year_month("y", "m"), dates.year_month("y", F.lit(None)))
    assert got == (date(2026, 1, 31), None, None, "2026-03", None)


def test_windows_of_time(one):
    row = {"s": datetime(2026, 1, 1), "e": datetime(2026, 1, 31, 13), "n": None}
    got = one(row, "s timestamp, e timestamp, n timestamp", dates.days_rounded("s", "e"), dates.window_days("s", "e"),
              dates.window_days("s", "n"), dates.in_window("e", "s", "n", datetime(2026, 2, 1)),
              dates.in_window("e", "s", "n"))
    assert got == (31, 30, None, True, None)


def test_active_on(one):
    row = {"a": None, "b": "4732-12-31", "c": "2026-01-01"}
    got = one(row, "a string, b string, c string", *[dates.active_on(c, date(2026, 1, 1)) for c in "abc"],
              *[dates.is_never(c) for c in "abc"])
    assert got == (True, True, False, None, True, False)


def test_rolling_months(one):
    row = {"a": datetime(2026, 2, 28, 5), "b": datetime(2026, 2, 27, 23)}
    assert one(row, "a timestamp, b timestamp", dates.since_months("a", date(2026, 8, 31), 6),
               dates.since_months("b", date(2026, 8, 31), 6)) == (True, False)


def test_amounts(one):
    row = {"cr": "cr", "db": "DB", "x": "XX", "v": 5.0, "z": 0.0, "n": None}
    got = one(row, "cr string, db string, x string, v double, z double, n double",
              amounts.credit_negative("cr", "v"), amounts.credit_negative("x", "v"), amounts.debit_or_credit("db", "v"),
              amounts.debit_or_credit("x", "v"), amounts.ratio("v", -F.col("v")), amounts.ratio("v", "z"),
              amounts.default("n", 1.0), amounts.reconciles("n", "z", 0.01))
    assert got == (-5.0, 5.0, 5.0, None, 1.0, None, 1.0, True)


def test_zero_as_null(one):
    assert one({"a": 0, "b": 3}, "a int, b int", amounts.zero_as_null("a"), amounts.zero_as_null("b")) == (None, "3")


def test_an_unset_threshold_gives_null_not_false(one):
    cond = F.col("v") > 1
    assert one({"v": 0.0}, "v double", flags.unless_unset(None, cond), flags.unless_unset(0.9, cond)) == (None, False)


def test_flags(one):
    row = {"a": None, "b": True, "c": False}
    value, unknown = flags.or_unknown("a", "none")
    got = one(row, "a boolean, b boolean, c boolean", flags.any_signal("a", "b"), flags.any_signal("a", "c"),
              value, unknown, flags.matches("c"), flags.matches("a"), flags.matches("b", True))
    assert got == (True, False, "none", True, True, False, True)
