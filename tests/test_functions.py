from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from opsflow.functions import dates as D
from opsflow.functions import parse as P
from opsflow.functions import text as T
from opsflow.operators.core import dec72_text


def one(spark, col, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_ci_equality_ignores_case_and_trailing_blanks(spark):
    assert one(spark, T.ci_eq("x", "CL"), [("cl ",), ("CL",), ("C L",), (None,)]) == [True, True, False, None]
    assert one(spark, T.ci_in("x", ["PA", "CL"]), [("pa  ",), ("XX",)]) == [True, False]


def test_concat_treats_null_as_empty(spark):
    assert one(spark, T.last_first("f", "l"), [(" Ann ", None), (None, None)], "f string, l string") == [", Ann", ", "]
    assert one(spark, T.full_name("f", "l"), [("Ann", "Lee ")], "f string, l string") == ["Ann Lee"]


def test_strip_is_python_strip(spark):
    vals = ["  a ", "\tb\n", " c　", "", "x", "é ", "  é"]
    got = one(spark, T.strip_ws("x"), [(v,) for v in vals])
    assert got == [v.strip() for v in vals]


def test_blank_and_escape_and_quotes(spark):
    assert one(spark, T.is_blank("x"), [("         ",), ("  1",), (None,)]) == [True, False, None]
    assert one(spark, T.html_escape("x"), [("a<b>&c",)]) == ["a&lt;b&gt;&amp;c"]
    assert one(spark, T.between_quotes("x"), [("Task '123' created",), ("none",)]) == ["123", ""]


def test_dec72_text_rounds_half_away_and_keeps_sign(spark):
    got = one(spark, dec72_text(F.col("x")), [(7.625,), (-12.345,), (0.004,), (40.0833333,), (1e3,)], "x double")
    assert got == ["7.63", "-12.35", "0.00", "40.08", "1000.00"]


def test_parsers_follow_python_rules(spark):
    assert one(spark, P.parse_int(F.col("x")), [(" 12 ",), ("5.0",), ("1,000",), ("+5",), ("",), (None,)]) == \
        [12, None, None, 5, None, None]
    got = one(spark, P.parse_decimal(F.col("x"), 26, 8), [("1,234.50",), ("1e3",), ("NaN",), ("abc",), (".5",)])
    assert got == [Decimal("1234.50000000"), Decimal("1000.00000000"), None, None, Decimal("0.50000000")]
    got = one(spark, P.parse_date(F.col("x")), [("2026-02-01",), ("2/3/2026",), ("03-02-2026",), ("2026-02-30",),
                                                 ("2026/02/01",), (" 2026-2-1 ",)])
    assert got == [date(2026, 2, 1), date(2026, 2, 3), date(2026, 2, 3), None, None, date(2026, 2, 1)]
    assert one(spark, P.hhmm_minutes(F.col("x")), [("12:00",), ("12:01",), (" 00:15 ",), ("ab:cd",)]) == \
        [720, 721, 15, None]
    assert one(spark, P.round_half_even(F.col("x"), 2), [(Decimal("0.125"),), (Decimal("0.135"),)],
               "x decimal(10,3)") == [Decimal("0.12"), Decimal("0.14")]


def test_dates_week_start_diff_and_zone(spark):
    rows = [(datetime(2026, 1, 1, 10, 0),), (datetime(2025, 12, 29, 0, 0),)]
    assert one(spark, D.week_start(F.col("x")), rows, "x timestamp_ntz") == [date(2025, 12, 29)] * 2
    got = one(spark, D.day_diff(F.col("x"), D.ts_lit(datetime(2026, 1, 2, 0, 1))), rows, "x timestamp_ntz")
    assert got == [1, 4]
    # DST gap and overlap in America/Denver
    got = one(spark, D.local_to_utc(F.col("x")),
              [(datetime(2026, 3, 8, 2, 30),), (datetime(2026, 11, 1, 1, 30),), (datetime(2026, 7, 1, 0, 0),)],
              "x timestamp_ntz")
    assert got == [datetime(2026, 3, 8, 9, 30), datetime(2026, 11, 1, 7, 30), datetime(2026, 7, 1, 6, 0)]
    assert one(spark, D.hhmm_ampm(F.col("x")), [(datetime(2026, 1, 1, 13, 5),), (datetime(2026, 1, 1, 9, 0),)],
               "x timestamp_ntz") == ["13:05 PM", "09:00 AM"]


def test_as_of_between_excludes_last_day_after_midnight(spark):
    df = spark.createDataFrame([(date(2026, 1, 1), date(2026, 3, 1))], "f date, t date")
    inside = df.select(D.ts_lit(datetime(2026, 3, 1, 0, 0)).between(F.col("f"), F.col("t"))).first()[0]
    after = df.select(D.ts_lit(datetime(2026, 3, 1, 0, 1)).between(F.col("f"), F.col("t"))).first()[0]
    assert inside is True and after is False


def test_strip_columns_is_python_strip(spark):
    vals = [("  a ", "b"), ("\ta ", " b　"), ("\x1ca", None), (None, "\n"), ("a b", "é "), ("", "\x7f \x0b")]
    df = T.strip_columns(spark.createDataFrame([(i, *v) for i, v in enumerate(vals)], "n int, x string, y string"), ["x", "y"])
    got = {r.n: (r.x, r.y) for r in df.collect()}
    assert got == {i: tuple(None if c is None else c.strip() for c in v) for i, v in enumerate(vals)}
    assert df.columns == ["n", "x", "y"]


def test_dates_by_parts_equal_dates_by_pattern(spark):
    days = ["0", "00", "1", "01", "9", "12", "13", "28", "29", "30", "31", "32"]
    years = ["0000", "0001", "1582", "1900", "2000", "2023", "9999"]
    texts = [t for y in years for a in days for b in days for t in (f"{y}-{a}-{b}", f"{a}/{b}/{y}", f"{a}-{b}-{y}")]
    texts += ["", "1-1", "2000-1-1x", "x2000-1-1", "1/1/200", "20000-1-1", "1-1/2000", "2000/1/1", "+200-1-1", "２000-1-1"]
    shapes = list(zip(P.DATE_SHAPES, ["yyyy-M-d", "M/d/yyyy", "d-M-yyyy"]))
    by_pattern = F.coalesce(*[F.when(F.col("x").rlike(s), F.try_to_date("x", f)) for s, f in shapes])
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "x string")
    odd = df.select("x", P.parse_date_stripped(F.col("x")).alias("a"), by_pattern.alias("b")).filter("NOT a <=> b")
    assert odd.select("x", F.col("a").cast("string"), F.col("b").cast("string")).collect() == []
