"""Boundary cases from FIXTURES.md on hand-made care tables."""
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from opsflow.operators import core as O
from opsflow.plans import triggers
from opsflow.sources.tables import Tables

ADM = ("patient_number string, admission_number string, facility_code string, discharge_code string, "
       "nurse_id string, nurse_id_arr7_2 string, primary_plan string")
EMP = "nurse_id string, first_name string, last_name string, employee_profile_code string, phone string"
VIS = ("visit_id string, nurse_id string, patient_number string, admission_number string, "
       "schedule_date timestamp_ntz, schedule_time timestamp_ntz, schedule_status_code string, duration string, "
       "confirmed_duration string, update_date timestamp_ntz, service_category string")
UTIL = ("system string, system_id string, client_id string, service string, programgroup string, themonth string, "
        "measure_type string, numerator decimal(18,4), denominator decimal(18,4), active_status int, "
        "frq_entered int, no_outliers int, no_duplicate_systems int")


def _tables(spark, **kw):
    base = dict(
        admissions=spark.createDataFrame([("P1", "A1", "LUS", "A", "N1", "N2", "UNSK"),
                                          ("P2", "A2", "LSK", "A", "N1", "N2", "UNSK")], ADM),
        employees=spark.createDataFrame([("N1", "Cora", "Lane", "HCA", "555-1"), ("E1", "Eve", "Hart", "HCA", "555-2"),
                                         ("E2", "Ed", "Ray", "CCT", "555-3")], EMP),
        users=spark.createDataFrame([("UC1", "Cora Lane")], "user_code string, user_name string"),
        patients=spark.createDataFrame([("P1", "Pat", "One", "1"), ("P2", "Pia", "Two", "1")],
                                       "patient_number string, first_name string, last_name string, residency_codes string"),
    )
    base.update(kw)
    return Tables.from_frames(**base)


def _util_row(client, group, month, num, den):
    return ("EHR1", client, client, "S", group, month, "HOURS", Decimal(num), Decimal(den), 1, 1, 1, 1)


def test_utilisation_boundaries(spark):
    rows = [_util_row("P1", "HOMEMAKER", "1998-06", "10.5", "10"),    # exactly 1.05 -> not over
            _util_row("P1", "RESPITE", "1998-06", "11", "10"),       # 1.10 -> over
            _util_row("P1", "PERSONAL", "1998-06", "5", "0"),        # zero authorised -> NULL ratio, excluded
            _util_row("P1", "CNA SERVICES", "1998-06", "20", "10"),  # excluded program group
            _util_row("P1", "HOMEMAKER", "1998-04", "2", "10")]      # under-use only counts quarterly
    c = _tables(spark, utilization=spark.createDataFrame(rows, UTIL))
    as_of = datetime(1998, 7, 15, 9, 30)
    over = {r.nurse_id: r.notes for r in triggers.util_notes(c, as_of, over=True).collect()}
    assert over == {"N1": "Overutilization Report for Previous Month: patient number P1 One, "
                          "RESPITE: billed hours: 11.00, auth hours: 10.00, overutilized by 10.00%"}
    under = {r.nurse_id: r.notes for r in triggers.util_notes(c, as_of, over=False).collect()}
    # quarter sums per group: HOMEMAKER 12.5/20 = 0.625 (not < .5); nothing under
    assert under == {}
    rows.append(_util_row("P1", "HOMEMAKER", "1998-05", "0", "20"))   # now 12.5/40 = 0.3125
    c = _tables(spark, utilization=spark.createDataFrame(rows, UTIL))
    under = [r.notes for r in triggers.util_notes(c, as_of, over=False).collect()]
    assert under == ["Underutilization Report for Previous Quarter: patient number P1 One, HOMEMAKER: "
                     "billed hours: 12.50, auth hours: 40.00, underutilized by -68.75%"]


@pytest.mark.parametrize("num,den,over", [("17.1990", "16.38", None), ("17.1991", "16.38", "5.00"), ("8.1650", "7", "16.64"),
                                          ("1.0050", "0.95", "5.79"), ("1.05", "1", None), ("1.0501", "1", "5.01")])
def test_utilisation_edges_are_exact(spark, num, den, over):
    c = _tables(spark, utilization=spark.createDataFrame([_util_row("P1", "RESPITE", "1998-06", num, den)], UTIL))
    notes = [r.notes for r in triggers.util_notes(c, datetime(1998, 7, 15, 9, 30), over=True).collect()]
    assert [n.rsplit(" ", 1)[1] for n in notes] == ([f"{over}%"] if over else [])


@pytest.mark.parametrize("num,den,text", [("1.0050", "1", "0.50"), ("0.2850", "0.3", "-5.00"), ("1.00005", "1", "0.01"), ("1.000049", "1", "0.00"),
                                          ("0.99995", "1", "-0.01"), ("2", "3", "-33.33"), ("1", "0", None), ("8.1650", "8", "2.06")])
def test_percent_text_is_rounded_once(spark, num, den, text):
    df = spark.createDataFrame([(Decimal(num), Decimal(den))], "a decimal(18,6), b decimal(18,6)")
    assert df.select(O.percent_over_text(F.col("a"), F.col("b"))).first()[0] == text


def test_decimal_text_of_decimals(spark):
    got = [spark.createDataFrame([(Decimal(x),)], "x decimal(18,4)").select(O.dec72_text(F.col("x"))).first()[0]
           for x in ("1.0050", "0.2850", "8.1650", "-1.0050", "-0.0010", "0")]
    assert got == ["1.01", "0.29", "8.17", "-1.01", "0.00", "0.00"]


def _visit(vid, nurse, adm, ts, dur, conf, status="V"):
    return (vid, nurse, "P" + adm[1:], adm, ts, ts, status, dur, conf, ts, "S")


def test_twelve_hour_and_quarter_hour_boundaries(spark):
    thu = datetime(1998, 6, 18, 9, 30)
    vis = [
        _visit("v1", "E1", "A2", datetime(1998, 6, 10, 8, 0), "11:00", "12:00"),   # 12:00 exactly: not over 12 h
        _visit("v2", "E1", "A2", datetime(1998, 6, 11, 8, 0), "11:00", "12:01"),   # 12:01 single visit at LSK
        _visit("v3", "E1", "A1", datetime(1998, 6, 12, 8, 0), "07:00", "07:00"),   # day total: 7+6 = 13 h
        _visit("v4", "E1", "A1", datetime(1998, 6, 12, 15, 0), "05:00", "06:00"),
        _visit("v5", "E2", "A2", datetime(1998, 6, 11, 8, 0), "11:00", "13:00"),   # CCT profile: excluded
    ]
    c = _tables(spark, visits=spark.createDataFrame(vis, VIS))
    got = sorted((r.notes, r.grp1_assignee1) for r in triggers.daily_overtime(c, thu).collect())
    assert got == [
        ("Employee Hart, Eve: exceeded both twelve hours in a visit/day and scheduled hours on 1998-06-11", "UC1"),
        ("Employee Hart, Eve: exceeded both twelve hours in a visit/day and scheduled hours on 1998-06-12", "UC1"),
    ]
    day15 = datetime(1998, 7, 15, 9, 30)
    upcoming = [
        _visit("u1", "E1", "A1", datetime(1998, 7, 17, 8, 0), "01:15", "01:15"),   # :15 is fine
        _visit("u2", "E1", "A1", datetime(1998, 7, 18, 8, 0), "01:20", "01:20"),   # :20 flagged
        _visit("u3", "E1", "A1", datetime(1998, 7, 16, 8, 0), "01:20", "01:20"),   # tomorrow before 09:30: outside
        _visit("u4", "E1", "A1", datetime(1998, 7, 29, 8, 0), "00:50", "00:50"),   # last day of the window
    ]
    c = _tables(spark, visits=spark.createDataFrame(upcoming, VIS))
    notes = [r.notes for r in triggers.not_div_by_15(c, day15).collect()]
    assert notes == ["There are visit(s) on these dates over the next two weeks that have a duration not "
                     "divisible by 15 minutes: 1998-07-18; 1998-07-29"]


def test_week_crossing_a_year(spark):
    from pyspark.sql import functions as F
    from opsflow.functions import dates as D
    df = spark.createDataFrame([(datetime(1998, 12, 31, 23, 0),), (datetime(1999, 1, 3, 1, 0),),
                                (datetime(1999, 1, 4, 0, 0),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(D.week_start(F.col("ts"))).collect()] == \
        [date(1998, 12, 28), date(1998, 12, 28), date(1999, 1, 4)]
