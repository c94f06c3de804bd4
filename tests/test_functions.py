"""Golden rows of the scalar rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from racelake.functions import dates, durations, links, rules, text

c = F.col


def results(spark, rows, schema, *rules_):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*rules_).collect()]


def column(spark, values, rule, kind="string"):
    return [r[0] for r in results(spark, [(v,) for v in values], f"x {kind}", rule(c("x")))]


def test_seconds(spark):
    cases = {
        "1:21.434": 81.434, "1:31:44.742": 5504.742, "+12.345s": 12.345, "+1:02.5": 62.5, "22.1": 22.1, " 1:02 ": 62.0,
        "12.5S": 12.5, "+1 lap": None, "DNF": None, "": None, "-": None, "—": None, "no time": None, None: None,
        "1:2:3:4": None, "nan": None, "1e3": None, "1_000": None, "1:": None, ":30": None,
    }
    assert column(spark, cases, durations.seconds) == list(cases.values())


def test_clock_rounds_before_it_splits(spark):
    cases = {5504.742: "01:31:45", 59.7: "00:01:00", 0.0: "00:00:00", 360000.0: "100:00:00", None: None}
    assert column(spark, cases, durations.clock, "double") == list(cases.values())


def test_time_from_leader(spark):
    rows = [(80.0, 1.2345), (80.0, None), (None, 1.0)]
    base, gap = c("b"), c("g")
    got = results(spark, rows, "b double, g double", durations.from_leader(base, gap), durations.from_leader(base, gap, strict=True))
    assert got == [(81.235, 81.235), (80.0, None), (None, None)]


def test_driver_and_code(spark):
    cases = {
        "Lando NorrisNOR": ("Lando Norris", "NOR"), "Lando Norris NOR": ("Lando Norris", "NOR"),
        "Lando Norris NOR ": ("Lando Norris", "NOR"), "Juan Fangio": ("Juan Fangio", None), "NOR": ("NOR", "NOR"), "": ("", None),
        None: (None, None),
    }
    got = results(spark, [(k,) for k in cases], "d string", text.driver_name(c("d")), text.driver_code(c("d")))
    assert got == list(cases.values())


def test_numbers(spark):
    whole = {"12": 12, "12.0": 12, " 7 ": 7, "12.5": None, "NC": None, "": None, None: None, "1e2": 100, "99999999999": None}
    assert column(spark, whole, lambda x: text.number(x, "int")) == list(whole.values())
    found = {"212,345 km/h": 212.345, "-3 of 4": -3.0, "none": None, "": None, None: None}
    assert column(spark, found, text.first_number) == list(found.values())


def test_text_rules(spark):
    assert column(spark, [" Max V ", None], text.plain_spaces) == ["Max V", None]
    assert column(spark, [" Time  /  RETIRED\n"], text.normal) == ["time / retired"]
    assert column(spark, ["* Car 5 * x", None], text.without_stars) == ["Car 5  x", None]
    assert column(spark, ["N/A", " - ", "dnf", "1:2"], lambda x: text.known_text(x, "dnf")) == [None, None, None, "1:2"]
    assert column(spark, ["Sorry, NO Results available", "x"], lambda x: text.mentions(x, "no results available")) == [True, False]
    rows = [(" +1.2",), ("1:20",), (None,)]
    assert results(spark, rows, "x string", text.time_part(c("x")), text.gap_part(c("x"))) == [
        (None, " +1.2"), ("1:20", None), (None, None)
    ]


def test_urls(spark):
    url = "https://r.example.org/en/results/2021/races/1064/bahrain/race-result"
    got = results(
        spark, [(url,), (url + "/",), ("https://r.example.org/x",), ("",), (None,)], "u string",
        links.race_id(c("u")), links.event_slug(c("u")), links.parent_slug(c("u")), links.session_url(c("u"), "qualifying/0"),
    )
    base = url.rsplit("/", 1)[0]
    assert got[0] == (1064, "bahrain", "bahrain", base + "/qualifying/0")
    assert got[1][:3] == (1064, "bahrain", "bahrain")
    assert got[2] == (None, None, "r.example.org", "https://r.example.org/qualifying/0")
    assert got[3] == (None, None, None, None)
    assert got[4] == (None, None, None, None)
    assert column(spark, [url], lambda u: links.practice_url(u, 3)) == [base + "/practice/3"]
    with pytest.raises(ValueError):
        links.practice_url(c("u"), 4)


def test_absolute_links(spark):
    page = "https://h.example.org/a/b?q=1#f"
    cases = {
        "https://x.org/y": "https://x.org/y", "//x.org/y": "https://x.org/y", "/y": "https://h.example.org/y",
        "y/z": "https://h.example.org/a/y/z", "?p=2": "https://h.example.org/a/b?p=2", "#t": "https://h.example.org/a/b?q=1#t",
        "": page,
    }
    assert column(spark, cases, lambda h: links.absolute(F.lit(page), h)) == list(cases.values())
    assert column(spark, ["y"], lambda h: links.absolute(F.lit("https://h.example.org"), h)) == ["https://h.example.org/y"]
    assert column(spark, ["u/a.png?web=1", "u/a.png"], links.download_link) == ["u/a.png?download=1", "u/a.png"]


def test_positions_and_statuses(spark):
    rows = [
        (None, "Finished", "1:30", 50), (None, "Finished", "SHC", 50), (None, "Finished", "SHC", None), (None, "Finished", None, 50),
        (None, "DNF", "DNF", 3), (3, "Finished", "+5.1s", 50),
    ]
    label = rules.race_position(c("p"), c("s"), c("t"))
    sprint = rules.sprint_position(c("p"), c("s"))
    got = results(
        spark, rows, "p int, s string, t string, l int",
        label, rules.race_status(label, c("s"), c("t"), c("l")), sprint, rules.sprint_status(sprint, c("s")),
    )
    assert got == [
        ("DQ", "DSQ", "DQ", "DSQ"), ("NC", "Finished", "DQ", "DSQ"), ("NC", "SHC", "DQ", "DSQ"), ("NC", "Finished", "DQ", "DSQ"),
        ("NC", "DNF", "NC", "DNF"), ("3", "Finished", "3", "Finished"),
    ]
    assert column(spark, [None, 4], rules.classified_position, "int") == ["NC", "4"]
    assert column(spark, [" DNF", "DSQ", "1:30", None], rules.raw_status) == ["DNF", "DSQ", "Finished", "Finished"]


def test_time_label(spark):
    rows = [("OK", "Finished", 12.345), ("OK", "DNF", None), ("OK", "Finished", None), ("OK", None, 1.0), ("+1 lap", "Finished", 2.0)]
    got = results(spark, rows, "t string, s string, g double", rules.time_label(c("t"), c("s"), c("g")))
    assert got == [("12.345",), ("DNF",), (None,), ("OK",), ("+1 lap",)]


def test_points_repair(spark):
    rows = [(0.0, 2, 2021), (0.0, 11, 2021), (0.0, 2, 1990), (0.0, None, 2021), (18.0, 2, 2021), (0.0, 10, 2010), (0.0, 0, 2021)]
    flag = rules.race_repair(c("p"), c("n"), c("s"))
    got = results(spark, rows, "p double, n int, s int", flag, rules.repaired(flag, rules.race_points(c("n")), c("p")))
    assert got == [("Y", 18.0), ("N", 0.0), ("N", 0.0), ("N", 0.0), ("N", 18.0), ("Y", 1.0), ("Y", 0.0)]
    flag = rules.sprint_repair(c("p"), c("n"), c("s"))
    rows = [(0.0, 8, 2022), (0.0, 9, 2022), (0.0, 8, 2021)]
    got = results(spark, rows, "p double, n int, s int", flag, rules.repaired(flag, rules.sprint_points(c("n")), c("p")))
    assert got == [("Y", 1.0), ("N", 0.0), ("N", 0.0)]


def test_race_dates(spark):
    cases = {
        "28 Mar": ("MAR", 3, 28, dt.date(2021, 3, 28)), "05 ENE": ("ENE", 1, 5, dt.date(2021, 1, 5)),
        "26 - 28 Mar": ("MAR", 3, 26, dt.date(2021, 3, 26)), "abc": ("ABC", None, None, None),
        "30 Feb": ("FEB", 2, 30, None), "Mar": ("MAR", 3, None, None), None: (None, None, None, None),
    }
    month, day = dates.month_abbreviation(c("x")), dates.leading_day(c("x"))
    number = dates.month_number(month)
    got = results(spark, [(k,) for k in cases], "x string", month, number, day, dates.date_of(F.lit(2021), number, day))
    assert got == list(cases.values())


def test_calendar_rules(spark):
    rows = [(dt.date(2021, 1, 1),), (dt.date(2024, 2, 29),), (dt.date(2021, 8, 1),)]
    d = c("d")
    got = results(
        spark, rows, "d date", dates.iso_weekday(d), dates.week_of_month(d), F.weekofyear(d), dates.week_start(d), dates.week_end(d),
        dates.period_key(d), dates.month_name(d), dates.month_short(d), dates.day_name(d), dates.day_short(d), dates.report_day(d),
    )
    assert got[0] == (5, 1, 53, dt.date(2020, 12, 28), dt.date(2021, 1, 3), 2021001, "January", "Jan", "Friday", "Fri", "01 Jan")
    assert got[1] == (4, 5, 9, dt.date(2024, 2, 26), dt.date(2024, 3, 3), 2024002, "February", "Feb", "Thursday", "Thu", "29 Feb")
    assert got[2][:2] == (7, 1)
