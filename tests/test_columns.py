import datetime as dt

import pytest
from pyspark.sql import functions as F

from statloom.functions import events, periods, text, times, values
from statloom.operators.selection import parse_selection


def each(spark, values, function, kind="string"):
    """The function of every value, in one job."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = frame.select("i", function(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows, key=lambda r: r.i)]


def one(spark, value, function, kind="string"):
    return each(spark, [value], function, kind)[0]


def columns_of(cases):
    return [list(column) for column in zip(*cases)]


@pytest.mark.parametrize("function, cases", [
    (periods.month_end, [
        ("2021M06", dt.date(2021, 6, 30)), ("2020M02", dt.date(2020, 2, 29)), ("2021M6", dt.date(2021, 6, 30)),
        ("2021M13", None), (None, None),
    ]),
    (periods.month_start, [("2021M06", dt.date(2021, 6, 1))]),
    (periods.quarter_end, [("2021Q2", dt.date(2021, 6, 30)), ("2021Q5", None)]),
    (periods.quarter_start, [("2021Q2", dt.date(2021, 4, 1))]),
    (periods.year_end, [("2021", dt.date(2021, 12, 31)), ("2021M06", None)]),
    (periods.reformat_month, [("2021M06", "01/06/2021")]),
    (periods.period_kind, [
        ("2021M06", "M"), ("2021Q2", "Q"), ("2021", "Y"), ("x2021M06 y", "M"), ("total", None), ("2021M6", "Y"),
    ]),
])
def test_periods(spark, function, cases):
    given, expected = columns_of(cases)
    assert each(spark, given, function) == expected


def test_formats():
    assert periods.spark_pattern("%YM%m") == "yyyy'M'M"
    assert periods.spark_pattern("%d/%m/%Y", printing=True) == "dd/MM/yyyy"
    with pytest.raises(ValueError):
        periods.spark_pattern("%j")


def test_yesterday_month(spark):
    assert one(spark, dt.date(2021, 9, 1), periods.yesterday_month, "date") == "Aug 2021"


def test_cells(spark):
    cells, numbers, statuses = columns_of([
        ("1,234 P", 1234.0, "P"), ("..", None, "F"), (None, None, "F"), ("1d", None, "F"), ("NaN", None, "F"),
        ("Inf", None, "F"), ("0x1F", None, "F"), ("-1.5e3 C", -1500.0, "C"), (".5", 0.5, "F"), ("7 ", 7.0, "F"),
        (" 7 P", 7.0, "P"), ("5 P R", 5.0, "P"), ("7  P", 7.0, ""), ("", None, "F"), (".. C", None, "C"),
    ])
    assert each(spark, cells, values.cell_value) == numbers
    assert each(spark, cells, values.cell_status) == statuses


def test_cells_split_once(spark):
    cells, texts, statuses = columns_of([
        ("5 P R", "5", "P R"), ("5", "5", None), ("..", None, None), ("1,234 P", "1,234", "P"), (None, None, None),
    ])
    assert each(spark, cells, values.cell_value_text) == texts
    assert each(spark, cells, values.cell_status_rest) == statuses


def test_selection_texts(spark):
    given, *expected = columns_of([
        ("ALL", "ALL", None, None), ("USE_LATEST_DATETIME<%YM%m>", "LATEST", "%YM%m", None),
        ("<2013M01>UNTIL_LATEST_DATETIME<%YM%m>", "FROM", "%YM%m", "2013M01"), ("2013M01", None, None, None),
        ("x USE_LATEST_DATETIME<%YM%m>", None, None, None),
    ])
    assert list(map(tuple, each(spark, given, parse_selection))) == list(zip(*expected))


def test_labels(spark):
    row = spark.createDataFrame([("a/b", None)], "x string, y string").select(
        text.label_key(F.col("x"), F.col("y")).alias("key"),
        text.dataset_slug(F.col("x"), F.lit("c")).alias("slug"),
        text.strip_suffix(F.lit("Napier (sea)"), " (sea)").alias("port"),
    ).first()
    assert tuple(row) == ("a/b__NA", "a b__c", "Napier")


def test_footnote(spark):
    html = '<td class="footnote">\n<b>Note</b>:&nbsp;a &amp;lt; b<br/><br/>End  </td>'
    assert one(spark, html, text.footnote_text) == "Note\n:\xa0a &lt; b\nEnd\n"


def test_captured_number(spark):
    pattern = r"List__ctl(\d+)_Label"
    assert one(spark, "List__ctl07_Label", lambda c: text.captured_number(c, pattern)) == "07"
    assert one(spark, "xList__ctl07_Label", lambda c: text.captured_number(c, pattern)) is None


def test_message(spark):
    filled = one(spark, "T", lambda c: text.message("{a}: {b}!", a=c, b=F.lit(None).cast("string")))
    assert filled == "T: None!"


BODY = 'files: a.csv\nFILES: b.csv\nurl: <a href="https://example.org/x">x</a>\nscript: <b>run.py</b>\n'


def test_event_bodies(spark):
    bodies, files, urls, scripts = columns_of([
        (BODY, ["a.csv", "b.csv"], "https://example.org/x", "run.py"), ("nothing here", [], None, None),
        ("url: no link\nscript:\n", [], None, ""), ("files: no line end", [], None, None),
    ])
    assert each(spark, bodies, events.body_files) == files
    assert each(spark, bodies, events.body_url) == urls
    assert each(spark, bodies, events.body_script) == scripts


def test_rollover(spark):
    days = [dt.date(2021, 9, day) for day in (17, 18, 19, 20)]  # Friday to Monday
    assert each(spark, days, times.rollover_days, "date") == [3, 1, 1, 1]
    assert each(spark, days, lambda c: times.rollover_days(c, skip_weekend=True), "date") == [3, 2, 1, 1]


@pytest.mark.parametrize("ts, zone, expected", [
    (dt.datetime(2024, 1, 1), "Pacific/Auckland", "2024-01-01T13:00:00+13:00"),
    (dt.datetime(2024, 7, 1, 0, 0, 0, 5), "Pacific/Auckland", "2024-07-01T12:00:00.000005+12:00"),
    (dt.datetime(2024, 1, 1), "America/St_Johns", "2023-12-31T20:30:00-03:30"),
    (dt.datetime(2024, 1, 1), "UTC", "2024-01-01T00:00:00+00:00"),
])
def test_iso_local(spark, ts, zone, expected):
    assert one(spark, ts, lambda c: times.iso_local(c, zone), "timestamp_ntz") == expected


def test_off_schedule(spark):
    summer, winter = dt.datetime(2024, 1, 1, 21, 45), dt.datetime(2024, 7, 1, 21, 45)
    assert one(spark, summer, times.off_schedule, "timestamp_ntz") is False
    assert one(spark, winter, times.off_schedule, "timestamp_ntz") is True
