import datetime as dt

import pytest
from pyspark.sql import functions as F

from statloom.plans import releases
from statloom.operators import history, recurrence
from statloom.sources.calendar import read_ics, read_ics_series
from statloom.sources.html import css_path, element_text, has_element, html_tables, page_xml
from statloom.sources.selectors import find_all

RULES = "rule_id string, url string, text_template string, date_str string, selector_kind string, selector string"
PAGE = '<html><body><h2 id=a>News<p class="x big">Data to <b>August 2021</b><p>other<br>line</body>'


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("u", PAGE), ("v", "<p>nothing")], "url string, html string")


@pytest.mark.parametrize("rule, updated, info", [
    (("no place", "August 2021", "xpath", "//p"), None, releases.template_check.__globals__["TEMPLATE_ERROR"]),
    (("<date_str> <date_str>", "August 2021", "xpath", "//p"), None, "text_template must contain exactly one '<date_str>' substring"),
    (("to <date_str>", "August 2021", "both", "//p"), None, "Exactly one of xpath or css must be specified"),
    (("to <date_str>", "August 2021", "xpath", ""), None, "Exactly one of xpath or css must be specified"),
    (("to <date_str>", "August 2021", "xpath", "//h6"), None, "Could not find HTML element according to xpath"),
    (("to <date_str>", "August 2021", "css", "#nope"), None, "Could not find HTML element according to css"),
    (("from <date_str>", "August 2021", "xpath", "//p"), None, "text_template is not valid for the HTML element"),
    (("to <date_str>", "August 2021", "xpath", "//p[1]"), True, "Data to August 2021"),
    (("to <date_str>", "July 2021", "xpath", "//p[1]"), False, "Data to August 2021"),
    (("to <date_str>", "August 2021", "css", "p.big"), True, "Data to August 2021"),
    (("to <date_str>", "August 2021", "xpath", "//h2[@id='a']/p[1]/b/.."), True, "Data to August 2021"),
    # The date is text, not a pattern.
    (("to <date_str>", "A.* 2021", "xpath", "//p[1]"), False, "Data to August 2021"),
])
def test_check_pages(spark, pages, rule, updated, info):
    rules = spark.createDataFrame([("r", "u", *rule)], RULES)
    assert tuple(releases.check_pages(rules, pages).first()) == ("r", updated, info)


def test_date_as_a_pattern(spark, pages):
    rules = spark.createDataFrame([("r", "u", "to <date_str>", "A.* 2021", "xpath", "//p[1]")], RULES)
    assert releases.check_pages(rules, pages, raw_regex=True).first().updated is True


def test_rule_without_its_page(spark, pages):
    rules = spark.createDataFrame([("r", "w", "to <date_str>", "x", "xpath", "//p"),
                                   ("s", "u", "to <date_str>", "August 2021", "xpath", "//p")], RULES)
    found = {r.rule_id: r.updated for r in releases.check_pages(rules, pages).collect()}
    assert found == {"r": None, "s": True}


def test_pages_are_closed(spark):
    soup = '<!DOCTYPE html><p>a & b<p x=1 x=2 bad!name>c<br><img src="i"></b><script>if (a<b) "</p>"</script><ul><li>1<li>2'
    frame = spark.createDataFrame([(soup,), (None,), ("",), ("\x00￾<p>z",)], "html string")
    rows = frame.select(page_xml("html").alias("x")).select(
        "x", has_element(F.col("x"), "//li[2]").alias("has"), element_text(F.col("x"), "//p[2]/@x").alias("x_attr"),
        element_text(F.col("x"), "//ul/li[1]").alias("li"), element_text(F.col("x"), "//p").alias("p"),
    ).collect()
    assert rows[0].has and rows[0].x_attr == "1" and rows[0].li == "1" and rows[0].p == "a & b"
    assert rows[1].x is None and rows[2].x == "<page></page>" and rows[3].p == "z"


def test_css():
    assert css_path("h1") == "//h1" and css_path("#a") == "//*[@id='a']"
    for selector in ("", "a >", "> a", "a,,b", "a:hover", "[x", "a!", "p::before"):
        with pytest.raises(ValueError):
            css_path(selector)


@pytest.mark.parametrize("selector, text", [
    ("div p", "one"), ("div > p", "two"), ("UL LI:last-child", "c"), ("li:nth-child(2)", "b"), ("li:first-child", "a"),
    ("h1 + p", None), ("h1 ~ p", "three"), ("h1 + div > p", "two"), ("li + li + li", "c"), ("[data-x]", "two"),
    ("p[data-x='y z']", "two"), ('[data-x~="z"]', "two"), ("[data-x^=y]", "two"), ('p[data-x$=" z"]', "two"),
    ("[data-x*=z]", "two"), ("[lang|=en]", "three"), ("[data-x^='']", None), ("#l > .k.m", "b"), ("b, h1", "title"),
    ("p.nope, li", "a"), ("*", "titleonetwoabcthree"),
])
def test_css_finds(spark, selector, text):
    page = ("<h1>title</h1><div><section><p>one</p></section><p data-x='y z'>two</p>"
            "<ul id=l><li>a</li><li class='k m'>b</li><li>c</li></ul></div><p lang=en-NZ>three</p>")
    xml = page_xml(F.lit(page))
    path = css_path(selector)
    found = spark.range(1).select(has_element(xml, path).alias("has"), element_text(xml, path).alias("text")).first()
    assert (found.has, found.text or None) == (text is not None, text)


def test_tables(spark):
    html = ('<!-- <table class="t"><tr><td>no --><script>"<table class=t>"</script><b title="<table class=t>">'
            '<table class="t"><tr><th data-class="x" rowspan="2">A<th title=5" colspan=2>B &amp; C<tr><td>1<td> 2\n 2 </table>'
            '<table><tr><td>x</table><table class="t"><td>in<table class="t"><tr><td>inner</table></table>')
    frame = spark.createDataFrame([(7, html), (8, None)], "id int, html string")
    cells = {(r.table_no, r.row, r.col): r.text for r in html_tables(frame, "id", "html", "t").collect()}
    assert cells == {
        (0, 0, 0): "A", (0, 0, 1): "B & C", (0, 0, 2): "B & C", (0, 1, 0): "A", (0, 1, 1): "1", (0, 1, 2): "2 2",
        (1, 0, 0): "in", (2, 0, 0): "inner",
    }
    assert html_tables(frame, "id", "html").where("table_no = 1").first().text == "x"


ICS = (
    "BEGIN:VCALENDAR\r\nVERSION:2.0\r\n"
    "BEGIN:VEVENT\r\nUID:1\r\nSUMMARY:Long\\, fol\r\n ded name\r\nDTSTART;TZID=Pacific/Auckland:20210915T104500\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nDTSTART:20210914T224500Z\r\nSUMMARY;LANGUAGE=en:B\r\nUID:2\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nUID:3\r\nSUMMARY:C\r\nDTSTART;VALUE=DATE:20210915\r\nEND:VEVENT\r\n"
    "BEGIN:VEVENT\r\nUID:4\r\nSUMMARY:B\r\nDTSTART:20210915T110000\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n"
)


def test_ics(spark, tmp_path):
    (tmp_path / "a.ics").write_text(ICS, newline="")
    (tmp_path / "b.ics").write_text(ICS.replace("UID:", "UID:b").replace("\r\n", "\n"), newline="")
    events = read_ics(spark, str(tmp_path)).collect()
    assert {(e.uid, e.name, e.begin) for e in events if not e.uid.startswith("b")} == {
        ("1", "Long, folded name", dt.datetime(2021, 9, 14, 22, 45)), ("2", "B", dt.datetime(2021, 9, 14, 22, 45)),
        ("3", "C", dt.datetime(2021, 9, 14, 12, 0)), ("4", "B", dt.datetime(2021, 9, 14, 23, 0)),
    }
    assert {e.uid for e in events} == {"1", "2", "3", "4", "b1", "b2", "b3", "b4"}
    services = spark.createDataFrame([("B",), ("Z",)], "name string")
    # The day is the local one: both events are on the 14th in UTC.
    due = releases.due_releases(read_ics(spark, str(tmp_path / "a.ics")), services, F.lit("2021-09-15").cast("date"))
    assert {(r.uid, r.off_schedule) for r in due.collect()} == {("2", False), ("4", True)}


def test_event_window(spark):
    day = dt.datetime(2021, 9, 15)
    rows = [(i, day + dt.timedelta(days=d, seconds=s), day + dt.timedelta(days=e))
            for i, (d, s, e) in enumerate([(-1, 0, 0), (-1, 1, 0), (0, 0, 1), (1, 0, 1.9), (1, 0, 2), (0, 0, 3)])]
    events = spark.createDataFrame(rows, "id int, start_dt timestamp_ntz, end_dt timestamp_ntz")
    kept = releases.event_window(events, F.lit("2021-09-15").cast("date"), 1, zone="UTC").collect()
    assert [r.id for r in kept] == [1, 2, 3]
    for days in (0, -1, 1.5, True, "1"):
        with pytest.raises(ValueError):
            releases.event_window(events, F.current_date(), days)


def test_next_releases_are_sorted_by_time(spark):
    events = spark.createDataFrame(
        [("b", "t", dt.datetime(2021, 9, 25, 14), dt.datetime(2021, 9, 25, 15), "files: x\n"),
         ("a", "t", dt.datetime(2021, 9, 25, 12), dt.datetime(2021, 9, 25, 13), "")],
        "ical_uid string, title string, start_dt timestamp_ntz, end_dt timestamp_ntz, body string",
    )
    rows = releases.next_releases(events, F.lit("2021-09-25").cast("date"), 1).collect()
    assert [(r.ical_uid, r.release_dt, r.files) for r in rows] == [
        ("a", "2021-09-26T00:00:00+12:00", []), ("b", "2021-09-26T03:00:00+13:00", ["x"]),
    ]


def test_local_midnights_bound_the_window(spark):
    day = dt.datetime(2021, 9, 13, 12)  # midnight of the 14th in Auckland
    rows = [(i, day + dt.timedelta(minutes=m)) for i, m in enumerate((0, 1, 60, 3 * 1440 - 61, 3 * 1440 - 60))]
    events = spark.createDataFrame(rows, "id int, start_dt timestamp_ntz").withColumn("end_dt", F.col("start_dt") + F.expr("interval 1 hour"))
    kept = releases.event_window(events, F.lit("2021-09-15").cast("date"), 1)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3]


def test_calendar_escapes_and_zones(spark, tmp_path):
    (tmp_path / "a.ics").write_text("".join(
        f"BEGIN:VEVENT\r\nUID:{uid}\r\nSUMMARY:{name}\r\nDTSTART{start}\r\nEND:VEVENT\r\n" for uid, name, start in [
            ("1", "C:\\\\new\\Nline\\, end", ";TZID=New Zealand Standard Time:20210915T104500"),
            ("2", "x", ";TZID=Nowhere Time:20210915T104500"), ("3", "y", ":2021")]))
    rows = {r.uid: r for r in read_ics(spark, str(tmp_path)).collect()}
    assert rows["1"].name == "C:\\new\nline, end" and rows["1"].begin == dt.datetime(2021, 9, 14, 22, 45) and rows["1"].error is None
    assert rows["2"].begin is None and rows["2"].error == "unknown zone: Nowhere Time"
    assert rows["3"].begin is None and rows["3"].error == "not a time: 2021"


SELECTORS = [
    "//li[2]/a", "//ul/li[last()]", "//li[position() > 1][1]", "//article/p[2]", "//article//p[last()]",
    "//*[@href='/b']/..", "//a[text()='two']/../..//b[@class='k m']", "//h2[text() = 'News']/../p[@class='x']", "//p[b]", "//p[not(b)]",
    "//p[contains(., 'August')]", "//p[starts-with(normalize-space(.), 'x y')]", "//li[a/@href='/c']/preceding-sibling::li[1]",
    "//li/following-sibling::li", "//b/ancestor::div[1]", "//b/ancestor-or-self::*[2]", "//section/descendant::p[2]", "//p/following::b[1]",
    "//b/preceding::p[1]", "//p | //h1", "//nothing | //li", "//div[count(p) = 2]", "//div[p and not(ul)]", "//div[p or ul]/p[1]",
    "//p[string-length(.) > 12]", "//a[substring(@href, 2, 1) = 'c']", "//a[substring-after(@href, '/') = 'b']", "//a[concat('/', 'b') = @href]",
    "//p[@class != 'x']", "//p[@class]", "//li[a = 'two']", "//li[2]/self::li", "//li/self::p", "//ul[li[3]]", "//ul[count(li) >= 3]/li[3]",
    "//*[name() = 'h2']", "//li[(1 + 1)]", "//p[number('2')]", "//li[. = 'three']", "//li[translate(., 'th', 'TH') = 'THree']", "//div//ul//a",
    "//p[2]", "//section//p[2]", "//br/..", "//li[position() = last() - 1]", "//div/*[1]", "//div/*[2]/..", "//p[true()]", "//p[false()]", "//p[@id='']",
]


def test_selectors_find_what_xpath_finds(spark):
    """Every selector against Spark's XPath functions, which take one constant path each."""
    page = ("<html><body><h1>Top</h1><div id=d><section><p class=x>Data to <b>August 2021</b> now<p>second<br>line<p class='y z'> x  y  z"
            "</section><div><h2>News</h2><p class=x>in news</p><p id=''>one</p></div><ul><li><a href='/a'>one</a><li><a href=/b>two</a></li>"
            "<li><a href='/c'>three</a></ul><p>tail <b class='k m'>bold</b></p></div><article><p>1</p><p>2<p>3 &amp; &lt;4</article>")
    xml = page_xml(F.lit(page))
    native = spark.range(1).select(*(F.struct(has_element(xml, s), element_text(xml, s)) for s in SELECTORS)).first()
    made = find_all(page, [("xpath", s) for s in SELECTORS])
    assert sum(found for found, _ in made) > 35
    for text, (found, value), (has, own) in zip(SELECTORS, made, native):
        assert (found, value) == (has, own if has else None), text


@pytest.mark.parametrize("text", ["", "//", "//p[", "//p]", "p//", "//p[foo()]", "//p[contains(.)]", "//p/@class", "//p/text()", "nope::p", "//p[1",
                                  "//p['a]", "//p[count('a')]", "$x", "//a b", "//p[@*]"])
def test_unsupported_selectors(text):
    assert find_all("<p class=x>a</p>", [("xpath", text), ("xpath", "//p")]) == [(None, None), (True, "a")]


def test_a_bad_selector_costs_its_own_rule(spark, pages):
    rules = [("a", "u", "to <date_str>", "August 2021", "xpath", "//p["), ("b", "u", "to <date_str>", "August 2021", "css", "p:hover"),
             ("c", "u", "to <date_str>", "August 2021", "xpath", "//p"), ("d", "v", "<date_str>", "nothing", "css", "p")]
    found = {r.rule_id: (r.updated, r.info) for r in releases.check_pages(spark.createDataFrame(rules, RULES), pages).collect()}
    assert found == {"a": (None, "Not a supported xpath selector: //p["), "b": (None, "Not a supported css selector: p:hover"),
                     "c": (True, "Data to August 2021"), "d": (True, "nothing")}


def test_selectors_of_any_number_are_one_pass(spark, monkeypatch):
    page = "".join(f"<p id='e{k}'>t{k}</p>" for k in range(500))
    rules = spark.range(500).select(F.concat(F.lit("r"), "id").alias("rule_id"), F.lit("u").alias("url"), F.lit("<date_str>").alias("text_template"),
                                    F.concat(F.lit("t"), "id").alias("date_str"), F.lit("css").alias("selector_kind"),
                                    F.concat(F.lit("#e"), "id").alias("selector"))
    made = releases.check_pages(rules, spark.createDataFrame([("u", page)], "url string, html string"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "#e1" not in plan
    assert [r.updated for r in made.collect()] == [True] * 500
    monkeypatch.setattr(releases, "SELECTORS_AT_ONCE", 60)
    assert [r.updated for r in releases.check_pages(rules, spark.createDataFrame([("u", page)], "url string, html string")).collect()] == [True] * 500


def test_many_selectors(spark):
    rules = spark.createDataFrame([(f"r{k}", "u", "<date_str>", f"t{k}", "css", f"#e{k}") for k in range(60)],
                                  "rule_id string, url string, text_template string, date_str string, selector_kind string, selector string")
    page = "".join(f"<p id='e{k}'>t{k}</p>" for k in range(60))
    found = releases.check_pages(rules, spark.createDataFrame([("u", page)], "url string, html string")).collect()
    assert len(found) == 60 and all(r.updated for r in found)


RRULES = [
    "FREQ=DAILY", "FREQ=DAILY;INTERVAL=3;COUNT=5", "FREQ=DAILY;BYDAY=MO,FR", "FREQ=DAILY;UNTIL=20210920", "FREQ=WEEKLY", "FREQ=WEEKLY;INTERVAL=2",
    "FREQ=WEEKLY;INTERVAL=3;BYDAY=SU,MO", "FREQ=WEEKLY;BYDAY=TU,TH;COUNT=7", "FREQ=MONTHLY", "FREQ=MONTHLY;BYMONTHDAY=31",
    "FREQ=MONTHLY;BYMONTHDAY=-1,1", "FREQ=MONTHLY;BYDAY=2TU", "FREQ=MONTHLY;INTERVAL=2;BYDAY=-1FR,1MO", "FREQ=MONTHLY;BYDAY=SU;COUNT=9",
    "FREQ=YEARLY", "FREQ=YEARLY;BYMONTH=9,10;BYMONTHDAY=15", "FREQ=MONTHLY;BYMONTH=10;BYMONTHDAY=5,6", "FREQ=DAILY;UNTIL=20210927T204500Z",
]


def test_occurrences(spark, tmp_path):
    """Rules against a library, over a change of the clock; exclusions, moved starts, and rules that say more."""
    from dateutil.rrule import rrulestr
    from zoneinfo import ZoneInfo

    zone, starts = ZoneInfo("Pacific/Auckland"), [dt.datetime(2021, 8, 31, 10, 45), dt.datetime(2021, 9, 6, 9, 45), dt.datetime(2020, 2, 29, 0, 0)]
    since, until = dt.datetime(2021, 9, 1), dt.datetime(2021, 11, 1)
    lines, expected = [], set()
    for k, (start, rule) in enumerate((s, r) for s in starts for r in RRULES):
        lines.append(f"BEGIN:VEVENT\nUID:{k}\nSUMMARY:s\nDTSTART:{start:%Y%m%dT%H%M%S}\nRRULE:{rule}\nEXDATE:20210913T104500,20210913T094500\nEND:VEVENT\n")
        plain = rule if not rule.endswith("Z") else rule[:-1].replace("20210927T204500", "20210928T094500")
        plain = plain.replace("UNTIL=20210920", "UNTIL=20210920T235959")
        for at in rrulestr(plain, dtstart=start).between(dt.datetime(2020, 1, 1), dt.datetime(2021, 12, 1), inc=True):
            utc = at.replace(tzinfo=zone).astimezone(dt.UTC).replace(tzinfo=None)
            if (at.date() != dt.date(2021, 9, 13) or not at.hour) and since <= utc < until:
                expected.add((str(k), "s", utc, None))
    moved = "BEGIN:VEVENT\nUID:0\nSUMMARY:moved\nDTSTART:20211005T120000\nRECURRENCE-ID:20211004T104500\nEND:VEVENT\n"
    other = "".join(f"BEGIN:VEVENT\nUID:x{k}\nSUMMARY:o\nDTSTART:{at}\n{rule}END:VEVENT\n" for k, (at, rule) in enumerate([
        ("20210915T000000Z", ""), ("20210915", ""), ("20200101", ""), ("20210915", "RRULE:FREQ=HOURLY\n"), ("20210915", "RRULE:FREQ=DAILY;BYSETPOS=1\n"),
        ("2021", "RRULE:FREQ=DAILY\n")]))
    expected.remove(("0", "s", dt.datetime(2021, 10, 3, 21, 45), None))
    expected |= {("0", "moved", dt.datetime(2021, 10, 4, 23, 0), None), ("x0", "o", dt.datetime(2021, 9, 15), None),
                 ("x1", "o", dt.datetime(2021, 9, 14, 12), None), ("x3", "o", None, "rule not supported: FREQ=HOURLY"),
                 ("x4", "o", None, "rule not supported: FREQ=DAILY;BYSETPOS=1"), ("x5", "o", None, "not a time: 2021")}
    (tmp_path / "a.ics").write_text("BEGIN:VCALENDAR\n" + "".join(lines) + moved + other + "END:VCALENDAR\n")
    found = recurrence.occurrences(read_ics_series(spark, str(tmp_path)), F.lit(since), F.lit(until)).collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == expected
    events = spark.createDataFrame(found, "uid string, name string, begin timestamp_ntz, error string").where("begin is not null and uid = '0'")
    days = history.single_occurrence(events, "uid", F.col("begin").cast("date"), "name").collect()
    assert {r.day.day: r.action for r in days if r.day.month == 10 and r.day.day in (3, 4, 5)} == {4: "ambiguous", 5: "cancel"}


def test_private_use_letters_stay(spark, tmp_path):
    (tmp_path / "a.ics").write_text("BEGIN:VEVENT\nUID:1\nSUMMARY:\ue000 a\\\\nb\\nc\\\\\\,d\nDTSTART:20210915\nEND:VEVENT\n")
    assert read_ics(spark, str(tmp_path)).first().name == "\ue000 a\\nb\nc\\,d"


def test_spans_without_bound(spark):
    """Large spans leave the task as they are made; a cell takes no column that an earlier one has."""
    pages = spark.createDataFrame([(1, "<table><tr><td rowspan=300 colspan=400>x<tr><td>y</table>"), (2, "<table><tr><td rowspan=99999999999999>z</table>")],
                                  "id int, html string")
    found = html_tables(pages.where("id = 1"), "id", "html")
    assert found.count() == 300 * 400 + 1 and found.where("text = 'y'").select("row", "col").first() == (1, 400)
    assert html_tables(pages.where("id = 2"), "id", "html").count() == 65_534


def test_a_calendar_is_read_once(spark, tmp_path):
    """The file may go when the occurrences have been asked for; days with a sign and without a number hold as they did."""
    path = tmp_path / "a.ics"
    path.write_text("BEGIN:VEVENT\r\nUID:a\r\nSUMMARY:s\r\nDTSTART:20240101T120000Z\r\nRRULE:FREQ=MONTHLY;BYDAY=+1MO,-1FR,3SU\r\nEND:VEVENT\r\n")
    since, until = (F.lit(dt.datetime(2024, m, 1)) for m in (1, 3))
    found = recurrence.occurrences(read_ics_series(spark, str(tmp_path)), since, until)
    path.write_text("")
    assert sorted(r.begin.date().isoformat() for r in found.collect()) == [
        "2024-01-01", "2024-01-21", "2024-01-26", "2024-02-05", "2024-02-18", "2024-02-23"]
