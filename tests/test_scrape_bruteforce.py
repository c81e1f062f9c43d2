"""The scrape on hand-written pages with the rows they must give."""

import datetime as dt

import pytest

from aerostar.plans import scrape
from aerostar.sources import attribute, attributes, element_text, elements_text

ITEM = ('<span class="dep" aria-label="Departure time: {dep}."></span><span class="arr" aria-label="Arrival time: {arr}."></span>'
        '<div class="al">{al}</div><div class="st">{st}</div>{fare}<div class="du">{du}</div><div class="from">{a}</div><div class="to">{b}</div>')
FARE = '<span role="text" aria-label="{0} US dollars">${0}</span>'


def page(cabin, date, *items):
    return f'<html><div class="cabin">{cabin}</div><input class="date" value="{date}"><ul>{"".join(items)}</ul></html>'


def item(dep, arr, al, st, fare, du, a="HAN", b="SGN"):
    return ITEM.format(dep=dep, arr=arr, al=al, st=st, fare=fare, du=du, a=a, b=b)


PAGES = [
    (1, page("Economy", "Wed, Jan 1",
             item("9:05 AM", "11:40 PM", "Delta\n, X", "Nonstop", FARE.format("1,234"), "2 hr 29\nmin"),
             item("12:00 PM", "1:00 AM", " Solo ", "1 stop", FARE.format("80"), "3 hr"),
             item("1:15 AM", "2:00 AM", " A, B", "Nonstop", "", "45 min"))),
    (2, page("Premium economy", "Fri, Feb 30", item("1:00 PM", "2:00 PM", "Q", "Nonstop", FARE.format("7"), "soon"))),
    (3, page("Economy", "Thu, Dec 4")),
    (4, page("Economy", "Thu, Dec 4", item("1:00 PM", "2:00 PM", "Q", "Nonstop", FARE.format("7") + FARE.format("8"), "1 hr"))),
]
D = dt.date
ROWS = [
    (1, D(2025, 1, 1), "HAN", "SGN", 1, 0, 1, "1,234", "Delta", "2.48", "9:05 AM", "11:40 PM", 1),
    (1, D(2025, 1, 1), "HAN", "SGN", 1, 0, 0, "80", "Solo", "3.00", "12:00 PM", "1:00 AM", 2),
    (2, None, "HAN", "SGN", 0, 0, 1, "7", "Q", None, "1:00 PM", "2:00 PM", 1),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, html string")


def test_rows_of_the_pages(spark, pages):
    got = [tuple(r) for r in scrape.scraped_flights(pages, divert=True).orderBy("page_id", "flightKey").collect()]
    assert got == ROWS  # the fare-less third flight is dropped, its key stays taken


def test_strict_durations(spark, pages):
    got = scrape.scraped_flights(pages, divert=True, strict_duration=True).orderBy("page_id", "flightKey").collect()
    assert [r.travelDuration for r in got] == ["2.48", "3.00", None]


def test_surplus_fares_are_rejected_and_fail_a_job_that_does_not_divert(spark, pages):
    assert [tuple(r) for r in scrape.page_rejects(pages).collect()] == [(4, 1, 2)]
    with pytest.raises(Exception, match="differ in length"):
        scrape.scraped_flights(pages).collect()


def test_table_wide_key(spark, pages):
    got = scrape.scraped_flights(pages, divert=True, table_key=True).orderBy("page_id", "flightKey").collect()
    assert [(r.page_id, r.flightKey) for r in got] == [(1, 1), (1, 2), (2, 4)]


def test_rules_for_other_markup(spark):
    html = ('<html><div data-a="1" class="x cabin y"><b>Economy</b></div><input value="Wed, Jan 1" class="d date">'
            '<span aria-label="Departure time: 9:05 AM." id="s"></span><span title="t" aria-label="Arrival time: 10:00 AM."></span>'
            '<div class="big al"><i>Air</i> &amp; Co&#44; B</div><div class="st">Non<b>stop</b></div>'
            '<span aria-label="about 90 US dollars" role="text">&#36;90</span>'
            '<div class="du">1&nbsp;hr 30&#160;min</div><div class="from">A&lt;1</div><div class="to">B</div></html>')
    rules = {"cabin": element_text("div", "cabin"), "date_label": attribute("input", "value", "date"),
             "dep": attributes("span", "aria-label", aria_label="Departure time:"), "arr": attributes("span", "aria-label", aria_label="Arrival time:"),
             "airline": elements_text("div", "al"), "stops": elements_text("div", "st"), "fare": elements_text("span", aria_label="US dollars"),
             "duration": elements_text("div", "du"), "from_ap": elements_text("div", "from"), "to_ap": elements_text("div", "to")}
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [tuple(r) for r in scrape.scraped_flights(df, rules=rules).collect()]
    assert got == [(1, D(2025, 1, 1), "A<1", "B", 1, 0, 1, "90", "Air & Co", "1.50", "9:05 AM", "10:00 AM", 1)]
