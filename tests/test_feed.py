from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import bag
from ledgerline.functions.times import entry_time
from ledgerline.functions.titles import is_filing_title, title_groups
from ledgerline.operators import feed
from ledgerline.sources.feed import land_feed, read_feed

TITLES = {
    "8-K - ACME INC (0000000001) (Filer)": ("8-K", "ACME INC", "0000000001"),
    "8-K - A - B (1) (Filer)": ("8-K - A", "B", "1"),
    "8-K - Q (Del) (0001) (Filer)": ("8-K", "Q (Del)", "0001"),
    "8-K - A (1) (F) (G)": ("8-K", "A (1)", "F"),
    "8-K - A B (1) (F)": ("8-K", "A B", "1"),
    "8-K - A\rB (1) (F)": ("8-K", "A\rB", "1"),
    "10-K - A (1) (F - x)": ("10-K", "A", "1"),
    " - A (1) (F)": ("", "A", "1"),
    "8-K -  () ()": ("8-K", "", ""),
    "x\n8-K - A (1) (F)\n10-K - B (2) (F)": ("8-K", "A", "1"),
    "8-K - $1 \\2 (1) (F)": ("8-K", "$1 \\2", "1"),
    "x (1) (F)": None,
    "8-K - A\n(1) (F)": None,
    "": None,
    "a\nb\nc": None,
}


def test_titles(spark):
    df = spark.createDataFrame([(title,) for title in TITLES], "title string")
    groups = title_groups(F.col("title"))
    got = {row[0]: tuple(row[1]) if row[2] else None
           for row in df.select("title", groups, is_filing_title(groups)).collect()}
    assert got == TITLES


@pytest.mark.parametrize("text, expected", [
    ("2019-02-22T17:29:01-05:00", "2019-02-22 22:29:01"),
    ("2019-02-22T17:29:01Z", "2019-02-22 17:29:01"),
    ("2019-02-22T17:29:01+05:30", "2019-02-22 11:59:01"),
    (" 2019-02-22T17:29:01.75Z ", "2019-02-22 17:29:01"),
    ("2019-02-22", "2019-02-22 00:00:00"),
    ("2019-02-30T00:00:00Z", None),
    ("12:30", None),
    ("soon", None),
    (None, None),
])
def test_entry_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(entry_time(F.col("t"))).first()[0] == expected


ENTRIES = [
    ("1", "8-K - ACME INC (0000000001) (Filer)", "https://x/1", "2019-02-22T17:29:01-05:00"),
    ("2", "8-K - A & \"B\" <C> (2) (Filer)", "https://x/2?a=1&b=2", "2019-02-23T00:00:00Z"),
    ("3", "8-K - ACME INC (1) (Filer)", None, "2019-02-22T17:29:01-05:00"),
    ("4", "x (1) (F)", "https://x/4", "2019-02-22T17:29:01-05:00"),
    ("5", "8-K - ACME INC (1) (Filer)", "https://x/5", "soon"),
    ("6", None, "https://x/6", "2019-02-22T17:29:01-05:00"),
]
SCHEMA = "entry_id string, title string, link string, updated string"


def test_parse_and_reject(spark):
    entries = spark.createDataFrame(ENTRIES, SCHEMA)
    assert bag(feed.parse_entries(entries, "entry_id")) == [
        ("1", "ACME INC", "8-K", "0000000001", "2019-02-22 22:29:01", "https://x/1"),
        ("2", 'A & "B" <C>', "8-K", "2", "2019-02-23 00:00:00", "https://x/2?a=1&b=2"),
    ]
    assert bag(feed.rejected_entries(entries).select("entry_id", "reason")) == [
        ("3", "no_link"), ("4", "bad_title"), ("5", "bad_time"), ("6", "bad_title"),
    ]


def test_feed_files_round_trip(spark, folder):
    entries = spark.createDataFrame(ENTRIES, SCHEMA)
    path = folder("feed")
    land_feed(entries, path)
    assert bag(read_feed(spark, path).select(*entries.columns)) == bag(entries)


def test_feed_with_several_links(spark, folder, tmp_path):
    (tmp_path / "feed.xml").write_text(
        '<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'
        '<entry><title>8-K - A (1) (F)</title><link rel="self" href="/s"/><link rel="alternate" href="/a"/>'
        "<updated>2019-02-22T17:29:01Z</updated><id>urn:1</id><summary>no</summary></entry>"
        '<entry><title>8-K - B (1) (F)</title><link href="/b"/><id>urn:2</id></entry>'
        "<entry><title>8-K - C (1) (F)</title><id>urn:3</id></entry></feed>"
    )
    got = read_feed(spark, str(tmp_path)).select("entry_id", "link", "updated")
    assert bag(got) == [("urn:1", "/a", "2019-02-22T17:29:01Z"), ("urn:2", "/b", None), ("urn:3", None, None)]


def test_title_pattern_runs_once_per_use(spark):
    entries = spark.createDataFrame(ENTRIES, SCHEMA)
    plan = feed.parse_entries(entries)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert plan.count("try_to_timestamp") <= 1 or plan.count("date_format(") == 1


def test_latest_page(spark):
    rows = [(f"{n:02d}", "c", "f", f"{n % 7}", f"2024-01-{n % 20 + 1:02d}", "u") for n in range(40)]
    filings = spark.createDataFrame(rows, "entry_id string, companyname string, formtype string, cik string, "
                                          "date string, inter_url string")
    page = [row["entry_id"] for row in feed.latest_page(filings, 4, "entry_id").collect()]
    assert page == ["39", "19", "38", "18"]
