from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import functions as F

from conftest import bag, executed_plan, small_skew_thresholds
from ledgerline.functions.html import LinkSection, document_link
from ledgerline.operators import enrich
from ledgerline.plans.filings import store_links

TABLE = '<table class="a tableFile" summary="Document Format Files">'
BASE = "https://www.sec.gov"
PAGES = {
    TABLE + '<a href="/x"></a><a href="/y">t</a></table>': BASE + "/y",
    TABLE + '<a href="/x"> </a><a href="/y">t</a></table>': BASE + "/x",
    "<table class='tableFile' summary='Document Format Files'><a href='/sq'>t</a></table>": BASE + "/sq",
    '<table summary="Document Format Files" id="q" class="tableFile"><a href="/order">t</a></table>': BASE + "/order",
    '<TABLE summary="Document Format Files" CLASS=tableFile><A data-href="/no" HREF=/u?a=1&amp;b=2>t</A></TABLE>':
        BASE + "/u?a=1&b=2",
    TABLE + "<tr><td><a href='/b'><b>t</b></a></td></tr></table>": BASE + "/b",
    TABLE + '<a href="/e"><img src="i"></a>\n<a\nhref="/nl">t\nt</a></table>': BASE + "/nl",
    # The first table that fits is taken, whatever stands before it.
    '<table class="other"><a href="/o">o</a></table>' + TABLE + '<a href="/x">t</a></table>': BASE + "/x",
    '<table class="tableFileX" summary="Document Format Files"><a href="/x">t</a></table>': None,
    '<table class="tableFile" summary="Data Files"><a href="/x">t</a></table>': None,
    # Nested tables neither end the section nor hide their links.
    TABLE + '<table><tr></tr></table><a href="/n">t</a></table><a href="/z">q</a>': BASE + "/n",
    TABLE + '<table><a href="/in">t</a></table><a href="/n">t</a></table>': BASE + "/in",
    TABLE + '<table><table></table></table></table><a href="/z">q</a>': None,
    TABLE + '</table><a href="/z">q</a>': None,
    TABLE + '<a href="/open">t</a>': BASE + "/open",
    TABLE + '<a name="n">t</a><a href="/q">z</a></table>': None,
    "<!-- " + TABLE + '<a href="/c">c</a></table> -->' + TABLE + '<a href="/d">d</a></table>': BASE + "/d",
    "<script>var t='" + TABLE + "<a href=\"/s\">s</a>';</script>" + TABLE + '<a href="/t">t</a></table>': BASE + "/t",
    "<p>": None,
    "": None,
}


class Links(HTMLParser):
    """The same search with an HTML parser, one page at a time; for comparison only."""

    def __init__(self, page):
        super().__init__()
        self.depth, self.over, self.anchor, self.found = 0, False, None, None
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        if tag == "table" and not self.over:
            fits = "tableFile" in (named.get("class") or "").split() and named.get("summary") == "Document Format Files"
            if self.depth > 0 or fits:
                self.depth += 1
        elif tag == "a" and self.depth > 0:
            self.anchor = [named.get("href"), ""]

    def handle_data(self, data):
        if self.anchor:
            self.anchor[1] += data

    def handle_endtag(self, tag):
        if tag == "a" and self.anchor:
            if self.anchor[1] and self.found is None:
                self.found = self.anchor
            self.anchor = None
        elif tag == "table" and self.depth > 0:
            self.depth -= 1
            self.over = self.depth == 0

    @property
    def link(self):
        return BASE + self.found[0] if self.found and self.found[0] else None


def links(spark, pages, section=LinkSection()):
    df = spark.createDataFrame([(page,) for page in pages], "html string")
    return {row[0]: row[1] for row in df.select("html", document_link(F.col("html"), section)).collect()}


def test_document_link(spark):
    assert links(spark, PAGES) == PAGES


def test_document_link_like_a_parser(spark):
    assert {page: Links(page).link for page in PAGES} == PAGES


def test_section_is_a_parameter(spark):
    page = '<nav><a href="/a">x</a></nav><div class="docs"><a href="/b">x</a></div>'
    assert links(spark, [page], LinkSection("nav", None, None))[page] == BASE + "/a"
    assert links(spark, [page], LinkSection("div", "docs", None))[page] == BASE + "/b"


def filing(spark, *urls):
    rows = [(f"c{n}", "8-K", str(n), "2024-01-01", url) for n, url in enumerate(urls)]
    return spark.createDataFrame(rows, "companyname string, formtype string, cik string, date string, inter_url string")


def crawled(spark, *rows):
    return spark.createDataFrame(rows, "url string, status int, html string")


def test_enrich_outcomes(spark):
    good = TABLE + '<a href="/d">t</a></table>'
    pages = crawled(spark, ("u0", 200, good), ("u1", 202, good), ("u2", 404, good), ("u3", 200, "<p>"),
                    ("u4", 200, TABLE + "<a>t</a></table>"), ("u5", None, good))
    enriched = enrich.enrich(filing(spark, "u0", "u1", "u2", "u3", "u4", "u5", "u6", None, "u0"),
                             enrich.page_links(pages))
    got = bag(enriched.select("cik", "formurl", "enrich_status"))
    assert got == [
        ("0", BASE + "/d", "ok"), ("1", BASE + "/d", "ok"), ("2", None, "http_error"), ("3", None, "no_link"),
        ("4", None, "no_link"), ("5", None, "http_error"), ("6", None, "no_page"), ("7", None, "no_page"),
        ("8", BASE + "/d", "ok"),
    ]
    assert enrich.survivors(enriched).count() == 5
    assert bag(enrich.dropped(enriched).select("cik", "enrich_status")) == [
        ("3", "no_link"), ("4", "no_link"), ("6", "no_page"), ("7", "no_page")]


def test_copies_of_a_page_do_not_multiply_filings(spark):
    good = TABLE + '<a href="/d">t</a></table>'
    pages = crawled(spark, *[("u0", 500, "")] * 3, *[("u0", 200, good)] * 5, ("u0", 200, "<p>"))
    enriched = enrich.enrich(filing(spark, "u0", "u0"), enrich.page_links(pages))
    assert bag(enriched.select("formurl", "enrich_status")) == [(BASE + "/d", "ok")] * 2


def test_page_text_stays_at_the_scan(spark, folder):
    path = folder("pages")
    crawled(spark, ("u0", 200, "<p>")).write.parquet(path)
    plan = executed_plan(enrich.page_links(spark.read.parquet(path)))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("html" in line for line in exchanges)


def test_a_hot_url_is_split(spark):
    filings = spark.range(0, 60_000, 1, 8).select(
        F.col("id").cast("string").alias("companyname"), F.lit("8-K").alias("formtype"),
        F.lit("1").alias("cik"), F.lit("d").alias("date"),
        F.when(F.col("id") % 3 > 0, F.lit("u0")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("inter_url"),
    )
    pages = spark.range(60_000).select(
        F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit(200).alias("status"), F.lit("<p>").alias("html"))
    with small_skew_thresholds(spark):
        enriched = enrich.enrich(filings, store_links(pages))
        assert len(enriched.collect()) == 60_000
        assert "skew=true" in executed_plan(enriched)
