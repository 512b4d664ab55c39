"""Many random inputs at once, against plain Python that states the expected semantics."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import bag
from ledgerline.fixed_values import alias_rules
from ledgerline.functions import accounts as acc
from ledgerline.functions.html import document_link
from ledgerline.functions.titles import is_filing_title, title_groups
from ledgerline.operators.tags import merge_tag_sets, merge_tags, tag_assignments
from test_landing import TABLE, Links


@pytest.fixture
def rng():
    return random.Random(20240101)


def test_titles(spark, rng):
    pieces = [" - ", " (", ")", "(", "-", " ", "8-K", "A", "\n", "\r", " ", "", "$1", "\\", "é"]
    usual = ["8-K", " - ", "A", " - ", "B", " (", "1", ")", " (", "F", ")"]
    titles = {"".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(3000)}
    for _ in range(3000):
        title = list(usual)
        for _ in range(rng.randint(0, 4)):
            title.insert(rng.randint(0, len(title)), rng.choice(pieces))
        titles.add("".join(title))
    pattern = re.compile(r"(.*) - (.*) \((.*)\) \((.*)\)")
    expected = {title: found[0][:3] if (found := pattern.findall(title)) else None for title in titles}
    assert sum(value is not None for value in expected.values()) > 1000
    df = spark.createDataFrame([(title,) for title in titles], "title string")
    groups = title_groups(F.col("title"))
    got = {row[0]: tuple(row[1]) if row[2] else None
           for row in df.select("title", groups, is_filing_title(groups)).collect()}
    assert got == expected


def page(rng, depth=0):
    """Random well-formed markup: tables in tables, anchors with and without text, comments, scripts."""
    parts = []
    for number in range(rng.randint(0, 4)):
        kind = rng.randint(0, 7)
        if kind <= 1 and depth < 3:
            opening = rng.choice([TABLE, "<table>", '<TABLE class="tableFile">',
                                  "<table summary='Document Format Files' class='tableFile x'>"])
            parts.append(opening + page(rng, depth + 1) + rng.choice(["</table>", "</TABLE >"]))
        elif kind <= 4:
            target = rng.choice([f' href="/{depth}{number}"', f" href='/{depth}{number}?q=1&amp;r=2'", " name='n'", ""])
            parts.append(f"<a{target}>" + rng.choice(["", " ", "text", "<b></b>", "<b>t</b>"]) + "</a>")
        elif kind == 5:
            parts.append("<!-- " + TABLE + '<a href="/c">c</a></table> -->')
        elif kind == 6:
            parts.append("<script>x = '" + TABLE + '<a href="/s">s</a>' + "'</script>")
        else:
            parts.append("<p>words</p>\n")
    return "".join(parts)


def test_pages(spark, rng):
    pages = sorted({page(rng) for _ in range(2500)} | {TABLE + page(rng, 1) + "</table>" for _ in range(1500)})
    expected = {one: Links(one).link for one in pages}
    assert sum(value is not None for value in expected.values()) > 400
    df = spark.createDataFrame([(one,) for one in pages], "html string")
    got = {row[0]: row[1] for row in df.select("html", document_link(F.col("html"))).collect()}
    assert {one for one in pages if got[one] != expected[one]} == set()


@pytest.mark.parametrize(("alias", "lob", "env"), [
    ("ma-core-prd", "CORE", "PRD"),
    ("core-ma-prd", "CORE", "PRD"),
    ("ma-ma-x-dev", "X", "DEV"),
    ("mit-core-prd", "MIT_CORE", "PRD"),
    ("a-mit-b", "A_MIT", "B"),
    ("acme-sig-dev", "SIG", "DEV"),
    ("sig-acme-dev", "SIG", "DEV"),
    ("ma-acme-a-b", "ACME_A", "B"),
    ("mit-acme-a-b", "MIT_ACME_A", "B"),
    ("ma-mit-a-b", "MIT_A", "B"),
    ("ma-", "", ""),
    ("ma-prd", "", "PRD"),
    ("ma--", "", ""),
    ("acme-", "", ""),
    ("MA-core-prd", None, None),
    ("core-prd", None, None),
    ("ma", None, None),
    ("", None, None),
])
def test_aliases(spark, alias, lob, env):
    df = spark.createDataFrame([(alias,)], "alias string")
    df = df.withColumn("n", acc.normalised_alias(F.col("alias"), alias_rules("acme-")))
    got = df.select(acc.line_of_business(F.col("n")), acc.environment(F.col("n"))).first()
    assert tuple(got) == (lob, env)


def test_merged_tags(spark, rng):
    resources = [f"r{n}" for n in range(60)]
    inventory = {name: [(rng.choice("KLMN"), str(rng.random())) for _ in range(rng.randint(0, 5))] for name in resources}
    classes = {name: rng.choice(["ids", "db", "bucket"]) for name in resources + ["new1", "new2"]}
    rows = []
    for number in range(150):
        name = rng.choice(list(classes))
        rows += [(str(number), f"t{number // 3:04d}", "r", name, classes[name], key, f"{number}{key}")
                 for key in rng.sample("KLXY", 2)]
    expected = {}
    for name, pairs in inventory.items():
        if not any(row[3] == name and row[4] == "bucket" for row in rows):
            expected.update({(name, key): value for key, value in pairs})
    for row in sorted(rows, key=lambda row: (row[1], row[0])):
        expected[row[3], row[5]] = row[6]
    stored = spark.createDataFrame([(name, "r", pairs) for name, pairs in inventory.items()],
                                   "resource_id string, region string, tags array<struct<Key:string,Value:string>>")
    assigned = spark.createDataFrame(rows, "event_id string, event_time string, region string, resource_id string, "
                                           "resource_class string, key string, value string")
    merged = merge_tags(stored, assigned).select("resource_id", "key", "value")
    assert bag(merged) == sorted(((*place, value) for place, value in expected.items()), key=repr)


def test_merged_tag_sets(spark, rng):
    """Sets of the same keys: the same as tag by tag, hot resources and repeated inventory rows included."""
    names = [f"r{n}" for n in range(40)]
    pairs = "array<struct<Key:string,Value:string>>"
    held = [(rng.choice(names), rng.choice("ab"), [(rng.choice("KLMN"), str(n * 10 + k)) for k in range(rng.randint(0, 4))])
            for n in range(30)]
    held += [("plain", "a", None), ("plain", "b", [])]
    sets = []
    for number in range(200):
        name = rng.choice([*names, *["r1"] * 40])
        sets.append((str(number), f"t{number // 3:04d}", rng.choice("ab"), name, "bucket" if name in names[:9] else "ids",
                     [(key, f"{number}{key}") for key in "KLX"]))
    inventory = spark.createDataFrame(list({row[:2]: row for row in held}.values()),
                                      f"resource_id string, region string, tags {pairs}")
    found = spark.createDataFrame(sets, "event_id string, event_time string, region string, resource_id string, "
                                        f"resource_class string, tags {pairs}")
    assert bag(merge_tag_sets(inventory, found)) == bag(merge_tags(inventory, tag_assignments(found)))
    none = found.limit(0)
    assert bag(merge_tag_sets(inventory, none)) == bag(merge_tags(inventory, tag_assignments(none)))
