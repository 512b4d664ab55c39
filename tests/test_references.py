from __future__ import annotations

import html
import random

from pyspark.sql import functions as F

from ledgerline.functions.html import decoded_references, link_target

GIVEN = ["", "&", "&&", "&;", "&#", "&#;", "&#x;", "&#xg", "a&amp;b", "&amp;lt;", "&AMP", "&notit;", "&notin;", "&not", "&copy2024", "&#65",
         "&#x41;", "&#X41", "&#0;", "&#128;", "&#x9f;", "&#xD800;", "&#1114111;", "&#1114112;", "&#99999999999999999999999;",
         "&#00000000000000000000065;", "&#xfdd0;", "&#11;", "&#13;", "&#1;", "&NotEqualTilde;", "&fjlig;", "&thetasym", "&zzz;", "&a b",
         "&quot;&apos;&nbsp;", "x&y=1&lang=2&reg=3", "&\n&amp;", "&😀;", "&lt;&gt;&#39;&amp;#39;", "&" + "a" * 40 + ";", "é&eacute;&eacut",
         "&#x1F600;&#128512", "&#xFFFE;", "&#x80&#x81"]


def random_texts(count):
    rng = random.Random(8)
    names = ["amp", "lt", "copy", "not", "notin", "frac12", "para", "AElig", "zwj", "hellip", "b", "x"]
    parts = ["&", "#", "#x", ";", " ", "\n", "a", "9", "fF", "é", "<", *names, *(f"&{name};" for name in names)]
    numbers = [f"&#{rng.randrange(0x111000)};" for _ in range(50)] + [f"&#x{rng.randrange(0x200):x}" for _ in range(50)]
    return ["".join(rng.choice(rng.choice((parts, numbers))) for _ in range(rng.randrange(1, 12))) for _ in range(count)]


def test_references_are_read_as_browsers_do(spark):
    texts = GIVEN + random_texts(3000)
    rows = spark.createDataFrame([(text,) for text in [*texts, None]], "text string")
    found = rows.select("text", decoded_references(F.col("text")).alias("read")).collect()
    wrong = [(row["text"], row["read"], html.unescape(row["text"])) for row in found
             if row["text"] is not None and row["read"] != html.unescape(row["text"])]
    assert not wrong, wrong[:5]
    assert [row["read"] for row in found if row["text"] is None] == [None]


def test_link_targets(spark):
    anchors = [(f'<a href="/d?x=1&amp;y={text}">t</a>', html.unescape(f"/d?x=1&amp;y={text}")) for text in ("&eacute;", "&#38;", "2&copy=3")]
    rows = spark.createDataFrame(anchors, "anchor string, target string")
    assert rows.where(link_target(F.col("anchor")) != F.col("target")).count() == 0
