from __future__ import annotations

import base64
import json

from pyspark.sql import functions as F

from conftest import bag
from ledgerline.operators import requests
from ledgerline.schemas import NOTIFICATION_REQUEST, RENDER_REQUEST
from ledgerline.sources.tables import read_requests, readable, scan_requests, unreadable

def test_read_requests(spark, tmp_path):
    lines = [{"to": ["x@example.com"], "companyname": "A", "formtype": "8-K", "table": "t", "more": 1},
             {"to": ["x@example.com"], "companyname": "B", "formtype": "8-K"}]
    (tmp_path / "requests.json").write_text("\n".join(map(json.dumps, lines)))
    found = read_requests(spark, str(tmp_path), NOTIFICATION_REQUEST)
    assert [row["recipient"] for row in requests.notification_outbox(found).collect()] == ["x@example.com"]
    assert [row["companyname"] for row in requests.notification_rejects(found).collect()] == ["B"]
    (tmp_path / "render").mkdir()
    (tmp_path / "render" / "r.json").write_text(
        json.dumps({"formurl": "u", "options": {"page-size": "A4"}, "ticker": "T", "date": "d", "formtype": "10-K"}))
    wanted = read_requests(spark, str(tmp_path / "render"), RENDER_REQUEST)
    assert requests.render_manifest(wanted, "https://e", "b").first()["filename"] == "T-10-K-d.pdf"


NOTICE = "to array<string>, companyname string, formtype string, `table` string"


def test_outbox_escapes(spark):
    name, table = 'A "B" \\ é', '<table class="t">\n</table>'
    df = spark.createDataFrame([(["x@example.com", "y@example.com"], name, "8-K", table)], NOTICE)
    rows = requests.notification_outbox(df).collect()
    assert [row["recipient"] for row in rows] == ["x@example.com", "y@example.com"]
    assert {row["template"] for row in rows} == {"FilingsTemplate"}
    assert json.loads(rows[0]["template_data"]) == {"companyname": name, "formtype": "8-K", "table": table}


def test_incomplete_notices_are_set_aside(spark):
    df = spark.createDataFrame([(None, "a", "8-K", "t"), (["x"], None, "8-K", "t"), (["x"], "c", "8-K", "t")], NOTICE)
    assert requests.notification_outbox(df).count() == 1
    assert requests.notification_rejects(df).count() == 2


def test_blank_recipients(spark):
    """Every request leaves something: a row per real recipient, or itself among the rejects."""
    lists = [[], [None, ""], [None, "x@example.com", ""], ["x@example.com", "x@example.com"]]
    df = spark.createDataFrame([(to, str(at), "8-K", "t") for at, to in enumerate(lists)], NOTICE)
    sent = requests.notification_outbox(df).collect()
    assert [(json.loads(row["template_data"])["companyname"], row["recipient"]) for row in sent] == [
        ("2", "x@example.com"), ("3", "x@example.com"), ("3", "x@example.com")]
    assert [row["companyname"] for row in requests.notification_rejects(df).collect()] == ["0", "1"]


RENDER = "formurl string, options map<string,string>, ticker string, date string, formtype string"


def test_manifest(spark):
    df = spark.createDataFrame([("u", {}, "T", "d", "10-K"), ("u", {}, None, "d", "10-K"),
                                ("u", {}, "T", "d", "8-K/A")], RENDER)
    rows = requests.render_manifest(df, "https://e", "b").collect()
    assert [tuple(row) for row in rows] == [
        ("u", "T-10-K-d.pdf", "https://e/b/T-10-K-d.pdf", 200, "success"),
        ("u", None, "", 400, "missing field"),
        ("u", "T-8-K/A-d.pdf", "https://e/b/T-8-K/A-d.pdf", 200, "success"),
    ]
    safe = requests.render_manifest(df, "https://e", "b", slash="_").collect()
    assert safe[2]["filename"] == "T-8-K_A-d.pdf"


def test_html_validation(spark):
    df = spark.createDataFrame([(1, "<p>"), (2, ""), (3, None)], "id int, html string")
    message = "Validation error: Missing field 'html'."
    got = requests.validate_html(df).select("id", "status", "error")
    assert bag(got) == [(1, 200, None), (2, 400, message), (3, 400, message)]


def test_base64_is_one_line(spark):
    content = bytes(range(256)) * 4
    df = spark.createDataFrame([(bytearray(content),), (bytearray(b""),)], "pdf binary")
    rows = [row["data"] for row in requests.base64_payload(df, "pdf").collect()]
    assert rows == [base64.b64encode(content).decode(), ""]


def test_entities(spark):
    from ledgerline.operators.entities import entity_lookup

    rows = [("2", "B", "t"), ("1", "A", "t"), ("1", "A", "t"), (None, "A", "t"), ("3", "", "t"), ("4", "C", ""),
            ("5", "C", None), ("6", None, "t"), ("7", "D", " ")]
    df = spark.createDataFrame(rows, "cik string, company_common_name string, exchange_ticker string")
    assert [tuple(row) for row in entity_lookup(df).collect()] == [
        (None, "A", "t"), ("1", "A", "t"), ("2", "B", "t"), ("7", "D", " ")]
    assert entity_lookup(df).columns == ["cik", "companyname", "ticker"]
    assert df.select(F.lit(1)).count() == len(rows)


def test_every_line_is_accounted_for(spark, tmp_path):
    good = {"to": ["x@example.com"], "companyname": "A", "formtype": "8-K", "table": "t"}
    lines = [json.dumps(good), json.dumps({"companyname": "B"}), json.dumps(good)[:-5], "", "  ", f"[{json.dumps(good)}]", "7",
             "null", "{}", '{"to":"x@example.com","companyname":"C","formtype":"8-K","table":"t"}', "  " + json.dumps(good)]
    (tmp_path / "requests.json").write_text("\n".join(lines))
    scanned = scan_requests(spark, str(tmp_path), NOTIFICATION_REQUEST)
    assert scanned.count() == 9
    assert bag(unreadable(scanned)) == sorted((lines[at],) for at in (2, 5, 6, 7, 9))
    requested = readable(scanned)
    assert requested.columns == list(NOTIFICATION_REQUEST.names)
    assert [row["recipient"] for row in requests.notification_outbox(requested).collect()] == ["x@example.com"] * 2
    assert bag(requests.notification_rejects(requested).select("companyname")) == [("B",), (None,)]
