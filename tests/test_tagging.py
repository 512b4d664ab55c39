from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import bag, executed_plan, small_skew_thresholds
from ledgerline.catalog import inputs, tagging_queries
from ledgerline.fixed_values import EVENT_RULES, TAG_DEFAULTS, TAG_KEYS, alias_rules
from ledgerline.functions import accounts as acc
from ledgerline.operators import events as ev
from ledgerline.operators import tags
from ledgerline.plans.tagging import TaggedEvents, tag_events
from ledgerline.sources.tables import parse_audit_log

RULES = alias_rules("acme-")


@pytest.mark.parametrize("alias, lob, env, backup", [
    ("ma-data-ss-sbx", "DATA_SS", "SBX", ""),
    ("mit-core-prd", "MIT_CORE", "PRD", "monthly"),
    ("acme-core-nprd", "CORE", "NPRD", ""),
    ("sigma-x", "", "SIGX", ""),
    ("ma-ma-a-b", "A", "B", ""),
    ("mit-ma-a", "MIT", "A", ""),
    ("acme-mit-a-b", "ACME_MIT_A", "B", ""),
    ("prd-ma-", "PRD", "", ""),
    ("zz-1-prd", None, None, None),
    (None, None, None, None),
])
def test_alias(spark, alias, lob, env, backup):
    df = spark.createDataFrame([(alias,)], "alias string")
    df = df.select(acc.normalised_alias(F.col("alias"), RULES).alias("n"))
    df = df.select(acc.line_of_business(F.col("n")).alias("lob"), acc.environment(F.col("n")).alias("env"))
    got = df.select("lob", "env", acc.default_backup(F.col("env"))).first()
    assert tuple(got)[:2] == (lob, env)
    if env is not None:
        assert got[2] == backup


def user(name="u", kind="IAMUser", principal="AID", issuer=None):
    identity = {"arn": "arn:u", "principalId": principal, "type": kind}
    if name is not None:
        identity["userName"] = name
    if issuer is not None:
        identity["sessionContext"] = {"sessionIssuer": {"userName": issuer}}
    return identity


def event(key, name, elements, identity=None, region="r1", account="a1", parent="responseElements"):
    record = {"id": key, "time": f"2024-01-01T00:00:{key:0>2}", "account": account, "detail": {
        "eventName": name, "userIdentity": identity or user(), parent: elements}}
    if region is not None:
        record["region"] = region
    return json.dumps(record)


def items(field, item, *ids):
    return {field: {"items": [{item: one, "noise": {"a": [1]}} for one in ids]}}


def spot(*ids):
    return items("spotInstanceRequestSet", "spotInstanceRequestId", *ids)


def instances(*ids):
    return items("instancesSet", "instanceId", *ids)


def tagged(spark, lines, inventory=(), attachments=()):
    accounts = spark.createDataFrame(
        [("a1", ["old", "ma-data-ss-prd"]), ("a2", []), ("a3", ["zz-a-b"])], "account string, aliases array<string>")
    return tag_events(
        parse_audit_log(spark.createDataFrame([(line,) for line in lines], "value string")),
        accounts,
        spark.createDataFrame(list(attachments), "parent_id string, child_id string, kind string"),
        spark.createDataFrame(
            [(r, region, pairs) for r, region, pairs in inventory],
            "resource_id string, region string, tags array<struct<Key:string,Value:string>>"),
        aliases=RULES,
    )


def values(outcome, resource):
    rows = outcome.assignments.filter(F.col("resource_id") == resource).select("key", "value").collect()
    assert len(rows) == len({row["key"] for row in rows})
    return dict(map(tuple, rows))


def test_owner_and_role(spark):
    outcome = tagged(spark, [
        event("1", "CreateVpc", {"vpcId": "v1"}, user("u")),
        event("2", "CreateVpc", {"vpcId": "v2"}, user(None, "AssumedRole", "AID:s:t", "r")),
        event("3", "CreateVpc", {"vpcId": "v3"}, user(None, "AssumedRole", "AID", "r")),
        event("4", "CreateVpc", {"vpcId": "v4"}, user(None, "AssumedRole", "AID:s")),
        event("5", "CreateVpc", {"vpcId": "v5"}, user(None)),
        event("6", "CreateVpc", {"vpcId": "v6"}, user(None, "AssumedRole", "AID:", "r")),
    ])
    context = {row["event_id"]: (row["owner"], row["role"], row["error"]) for row in outcome.context.collect()}
    assert context == {
        "1": ("u", "IAM_USER", None), "2": ("s", "r", None), "3": (None, "r", "no_session_name"),
        "4": ("s", None, "no_issuer"), "5": (None, "IAM_USER", "no_user_name"), "6": ("", "r", None),
    }


def test_errors_and_unsupported(spark):
    outcome = tagged(spark, [
        event("1", "DeleteVolume", {"volumeId": "x"}),
        event("2", "CreateVpc", {"other": "x"}),
        event("3", "CreateVpc", None),
        event("4", "CreateVpc", {"vpcId": ""}),
        event("5", "CreateVpc", {"vpcId": "v"}, region=None),
        event("6", "CreateVpc", {"vpcId": "v"}, account="a2"),
        event("7", "CreateVpc", {"vpcId": "v"}, account="a3"),
        event("8", "RunInstances", {"instancesSet": {"items": [{"instanceId": "i"}, {"x": "y"}]}}),
        event("9", "RunInstances", {"instancesSet": {}}),
        '{"id": "10", "detail": {',
        event("11", "DeleteVolume", {}, account="a2"),
        event("12", "RequestSpotInstances", spot("sir-1", "sir-2")),
    ], attachments=[("sir-1", "i-1", "spot")])
    errors = {row["event_id"]: row["error"] for row in outcome.errors.collect()}
    assert errors == {
        "2": "no_resource", "3": "no_resource", "4": "no_resource", "5": "missing_field", "6": "no_alias",
        "7": "unknown_alias", "8": "no_resource", "9": "no_resource", None: "missing_field", "11": "no_alias",
        "12": "unfulfilled_request",
    }
    assert bag(outcome.unsupported) == [("1", "DeleteVolume")]
    assert outcome.assignments.count() == 0


def test_every_rule_finds_its_resource(spark):
    lines = []
    for number, rule in enumerate(EVENT_RULES):
        elements = items(rule.field, rule.item, f"id{number}") if rule.item else {rule.field: f"id{number}"}
        lines.append(event(str(number), rule.event_name, elements, parent=rule.parent))
    outcome = tagged(spark, lines, attachments=[("id2", "id2", "spot")])
    got = {row["event_id"]: (row["resource_id"], row["resource_class"]) for row in outcome.resources.collect()}
    assert got == {str(n): (f"id{n}", rule.resource_class) for n, rule in enumerate(EVENT_RULES)}
    assert len(EVENT_RULES) == 27


def test_number_of_instances(spark):
    outcome = tagged(spark, [event(str(n), "RunInstances", instances(*ids))
                             for n, ids in enumerate([[], ["i1"], ["i1", "i2"]])])
    assert bag(ev.resources_per_event(outcome.context)) == [
        ("0", "RunInstances", 0), ("1", "RunInstances", 1), ("2", "RunInstances", 2)]
    assert bag(outcome.resources.select("event_id", "pos", "resource_id")) == [
        ("1", 0, "i1"), ("2", 0, "i1"), ("2", 1, "i2")]


def test_expansion(spark):
    attachments = [
        ("i1", "vol1", "volume"), ("i1", "eni1", "interface"), ("i1", "snap0", "snapshot"), ("i9", "vol9", "volume"),
        ("ami1", "snap1", "snapshot"), ("ami1", "volx", "volume"), ("sir1", "i2", "spot"), ("i2", "vol2", "volume"),
        ("v1", "volv", "volume"),
    ]
    outcome = tagged(spark, [
        event("1", "RunInstances", instances("i1", "i3")),
        event("2", "CreateImage", {"imageId": "ami1"}),
        event("3", "RequestSpotInstances", spot("sir1")),
        event("4", "CreateVpc", {"vpcId": "v1"}),
    ], attachments=attachments)
    assert bag(outcome.expanded.select("event_id", "resource_id")) == [
        ("1", "eni1"), ("1", "i1"), ("1", "i3"), ("1", "vol1"), ("2", "ami1"), ("2", "snap1"),
        ("3", "i2"), ("3", "vol2"), ("4", "v1")]


def test_last_tag_of_the_event_wins(spark):
    outcome = tagged(spark, [
        event("1", "RunInstances", instances("i1", "i2", "i3")),
        event("2", "CreateVolume", {"volumeId": "vol"}),
        event("3", "CreateVpc", {"vpcId": "i1"}),
        event("4", "CreateDBInstance", {"dBInstanceArn": "db"}, region="r2"),
    ], inventory=[
        ("i1", "r1", [("Backup", "a"), ("Application", "z"), ("Application", "y"), ("LOB", "mine")]),
        ("i2", "r1", [("Backup", "b"), ("Patch_Level", "")]),
        ("i3", "r1", None),
        ("i3", "r2", [("Backup", "elsewhere")]),
        ("vol", "r1", []),
        ("db", "r1", [("Backup", "elsewhere")]),
        ("db", "r2", [("Backup", "db"), ("Monitoring_Strategy", "None")]),
    ], attachments=[("i2", "eni", "interface")])
    defaults = {"Provisioned_By": "u", "LOB": "DATA_SS", "Role": "IAM_USER", "Environment": "PRD", "Application": "",
                "Business_Service": "", "Patch_Level": "MIT", "Backup": "monthly", "Monitoring_Strategy": "Persistent"}
    shared = {**defaults, "Backup": "b", "Application": "y", "Patch_Level": ""}
    for resource in ("i2", "i3", "eni"):
        assert values(outcome, resource) == shared
    assert values(outcome, "vol") == defaults
    assert values(outcome, "db") == {**defaults, "Backup": "db", "Monitoring_Strategy": "None"}
    vpc = outcome.assignments.filter("event_id = '3'").select("key", "value")
    assert [row["key"] for row in vpc.collect()] == list(TAG_KEYS)
    assert dict(map(tuple, vpc.collect())) == defaults


def test_merge(spark):
    inventory = spark.createDataFrame([
        ("i", "r", [("Mine", "1"), ("Backup", "old")]), ("b", "r", [("Mine", "1"), ("Backup", "old")]),
        ("b", "other", [("Mine", "1")]), ("n", "r", None), ("q", "r", [("K", "1"), ("K", "2")]),
    ], "resource_id string, region string, tags array<struct<Key:string,Value:string>>")
    rows = [("1", "t1", "r", "i", "ids", "Backup", "first"), ("2", "t2", "r", "i", "ids", "Backup", "second"),
            ("3", "t1", "r", "b", "bucket", "Backup", "new"), ("4", "t1", "r", "fresh", "ids", "Backup", "x")]
    assignments = spark.createDataFrame(
        rows, "event_id string, event_time string, region string, resource_id string, resource_class string, "
              "key string, value string")
    assert bag(tags.merge_tags(inventory, assignments)) == [
        ("other", "b", "Mine", "1"), ("r", "b", "Backup", "new"), ("r", "fresh", "Backup", "x"),
        ("r", "i", "Backup", "second"), ("r", "i", "Mine", "1"), ("r", "q", "K", "2")]


def test_the_log_is_parsed_once(spark):
    lines = spark.createDataFrame([(event("1", "CreateVpc", {"vpcId": "v"}),)], "value string")
    events = parse_audit_log(lines).filter("event_name = 'CreateVpc' and region is not null")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_a_hot_event_and_a_hot_parent_are_split(spark, folder):
    """One event names two thirds of all resources, one of them holds two thirds of all attachments."""
    carried = {"event_time": "t", "region": "r", "event_name": "RunInstances", "owner": "o", "role": "x",
               "lob": "l", "env": "e", "resource_class": "ids", "via": None}
    number = F.col("id").cast("string")
    hot = F.col("id") % 3 > 0
    base = spark.range(0, 60_000, 1, 8)
    paths = {name: folder(name) for name in ("resources", "attachments", "chosen")}
    base.select(
        F.when(hot, F.lit("hot")).otherwise(number).alias("event_id"),
        *[F.lit(value).cast("string").alias(name) for name, value in carried.items()],
        F.lit(True).alias("reads_tags"), F.array(F.lit("volume")).alias("children"),
        F.lit(0).alias("pos"), F.concat(F.lit("i"), number).alias("resource_id"),
    ).write.parquet(paths["resources"])
    base.select(
        F.when(hot, F.lit("i1")).otherwise(F.concat(F.lit("i"), number)).alias("parent_id"),
        F.concat(F.lit("vol"), number).alias("child_id"), F.lit("volume").alias("kind"),
    ).write.parquet(paths["attachments"])
    base.select(
        number.alias("event_id"), *[F.lit("v").alias(key) for key in TAG_DEFAULTS]
    ).write.parquet(paths["chosen"])
    with small_skew_thresholds(spark):
        tables = {name: spark.read.parquet(path) for name, path in paths.items()}
        expanded = ev.expand_resources(tables["resources"], tables["attachments"])
        assert len(expanded.select("resource_id").collect()) == 120_000
        tagged_rows = tags.tag_assignments(tags.tag_sets(tables["resources"], tables["chosen"]))
        assert len(tagged_rows.collect()) == 60_000 * len(TAG_KEYS)
        narrow = expanded.select("event_id", "resource_id")
        narrow.collect()
        assert "skew=true" in executed_plan(narrow)
        assert "skew=true" in executed_plan(tagged_rows)


def test_short_rows_are_dealt_over_all_cores(spark, folder):
    root = folder("tables")
    spark.range(400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 9 as user_id", "'click' as event_type",
        "cast(id as double) as value", "'{\"k\": 1}' as props").coalesce(1).write.parquet(f"{root}/events.parquet")
    once, dealt = (inputs.derive(spark, root, inputs.AUDIT, spread=spread) for spread in (False, True))
    assert once.rdd.getNumPartitions() == 1
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert bag(once) == bag(dealt)


def test_only_attachments_of_wanted_kinds_are_read(spark):
    tagged = TaggedEvents(*[spark.createDataFrame([], schema) for schema in (
        "event_id string, event_time string, account string, region string, event_name string, arn string, principal_id string, "
        "user_type string, user_name string, issuer_name string, detail struct<responseElements: map<string,string>, "
        "requestParameters: map<string,string>>", "account string, aliases array<string>")],
        spark.createDataFrame([("p", "c", kind) for kind in ("spot", "volume", "interface", "snapshot", "other", None)],
                              "parent_id string, child_id string, kind string"), None)
    assert {row["kind"] for row in tagged._of_kinds(tagged._via).collect()} == {"spot"}
    assert {row["kind"] for row in tagged._of_kinds(tagged._attached).collect()} == {"volume", "interface", "snapshot"}


def test_queries_store_no_attachments(spark, folder, monkeypatch):
    """Each step takes the kinds it asks for from the derived rows; all attachments are never written."""
    source = folder("tables")
    lines = spark.range(40).select(F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_linenumber"), F.col("id").alias("l_partkey"))
    lines.write.parquet(f"{source}/lineitem.parquet")
    spark.range(3).selectExpr("id as n_nationkey", "'N' || id as n_name").write.parquet(f"{source}/nation.parquet")
    spark.range(3).selectExpr("id as event_id", "0D as value", "id as user_id", "'x' as event_type", "'{\"k\": 1}' as props",
                              "timestamp '2024-01-01 00:00:00' as ts").write.parquet(f"{source}/events.parquet")
    stored, cut = [], tagging_queries.session.cut
    monkeypatch.setattr(tagging_queries.session, "cut", lambda df, name, *more, **options: stored.append(name) or cut(df, name, *more, **options))
    _, attachments, _ = tagging_queries._snapshots(spark, source)
    assert stored == []
    assert {row.kind for row in attachments.collect()} == {"spot", "volume", "interface", "snapshot"}
    spots = executed_plan(attachments.where("kind = 'spot'")).split("HashAggregate")
    assert "l_linenumber" in spots[-1] and "Filter" in spots[-1]
