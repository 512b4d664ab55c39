"""Audit events to the resources they created."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import ALIAS_RULES, EVENT_RULES, AliasRule, EventRule
from ledgerline.functions.accounts import current_alias, environment, line_of_business, normalised_alias
from ledgerline.functions.identity import is_iam_user, owner, role
from ledgerline.functions.nulls import any_null

_RULE_SCHEMA = (
    "event_name string, resource_class string, parent string, field string, item string, "
    "reads_tags boolean, children array<string>, via string"
)
_REQUIRED = ("region", "event_name", "arn", "principal_id", "user_type")
_CARRIED = ("event_id", "event_time", "region", "event_name", "owner", "role", "lob", "env",
            "resource_class", "reads_tags", "children", "via")


def rule_table(df: DataFrame, rules: Sequence[EventRule] = EVENT_RULES) -> DataFrame:
    """The rules as rows; as many as there are supported event names."""
    rows = [
        (r.event_name, r.resource_class, r.parent, r.field, r.item, r.reads_tags, list(r.children), r.via)
        for r in rules
    ]
    return df.sparkSession.createDataFrame(rows, _RULE_SCHEMA)


def named_resources(detail: Column, parent: Column, field: Column, item: Column) -> Column:
    """The resource ids an event names, as an array; null if the field or its list is missing.

    Where to look comes from the event's rule, as columns.
    """
    parents = [F.when(parent == name, detail[name]) for name in ("responseElements", "requestParameters")]
    value = F.try_element_at(F.coalesce(*parents), field)
    listed = F.from_json(value, "items array<map<string,string>>")["items"]
    ids = F.transform(listed, lambda entry: F.try_element_at(entry, item))
    return F.when(item.isNotNull(), ids).when(value.isNotNull(), F.array(value))


def account_context(accounts: DataFrame, rules: Sequence[AliasRule] = ALIAS_RULES) -> DataFrame:
    """Per account its alias, environment and line of business (null if the alias is not known)."""
    aliased = accounts.select("account", current_alias(F.col("aliases")).alias("alias"))
    named = aliased.withColumn("normalised", normalised_alias(F.col("alias"), rules))
    return named.select(
        "account",
        "alias",
        environment(F.col("normalised")).alias("env"),
        line_of_business(F.col("normalised")).alias("lob"),
    )


def with_context(
    events: DataFrame,
    accounts: DataFrame,
    rules: Sequence[EventRule] = EVENT_RULES,
    aliases: Sequence[AliasRule] = ALIAS_RULES,
) -> DataFrame:
    """Events with owner, role, environment, rule and named resources, and their first ``error``.

    An event with an error yields nothing later on; it never fails the job. An event without rule has a
    null ``resource_class`` and no error.
    """
    known = events.join(account_context(accounts, aliases), "account", "left").join(
        F.broadcast(rule_table(events, rules)), "event_name", "left"
    )
    user = owner(F.col("user_type"), F.col("user_name"), F.col("principal_id"))
    ids = named_resources(F.col("detail"), F.col("parent"), F.col("field"), F.col("item"))
    built = (
        known.withColumn("resource_ids", ids)
        .withColumn("owner", user)
        .withColumn("role", role(F.col("user_type"), F.col("issuer_name")))
    )
    nameless = F.exists("resource_ids", lambda name: F.coalesce(name, F.lit("")) == "")
    error = (
        F.when(any_null(*_REQUIRED), F.lit("missing_field"))
        .when(F.col("alias").isNull(), F.lit("no_alias"))
        .when(F.col("env").isNull(), F.lit("unknown_alias"))
        .when(F.col("owner").isNull(),
              F.when(is_iam_user(F.col("user_type")), F.lit("no_user_name")).otherwise(F.lit("no_session_name")))
        .when(F.col("role").isNull(), F.lit("no_issuer"))
        .when(F.col("resource_class").isNotNull() & (F.col("resource_ids").isNull() | nameless),
              F.lit("no_resource"))
    )
    return built.withColumn("error", error).select(*_CARRIED, "resource_ids", "error")


def event_errors(context: DataFrame) -> DataFrame:
    return context.filter(F.col("error").isNotNull()).select("event_id", "event_name", "error")


def unsupported_events(context: DataFrame) -> DataFrame:
    """Sound events of a kind that is not tagged."""
    other = F.col("error").isNull() & F.col("resource_class").isNull()
    return context.filter(other).select("event_id", "event_name")


def _supported(context: DataFrame) -> DataFrame:
    return context.filter(F.col("error").isNull() & F.col("resource_class").isNotNull())


def event_resources(context: DataFrame) -> DataFrame:
    """One row per resource an event names, with its position in the event."""
    return _supported(context).select(*_CARRIED, F.posexplode("resource_ids").alias("pos", "resource_id"))


def resources_per_event(context: DataFrame) -> DataFrame:
    return _supported(context).select("event_id", "event_name", F.size("resource_ids").alias("n_resources"))


def requested_resources(named: DataFrame, attachments: DataFrame) -> DataFrame:
    """Named resources that stand for another one, with that one as ``child_id`` (null if there is none yet)."""
    wanted = named.filter(F.col("via").isNotNull())
    return wanted.join(
        attachments,
        (wanted["resource_id"] == attachments["parent_id"]) & (wanted["via"] == attachments["kind"]),
        "left",
    ).drop("parent_id", "kind")


def unfulfilled_events(requested: DataFrame) -> DataFrame:
    """Events with a request that has no resource yet; like any event error, they yield nothing."""
    waiting = requested.filter(F.col("child_id").isNull())
    return waiting.select("event_id", "event_name", F.lit("unfulfilled_request").alias("error")).distinct()


def fulfilled_resources(named: DataFrame, requested: DataFrame, unfulfilled: DataFrame) -> DataFrame:
    """Named resources with every request replaced by what it led to; unfulfilled events are left out."""
    replaced = (
        requested.join(unfulfilled.select("event_id"), "event_id", "left_anti")
        .withColumn("resource_id", F.col("child_id"))
        .drop("child_id")
    )
    return named.filter(F.col("via").isNull()).unionByName(replaced)


def expand_resources(resources: DataFrame, attachments: DataFrame) -> DataFrame:
    """The resources and whatever is attached to them, of the kinds their rule names."""
    parents = resources.filter(F.size("children") > 0)
    attached = parents.join(
        attachments,
        (parents["resource_id"] == attachments["parent_id"])
        & F.array_contains(parents["children"], attachments["kind"]),
    )
    children = attached.withColumn("resource_id", F.col("child_id")).drop("parent_id", "child_id", "kind")
    return resources.unionByName(children)
