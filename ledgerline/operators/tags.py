"""Tags of newly created resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.fixed_values import TAG_DEFAULTS, TAG_KEYS
from ledgerline.functions.accounts import default_tag

# Tags that come from the event; all others may have been chosen on the resource.
_EVENT_TAGS = {"Provisioned_By": "owner", "LOB": "lob", "Role": "role", "Environment": "env"}


def chosen_tags(resources: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per event the overridable tags already on its resources; of several the last one counts.

    "Last" is by the resource's position in the event, then the tag's position on the resource. All
    resources of an event share the outcome. Other tags are cut off before the join.
    """
    numbered = F.transform("tags", lambda tag, at: F.struct(at.alias("at"), tag["Key"].alias("key"),
                                                            tag["Value"].alias("value")))
    wanted = inventory.select(
        "region",
        "resource_id",
        F.filter(numbered, lambda tag: tag["key"].isin(*TAG_DEFAULTS)).alias("tags"),
    ).filter(F.size("tags") > 0)
    asked = resources.filter("reads_tags").select("event_id", "region", "resource_id", "pos")
    found = asked.join(wanted, ["region", "resource_id"]).select("event_id", "pos", F.inline("tags"))
    order = F.struct("pos", "at", "value")
    return found.groupBy("event_id").agg(*[
        F.max_by("value", F.when(F.col("key") == key, order)).alias(key) for key in TAG_DEFAULTS
    ])


def _tag_value(key: str) -> Column:
    if key in _EVENT_TAGS:
        return F.col(_EVENT_TAGS[key])
    return F.coalesce(F.col(key), default_tag(key, F.col("env")))


def resolve_tags(events: DataFrame, chosen: DataFrame, *keep: str) -> DataFrame:
    """One column per tag for rows with an event's context; ``keep`` names columns to carry along."""
    joined = events.join(chosen, "event_id", "left")
    return joined.select(*keep, *[_tag_value(key).alias(key) for key in TAG_KEYS])


def tag_sets(resources: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per resource with the list of its tags, in their fixed order."""
    pairs = [F.struct(F.lit(key).alias("Key"), _tag_value(key).alias("Value")) for key in TAG_KEYS]
    return resources.join(chosen, "event_id", "left").select(
        "event_id", "event_time", "region", "resource_id", "resource_class", F.array(*pairs).alias("tags")
    )


def tag_assignments(sets: DataFrame) -> DataFrame:
    """One row per resource and tag. (The outer form spares a check for empty lists, of which there are none.)"""
    return sets.select("*", F.inline_outer("tags").alias("key", "value")).drop("tags")


def merge_tags(inventory: DataFrame, assignments: DataFrame, tagged: DataFrame | None = None) -> DataFrame:
    """The tags resources have once the assignments are applied, as ``(region, resource_id, key, value)``.

    Assigned tags are set key by key and others stay, except on buckets, where the assigned set replaces
    all. If several events tag a resource, the last one counts. This is one grouping of both sides, not
    a full outer join: it is pre-aggregated, and a resource that is hot on either side does no harm.

    Of events at the same time the one with the greater id counts, ids being compared as text. ``tagged`` may
    name the assigned resources, one row each, so that the buckets need not be told from nine rows of each.
    """
    resource = ["region", "resource_id"]
    replaced = (assignments if tagged is None else tagged).filter(F.col("resource_class") == "bucket").select(*resource)
    existing = (
        inventory.join(replaced, resource, "left_anti")
        .select(*resource, F.posexplode("tags").alias("at", "tag"))
        .select(
            *resource,
            F.col("tag.Key").alias("key"),
            F.col("tag.Value").alias("value"),
            F.struct(
                F.lit(False).alias("assigned"), F.lit("").alias("event_time"), F.lit("").alias("event_id"), "at"
            ).alias("rank"),
        )
    )
    assigned = assignments.select(
        *resource,
        "key",
        "value",
        F.struct(
            F.lit(True).alias("assigned"), "event_time", "event_id", F.lit(0).alias("at")
        ).alias("rank"),
    )
    return existing.unionByName(assigned).groupBy(*resource, "key").agg(F.max_by("value", "rank").alias("value"))


def merge_tag_sets(inventory: DataFrame, sets: DataFrame) -> DataFrame:
    """The same from tag sets, one row per resource and event, when all sets have the same keys.

    Then the last set of a resource wins with all its keys, so sets are compared before they are spread over their tags,
    and what an inventory row keeps is decided by looking that one set up. Existing tags that stay meet no assigned one
    and are grouped on their own. The last sets are stored, as both sides read them.
    """
    resource = ["region", "resource_id"]
    last = session.cut(sets.groupBy(*resource).agg(
        F.max_by("tags", F.struct("event_time", "event_id")).alias("tags"),
        F.bool_or(F.col("resource_class") == "bucket").alias("replaces"),
    ), "last-tag-sets")
    assigned = F.transform("assigned", lambda tag: tag["Key"])
    stays = F.col("assigned").isNull() | (~F.col("replaces") & ~F.array_contains(assigned, F.col("key")))
    own = inventory.select(*resource, F.col("tags").alias("existing"))
    met = own.join(last.select(*resource, F.col("tags").alias("assigned"), "replaces"), resource, "left")
    existing = (
        met.select(*resource, "assigned", "replaces", F.posexplode("existing").alias("at", "tag"))
        .select(*resource, "assigned", "replaces", "at", F.col("tag.Key").alias("key"), F.col("tag.Value").alias("value"))
        .filter(F.col("key").isNull() | F.coalesce(stays, F.lit(True)))
        .groupBy(*resource, "key").agg(F.max_by("value", "at").alias("value"))
    )
    return existing.unionByName(last.select(*resource, F.inline("tags").alias("key", "value")))
