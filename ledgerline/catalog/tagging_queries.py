"""Registered queries: accounts, audit events, resources and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.catalog import inputs
from ledgerline.catalog.inputs import derive, for_check
from ledgerline.fixed_values import EVENT_RULES, TAG_DEFAULTS, TAG_KEYS, alias_rules
from ledgerline.functions import accounts as acc
from ledgerline.functions.identity import owner, role
from ledgerline.functions.payloads import array_json
from ledgerline.operators import events as ev
from ledgerline.operators import tags
from ledgerline.plans.tagging import TaggedEvents, event_context, tag_events
from ledgerline.schemas import AUDIT_IDENTITY
from ledgerline.sources.tables import parse_audit_log, stream_audit_log
from ledgerline.streaming.tagging import start_tagging

_ALIASES = alias_rules(inputs.ORGANISATION)


def _aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = derive(spark, sf_dir, inputs.ALIASES)
    normalised = acc.normalised_alias(F.col("alias"), _ALIASES)
    return named.withColumn("normalised", normalised).withColumn("env", acc.environment(F.col("normalised")))


def alias_to_lob_env(spark: SparkSession, sf_dir: str) -> DataFrame:
    lob = acc.line_of_business(F.col("normalised"))
    return _aliases(spark, sf_dir).select("s_suppkey", "alias", "normalised", "env", lob.alias("lob"))


def tag_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _aliases(spark, sf_dir).filter(F.col("env").isNotNull())
    return known.select("s_suppkey", *[acc.default_tag(key, F.col("env")).alias(key) for key in TAG_DEFAULTS])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_audit_log(derive(spark, sf_dir, inputs.AUDIT, spread=True))


def audit_event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_audit_log(derive(spark, sf_dir, inputs.AUDIT), schema=AUDIT_IDENTITY).drop("detail")


def event_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_audit_log(derive(spark, sf_dir, inputs.AUDIT), schema=AUDIT_IDENTITY).select(
        "event_id",
        owner(F.col("user_type"), F.col("user_name"), F.col("principal_id")).alias("owner"),
        role(F.col("user_type"), F.col("issuer_name")).alias("role"),
    )


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.ACCOUNTS).withColumn("aliases", F.split("aliases", ","))


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, attachments and inventory.

    The attachments are not stored: every step that reads them asks for kinds of its own, and leaves out the others in
    the scan, before equal ones are found.
    """
    pairs = F.array(*[F.struct(F.col(f"key{n}").alias("Key"), F.col(f"value{n}").alias("Value")) for n in (1, 2)])
    inventory = derive(spark, sf_dir, inputs.INVENTORY, spread=True).select(
        "resource_id", "region", F.when(F.col("has_tags"), pairs).alias("tags")
    )
    return _accounts(spark, sf_dir), derive(spark, sf_dir, inputs.ATTACHMENTS), inventory


def _tagged(spark: SparkSession, sf_dir: str) -> TaggedEvents:
    return tag_events(_events(spark, sf_dir), *_snapshots(spark, sf_dir), aliases=_ALIASES)


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_context(_events(spark, sf_dir), _accounts(spark, sf_dir), aliases=_ALIASES)


def event_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).errors


def event_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.unsupported_events(_context(spark, sf_dir))


def event_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = ev.event_resources(_context(spark, sf_dir))
    return named.select("event_id", "event_name", "resource_class", "pos", "resource_id")


def resources_per_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.resources_per_event(_context(spark, sf_dir))


def resource_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).expanded.select("event_id", "event_name", "resource_id")


def tag_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tags of every event that has resources of its own."""
    tagged = _tagged(spark, sf_dir)
    events = tagged.resources.select("event_id", "owner", "role", "lob", "env").distinct()
    return tags.resolve_tags(events, tagged.chosen, "event_id")


def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _tagged(spark, sf_dir).tag_sets
    return sets.select("event_id", "resource_id", array_json(F.col("tags")).alias("tags"))


def tag_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).assignments


def tag_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = _tagged(spark, sf_dir)
    return tags.merge_tag_sets(tagged.inventory, tagged.tag_sets)


def stream_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, target = session.workspace(spark, "audit"), session.workspace(spark, "tagged")
    derive(spark, sf_dir, inputs.AUDIT, spread=True).write.text(log)
    start_tagging(
        stream_audit_log(spark, log),
        lambda: _snapshots(spark, sf_dir),
        target,
        session.workspace(spark, "checkpoint"),
        aliases=_ALIASES,
    ).awaitTermination()
    schema = "event_id string, event_time string, region string, resource_id string, resource_class string, " \
             "key string, value string"
    return spark.read.schema(schema).parquet(f"{target}/assignments/*")


QUERIES = {
    "alias_to_lob_env": alias_to_lob_env,
    "tag_defaults": tag_defaults,
    "audit_event_parse": audit_event_parse,
    "event_owner": event_owner,
    "event_errors": event_errors,
    "event_unsupported": event_unsupported,
    "event_resources": event_resources,
    "resources_per_event": resources_per_event,
    "resource_expand": resource_expand,
    "tag_resolve": tag_resolve,
    "tag_sets": tag_sets,
    "tag_assignments": tag_assignments,
    "tag_merge": tag_merge,
    "stream_tagging": stream_tagging,
}

# --- The same results in DuckDB ---------------------------------------------------------------------


def _alias_parts(alias: str) -> str:
    return f"""case when contains({alias}, 'ma-') then replace({alias}, 'ma-', '')
      when contains({alias}, 'mit-') then {alias}
      when contains({alias}, '{inputs.ORGANISATION}') then replace({alias}, '{inputs.ORGANISATION}', '') end"""


_ENV = "upper(string_split(normalised, '-')[-1])"
_LOB = "upper(array_to_string(string_split(normalised, '-')[:-2], '_'))"
_BACKUP = "case when env = 'PRD' then 'monthly' else '' end"

_ALIAS_ROWS = f"""
aliased as (
  select *, {_ENV} as env, {_LOB} as lob
  from (select *, {_alias_parts('alias')} as normalised from {for_check(inputs.ALIASES)} a)
)"""

_PATHS = {
    "event_id": "id", "event_time": "time", "account": "account", "region": "region",
    "event_name": "detail.eventName", "arn": "detail.userIdentity.arn",
    "principal_id": "detail.userIdentity.principalId", "user_type": "detail.userIdentity.type",
    "user_name": "detail.userIdentity.userName",
    "issuer_name": "detail.userIdentity.sessionContext.sessionIssuer.userName",
}
_PARSED = f"""
raw as (
  select case when json_valid(value) then value else '{{}}' end as record from {for_check(inputs.AUDIT)} a
),
parsed as (
  select {', '.join(f"json_extract_string(record, '$.{path}') as {name}" for name, path in _PATHS.items())},
    record
  from raw
),
owned as (
  select *,
    case when user_type = 'IAMUser' then user_name else string_split(principal_id, ':')[2] end as owner,
    case when user_type = 'IAMUser' then 'IAM_USER' else issuer_name end as role
  from parsed
)"""


def _rule_values() -> str:
    rows = []
    for rule in EVENT_RULES:
        via = f"'{rule.via}'" if rule.via else "null"
        children = ",".join(rule.children)
        rows.append(f"('{rule.event_name}', '{rule.resource_class}', {rule.reads_tags}, '{children}', {via})")
    return ", ".join(rows)


def _found_ids() -> str:
    """The ids as a list, one CASE branch per path; a missing list is null."""
    scalar = "case when json_extract_string(record, '{p}') is null then null " \
             "else [json_extract_string(record, '{p}')] end"
    branches = []
    for rule in EVENT_RULES:
        path = f"$.detail.{rule.parent}.{rule.field}" + (".items" if rule.item else "")
        if rule.item:
            ids = (f"case when json_extract(record, '{path}') is null then null "
                   f"else json_extract_string(record, '{path}[*].{rule.item}') end")
        else:
            ids = scalar.replace("{p}", path)
        branches.append(f"when '{rule.event_name}' then {ids}")
    return f"case event_name {' '.join(branches)} end"


_CONTEXT = f"""
{_PARSED},
accounts as (
  select account, alias, {_ENV} as env, {_LOB} as lob
  from (select account, alias, {_alias_parts('alias')} as normalised
        from (select account, string_split(aliases, ',')[-1] as alias from {for_check(inputs.ACCOUNTS)} a))
),
rules(event_name, resource_class, reads_tags, children, via) as (values {_rule_values()}),
context as (
  select *, case
      when region is null or event_name is null or arn is null or principal_id is null or user_type is null
        then 'missing_field'
      when alias is null then 'no_alias'
      when env is null then 'unknown_alias'
      when owner is null and user_type = 'IAMUser' then 'no_user_name'
      when owner is null then 'no_session_name'
      when role is null then 'no_issuer'
      when resource_class is not null and ids is null then 'no_resource' end as error
  from (select o.*, a.alias, a.env, a.lob, r.* exclude (event_name), {_found_ids().replace('case event_name', 'case o.event_name')} as ids
        from owned o left join accounts a on o.account = a.account left join rules r on o.event_name = r.event_name)
),
named as (
  select * exclude (ids), unnest(ids) as resource_id, unnest(range(len(ids))) as pos
  from context where error is null and resource_class is not null
),
attachments as (select * from {for_check(inputs.ATTACHMENTS)} a),
requested as (
  select n.*, child_id from named n left join attachments a on n.resource_id = parent_id and n.via = kind
  where via is not null
),
resources as (
  select * from named where via is null
  union all
  select * exclude (resource_id, pos, child_id), child_id as resource_id, pos from requested
  where event_id not in (select event_id from requested where child_id is null)
),
expanded as (
  select * from resources
  union all
  select r.* exclude (resource_id, pos), child_id as resource_id, pos
  from resources r join attachments a on r.resource_id = parent_id
    and list_contains(string_split(children, ','), kind)
),
inventory as (
  select resource_id, region, 0 as tag_at, key1 as key, value1 as value from {for_check(inputs.INVENTORY)} i where has_tags
  union all
  select resource_id, region, 1, key2, value2 from {for_check(inputs.INVENTORY)} i where has_tags
),
chosen as (
  select event_id, {', '.join(
      f"arg_max(value, [pos, tag_at]) filter (where key = '{key}') as {key}" for key in TAG_DEFAULTS)}
  from resources join inventory using (region, resource_id) where reads_tags group by event_id
)"""

_DEFAULT_SQL = {
    key: _BACKUP if value is None else f"'{value}'" for key, value in TAG_DEFAULTS.items()
}
_EVENT_VALUES = {"Provisioned_By": "owner", "LOB": "lob", "Role": "role", "Environment": "env"}
_TAG_VALUES = {
    key: _EVENT_VALUES.get(key) or f"coalesce({key}, {_DEFAULT_SQL[key]})" for key in TAG_KEYS
}
_ASSIGNED = f"""{_CONTEXT},
assigned as (
  select event_id, event_time, region, resource_id, resource_class, unnest([{', '.join(
      f"{{'key': '{key}', 'value': {value}}}" for key, value in _TAG_VALUES.items())}], recursive := true)
  from expanded left join chosen using (event_id)
)"""

_ASSIGNMENTS = f"with {_ASSIGNED} select * from assigned"

CHECKS = {
    "alias_to_lob_env": f"with {_ALIAS_ROWS} select s_suppkey, alias, normalised, env, lob from aliased",
    "tag_defaults": f"""
        with {_ALIAS_ROWS}
        select s_suppkey, {', '.join(f'{sql} as {key}' for key, sql in _DEFAULT_SQL.items())}
        from aliased where env is not null""",
    "audit_event_parse": f"with {_PARSED} select {', '.join(_PATHS)} from parsed",
    "event_owner": f"with {_PARSED} select event_id, owner, role from owned",
    "event_errors": f"""
        with {_CONTEXT}
        select event_id, event_name, error from context where error is not null
        union all
        select distinct event_id, event_name, 'unfulfilled_request' from requested where child_id is null""",
    "event_unsupported": f"""
        with {_CONTEXT} select event_id, event_name from context where error is null and resource_class is null""",
    "event_resources": f"""
        with {_CONTEXT}
        select event_id, event_name, resource_class, cast(pos as integer) as pos, resource_id from named""",
    "resources_per_event": f"""
        with {_CONTEXT} select event_id, event_name, cast(len(ids) as integer) as n_resources
        from context where error is null and resource_class is not null""",
    "resource_expand": f"with {_CONTEXT} select event_id, event_name, resource_id from expanded",
    "tag_resolve": f"""
        with {_CONTEXT}
        select event_id, {', '.join(f'{value} as {key}' for key, value in _TAG_VALUES.items())}
        from (select distinct event_id, owner, role, lob, env from resources) left join chosen using (event_id)""",
    "tag_sets": f"""
        with {_CONTEXT}
        select event_id, resource_id, cast(to_json([{', '.join(
            f"{{'Key': '{key}', 'Value': {value}}}" for key, value in _TAG_VALUES.items())}]) as varchar) as tags
        from expanded left join chosen using (event_id)""",
    "tag_assignments": _ASSIGNMENTS,
    "tag_merge": f"""
        with {_ASSIGNED},
        latest as (
          select region, resource_id, key, arg_max(value, event_time || ' ' || event_id) as value
          from assigned group by all
        ),
        kept as (
          select region, resource_id, key, arg_max(value, tag_at) as value from inventory
          where not exists (select 1 from assigned b where b.resource_class = 'bucket'
            and b.region = inventory.region and b.resource_id = inventory.resource_id)
          group by all
        )
        select coalesce(l.region, k.region) as region, coalesce(l.resource_id, k.resource_id) as resource_id,
          coalesce(l.key, k.key) as key, case when l.key is not null then l.value else k.value end as value
        from latest l full outer join kept k
          on l.region = k.region and l.resource_id = k.resource_id and l.key = k.key""",
    "stream_tagging": _ASSIGNMENTS,
}
