"""Inputs of the registered queries, derived from the given tables.

The given tables hold no filings or audit events, so each input is a SELECT over them, in SQL that Spark
and DuckDB both read. The registered query and its check start from the same text; what is checked is
everything after it. Every input covers all rows of its tables; the ``case`` expressions only vary the
rows, so that every outcome of an operator occurs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerline.fixed_values import EVENT_RULES, SITE_BASE, TAG_DEFAULTS
from ledgerline.sources.tables import read_table

ORGANISATION = "org-"
_TASKS_A_CORE = 2

_FORM = (
    "case {key} % 5 when 0 then '10-K' when 1 then '8-K' when 2 then '8-K/A' when 3 then '8-K' else '10-Q' end"
)


def _text(value: str) -> str:
    return f"cast({value} as string)"


def _div(value: str, by: int) -> str:
    return f"cast(floor({value} / {by}) as bigint)"


def _two_digits(value: str) -> str:
    return f"lpad({_text(value)}, 2, '0')"


# Feed entries. Some lack the separator, some have one more, some lack a link or a readable time.
ENTRIES = f"""
select {_text('o_orderkey')} as entry_id,
  {_FORM.format(key='o_orderkey')}
    || case when o_orderkey % 13 = 0 then ' ' else ' - ' end || c_name
    || case when o_orderkey % 4 = 0 then ' - NEW' else '' end
    || ' (' || lpad({_text('c_custkey')}, 10, '0') || ') (Filer)' as title,
  case when o_orderkey % 17 = 0 then null
       else '{SITE_BASE}/p/' || {_text(_div('o_orderkey', 50))} end as link,
  case when o_orderkey % 19 = 0 then 'soon'
       else substr({_text('o_orderdate')}, 1, 10) || 'T' || {_two_digits('o_orderkey % 24')} || ':'
         || {_two_digits('o_orderkey % 60')} || ':07'
         || case o_orderkey % 3 when 0 then '-05:00' when 1 then 'Z' else '+05:30' end end as updated,
  o_orderdate as landed
from <orders> join <customer> on o_custkey = c_custkey
"""

# Filing records with many equal ones among them; the date is null for some.
FILINGS = f"""
select 'COMPANY ' || {_text('user_id')} as companyname,
  event_type as formtype,
  {_text('user_id')} as cik,
  case when value < 5 then null
       else '2024-01-' || {_two_digits('user_id % 28 + 1')} || ' 00:00:00' end as date,
  '{SITE_BASE}/p/' || {_text(_div('value', 20))} as inter_url,
  ts
from <events>
"""

# Filings whose landing pages are in PAGES, or beyond them for the last ones.
LANDING_FILINGS = f"""
select 'COMPANY ' || {_text('user_id')} as companyname,
  case event_type when 'click' then '8-K' when 'view' then '10-K' when 'signup' then '8-K/A'
                  else event_type end as formtype,
  {_text('user_id')} as cik,
  substr({_text('ts')}, 1, 19) as date,
  '{SITE_BASE}/p/' || {_text(_div('event_id', 30))} as inter_url
from <events>
"""

# Crawled landing pages: the navigation becomes the document table; some begin with an empty link, some
# are blank, some answered with an error.
PAGES = f"""
select '{SITE_BASE}/p/' || {_text('page_id')} as url,
  case page_id % 4 when 1 then 404 when 2 then 202 else 200 end as status,
  case when page_id % 5 = 0 then ''
       else replace(replace(html, '<nav>',
              '<table summary="Document Format Files" class="files tableFile">'
                || case when page_id % 3 = 0 then '<a href="/none"><b></b></a>' else '' end),
            '</nav>', '</table>') end as html
from <pages>
"""

# Daily crawl records; some lack the document address.
DAILY = f"""
select replace(substr({_text('ts')}, 1, 10), '-', '') as ymd,
  {_text('user_id')} as cik,
  substr({_text('ts')}, 1, 10) as date,
  event_type as formtype,
  '{SITE_BASE}/p/' || {_text('event_id')} as inter_url,
  'COMPANY ' || {_text('user_id')} as companyname,
  case when value < 5 then null else '{SITE_BASE}/d/' || {_text('event_id')} end as formurl,
  {_div('event_id', 100000)} as chunk
from <events>
"""

ENTITY_MASTER = f"""
select case when c_custkey % 5 = 0 then null else {_text('c_custkey')} end as cik,
  case when c_custkey % 13 = 0 then '' else c_name end as company_common_name,
  case when c_custkey % 7 = 0 then '' when c_custkey % 11 = 0 then null else c_mktsegment end as exchange_ticker
from <customer> join <orders> on c_custkey = o_custkey
"""

ALIASES = f"""
select s_suppkey,
  case s_suppkey % 4 when 0 then 'ma-' when 1 then 'mit-' when 2 then '{ORGANISATION}' else 'zz-' end
    || case when s_suppkey % 10 = 0 then '' else replace(lower(s_name), '#', '-') || '-' end
    || case s_suppkey % 3 when 0 then 'prd' when 1 then 'sbx' else 'nprd' end as alias
from <supplier>
"""

# One row per account; the list of aliases is comma-separated here.
ACCOUNTS = f"""
select 'acct-' || {_text('n_nationkey')} as account,
  'old-alias,' || case n_nationkey % 6 when 0 then 'ma-' when 1 then 'mit-' when 5 then 'zz-'
                                       else '{ORGANISATION}' end
    || replace(lower(n_name), '_', '-') || '-'
    || case n_nationkey % 3 when 0 then 'prd' when 1 then 'sbx' else 'nprd' end as aliases
from <nation>
"""

_UNKNOWN_EVENTS = ("DeleteVolume", "StopInstances", "DeleteBucket")
_EVENT_COUNT = len(EVENT_RULES) + len(_UNKNOWN_EVENTS)
_PREFIXES = {"RunInstances": "i-", "RequestSpotInstances": "sir-", "CreateImage": "ami-", "CreateVolume": "vol-"}


def _prefix(rule) -> str:
    return _PREFIXES.get(rule.event_name, f"{rule.resource_class}-{rule.event_name.lower()}-")


def _event_name() -> str:
    names = [rule.event_name for rule in EVENT_RULES] + list(_UNKNOWN_EVENTS)
    cases = " ".join(f"when {at} then '{name}'" for at, name in enumerate(names))
    return f"case event_id % {_EVENT_COUNT} {cases} end"


def _elements() -> str:
    """The JSON members below ``detail`` that name the created resources; lists have 0 to 2 items."""
    cases = []
    for at, rule in enumerate(EVENT_RULES):
        if rule.item:
            first = f"""'{{"{rule.item}":"{_prefix(rule)}' || {_text('event_id')} || '"}}'"""
            second = f"""'{{"{rule.item}":"{_prefix(rule)}' || {_text('event_id + 1')} || '"}}'"""
            value = (
                f"""'{{"items":[' || case {_div('event_id', _EVENT_COUNT)} % 3 when 0 then '' when 1 then {first} """
                f"""else {first} || ',' || {second} end || ']}}'"""
            )
        else:
            value = f"""'"{_prefix(rule)}' || {_text('event_id')} || '"'"""
        cases.append(f"""when {at} then '"{rule.parent}":{{"{rule.field}":' || {value} || '}}'""")
    return f"""case event_id % {_EVENT_COUNT} {' '.join(cases)} else '"responseElements":{{"x":"y"}}' end"""


_REGION = f"'region-' || {_text(_div('event_id', _EVENT_COUNT) + ' % 3')}"

# Audit records as JSON text: every supported event and three others; users and assumed roles. Some lack
# the region, the user name, the session name or the resource, and some are cut off.
AUDIT = f"""
select case when event_id % 41 = 0 then substr(line, 1, length(line) - 2) else line end as value
from (
  select event_id,
    '{{"id":"' || {_text('event_id')} || '","time":"' || substr({_text('ts')}, 1, 19)
      || '","account":"acct-' || {_text('user_id % 26')} || '",'
      || case when event_id % 37 = 0 then '' else '"region":"' || {_REGION} || '",' end
      || '"detail":{{"eventName":"' || {_event_name()} || '","userIdentity":{{"arn":"arn:u:'
      || {_text('user_id')} || '",'
      || case when user_id % 2 = 0
              then '"type":"IAMUser","principalId":"AID"'
                || case when event_id % 29 = 0 then '' else ',"userName":"user' || {_text('user_id')} || '"' end
              else '"type":"AssumedRole","principalId":"AID'
                || case when event_id % 31 = 0 then '' else ':session' || {_text('user_id')} || ':x' end
                || '","sessionContext":{{"sessionIssuer":{{"userName":"role' || {_text('user_id % 9')} || '"}}}}' end
      || '}},' || case when event_id % 23 = 0 then '"responseElements":null' else {_elements()} end
      || '}}}}' as line
  from <events>
) lines
"""


def _tag_key(value: str) -> str:
    keys = [*TAG_DEFAULTS, "Cost_Center"]
    cases = " ".join(f"when {at} then '{key}'" for at, key in enumerate(keys))
    return f"case {value} % {len(keys)} {cases} end"


def _scalar_id() -> str:
    cases = " ".join(
        f"when {at} then '{_prefix(rule)}' || {_text('event_id')}"
        for at, rule in enumerate(EVENT_RULES) if not rule.item
    )
    return f"case event_id % {_EVENT_COUNT} {cases} end"


# Resources with up to two tags (key and value in columns); some have no tag list. All ids that events
# may look up exist, instances among them.
INVENTORY = f"""
select resource_id, region, has_tags, key1, value1, key2, value2
from (
  select {_scalar_id()} as resource_id, {_REGION} as region, event_id % 9 <> 0 as has_tags,
    {_tag_key('event_id')} as key1, replace(replace(props, '{{"k": ', ''), '}}', '') || '-a' as value1,
    {_tag_key(_div('event_id', 7))} as key2, replace(replace(props, '{{"k": ', ''), '}}', '') || '-b' as value2
  from <events>
  union all
  select 'i-' || {_text('event_id')}, {_REGION}, event_id % 8 <> 0,
    {_tag_key(_div('event_id', 5))}, replace(replace(props, '{{"k": ', ''), '}}', '') || '-c',
    {_tag_key('event_id')}, replace(replace(props, '{{"k": ', ''), '}}', '') || '-d'
  from <events>
) tagged
where resource_id is not null
"""

# What is attached to what: volumes and interfaces to instances, snapshots to images, instances to spot
# requests.
ATTACHMENTS = f"""
select
  case slot when 0 then 'sir-' when 3 then 'ami-' else 'i-' end || {_text('l_orderkey')} as parent_id,
  case slot when 0 then 'i-' || {_text('l_orderkey')}
            else case slot when 1 then 'vol-' when 2 then 'eni-' else 'snap-' end
              || {_text('l_orderkey')} || '-' || {_text('part')} end as child_id,
  case slot when 0 then 'spot' when 1 then 'volume' when 2 then 'interface' else 'snapshot' end as kind
from (
  select distinct l_orderkey, l_linenumber % 4 as slot,
    case when l_linenumber % 4 = 0 then null else l_partkey end as part
  from <lineitem>
) attached
"""

# Notification requests; recipients are comma-separated here. For some they are missing, none ('-'), or blank ('?': null).
NOTIFICATIONS = f"""
select case when o_orderkey % 31 = 0 then null
            when o_orderkey % 37 = 0 then '-'
            when o_orderkey % 41 = 0 then '?,'
            when o_orderkey % 43 = 0 then '?,desk@example.com,'
            else 'desk' || {_text('o_orderkey % 7')} || '@example.com'
              || case when o_orderkey % 2 = 0 then ',team' || {_text('o_orderkey % 5')} || '@example.com' else '' end
       end as recipients,
  c_name || ' "A"' as companyname,
  {_FORM.format(key='o_orderkey')} as formtype,
  '<table class="t"><tr><td>' || o_orderpriority || '</td></tr></table>' as "table"
from <orders> join <customer> on o_custkey = c_custkey
"""

# Lines of request files: complete ones, some without a field or a recipient, some cut off, some that are no object.
REQUEST_LINES = f"""
select o_orderkey,
  case when o_orderkey % 29 = 0 then substr(line, 1, length(line) - 9)
       when o_orderkey % 43 = 0 then '[' || line || ']'
       when o_orderkey % 47 = 0 then {_text('o_orderkey')}
       else line end as line
from (
  select o_orderkey,
    '{{"to":' || case when o_orderkey % 37 = 0 then '[]' when o_orderkey % 41 = 0 then '["",null]'
                     else '["desk' || {_text('o_orderkey % 7')} || '@example.com","team@example.com"]' end
      || case when o_orderkey % 31 = 0 then '' else ',"companyname":"' || c_name || '"' end
      || ',"formtype":"' || {_FORM.format(key='o_orderkey')} || '","' || 'table":"<td>'
      || o_orderpriority || '</td>"}}' as line
  from <orders> join <customer> on o_custkey = c_custkey
) written
"""

RENDER = f"""
select '{SITE_BASE}/d/' || {_text('o_orderkey')} as formurl,
  'A4' as page_size,
  case when o_orderkey % 21 = 0 then null else c_mktsegment end as ticker,
  substr({_text('o_orderdate')}, 1, 10) as date,
  {_FORM.format(key='o_orderkey')} as formtype
from <orders> join <customer> on o_custkey = c_custkey
"""

HTML_REQUESTS = """
select page_id, case page_id % 6 when 0 then '' when 1 then null else html end as html from <pages>
"""

_NAMES = ("customer", "orders", "lineitem", "supplier", "nation", "events", "pages")


def _tables(text: str) -> list[str]:
    return [name for name in _NAMES if re.search(rf"(from|join) <{name}>", text)]


def for_check(text: str) -> str:
    """The input as a subquery for DuckDB, where the tables are views."""
    for name in _tables(text):
        text = text.replace(f"<{name}>", name)
    return f"({text.strip()})"


def derive(spark: SparkSession, sf_dir: str, text: str, spread: bool = False) -> DataFrame:
    """The input as a DataFrame over the tables in ``sf_dir``.

    ``spread`` deals the rows of the tables over all cores first. A scan has no more tasks than the files have row groups,
    which are few where rows are short, however much work each of them is.
    """
    tables = _tables(text)
    text = text.replace("{", "{{").replace("}", "}}").replace('"table"', "`table`")
    for name in tables:
        text = text.replace(f"<{name}>", "{" + name + "}")
    found = {name: read_table(spark, sf_dir, name) for name in tables}
    if spread:
        found = {name: table.repartition(_TASKS_A_CORE * spark.sparkContext.defaultParallelism) for name, table in found.items()}
    return spark.sql(text, **found)
