"""Registered queries: feed, comparison with the state, enrichment, routing, entities."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.catalog import inputs
from ledgerline.catalog.inputs import derive, for_check
from ledgerline.fixed_values import SITE_BASE, TITLE_PATTERN
from ledgerline.functions.html import LinkSection
from ledgerline.operators import enrich, entities, feed, records
from ledgerline.plans.filings import FilingBatch, deliver, process_entries, store_links
from ledgerline.schemas import FILING, FILING_COLUMNS, FILING_ENRICHED_COLUMNS
from ledgerline.sources.feed import land_feed, read_feed
from ledgerline.sources.ledger import FilingLedger
from ledgerline.sources.tables import read_table
from ledgerline.streaming.filings import commit_batch

_OLD_UNTIL = dt.datetime(2024, 1, 16)
_NEW_FROM = dt.datetime(2024, 1, 10)
_ENTITY = "0000000007"
_SEEN_UNTIL = dt.datetime(1997, 1, 1)


def _before(moment: dt.datetime):
    return F.lit(moment).cast("timestamp_ntz")


def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.entity_lookup(derive(spark, sf_dir, inputs.ENTITY_MASTER))


def raw_polls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The entries of an early poll and of a later one that holds them again."""
    entries = _entries(spark, sf_dir)
    return entries.filter(F.col("landed") < _before(_SEEN_UNTIL)), entries


def entry_polls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The filings of these polls."""
    early, entries = raw_polls(spark, sf_dir)
    return feed.parse_entries(early), feed.parse_entries(entries)


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, inputs.ENTRIES)


def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.workspace(spark, "feed")
    land_feed(_entries(spark, sf_dir), folder)
    return read_feed(spark, folder).select("entry_id", "title", "link", "updated")


def feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.parse_entries(_entries(spark, sf_dir), "entry_id")


def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.rejected_entries(_entries(spark, sf_dir)).select("entry_id", "reason")


def feed_latest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings = feed_parse(spark, sf_dir)
    return feed.latest_page(filings, tie_break="entry_id").select("entry_id", *FILING_COLUMNS)


def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a form type, and the first of an entity."""
    filings = feed_parse(spark, sf_dir)
    pages = {"form": feed.latest_page(filings, tie_break="entry_id", start=10, form_type="8-K"),
             "entity": feed.latest_page(filings, tie_break="entry_id", entity=_ENTITY)}
    shown = [page.select(F.lit(name).alias("page"), "entry_id", *FILING_COLUMNS) for name, page in pages.items()]
    return shown[0].unionByName(shown[1])


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    filings = derive(spark, sf_dir, inputs.FILINGS)
    old = filings.filter(F.col("ts") < _before(_OLD_UNTIL))
    new = filings.filter(F.col("ts") >= _before(_NEW_FROM))
    return old.select(*FILING_COLUMNS), new.select(*FILING_COLUMNS)


def filing_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return records.fresh_records(new, old, FILING_COLUMNS)


def filing_state_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return records.state_after(old, records.fresh_records(new, old, FILING_COLUMNS), FILING_COLUMNS)


def filing_diff_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An early poll, a reset of the ledger, and a poll that holds everything: all of it is new again."""
    ledger = FilingLedger(session.workspace(spark, "reset-ledger"))
    old, _ = _old_and_new(spark, sf_dir)
    commit_batch(ledger, old.withColumn("snapshot_id", F.lit("s1")), 0)
    ledger.reset(spark)
    everything = derive(spark, sf_dir, inputs.FILINGS).select(*FILING_COLUMNS)
    commit_batch(ledger, everything.withColumn("snapshot_id", F.lit("s2")), 1)
    return ledger.rows(spark).select("batch_id", *FILING_COLUMNS)


def landing_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").withColumn("status", F.lit(200))
    links = enrich.page_links(pages, LinkSection(tag="nav", class_name=None, summary=None))
    return links.select("url", "formurl")


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_links(derive(spark, sf_dir, inputs.PAGES))


def _landing_batch(spark: SparkSession, sf_dir: str) -> FilingBatch:
    filings = derive(spark, sf_dir, inputs.LANDING_FILINGS)
    return deliver(filings, _links(spark, sf_dir))


def landing_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing_batch(spark, sf_dir).enriched


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing_batch(spark, sf_dir).dropped


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said of a poll, and of the same poll again."""
    filings, links = derive(spark, sf_dir, inputs.LANDING_FILINGS), _links(spark, sf_dir)
    nothing = spark.createDataFrame([], FILING)
    polls = [deliver(records.fresh_records(filings, seen, FILING_COLUMNS), links).summary for seen in (nothing, filings)]
    return polls[0].unionByName(polls[1])


def route_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing_batch(spark, sf_dir).routed.select("route", "title", *FILING_ENRICHED_COLUMNS)


def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing_batch(spark, sf_dir).messages


def new_filings_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way of a batch: parse, compare with what was seen, enrich, route."""
    seen, _ = entry_polls(spark, sf_dir)
    batch = process_entries(_entries(spark, sf_dir), seen, _links(spark, sf_dir))
    return batch.routed.select("route", "title", *FILING_ENRICHED_COLUMNS)


QUERIES = {
    "entity_lookup": entity_lookup,
    "feed_scan": feed_scan,
    "feed_parse": feed_parse,
    "feed_rejects": feed_rejects,
    "feed_latest_page": feed_latest_page,
    "feed_page": feed_page,
    "filing_diff": filing_diff,
    "filing_state_after": filing_state_after,
    "filing_diff_after_reset": filing_diff_after_reset,
    "landing_link": landing_link,
    "landing_enrich": landing_enrich,
    "landing_rejects": landing_rejects,
    "batch_summary": batch_summary,
    "route_filings": route_filings,
    "route_messages": route_messages,
    "new_filings_routed": new_filings_routed,
}

# --- The same results in DuckDB ---------------------------------------------------------------------

_TITLE = f"'{TITLE_PATTERN.removeprefix('(?d)')}'"

# Times as text in UTC: wall clock minus the offset that follows it.
_JUDGED = f"""
judged as (
  select *, case when link is null then 'no_link'
                 when not regexp_matches(title, {_TITLE}) then 'bad_title'
                 when date is null then 'bad_time' end as reason
  from (
    select *, strftime(
        try_cast(substr(updated, 1, 19) as timestamp)
          - to_minutes(cast(case when right(updated, 1) = 'Z' then 0
              else try_cast(substr(updated, 20, 1) || '1' as integer)
                 * (60 * try_cast(substr(updated, 21, 2) as integer) + try_cast(substr(updated, 24, 2) as integer))
              end as bigint)), '%Y-%m-%d %H:%M:%S') as date
    from {for_check(inputs.ENTRIES)} entries)
),
parsed as (
  select entry_id, landed,
    regexp_extract(title, {_TITLE}, 2) as companyname, regexp_extract(title, {_TITLE}, 1) as formtype,
    regexp_extract(title, {_TITLE}, 3) as cik, date, link as inter_url
  from judged where reason is null
)"""

_FILING = ", ".join(FILING_COLUMNS)


def _same(left: str, right: str) -> str:
    return " and ".join(f"{left}.{name} is not distinct from {right}.{name}" for name in FILING_COLUMNS)


_OLD_NEW = f"""
old as (select {_FILING} from {for_check(inputs.FILINGS)} f where ts < timestamp '{_OLD_UNTIL}'),
new as (select {_FILING} from {for_check(inputs.FILINGS)} f where ts >= timestamp '{_NEW_FROM}'),
fresh as (select * from new where not exists (select 1 from old where {_same('old', 'new')}))"""


def _link_sql(html: str, tag: str) -> str:
    """First anchor with text in the first ``tag`` element (the given pages do not nest it)."""
    anchors = rf"regexp_extract_all(regexp_extract({html}, '(?s)<{tag}[^>]*>(.*?)</{tag}>', 1), '(?s)<a\b[^>]*>.*?</a>')"
    first = f"list_filter({anchors}, lambda a: regexp_replace(a, '<[^>]*>', '', 'g') <> '')[1]"
    return f"""'{SITE_BASE}' || regexp_extract({first}, 'href="([^"]*)"', 1)"""


def _best_page(found: str) -> str:
    """One row per address: the best outcome first, then the smallest link."""
    return f"""
  select url, outcome, formurl from (
    select *, row_number() over (partition by url order by outcome <> 'ok', outcome, formurl nulls first) as place
    from ({found}) found)
  where place = 1"""


def _enriched(filings: str) -> str:
    found = f"""
    select url, case when status not in (200, 201, 202) then 'http_error'
                     when link is null then 'no_link' else 'ok' end as outcome,
      case when status in (200, 201, 202) then link end as formurl
    from (select *, {_link_sql('html', 'table')} as link from {for_check(inputs.PAGES)} p)"""
    return f"""
links as ({_best_page(found)}),
enriched as (
  select {_FILING}, formurl, coalesce(outcome, 'no_page') as enrich_status
  from {filings} f left join links on inter_url = url
),
survivors as (select * from enriched where enrich_status in ('ok', 'http_error')),
routed as (
  select case formtype when '8-K' then '8k' else '10k' end as route,
    formtype || ' filings from SEC RSS' as title, {_FILING}, formurl
  from survivors where formtype in ('8-K', '10-K')
)"""


_UNSEEN = f"""
unseen as (
  select * from parsed n where not exists (
    select 1 from parsed o where o.landed < timestamp '{_SEEN_UNTIL}' and {_same('o', 'n')})
)"""

_MESSAGES = f"""
    select route, title, cast(json_object({', '.join(f"'{name}', {name}" for name in FILING_ENRICHED_COLUMNS)}) as varchar)
      as body
    from routed"""

_LANDING = f"with {_enriched(for_check(inputs.LANDING_FILINGS))}"

CHECKS = {
    "entity_lookup": f"""
        select distinct cik, company_common_name as companyname, exchange_ticker as ticker
        from {for_check(inputs.ENTITY_MASTER)} m
        where exchange_ticker <> '' and company_common_name <> ''
        order by companyname, cik nulls first, ticker""",
    "feed_scan": f"select entry_id, title, link, updated from {for_check(inputs.ENTRIES)} e",
    "feed_parse": f"with {_JUDGED} select entry_id, {_FILING} from parsed",
    "feed_rejects": f"with {_JUDGED} select entry_id, reason from judged where reason is not null",
    "feed_latest_page": f"""
        with {_JUDGED} select entry_id, {_FILING} from parsed order by date desc, entry_id desc limit 10""",
    "feed_page": f"""
        with {_JUDGED}
        select * from (select 'form' as page, entry_id, {_FILING} from parsed where formtype = '8-K'
                       order by date desc, entry_id desc limit 10 offset 10)
        union all
        select * from (select 'entity' as page, entry_id, {_FILING} from parsed where cik = '{_ENTITY}'
                       order by date desc, entry_id desc limit 10)""",
    "filing_diff": f"with {_OLD_NEW} select * from fresh",
    "filing_state_after": f"with {_OLD_NEW} select * from old union all select * from fresh",
    "filing_diff_after_reset": f"""
        with {_OLD_NEW}
        select cast(0 as bigint) as batch_id, * from old
        union all select 1, {_FILING} from {for_check(inputs.FILINGS)} f""",
    "landing_link": f"""
        with links as (select url, {_link_sql('html', 'nav')} as formurl from pages)
        select url, formurl from ({_best_page(
            "select url, case when formurl is null then 'no_link' else 'ok' end as outcome, formurl from links")})""",
    "landing_enrich": f"{_LANDING} select * from enriched",
    "landing_rejects": f"""
        {_LANDING} select {_FILING}, enrich_status from enriched where enrich_status in ('no_link', 'no_page')""",
    "batch_summary": f"""
        {_LANDING} select count(*) as new_filings,
          count(*) filter (where enrich_status in ('ok', 'http_error')) as processed,
          count(*) > 0 as state_changed,
          'Finished downloading for ' || count(*) filter (where enrich_status in ('ok', 'http_error'))
            || ' companies.' as body
        from enriched
        union all select 0, 0, false, 'Finished downloading for 0 companies.'""",
    "route_filings": f"{_LANDING} select * from routed",
    "route_messages": f"{_LANDING} {_MESSAGES}",
    "new_filings_routed": f"""
        with {_JUDGED}, {_UNSEEN}, {_enriched('unseen')} select * from routed""",
}

_POLLED = f"""
    with {_JUDGED}, {_UNSEEN},
    polled as (
      select {_FILING} from parsed where landed < timestamp '{_SEEN_UNTIL}'
      union all select {_FILING} from unseen
    ), {_enriched('polled')}"""

# Everything that both polls leave behind: messages, entries that are none, filings that are dropped, and the totals.
POLLED_OUTPUTS = f"""
    {_POLLED}
    select 'message' as output, route as name, body as detail from ({_MESSAGES}) sent
    union all select 'reject', reason, entry_id from judged where reason is not null and landed < timestamp '{_SEEN_UNTIL}'
    union all select 'reject', reason, entry_id from judged where reason is not null
    union all select 'dropped', enrich_status, inter_url from enriched where enrich_status in ('no_link', 'no_page')
    union all select 'summary', 'new_filings', cast(count(*) as varchar) from enriched
    union all select 'summary', 'processed', cast(count(*) filter (where enrich_status in ('ok', 'http_error')) as varchar)
      from enriched"""

# Both polls, one after the other: all of the early one, and what the later one adds.
POLLED_MESSAGES = f"""
    {_POLLED}
    {_MESSAGES}"""
