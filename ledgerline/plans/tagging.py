"""From audit events to tag assignments; the same function serves batches and streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.fixed_values import ALIAS_RULES, EVENT_RULES, AliasRule, EventRule
from ledgerline.operators import events as ev
from ledgerline.operators import tags


def event_context(
    events: DataFrame,
    accounts: DataFrame,
    rules: Sequence[EventRule] = EVENT_RULES,
    aliases: Sequence[AliasRule] = ALIAS_RULES,
) -> DataFrame:
    """Events with everything their own record, account and rule say; lazy, one pass."""
    return ev.with_context(events, accounts, rules, aliases)


class TaggedEvents:
    """The outcomes for a set of events.

    A step that several outcomes read is stored when the first of them is asked for, so the log is parsed once and
    requests are followed once, and what no outcome asks for is never run. Being stored tables, what is joined by event
    is not a grouping, so adaptive execution can split an event with very many resources.
    """

    def __init__(
        self,
        events: DataFrame,
        accounts: DataFrame,
        attachments: DataFrame,
        inventory: DataFrame,
        rules: Sequence[EventRule] = EVENT_RULES,
        aliases: Sequence[AliasRule] = ALIAS_RULES,
        work: str | None = None,
    ):
        self._built = event_context(events, accounts, rules, aliases)
        self.attachments = attachments
        self._via = {rule.via for rule in rules if rule.via}
        self._attached = {kind for rule in rules for kind in rule.children}
        self.inventory = inventory
        self._work = work

    def _of_kinds(self, kinds: set[str]) -> DataFrame:
        """The attachments that the rules can ask for; the others are left out before they are shuffled."""
        return self.attachments.filter(F.col("kind").isin(*sorted(kinds)))

    def _stored(self, step: DataFrame, name: str) -> DataFrame:
        return session.cut(step, name, self._work)

    @cached_property
    def context(self) -> DataFrame:
        return self._stored(self._built, "context")

    @cached_property
    def requested(self) -> DataFrame:
        return self._stored(ev.requested_resources(ev.event_resources(self.context), self._of_kinds(self._via)), "requested")

    @cached_property
    def unfulfilled(self) -> DataFrame:
        return self._stored(ev.unfulfilled_events(self.requested), "unfulfilled")

    @cached_property
    def resources(self) -> DataFrame:
        named = ev.event_resources(self.context)
        return self._stored(ev.fulfilled_resources(named, self.requested, self.unfulfilled), "resources")

    @cached_property
    def chosen(self) -> DataFrame:
        return self._stored(tags.chosen_tags(self.resources, self.inventory), "chosen")

    @property
    def errors(self) -> DataFrame:
        return ev.event_errors(self.context).unionByName(self.unfulfilled)

    @property
    def unsupported(self) -> DataFrame:
        return ev.unsupported_events(self.context)

    @property
    def expanded(self) -> DataFrame:
        return ev.expand_resources(self.resources, self._of_kinds(self._attached))

    @property
    def tag_sets(self) -> DataFrame:
        return tags.tag_sets(self.expanded, self.chosen)

    @property
    def assignments(self) -> DataFrame:
        return tags.tag_assignments(self.tag_sets)


def tag_events(
    events: DataFrame,
    accounts: DataFrame,
    attachments: DataFrame,
    inventory: DataFrame,
    rules: Sequence[EventRule] = EVENT_RULES,
    aliases: Sequence[AliasRule] = ALIAS_RULES,
    work: str | None = None,
) -> TaggedEvents:
    """The tags of events; steps are stored below ``work`` (default: fresh folders) when an outcome needs them."""
    return TaggedEvents(events, accounts, attachments, inventory, rules, aliases, work)
