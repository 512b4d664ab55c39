"""Environment, line of business and backup policy from an account alias."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import ALIAS_RULES, BACKUP_BY_ENVIRONMENT, TAG_DEFAULTS, AliasRule


def current_alias(aliases: Column) -> Column:
    """The last alias of the list; null for an empty or missing list."""
    return F.try_element_at(aliases, F.lit(-1))


def normalised_alias(alias: Column, rules: Sequence[AliasRule] = ALIAS_RULES) -> Column:
    """The alias without its organisation token; null if no token occurs.

    A token counts wherever it occurs, not only in front: ``sigma-x`` contains ``ma-``.
    """
    known = [
        F.when(F.contains(alias, F.lit(rule.token)),
               F.replace(alias, F.lit(rule.token), F.lit("")) if rule.strip else alias)
        for rule in rules
    ]
    return F.coalesce(*known)


def environment(normalised: Column) -> Column:
    """The last dash-separated piece, in capitals."""
    return F.upper(F.try_element_at(F.split(normalised, "-"), F.lit(-1)))


def line_of_business(normalised: Column) -> Column:
    """All pieces but the last, joined by underscores, in capitals; empty if there is one piece only."""
    pieces = F.split(normalised, "-")
    return F.upper(F.array_join(F.slice(pieces, F.lit(1), F.size(pieces) - 1), "_"))


def default_backup(env: Column) -> Column:
    """The backup policy an environment gets when nobody chose one."""
    chosen = [F.when(env == name, F.lit(policy)) for name, policy in BACKUP_BY_ENVIRONMENT.items()]
    return F.coalesce(*chosen, F.lit(""))


def default_tag(key: str, env: Column) -> Column:
    """The start value of an overridable tag."""
    value = TAG_DEFAULTS[key]
    return default_backup(env) if value is None else F.lit(value)
