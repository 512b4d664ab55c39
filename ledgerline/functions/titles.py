"""Splitting a feed entry's title into its parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import TITLE_PATTERN

TITLE_PARTS = ("formtype", "companyname", "cik")


def title_groups(title: Column) -> Column:
    """Form type, company and entity id of the first match in a title, as an array.

    Titles that do not match give an array of another size. Groups are greedy, so the last `` - `` that
    fits splits form type and company. A match lies within a line, so once it is cut out, line feeds can
    tell its groups apart; that takes two runs of the pattern instead of one per group.
    """
    match = F.regexp_extract(title, TITLE_PATTERN, 0)
    return F.split(F.regexp_replace(match, TITLE_PATTERN, "$1\n$2\n$3"), "\n")


def is_filing_title(groups: Column) -> Column:
    return F.size(groups) == len(TITLE_PARTS)


def title_part(groups: Column, part: str) -> Column:
    return F.get(groups, F.lit(TITLE_PARTS.index(part)))
