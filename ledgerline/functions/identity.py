"""Who caused an audit event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import IAM_USER_ROLE, IAM_USER_TYPE


def is_iam_user(user_type: Column) -> Column:
    return user_type == IAM_USER_TYPE


def owner(user_type: Column, user_name: Column, principal_id: Column) -> Column:
    """The user's own name, or the session name that follows the first colon of the principal.

    Null when the principal has no colon; the caller turns that into an event error.
    """
    session = F.get(F.split(principal_id, ":"), F.lit(1))
    return F.when(is_iam_user(user_type), user_name).otherwise(session)


def role(user_type: Column, issuer_name: Column) -> Column:
    return F.when(is_iam_user(user_type), F.lit(IAM_USER_ROLE)).otherwise(issuer_name)
