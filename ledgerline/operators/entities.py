"""The entity list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_lookup(master: DataFrame) -> DataFrame:
    """Distinct entities that have a name and a ticker, by name. The entity id may be null.

    ``master`` has ``cik, company_common_name, exchange_ticker``. All columns take part in the order, so
    equal names are in a fixed order and a frequent name does not end up in one sort task.
    """
    named = master.filter((F.col("exchange_ticker") != "") & (F.col("company_common_name") != ""))
    return (
        named.select(
            "cik",
            F.col("company_common_name").alias("companyname"),
            F.col("exchange_ticker").alias("ticker"),
        )
        .distinct()
        .orderBy("companyname", "cik", "ticker")
    )
