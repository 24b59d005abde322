"""The named queries: every operator run over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, FloatType, IntegralType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns in the types every client reads alike: bigint, double, string, boolean."""
    target = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DecimalType, FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, IntegralType) and not isinstance(field.dataType, BooleanType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        target.append(c.alias(field.name))
    return df.select(*target)


def load_all() -> dict[str, Query]:
    from comanda.plans import (  # noqa: F401
        basket_queries,
        customer_queries,
        reorder_queries,
        stock_queries,
        visit_queries,
    )

    return dict(QUERIES)
