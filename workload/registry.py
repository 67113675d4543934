"""Registered queries: a Spark callable, the columns it returns and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.functions import round_exact

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Columns and kinds of the queries with SQL, for what is worked out from their results.
SPECS: dict[str, list[list[str]]] = {}

# Column kinds: s text, i whole number, d double rounded to six places, t timestamp as text,
# b boolean. Both engines are brought to the same form.
_SPARK = {
    "s": lambda c: F.col(c).cast("string"),
    "i": lambda c: F.col(c).cast("bigint"),
    "d": lambda c: round_exact(c, 6),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "b": lambda c: F.col(c).cast("boolean"),
}
_SQL = {
    "s": "CAST({c} AS VARCHAR)",
    "i": "CAST({c} AS BIGINT)",
    "d": "CAST(round(CAST({c} AS DECIMAL(38,10)), 6) AS DOUBLE)",
    "t": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
    "b": "CAST({c} AS BOOLEAN)",
}


def query(name: str, columns: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``columns`` is "name:kind name:kind ..."."""
    spec = [c.split(":") for c in columns.split()]

    def add(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(spark, sf).select(*[_SPARK[k](c).alias(c) for c, k in spec])

        QUERIES[name] = run
        SPECS[name] = spec
        if sql is not None:
            shown = ", ".join(f'{_SQL[k].format(c=chr(34) + c + chr(34))} AS "{c}"' for c, k in spec)
            ORACLE[name] = f"SELECT {shown} FROM ({sql.strip()}) AS result"
        return fn

    return add
