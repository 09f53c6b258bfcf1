"""Registration, table access and result normalisation."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ["parsing", "lookups", "bidding", "funnels", "devices", "rules", "ranking", "profiles", "content", "quality", "reports", "storage", "streams"]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The given tables of one scale directory; each is opened once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        setattr(self, name, table)
        return table


def tidy(df: DataFrame) -> DataFrame:
    """Types both engines agree on: bigint, double to six places, text.

    The nudge keeps exact halves, whose last bit depends on summation order, on
    one side of the rounding.
    """
    def norm(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + 1e-9, 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c.cast("array<string>"))
        return c.alias(f.name)

    return df.select(*[norm(f) for f in df.schema.fields])


def r(expr: str) -> str:
    """SQL counterpart of :func:`tidy` for floating columns."""
    return f"round(CAST({expr} AS DOUBLE) + 1e-9, 6)"


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of :class:`Tables` under ``name`` with its SQL, if it has one."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = lambda spark, path: tidy(fn(Tables(spark, path)))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
