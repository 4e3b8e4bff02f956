"""Registry of the queries and of the SQL texts that check them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import Tables


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    covers: str
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(build, covers, sql)
        return build

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ENTRIES[name].build(Tables(spark, sf_dir))
