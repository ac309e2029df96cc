"""Registered queries: a Spark build and, where SQL can say it, the equal SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pilotlamp.plans.views import TABLES, VIEWS


class Tables:
    """The parquet tables of one directory and the views derived from them, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                self._made[name] = self.sql(VIEWS[name])
            else:
                raise AttributeError(name)
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        used = sorted(set(re.findall(r"\{(\w+)\}", text)))
        return self.spark.sql(text, **{u: getattr(self, u) for u in used})


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def plain_sql(text: str) -> str:
    """SQL with every used view as a leading CTE and bare table names."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\{(\w+)\}", sql):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(text)
    bare = lambda sql: re.sub(r"\{(\w+)\}", r"\1", sql)
    ctes = ",\n".join(f"{v} AS ({bare(VIEWS[v])})" for v in order)
    body = bare(text).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[len('WITH '):].strip()}"
    return f"WITH {ctes}\n{body}"


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, fn, plain_sql(oracle) if oracle else None)
        return fn

    return add
