"""Registration of queries with their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .roles import ROLE_SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """One integer and one floating type, so that both engines name the same types."""

    def cast(name: str, kind: str):
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("long").alias(name)
        if kind.startswith("decimal") or kind == "float":
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[cast(n, k) for n, k in df.dtypes])


def _used(text: str) -> list[str]:
    return [role for role in ROLE_SQL if re.search(rf"\b{role}\b", text)]


def with_roles(sql: str) -> str:
    """Puts the role tables a query mentions, and those they mention, in front of it."""
    needed: set[str] = set()
    todo = _used(sql)
    while todo:
        role = todo.pop()
        if role not in needed:
            needed.add(role)
            todo += [r for r in _used(ROLE_SQL[role]) if r != role]
    heads = [f"{role} AS ({ROLE_SQL[role].strip()})" for role in ROLE_SQL if role in needed]
    body = sql.strip()
    if not heads:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body


def query(name: str, sql: str | None = None):
    """Registers ``fn(roles)`` under ``name``."""

    def register(fn: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Roles(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_roles(sql)
        return fn

    return register


# SQL fragments shared by the twins ----------------------------------------------------------------

DONE = "OrderStatus IN ('Delivered', 'Delivered Late')"


def r2(n: str, d: str) -> str:
    """n / d for integers, rounded half away from zero to two places, as DOUBLE."""
    whole = f"CAST({n} AS HUGEINT)"
    return (
        f"(CASE WHEN ({d}) <> 0 THEN CAST((CASE WHEN {whole} < 0 THEN -1 ELSE 1 END)"
        f" * ((200 * abs({whole}) + ({d})) // (2 * ({d}))) AS DOUBLE) / 100 END)"
    )


def pct2(part: str, whole: str) -> str:
    return r2(f"100 * ({part})", whole)


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def mean_money2(x: str) -> str:
    """avg of a decimal(.,2) column to two places."""
    return r2(cents(f"sum({x})"), f"(100 * count({x}))")


def mean_int2(x: str) -> str:
    return r2(f"sum({x})", f"count({x})")


def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio(x: str, y: str) -> str:
    return f"(CAST({x} AS DOUBLE) / nullif(CAST({y} AS DOUBLE), 0))"
