"""Registration of queries with the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lorekeeper.sources.archive import PRELUDE, Archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of an Archive under its own name; sql may use the model's tables of PRELUDE."""

    def register(f: Callable[[Archive], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Archive(spark, sf_dir))
        if sql is not None:
            body = sql.strip()
            used = _needed(body)
            ctes = ", ".join(f"{name} AS ({PRELUDE[name]})" for name in used)
            if ctes and body[:5].upper() == "WITH ":
                body = f"WITH {ctes}, {body[5:]}"
            elif ctes:
                body = f"WITH {ctes} {body}"
            ORACLE_SQL[f.__name__] = body
        return f

    return register


def _needed(body: str) -> list[str]:
    """The model tables that a query names, and those that these are made of, in the order of PRELUDE."""
    import re

    names, text = set(), body
    while True:
        more = {n for n in PRELUDE if re.search(rf"\b{n}\b", text)} - names
        if not more:
            return [n for n in PRELUDE if n in names]
        names |= more
        text = " ".join(PRELUDE[n] for n in more)
