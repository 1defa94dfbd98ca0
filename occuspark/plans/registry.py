"""Registry of named queries.

A query is ``fn(spark, sf_dir) -> DataFrame`` plus, where the result is
expressible in SQL, an oracle text for DuckDB.  Oracle texts may name the
``v_*`` fixture views; :func:`oracle_sql` prepends exactly the views a text
needs as CTEs so every oracle runs on the bare driver tables.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import views as V


@dataclass
class QuerySpec:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    digits: int = 8


REGISTRY: dict[str, QuerySpec] = {}


def round_binary(c, digits: int):
    """Round half away from zero on the binary value (``round(x * 10^d) / 10^d``).

    Spark's ``round`` rounds the shortest decimal text of a double, so a value
    printed as ``0.533301415`` goes up while the same double rounded in binary
    goes down; the oracle engine rounds in binary, and so do we.
    """
    m = float(10 ** digits)
    y = F.abs(c * F.lit(m))
    r = F.signum(c) * F.floor(y + F.lit(0.5)).cast("double") / F.lit(m)
    return F.when(c.isNull() | F.isnan(c), c).when(y < F.lit(4.0e15), r).otherwise(c)


def normalise(df: DataFrame, digits: int = 8) -> DataFrame:
    """Canonical output types: integral -> BIGINT, float -> DOUBLE rounded, DATE -> 'yyyy-MM-dd'."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = round_binary(c.cast("double"), digits)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, digits: int = 8):
    """Register ``fn`` under ``name``; its output is normalised (see above)."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalise(fn(V.Ctx(spark, sf_dir)), digits)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, run, sql, digits)
        return fn

    return deco


_VIEW_RE = re.compile(r"\bv_[a-z0-9_]+\b")


def _needed_views(sql: str) -> list[str]:
    seen: set[str] = set()
    stack = [m for m in _VIEW_RE.findall(sql) if m in V.VIEW_SQL]
    while stack:
        v = stack.pop()
        if v in seen:
            continue
        seen.add(v)
        stack.extend(m for m in _VIEW_RE.findall(V.VIEW_SQL[v]) if m in V.VIEW_SQL and m not in seen)
    return [v for v in V.VIEW_SQL if v in seen]


def expand(sql: str) -> str:
    views = _needed_views(sql)
    body = sql.strip().rstrip(";")
    if not views:
        return body
    ctes = ",\n".join(f"{v} AS (\n{V.VIEW_SQL[v].strip()}\n)" for v in views)
    if re.match(r"(?is)^\s*with\s", body):
        body = re.sub(r"(?is)^\s*with\s+(recursive\s+)?", "", body, count=1)
        return f"WITH {ctes},\n{body}"
    return f"WITH {ctes}\n{body}"


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.fn for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load_all()
    con = _schema_connection()
    return {k: canonical_sql(expand(v.sql), v.digits, con) for k, v in REGISTRY.items() if v.sql}


#: Tables that oracle texts are bound against; any scale has the same columns.
SCHEMA_DIR = os.environ.get("OCCUSPARK_SCHEMA_DIR", "/root/testdata/sf0.001")
_INT_TYPES = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER",
              "UBIGINT", "UHUGEINT"}


def _schema_connection():
    """DuckDB connection used only to *bind* oracle texts (DESCRIBE), never to answer them."""
    import duckdb

    from ..sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SCHEMA_DIR}/{t}.parquet')")
    return con


def canonical_sql(sql: str, digits: int, con) -> str:
    """Wrap an oracle so its output types match :func:`normalise` (BIGINT / rounded DOUBLE)."""
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    cols = []
    for name, typ, *_ in desc:
        q = '"' + name.replace('"', '""') + '"'
        t = typ.upper()
        if t in _INT_TYPES:
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif t in ("DOUBLE", "FLOAT", "REAL") or t.startswith("DECIMAL"):
            cols.append(f"round(CAST({q} AS DOUBLE), {digits}) AS {q}")
        elif t == "DATE":
            cols.append(f"strftime({q}, '%Y-%m-%d') AS {q}")
        else:
            cols.append(q)
    return f"SELECT {', '.join(cols)} FROM (\n{sql}\n) AS oracle_q"


def _load_all() -> None:
    from . import catalogue  # noqa: F401
