"""Compare a Spark result with the SQL result on the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, bool) or value is None:
        return value
    return value


_KINDS = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "float", "float": "float",
          "string": "str", "date": "date", "timestamp": "ts", "timestamp_ntz": "ts", "boolean": "bool",
          "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int", "HUGEINT": "huge", "DOUBLE": "float",
          "FLOAT": "float", "VARCHAR": "str", "DATE": "date", "TIMESTAMP": "ts", "BOOLEAN": "bool"}


def differences(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of what differs (empty when equal)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return -1, [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        mine = _KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if mine != kinds[field.name]:
            problems.append(f"type of {field.name}: {mine} != {kinds[field.name]}")
    order = sorted(names)
    index = [names.index(n) for n in order]
    got = Counter(tuple(_plain(row[n]) for n in order) for row in df.select(*[f"`{n}`" for n in order]).collect())
    want = Counter(tuple(_plain(row[i]) for i in index) for row in expected)
    n = sum(got.values())
    if got != want:
        extra, missing = got - want, want - got
        problems.append(f"rows {n} vs {sum(want.values())}; {sum(extra.values())} only in Spark e.g. "
                        f"{list(extra)[:2]}; {sum(missing.values())} only in SQL e.g. {list(missing)[:2]} ({order})")
    return n, problems
