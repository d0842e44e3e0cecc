"""Order-independent comparison of a Spark result with the checking engine's."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if value != value else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(plain(r[i])).__name__, plain(r[i])) for i in order) for r in rows)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(df, con, sql: str) -> str | None:
    """None if equal, else a short account."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    want = bag(names, expected.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; "
        f"only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
    )
