"""Run registered queries beside their SQL text in DuckDB: ``python tests/compare.py [sf] [name …]``."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(rows) -> list[tuple]:
    def cell(v):
        if isinstance(v, (list, tuple)):
            return tuple(map(cell, v))
        return (v is None, str(v))

    return sorted(tuple(map(cell, r)) for r in rows)


def check(con, df, sql: str | None) -> str | None:
    """None when the results agree, else what differs."""
    cols = sorted(df.columns)
    got = normal(tuple(r) for r in df.select(*cols).collect())
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} != {sorted(rel.columns)}"
    want = normal(rel.select(*(f'"{c}"' for c in cols)).fetchall())
    if got == want:
        return None if got else "no rows"
    a, b = set(got), set(want)
    return f"rows {len(got)} / {len(want)}; only spark {list(a - b)[:2]}; only sql {list(b - a)[:2]}"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from feedloom.session import build_session

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = build_session("compare", "local[8]", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, bad = duck(sf_dir), 0
    oracles = oracle_sql()
    for name, fn in queries().items():
        if argv[1:] and not any(name.startswith(a) for a in argv[1:]):
            continue
        start = time.time()
        try:
            problem = check(con, fn(spark, sf_dir), oracles.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {time.time() - start:6.2f}s {name}{'' if problem is None else ': ' + problem[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
