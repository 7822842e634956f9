"""What several test modules use."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(row) -> tuple:
    return tuple(round(x, 9) if isinstance(x, float) else x if isinstance(x, (int, str, bool, type(None))) else str(x) for x in row)


def same_rows(df, sql: str, sf_dir: str = SF) -> None:
    """The rows of a DataFrame and of DuckDB's SQL are equal, in any order."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    body = sql.strip().rstrip(";")
    columns = sorted(con.sql(body).columns)
    assert sorted(df.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    want = [plain(r) for r in con.sql(f"SELECT {names} FROM ({body})").fetchall()]
    got = [plain(r) for r in df.select(*columns).collect()]
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
