"""What several test modules of this folder use."""

from __future__ import annotations


def write_tables(root, **tables) -> str:
    """Tables as one folder that the queries read."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return str(root)
