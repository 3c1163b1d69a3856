"""Overwrite of a plain folder that is read while it is rewritten, and JSON export. ``snapshots`` has tables with versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .files import Store


def overwrite(df: DataFrame, path: str) -> None:
    """Writes beside path, then swaps: readers of path never see half a table. A swap that fails puts the old table back."""
    store = Store(df.sparkSession, path)
    fresh, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.parquet(fresh)
    there = store.exists(path)
    if there:
        store.move(path, old)
    try:
        store.move(fresh, path)
    except Exception:
        if there:
            store.move(old, path)
        store.delete(fresh)
        raise
    store.delete(old)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
