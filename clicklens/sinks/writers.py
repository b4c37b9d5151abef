"""Writers to databases. Files are written by :mod:`clicklens.sinks.snapshots`."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append",
               batch_size: int = 1000) -> None:
    """Batched JDBC insert (the writer groups rows per partition)."""
    df.write.mode(mode).option("batchsize", str(batch_size)).jdbc(url, table, properties=properties)
