"""Writing new table versions.

Parquet tables take no MERGE, so a job's new snapshot is written whole (or per partition)
to a fresh folder and the caller switches readers to it once the write has committed --
readers never see a half-written table, and a failed job leaves the old version intact.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_snapshot(df: DataFrame, base_path: str, partition_by: list[str] | None = None,
                   cluster_by: list[str] | None = None) -> str:
    """Write ``df`` as a new version under ``base_path`` and return its folder.

    ``partition_by`` gives directory partitions (low-cardinality columns such as a
    branch); ``cluster_by`` range-sorts rows so file statistics prune range filters.
    """
    path = f"{base_path.rstrip('/')}/version={uuid.uuid4().hex}"
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
