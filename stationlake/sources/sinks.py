"""Result sinks of the batch analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def write_csv(result: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, replacing the folder; nested columns as JSON text.

    Every task writes its own part file. ``single_file`` writes one file from one task,
    which suits results whose size is bounded by construction (24 hours, 5 periods).
    """
    from pyspark.sql import functions as F

    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
            for f in result.schema.fields]
    out = result.select(*cols)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_json(summary: DataFrame, path: str) -> None:
    """The one-row nested summary as a JSON document (UTF-8), replacing the folder."""
    summary.coalesce(1).write.mode("overwrite").json(path)
