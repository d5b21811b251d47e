"""File manifests: which inputs are new, loaded or failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def unprocessed(files: DataFrame, loaded: DataFrame, failed: DataFrame,
                key: str = "file_name") -> DataFrame:
    """Files neither loaded nor failed before: one left anti join against the
    union of both logs (J4, U2). Nulls in a log never match."""
    done = loaded.select(key).unionByName(failed.select(key))
    return files.join(done, key, "left_anti")
