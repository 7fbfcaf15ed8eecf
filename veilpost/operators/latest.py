"""One row per key, for tables that are joined to mails."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | list[str], version: str | None = None) -> DataFrame:
    """The row of greatest `version` per key; of several such rows, or without a version, the one of greatest digest.

    Rows are compared within tasks first, so a key that was written very often is no hot spot.  A missing version
    is older than any other.  Columns and their order stay.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    digest = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    order = F.struct(F.col(version), digest) if version else digest
    found = df.groupBy(*keys).agg(F.max_by(row, order).alias("__row"))
    return found.select(*keys, "__row.*").select(*df.columns)
