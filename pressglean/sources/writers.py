"""Writers of tables and of the small dated files that people read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_csv(df: DataFrame, path: str) -> bool:
    """CSV with a header, arrays as the text of a tuple; nothing is written for no rows."""
    if df.isEmpty():
        return False
    cols = [F.concat(F.lit("("), F.array_join(F.col(f.name).cast("array<string>"), ", "), F.lit(")")).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema]
    df.select(*cols).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
    return True


def as_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def as_map(df: DataFrame, key: str, path: str) -> None:
    """One JSON object by `key`; for the outputs of one day, which fit one row."""
    rest = [c for c in df.columns if c != key]
    one = df.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.struct(*rest)))))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def snapshots(links: DataFrame, path: str) -> None:
    """Links by day and category; only the days and categories that occur are replaced."""
    links.where("category is not null").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds", "category").parquet(path)


def history_version(history: DataFrame, path: str, version: int) -> str:
    """The history, sorted, as a new version beside those before: readers of an older one aren't disturbed."""
    where = f"{path}/v={version}"
    history.select("url").distinct().repartitionByRange("url").sortWithinPartitions("url").write.mode("overwrite").parquet(where)
    return where


def cleared(df: DataFrame, path: str) -> None:
    """An empty table of the same columns in place of the one at `path`."""
    df.limit(0).write.mode("overwrite").parquet(path)


def as_document(df: DataFrame, path: str) -> None:
    """The one text column of a frame as a text file."""
    df.coalesce(1).write.mode("overwrite").text(path)
