"""Operators on links and their history: filters, anti-joins, unions, first-wins and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressglean.functions import url as U
from pressglean.runtime import small_side, written


def unseen(links: DataFrame, history: DataFrame, url_col: str = "url") -> DataFrame:
    """Links whose URL isn't in the history; repeats within the links stay, and so do NULL URLs."""
    return links.join(history.select(F.col(url_col)).distinct(), url_col, "left_anti")


def seen(links: DataFrame, history: DataFrame, url_col: str = "url") -> DataFrame:
    return links.join(history.select(F.col(url_col)).distinct(), url_col, "left_semi")


def extended_history(history: DataFrame, new: DataFrame, url_col: str = "url") -> DataFrame:
    """Set union of both URL columns, without NULLs."""
    return history.select(url_col).unionByName(new.select(url_col)).where(F.col(url_col).isNotNull()).distinct()


def added_count(history: DataFrame, new: DataFrame, url_col: str = "url") -> DataFrame:
    """(total, added): distinct URLs after the union, and those that are new."""
    both = history.select(url_col, F.lit(0).alias("is_new")).unionByName(new.select(url_col, F.lit(1).alias("is_new")))
    each = both.where(F.col(url_col).isNotNull()).groupBy(url_col).agg(F.min("is_new").alias("is_new"))
    return each.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("is_new"), F.lit(0)).alias("added"))


def first_of_each(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by `order`: by a partial aggregate, so hot keys don't gather in one task. NULL is a key."""
    cols = [c for c in df.columns if c not in order]
    first = F.min(F.struct(*order, *cols)) if all(_ordered(df, c) for c in cols) else F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(key).agg(first.alias("first")).select(*(F.col("first")[c].alias(c) for c in df.columns))


def _ordered(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() not in ("map", "variant")


def older_backlog(older: DataFrame, current: DataFrame, history: DataFrame, *order: str, url_col: str = "url") -> DataFrame:
    """Links of earlier days that are neither done nor listed today, the first of each URL."""
    left = unseen(unseen(older, history, url_col), current, url_col).where(F.col(url_col).isNotNull())
    return first_of_each(left, url_col, *order)


def classified(links: DataFrame, url_col: str = "url", **rules) -> DataFrame:
    return links.withColumn("category", U.category(F.col(url_col), **rules))


def category_counts(links: DataFrame, url_col: str = "url", **rules) -> DataFrame:
    """(category, links) of the categories that occur; invalid URLs don't count."""
    c = links.select(U.category(F.col(url_col), **rules).alias("category")).where("category is not null")
    return c.groupBy("category").agg(F.count(F.lit(1)).alias("links"))


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Rows numbered from 1 within `groups` by `order`, in range partitions: no group has to fit one task.

    The order must be total for a stable result. Each partition is numbered by itself and shifted by what
    the partitions before it hold of the group.
    """
    keys = [F.col(c) for c in (*groups, *order)]
    parted = written(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = parted.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = small_side(sizes.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "shifts")
    joined = parted.join(shifts, on=[parted[c].eqNullSafe(shifts[c]) for c in (*groups, "_part")], how="inner").select(parted["*"], shifts["_shift"])
    own = Window.partitionBy(*groups, "_part").orderBy(*order)
    return joined.withColumn(name, (F.row_number().over(own) + F.col("_shift")).cast("long")).drop("_part", "_shift")


def batches(df: DataFrame, groups: list[str], order: list[str], mb: Column, small_mb: float = 1.5, small: int = 3, large: int = 2) -> DataFrame:
    """`df` with large (whether above `small_mb`) and batch_no: small rows first in batches of `small`, then large ones of `large`."""
    sized = df.withColumn("large", mb > small_mb)
    rows = numbered(sized, [*groups, "large"], order, "rn")
    n_small = rows.where("not large").groupBy(*groups).agg(F.ceil(F.max("rn") / small).alias("_small")) if groups else rows.where("not large").agg(F.ceil(F.coalesce(F.max("rn"), F.lit(0)) / small).alias("_small"))
    rows = rows.join(small_side(n_small, "batches"), groups, "left") if groups else rows.join(F.broadcast(n_small))
    no = F.when(F.col("large"), F.coalesce("_small", F.lit(0)) + F.floor((F.col("rn") - 1) / large)).otherwise(F.floor((F.col("rn") - 1) / small)) + 1
    return rows.withColumn("batch", no.cast("long")).drop("_small", "rn")


def even_batches(df: DataFrame, groups: list[str], order: list[str], size: int) -> DataFrame:
    return numbered(df, groups, order, "rn").withColumn("batch", (F.floor((F.col("rn") - 1) / size) + 1).cast("long")).drop("rn")
