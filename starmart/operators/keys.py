"""Surrogate keys and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Sixteen bits of a digest: enough buckets for any cluster, few enough that the
# table of bucket sizes is always small.
BUCKETS = 1 << 16


def digest(*columns: str) -> Column:
    """MD5 of a natural key; nulls are read as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def digest_bucket(digest_column: str | Column) -> Column:
    """Bucket 0..65535 that grows with the digest. Never null, and known to Spark as such."""
    return F.coalesce(F.conv(F.substring(digest_column, 1, 4), 16, 10).cast("int"), F.lit(0))


def number_rows(rows: DataFrame, key: str, bucket: str, order: list[str]) -> DataFrame:
    """Add the dense key 1..n in the order of (``bucket``, ``order``).

    Rows are numbered inside their bucket and shifted by the number of rows in
    the buckets before it, so no task holds more than its buckets. The running
    total is over at most ``BUCKETS`` rows, which also bounds the broadcast.
    """
    within = Window.partitionBy(bucket).orderBy(*[F.asc_nulls_first(c) for c in order])
    numbered = rows.withColumn("_position", F.row_number().over(within))
    # The last row of a bucket tells its size. Taking the whole row keeps this
    # branch's shuffle identical to the other one, so Spark runs it only once.
    last = F.max(F.struct("_position", *rows.columns))["_position"]
    sizes = numbered.groupBy(bucket).agg(last.alias("_size"))
    offsets = sizes.select(
        bucket, (F.sum("_size").over(Window.orderBy(bucket)) - F.col("_size")).alias("_offset")
    )
    return numbered.join(F.broadcast(offsets), bucket).select(
        (F.col("_offset") + F.col("_position")).alias(key), *rows.columns
    )


def number_groups(rows: DataFrame, key: str, group: str, group_key: str, bucket: str, order: str) -> DataFrame:
    """``number_rows`` in the order of (``bucket``, ``group_key``, ``order``) without moving the rows.

    The rows of a ``group`` lie in one task, and it has one ``group_key`` and one ``bucket``. Only the groups, a row each, are
    dealt by bucket; the rows are numbered in their group and shifted by the number of rows in all groups before it.
    """
    groups = rows.groupBy(group).agg(F.first(group_key).alias(group_key), F.first(bucket).alias(bucket), F.count(F.lit(1)).alias("_rows"))
    so_far = F.sum("_rows").over(Window.partitionBy(bucket).orderBy(group_key))
    summed = groups.withColumn("_end", so_far)
    # the whole row, as in number_rows
    last = F.max(F.struct("_end", *groups.columns))["_end"]
    sizes = summed.groupBy(bucket).agg(last.alias("_size"))
    offsets = sizes.select(
        bucket, (F.sum("_size").over(Window.orderBy(bucket)) - F.col("_size")).alias("_offset")
    )
    shifts = summed.join(F.broadcast(offsets), bucket).select(
        group, (F.col("_offset") + F.col("_end") - F.col("_rows")).alias("_shift"))
    position = F.row_number().over(Window.partitionBy(group).orderBy(F.asc_nulls_first(order)))
    return rows.withColumn("_position", position).join(shifts, group).select(
        (F.col("_shift") + F.col("_position")).alias(key), *rows.columns
    )


def dense_key(rows: DataFrame, key: str, natural_key: list[str]) -> DataFrame:
    """Number rows 1..n by the digest of their natural key.

    Digest order rather than natural order: digests fill the buckets evenly
    whatever the keys look like, and the numbers do not depend on partitioning.
    """
    hashed = rows.withColumn("_digest", digest(*natural_key)).withColumn("_bucket", digest_bucket("_digest"))
    numbered = number_rows(hashed, key, "_bucket", ["_digest", *rows.columns])
    return numbered.select(key, *rows.columns)


def extend_keys(registry: DataFrame | None, rows: DataFrame, key: str, natural_key: list[str]) -> DataFrame:
    """The registry (``key``, ``natural_key``) with every natural key of ``rows``.

    A key once given stays: natural keys that are no longer in ``rows`` keep theirs, and new ones are numbered from the
    greatest key on, in digest order. So keys are the same in every later build, unique, and dense from 1. Missing parts of
    a natural key compare equal. Store the result before the next build reads it.
    """
    found = rows.select(*natural_key).distinct()
    if registry is None:
        return dense_key(found, key, natural_key)
    known = registry.select(*[F.col(c).alias(f"_known_{c}") for c in natural_key])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in natural_key]
    fresh = dense_key(found.join(known, same, "left_anti"), key, natural_key)
    last = registry.agg(F.max(key)).first()[0] or 0
    return registry.select(key, *natural_key).unionByName(fresh.withColumn(key, F.col(key) + F.lit(last)))


def duplicate_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row; empty for a sound dimension."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def assert_unique(table: DataFrame, key: list[str], name: str) -> DataFrame:
    """The table, if each key has one row; a lookup by a repeated key would repeat facts."""
    repeated = duplicate_keys(table, key).count()
    if repeated:
        raise ValueError(f"{name}: {repeated} values of {', '.join(key)} have more than one row")
    return table
