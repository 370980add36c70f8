"""Key lookups that stay balanced when one key holds a large share of the rows.

A fact table joined to a table of keys is shuffled on the key, so a key with a
third of the rows would put a third of the work in one task. Adaptive
execution cannot always split that task (it does not when the lookup is
itself an aggregate), so heavy keys are salted here:

* ``heavy_keys`` finds them with one pass over the key columns. A key is heavy
  when it holds more rows than an even partition, so there are never more heavy
  keys than partitions, and sketches sized by the partitions find them all.
  The sketches are merged in two levels, so no task sees more than ``MERGE_GROUPS``.
* ``lookup_join`` spreads the rows of heavy keys over all shuffle partitions
  and repeats only the heavy keys' lookup rows.

The sketch decides the route of a row, never whether it is kept: any set of
heavy keys, even a wrong one, gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A frequent-item sketch overestimates by at most rows / this many per partition.
TRACKED_PER_PARTITION = 8
MERGE_GROUPS = 512
MOST_TRACKED = 1_000_000  # the largest sketch Spark allows


def partitions(of: DataFrame | SparkSession) -> int:
    session = of.sparkSession if isinstance(of, DataFrame) else of
    return int(session.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(rows: DataFrame, *key_sets: list[str]) -> list[Column]:
    """For each key set, a scalar column holding the hashes of all keys with more rows than an even partition."""
    names = [f"k{i}" for i in range(len(key_sets))]
    parts = partitions(rows)
    tracked = min(MOST_TRACKED, max(1024, TRACKED_PER_PARTITION * parts))
    hashed = rows.select(
        F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("merge_group"),
        *[F.xxhash64(*keys).alias(name) for name, keys in zip(names, key_sets)],
    )
    merged = (
        hashed.groupBy("merge_group")
        .agg(F.count(F.lit(1)).alias("n"),
             *[F.expr(f"approx_top_k_accumulate({n}, {tracked})").alias(n) for n in names])
        .groupBy(F.lit("all"))  # no row, rather than a failure, when there are no sketches to merge
        .agg(F.sum("n").alias("n"), *[F.expr(f"approx_top_k_combine({n}, {tracked})").alias(n) for n in names])
    )
    found = "transform(filter(approx_top_k_estimate({0}, {1}), t -> t.count * {2} > n), t -> t.item)"
    heavy = merged.select(
        F.struct(*[F.expr(found.format(n, min(tracked, 2 * parts), parts)).alias(n) for n in names])
    ).scalar()
    return [heavy[name] for name in names]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    heavy: list[tuple[Column, list[str]]] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds few rows per key (``how``: left, inner, left_semi).

    ``heavy`` lists (heavy hashes, key columns); a row is salted when it is
    heavy in every listed key set. By default the join key itself is sketched.
    """
    if heavy is None:
        heavy = [(heavy_keys(rows, on)[0], on)]
    spread = partitions(rows)

    salted = F.lit(True)
    for hashes, keys in heavy:
        salted = salted & F.coalesce(F.array_contains(hashes, F.xxhash64(*keys)), F.lit(False))

    # The partition id is fixed for a row however often its task is retried,
    # and separates exact copies of a row that a hash of its columns could not.
    salt = F.when(salted, F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(spread)))
    left = rows.withColumn("_salt", F.coalesce(salt.cast("int"), F.lit(0)))
    salts = F.when(salted, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.withColumn("_salt", F.explode(salts))

    if not null_safe:
        return left.join(right, [*on, "_salt"], how).select(*_kept(rows, lookup, on, how))
    right = right.withColumnsRenamed({c: f"_{c}" for c in [*on, "_salt"]})
    matches = F.col("_salt") == F.col("__salt")
    for c in on:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right, matches, how).select(*_kept(rows, lookup, on, how))


def _kept(rows: DataFrame, lookup: DataFrame, on: list[str], how: str) -> list[str]:
    if how == "left_semi":
        return rows.columns
    return rows.columns + [c for c in lookup.columns if c not in on]
