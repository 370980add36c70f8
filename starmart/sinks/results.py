"""Dashboard result sets as JSON."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window, functions as F


def first_row(result: DataFrame) -> dict:
    """The only row of a single-row result, or an empty dict."""
    row = result.first()
    return row.asDict() if row else {}


def payload(result_sets: dict[str, DataFrame], order: dict[str, list]) -> DataFrame:
    """All result sets in one frame: (result_set, position, row as JSON text).

    Dates become ISO text and nulls are kept. ``order`` gives the sort of each
    set with more than one row; sets are dashboard-sized, so numbering them in
    one task is fine.
    """
    frames = []
    for name, result in result_sets.items():
        position = F.row_number().over(Window.orderBy(*order.get(name, [F.lit(1)])))
        frames.append(result.select(
            F.lit(name).alias("result_set"),
            position.alias("position"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row_json"),
        ))
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def write_results(result_sets: dict[str, DataFrame], path: str, parallel: int = 4) -> None:
    """Write each result set as newline-delimited JSON under its name.

    The sets are independent jobs and are submitted together.
    """
    def write(item):
        name, result = item
        result.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(write, result_sets.items()))
