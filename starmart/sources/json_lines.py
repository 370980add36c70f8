"""Newline-delimited JSON sources.

A line is a row when it holds one JSON object and nothing else. Every other line is rejected: text that is not JSON, an
object cut off or followed by anything, and JSON values that are no objects (``42``, ``[1, 2]``, ``"s"``, ``null``),
which have no fields to make a row of. Fields may repeat (the last counts) and numbers may be ``NaN``. Blank lines are
neither kept nor rejected. The same test serves the scan and the audit.

Each line is parsed once: inside an array of typed rows, in front of an end mark, anything that follows the object
breaks the array or moves the mark, so one parse gives the fields and the verdict.

Objects in the fields of ``schemas.SOURCE_TEXT`` keep their source text, byte for byte, up to ``DEEPEST`` levels of
nesting (a deeper one is kept as compact JSON); ``json_value`` reads typed values out of such texts.

A missing path raises Spark's ``PATH_NOT_FOUND`` analysis error; nothing is
caught here, so a build never continues with a source missing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from starmart.schemas import SOURCE_TEXT, SOURCES
from starmart.sinks.tables import write_table

STRICT = {"allowSingleQuotes": "false"}
END = "end of line"
MARK = "__end"
DEEPEST = 8


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of the file under a declared schema, without the rejected lines.

    A readable line whose field has the wrong type is kept with that field null.
    """
    return _rows(_lines(spark, path), schema)


def json_reject_stats(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One row: the number of lines kept and of lines rejected."""
    return _lines(spark, path).select(is_object("value").alias("good")).agg(
        F.count_if("good").alias("kept"), F.count_if(~F.col("good")).alias("rejected")
    )


def is_object(line: str) -> Column:
    """Is the text one JSON object and nothing else?

    Spark's parser stops after the first value. Inside an array, in front of an
    end mark, anything that follows the value breaks the array or moves the mark.
    """
    inside = F.concat(F.lit("["), line, F.lit(f',"{END}"]'))
    values = F.from_json(inside, "array<string>", STRICT)
    return F.coalesce(
        F.ltrim(line).startswith("{") & (F.size(values) == 2) & (F.get(values, 1) == END), F.lit(False))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter("trim(value) != ''")


def _rows(lines: DataFrame, schema: StructType) -> DataFrame:
    """The lines that hold one object, as typed rows.

    A row generator, so that a filter on the rows stays above it and does not parse the lines a second time.
    """
    ended = ArrayType(StructType([*schema.fields]).add(MARK, StringType()))
    inside = F.concat(F.lit("["), "value", F.lit(f',{{"{MARK}":"{END}"}}]'))
    parsed = F.transform(F.array(F.from_json(inside, ended, STRICT)), lambda v: F.when(
        F.ltrim("value").startswith("{") & (F.size(v) == 2) & (F.get(v, 1)[MARK] == END), F.slice(v, 1, 1)))
    rows = lines.select("value", F.inline(F.get(parsed, 0)))
    texts = {f.name: source_text("value", f.name) for f in schema.fields if f.name in SOURCE_TEXT and f.dataType == StringType()}
    return rows.select(*[texts.get(name, F.col(name)).alias(name) for name in schema.fieldNames()])


def value_pattern(deepest: int = DEEPEST) -> str:
    """A JSON value with so many levels below it; every loop is possessive, so long values are read without backtracking."""
    text, other = r'"(?:[^"\\]++|\\.)*+"', r'[^"{}\[\]]++'
    nested = rf"[{{\[](?:{other}|{text})*+[}}\]]"
    for _ in range(deepest - 1):
        nested = rf"[{{\[](?:{other}|{text}|{nested})*+[}}\]]"
    return rf'(?:{text}|{nested}|[^\s",{{}}\[\]]++)'


def source_text(line: str, field: str) -> Column:
    """What stands in the line for the top-level ``field``; its parsed value for strings and where nothing is found."""
    value = value_pattern()
    key = r'"(?:[^"\\]++|\\.)*+"'
    found = F.regexp_extract(line, rf'^\s*+\{{\s*+(?:{key}\s*+:\s*+{value}\s*+,\s*+)*"{field}"\s*+:\s*+({value})', 1)
    return F.when(F.col(field).isNull() | (found == "") | found.startswith('"'), F.col(field)).otherwise(found)


def json_value(text: str | Column, path: str, kind: str) -> Column:
    """A typed value out of JSON text, such as ``json_value("attributes", "$.size", "double")``; null where there is none."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def read_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The five sources, each from the path under its name."""
    return {name: read_json_lines(spark, paths[name], schema) for name, schema in SOURCES.items()}


def stage_sources(
    spark: SparkSession, paths: dict[str, str], out: str, audit: dict[str, dict[str, int]] | None = None
) -> dict[str, DataFrame]:
    """Parse each JSON source once into typed Parquet and return the stored tables.

    Everything downstream then reads columns instead of parsing text again.
    ``audit`` receives the lines kept and rejected per source, counted during
    the write.
    """
    def stage(name: str) -> DataFrame:
        given, kept = Observation(), Observation()
        lines = _lines(spark, paths[name]).observe(given, F.count(F.lit(1)).alias("n"))
        rows = _rows(lines, SOURCES[name]).observe(kept, F.count(F.lit(1)).alias("n"))
        write_table(rows, f"{out}/{name}")
        if audit is not None:
            audit[name] = {"kept": kept.get["n"], "rejected": given.get["n"] - kept.get["n"]}
        return spark.read.parquet(f"{out}/{name}")

    with ThreadPoolExecutor(len(SOURCES)) as pool:  # independent jobs, submitted together
        return dict(zip(SOURCES, pool.map(stage, SOURCES)))
