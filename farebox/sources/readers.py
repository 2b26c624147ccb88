"""Trip-file scans."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.columns import widen_integers
from farebox.schema import ID_COLS, trip_schema

MALFORMED = "_malformed"
SCHEMA_READERS = 16


def read_trips(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    months: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Parquet scan of a file, folder, glob or list of them.

    ``months`` keeps the given (year, month) partitions of a layer; the predicate is on the
    partition columns, so the other months' files are never listed into the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if months is None:
        return df
    wanted = [(F.col("data_year") == y) & (F.col("data_month") == m) for y, m in months]
    return df.filter(reduce(Column.__or__, wanted, F.lit(False)))


def read_trip_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV scan against a fixed schema; nothing is inferred, so the files are read once."""
    reader = spark.read.option("header", header).schema(schema or trip_schema())
    return reader.csv(path if isinstance(path, str) else list(path))


def parse_trip_lines(
    lines: DataFrame,
    schema: T.StructType,
    header: str | None = None,
    sep: str = ",",
    required: Sequence[int] = (0, 1, 2),
) -> DataFrame:
    """Split a ``value`` column of text lines into typed fields plus ``reject_reason``.

    A line is rejected when its field count is wrong (``field_count``), when a required field
    is empty (``empty_required``) or when a non-empty field does not parse as its declared type
    (``bad_value``). Quoting is not interpreted. Lines equal to ``header`` are left out.
    """
    body = lines if header is None else lines.filter(F.col("value") != F.lit(header))
    names = [f.name for f in schema.fields]
    target = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
    options = {"sep": sep, "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    fields = F.from_csv("value", target.toDDL(), options)
    # inline is a barrier for filters on its output: each line is parsed once, not once more
    # inside every predicate on the parsed columns
    parsed = body.select("value", F.inline(F.array(fields)))
    missing = reduce(Column.__or__, [F.col(names[i]).isNull() for i in required], F.lit(False))
    parts = F.split("value", _literal_pattern(sep), -1)
    empty = reduce(Column.__or__, [F.get(parts, F.lit(i)) == "" for i in required], F.lit(False))
    reason = F.when(
        F.col(MALFORMED).isNotNull() | missing,
        F.when(F.size(parts) != len(names), "field_count").when(empty, "empty_required").otherwise("bad_value"),
    )
    return parsed.select("value", *names, reason.alias("reject_reason"))


def read_trip_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    required: Sequence[int] = (0, 1, 2),
    header: str | bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Validating text scan: (typed good rows, rejected lines with their reason).

    ``header`` is the header line itself, of which every copy in any file is dropped; True takes
    the first line read for it; False, the default, treats every line as data.
    """
    schema = schema or trip_schema()
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    if header is True:
        first = lines.first()
        header = first["value"] if first is not None else False
    parsed = parse_trip_lines(lines, schema, header or None, sep, required)
    good = parsed.filter(F.col("reject_reason").isNull()).drop("value", "reject_reason")
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")
    return good, rejects


def _literal_pattern(sep: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() else c for c in sep)


def union_aligned(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name; int and long columns meet as long."""
    if not dfs:
        raise ValueError("union_aligned needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def align_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: names and types as declared, absent columns null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_trip_files(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    source_col: str | None = None,
) -> DataFrame:
    """Monthly Parquet files whose column types differ, as one aligned DataFrame.

    With a ``schema`` the result has exactly its columns. Without one every column of every
    file is kept: id columns and integers become long, and a column that a month lacks is null.
    Paths that share a physical schema share one scan, so the plan grows with the number of
    distinct schemas (a handful), not with the number of files. ``source_col`` names a column
    for the path of the file each row came from, which is gone after the union otherwise. The
    footers are read by ``SCHEMA_READERS`` threads at a time.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(SCHEMA_READERS) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    for path, physical in zip(paths, schemas):
        groups.setdefault(physical.json(), (physical, []))[1].append(path)
    scans = [spark.read.schema(physical).parquet(*members) for physical, members in groups.values()]
    if schema is None:
        aligned = [_with_long_ids(scan) for scan in scans]
    else:
        aligned = [align_types(scan, schema) for scan in scans]
    if source_col is not None:
        aligned = [part.withColumn(source_col, F.col("_metadata.file_path")) for part in aligned]
    return union_aligned(*aligned, allow_missing=True)


def _with_long_ids(df: DataFrame) -> DataFrame:
    ids = {c: F.col(c).try_cast("bigint") for c in ID_COLS if c in df.columns}
    return widen_integers(df.withColumns(ids) if ids else df)
