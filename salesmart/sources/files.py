"""File readers. Each returns the file's rows unchanged; repairs belong to the layers above."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How the source exports are written.
CSV_ENCODING = "Cp850"
XML_ROW_TAG = "_empty_"

_LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    encoding: str = CSV_ENCODING,
    file_glob: str | None = None,
    quoted_breaks: bool = True,
) -> DataFrame:
    """CSV with a header.

    ``quoted_breaks`` reads line breaks inside quotes, which stops Spark from splitting one file over tasks; turn it off
    for exports without them, so that large files split. Pass ``schema`` on large inputs to save the inference pass.
    """
    if encoding.lower() not in ("utf-8", "utf8") and spark.conf.get(_LEGACY_CHARSETS, "false") != "true":
        raise ValueError(
            f"code page {encoding} needs {_LEGACY_CHARSETS}=true: Spark 4 otherwise accepts a short list of charsets"
        )
    reader = spark.read.option("header", True).option("multiLine", quoted_breaks).option("encoding", encoding)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_xml(
    spark: SparkSession, path: str, row_tag: str = XML_ROW_TAG, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).format("xml").load(path)


_READERS = {"csv": read_csv, "xml": read_xml}


def read_source(spark: SparkSession, path: str, file_type: str, **options) -> DataFrame:
    """Dispatch on the file type. Workbooks come in as grid rows, see :mod:`salesmart.sources.grid`."""
    if file_type not in _READERS:
        raise ValueError(f"unsupported file type {file_type!r} for {path}; known: {sorted(_READERS)}")
    return _READERS[file_type](spark, path, **options)


def _headers(spark: SparkSession, directory: str, file_glob: str, encoding: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a glob by their header. Files are listed without reading them; of each only the header is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).load(directory).select("path")
    files: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(r.path for r in listed.collect()):
        columns = spark.read.option("header", True).option("encoding", encoding).csv(path).columns
        files.setdefault(tuple(columns), []).append(path)
    return files


def read_matching_csv(
    spark: SparkSession, directory: str, file_glob: str, schema: StructType | str | None = None,
    encoding: str = CSV_ENCODING, allow_missing: bool = False, **options,
) -> DataFrame:
    """All files of one glob, matched by column name and labelled with the file each row came from.

    Files with the same header are one scan; scans are united by name. A file that lacks a column of another one is an
    error unless ``allow_missing``, which fills it with NULL. A missing directory fails with ``PATH_NOT_FOUND``, one
    without a matching file with ``FileNotFoundError``.
    """
    by_header = {header: paths for header, paths in _headers(spark, directory, file_glob, encoding).items() if header}
    if not by_header:
        raise FileNotFoundError(f"no file matches {file_glob} in {directory}")
    columns = list(dict.fromkeys(c for header in by_header for c in header))
    short = {path: sorted(set(columns) - set(header)) for header, paths in by_header.items() for path in paths if set(header) != set(columns)}
    if short and not allow_missing:
        raise ValueError(f"columns are missing in files of {file_glob}: {short}")
    types = {f.name: f for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema or StructType())}

    def scan(header: tuple[str, ...], paths: list[str]) -> DataFrame:
        own = StructType([types[c] for c in header]) if types else None
        return read_csv(spark, paths, schema=own, encoding=encoding, **options).withColumn("source_file", F.col("_metadata.file_name"))

    scans = [scan(header, paths) for header, paths in by_header.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), scans)


def _file_lines(spark: SparkSession, path: str, file_glob: str | None) -> DataFrame:
    reader = spark.read
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def count_csv_records(spark: SparkSession, path: str, file_glob: str | None = None) -> DataFrame:
    """Records per file from a second, independent reading: lines and quote parity instead of a CSV parser.

    A record ends at a line end that lies outside quotes, i.e. after an even number of quotes so far. Each
    split counts its line ends for both possible parities of what precedes it; the splits of a file are then
    put in order and the matching count is taken. No file is ever held by one task.
    """
    # Lines are reduced to two small values before they are ordered.
    lines = _file_lines(spark, path, file_glob).select(
        "file_path",
        "file_name",
        "block_start",
        F.monotonically_increasing_id().alias("line_id"),
        F.regexp_count("value", F.lit('"')).alias("quotes"),
        (F.trim("value") == "").alias("blank"),
    )
    # A split is read by one task and holds at most spark.sql.files.maxPartitionBytes, so this window is bounded.
    in_split = Window.partitionBy("file_path", "block_start").orderBy("line_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    seen = lines.withColumn("odd", F.sum("quotes").over(in_split) % 2)
    splits = seen.groupBy("file_path", "file_name", "block_start").agg(
        F.sum("quotes").alias("quotes"),
        F.count_if((F.col("odd") == 0) & ~F.col("blank")).alias("ends_after_even"),
        F.count_if((F.col("odd") == 1) & ~F.col("blank")).alias("ends_after_odd"),
    )
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    ends = F.when(carried == 0, F.col("ends_after_even")).otherwise(F.col("ends_after_odd"))
    return (
        splits.withColumn("ends", ends)
        .groupBy("file_name")
        .agg((F.sum("ends") - F.count_distinct("file_path")).alias("records"))  # one header line per file
    )


def count_xml_records(spark: SparkSession, path: str, row_tag: str = XML_ROW_TAG) -> DataFrame:
    """Records per file by counting opening row tags, line by line."""
    opening = F.regexp_count("value", F.lit(f"<{row_tag}[\\s/>]")) + F.regexp_count("value", F.lit(f"<{row_tag}$"))
    return _file_lines(spark, path, None).groupBy("file_name").agg(F.sum(opening).alias("records"))
