"""Raw extracts: stored layouts, and reads that bind declared columns by name."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.functions.expressions import all_true, utc_instant
from lockgate.layouts import RAW_LAYOUT
from lockgate.sources import storage

FORMATS = ("parquet", "csv")

#: One row per data file.
FILE_FIELDS = "extract string, file string, columns array<struct<name: string, type: string>>"
#: One row per extract and layout, with the number of files that have it.
LAYOUT_FIELDS = "extract string, columns array<struct<name: string, type: string>>, files bigint"


def _as_stored(
    spark: SparkSession, path: str | list[str], fmt: str, base: str | None = None
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}: {fmt!r}")
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.option("basePath", base) if base else spark.read
    if fmt == "parquet":
        return reader.parquet(*paths)
    # enforceSchema off makes Spark compare every file's header with the first
    # one, so files with differing column orders fail instead of mixing columns.
    return reader.options(header=True, inferSchema=False, enforceSchema=False).csv(paths)


def stored_schema(spark: SparkSession, path: str, *, fmt: str = "parquet") -> T.StructType:
    """The layout of an extract whose files agree, by Spark's reader; CSV has names only.

    Spark looks at one file; :func:`stored_layouts` sees them all."""
    return _as_stored(spark, path, fmt).schema


def file_layouts(
    spark: SparkSession, paths: str | Sequence[str], *, fmt: str = "parquet"
) -> DataFrame:
    """The layout of every data file of the extracts, read by the executors.

    Nothing but footers (or header lines) is read. Hidden files and folders are passed
    over, and so are CSV files without a byte. An extract without data files gets one row
    that has no file and no columns.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}: {fmt!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    most = spark.sparkContext.defaultParallelism * 4
    extracts = spark.createDataFrame([(path,) for path in paths], "extract string")
    extracts = extracts.repartition(max(1, min(len(paths), most)), "extract")
    files = extracts.mapInArrow(_file_lister(fmt), "extract string, file string")
    return files.repartition("extract", "file").mapInArrow(_layout_reader(fmt), FILE_FIELDS)


def by_layout(files: DataFrame) -> DataFrame:
    """The rows of :func:`file_layouts` as one row per extract and layout."""
    return files.groupBy("extract", "columns").agg(F.count("file").alias("files"))


def stored_layouts(
    spark: SparkSession, paths: str | Sequence[str], *, fmt: str = "parquet"
) -> DataFrame:
    """The layouts that extracts hold: one row for each that any of their files has."""
    return by_layout(file_layouts(spark, paths, fmt=fmt))


# The functions that run on executors are closures with their own imports: they travel
# to the workers by value, which then need no copy of this package.


def _locator():
    def locate(name: str):
        from urllib.parse import quote

        from pyarrow.fs import FileSystem

        scheme, mark, rest = name.replace("s3a://", "s3://", 1).partition("://")
        if mark:
            return FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")
        return FileSystem.from_uri("file://" + quote(name.removeprefix("file:")))

    return locate


def _file_lister(fmt: str):
    locate = _locator()

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs as arrow_fs

        def files(extract: str) -> list[str | None]:
            system, path = locate(extract)
            if system.get_file_info(path).type != arrow_fs.FileType.Directory:
                return [extract]
            below = len(path.rstrip("/")) + 1
            found = []
            for info in system.get_file_info(arrow_fs.FileSelector(path, recursive=True)):
                inner = info.path[below:]
                hidden = any(part[:1] in "._" and "=" not in part for part in inner.split("/"))
                if info.is_file and not hidden and (info.size or fmt != "csv"):
                    found.append(f"{extract.rstrip('/')}/{inner}")
            return found or [None]

        for batch in batches:
            for extract in batch.column("extract").to_pylist():
                held = files(extract)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([extract] * len(held)), pa.array(held, pa.string())],
                    ["extract", "file"],
                )

    return read


def _layout_reader(fmt: str):
    SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
    locate = _locator()

    def read(batches: Iterator) -> Iterator:
        import csv
        import json

        import pyarrow as pa
        from pyarrow import parquet
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        fields = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
        layout = pa.schema([("extract", pa.string()), ("file", pa.string()), ("columns", fields)])

        def columns(file: str | None) -> list[dict]:
            if file is None:
                return []
            system, path = locate(file)
            if fmt == "csv":
                with system.open_input_stream(path) as stream:
                    header = next(csv.reader([_first_line(stream)]))
                return [{"name": name, "type": "string"} for name in header]
            with system.open_input_file(path) as source:
                footer = parquet.read_metadata(source)
            written_by_spark = (footer.metadata or {}).get(SPARK_SCHEMA)
            if written_by_spark:
                spark_types = StructType.fromJson(json.loads(written_by_spark))
            else:
                arrow = footer.schema.to_arrow_schema()
                spark_types = from_arrow_schema(arrow, prefer_timestamp_ntz=True)
            # Arrow takes the old 96-bit times for local ones; Spark does not.
            leaves = (footer.schema.column(i) for i in range(len(footer.schema)))
            instants = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
            return [
                {
                    "name": f.name,
                    "type": "timestamp" if f.name in instants else f.dataType.simpleString(),
                }
                for f in spark_types
            ]

        def _first_line(stream) -> str:
            line = b""
            while b"\n" not in line:
                block = stream.read(65536)
                if not block:
                    break
                line += block
            return line.split(b"\n", 1)[0].decode("utf-8").rstrip("\r")

        for batch in batches:
            pairs = zip(batch.column("extract").to_pylist(), batch.column("file").to_pylist(), strict=True)
            rows = [{"extract": e, "file": f, "columns": columns(f)} for e, f in pairs]
            yield pa.RecordBatch.from_pylist(rows, schema=layout)

    return read


def _declared(stored: DataFrame, field: T.StructField, *, case_sensitive: bool) -> Column:
    """The stored column that a declared one names, converted to its type."""
    exact = [f for f in stored.schema if f.name == field.name]
    alike = [f for f in stored.schema if f.name.casefold() == field.name.casefold()]
    found = exact or ([] if case_sensitive else alike)
    if not found:
        return F.lit(None).cast(field.dataType).alias(field.name)
    kind = found[-1].dataType
    value = F.col(f"`{found[-1].name}`")
    if kind == field.dataType:
        return value.alias(field.name)
    if isinstance(field.dataType, T.TimestampType):
        # Times without a zone are UTC, not the session's zone.
        if isinstance(kind, (T.TimestampNTZType, T.DateType)):
            return utc_instant(value.cast("timestamp_ntz")).alias(field.name)
        if isinstance(kind, T.StringType):
            as_utc = [F.concat(value, F.lit(end)) for end in ("Z", " 00:00:00Z")]
            readings = [text.try_cast("timestamp") for text in (*as_utc, value)]
            return F.coalesce(*readings).alias(field.name)
    # try_cast, so that ANSI mode does not decide between null and an error.
    return value.try_cast(field.dataType).alias(field.name)


def conform(
    stored: DataFrame, declared: T.StructType = RAW_LAYOUT, *, case_sensitive: bool = False
) -> DataFrame:
    """Projects a frame onto a declared layout, by name.

    Absent columns become null and undeclared ones are dropped; both stay
    unread. A value that does not convert becomes null.
    """
    return stored.select(*[_declared(stored, f, case_sensitive=case_sensitive) for f in declared])


def _within(
    stored: DataFrame, name: str, since: date | None, until: date | None, undated: bool
) -> DataFrame:
    """Rows whose time without a zone lies on the days asked for, as a range on the stored
    column, which the Parquet reader can use. Columns of other types are left to the caller."""
    for field in stored.schema:
        if field.name.casefold() == name.casefold() and isinstance(field.dataType, T.TimestampNTZType):
            value = F.col(f"`{field.name}`")
            bounds = []
            if since:
                bounds.append(value >= F.lit(f"{since} 00:00:00").cast("timestamp_ntz"))
            if until:
                after = until + timedelta(days=1)
                bounds.append(value < F.lit(f"{after} 00:00:00").cast("timestamp_ntz"))
            inside = all_true(bounds)
            stored = stored.filter(inside | value.isNull() if undated else inside)
    return stored


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    fmt: str = "parquet",
    declared: T.StructType = RAW_LAYOUT,
    files: DataFrame | None = None,
    days: tuple[str, date | None, date | None] | None = None,
    undated: bool = False,
) -> DataFrame:
    """One or many raw extracts in the declared layout.

    Files are read as they are stored and converted afterwards, because the Parquet reader
    refuses several lossless widenings, and takes the layout of one file for that of all.
    Extracts of one layout share a scan; an extract of several layouts has one for each.
    ``files`` saves reading the footers again when :func:`file_layouts` is at hand.
    ``days`` names a time column and the first and last day wanted of it: a hint that skips
    row groups, which doesn't replace a filter on the result. ``undated`` keeps the rows
    without that time.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = files if files is not None else file_layouts(spark, paths, fmt=fmt)
    found = found.groupBy("extract", F.to_json("columns").alias("layout")).agg(
        F.sort_array(F.collect_list("file")).alias("files")
    )
    # Names of files reach the driver for extracts of several layouts only.
    several = F.count(F.lit(1)).over(Window.partitionBy("extract")) > 1
    found = found.withColumn("several", several).withColumn("files", F.when(F.col("several"), F.col("files")))
    whole: dict[str, list[str]] = {}
    scans: list[tuple[list[str], str | None]] = []
    for row in found.orderBy("extract", "layout").collect():
        if row.several:
            scans.append((row.files, row.extract))
        else:
            whole.setdefault(row.layout, []).append(row.extract)
    scans += [(extracts, None) for extracts in whole.values()]
    result = None
    for chosen, base in scans:
        stored = _as_stored(spark, chosen, fmt, base)
        if days:
            stored = _within(stored, *days, undated)
        frame = conform(stored, declared)
        result = frame if result is None else result.unionByName(frame)
    return result


def read_dataset(
    spark: SparkSession, path: str, declared: T.StructType, *, fmt: str = "parquet"
) -> DataFrame:
    """Any dataset for a stand-alone check, in its layer's declared types.

    Its files may differ in columns and types: their layouts are read first, as for raw extracts.
    """
    return read_raw(spark, path, fmt=fmt, declared=declared)


def export(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Writes a whole dataset; CSV gets a header and keeps blanks in its strings."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, **keep).csv(path)
    elif fmt == "parquet":
        writer.parquet(path, compression=storage.CODEC)
    else:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}: {fmt!r}")
