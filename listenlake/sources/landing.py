"""Streaming reads of a landing folder whose schema may grow, and whose columns may change their type.

New columns are added, and a type gives way to a wider one that holds all its values. A column whose new type
doesn't fit keeps the type it has; its new values go, as they are, to a column of variants beside it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

from listenlake import fixed
from listenlake.sources import fs
from listenlake.sources.state import StateLog

# files count as new however old their times say they are: a copy keeps the time of its original
ANY_AGE = "36500d"

NO_FILES = ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")

# names the folders of a bronze table, one for each micro-batch
BATCH = "batch"

AUDIT_FIELDS = (
    StructField("input_file_path", StringType()),
    StructField("ingest_timestamp", TimestampType()),
    StructField("ingest_date", DateType()),
)


# holds, by column, the values that came in a type that doesn't fit
RESCUED = StructField("_rescued", VariantType())

# stands for a file's columns in a stream that reads none
NO_COLUMN = "_no_column"

WHOLE_NUMBERS = (ByteType(), ShortType(), IntegerType(), LongType())
# whole numbers that a double holds exactly
SHORT_NUMBERS = WHOLE_NUMBERS[:3]
# the error is not among those that PySpark translates
MERGE_CONFLICT = "CANNOT_MERGE_SCHEMAS"


def wider(one: DataType, other: DataType) -> DataType | None:
    """The type that holds all values of both, and that files of either can be read as; none if there is none."""
    if one == other:
        return one
    if one in WHOLE_NUMBERS and other in WHOLE_NUMBERS:
        return max(one, other, key=WHOLE_NUMBERS.index)
    if all(t in (*SHORT_NUMBERS, FloatType(), DoubleType()) for t in (one, other)):
        return DoubleType()
    return None


def widen(known: StructType | None, found: StructType | None) -> StructType | None:
    """Known columns, widened where a found one needs it, then columns seen for the first time.

    If a type doesn't fit, the known one stays and there is a column for rescued values.
    """
    if known is None or found is None:
        return known or found
    types = {f.name: f.dataType for f in found}
    both = {f.name: wider(f.dataType, types[f.name]) for f in known if f.name in types}
    fields = [StructField(f.name, both.get(f.name) or f.dataType, f.nullable) for f in known]
    fields += [StructField(f.name, f.dataType, True) for f in found if f.name not in known.names]
    if None in both.values() and RESCUED.name not in [f.name for f in fields]:
        fields.append(RESCUED)
    return StructType(fields)


def fitted(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows with the columns of the schema; what doesn't fit is rescued. Other columns of the rows stay behind them."""
    types = {f.name: f.dataType for f in rows.schema}
    odd = [f.name for f in schema if f.name in types and wider(f.dataType, types[f.name]) != f.dataType]
    columns = {
        f.name: (F.col(f.name) if f.name in types and f.name not in odd else F.lit(None)).cast(f.dataType)
        for f in schema
        if f != RESCUED or f.name in types
    }
    if odd:
        some = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in odd))
        columns[RESCUED.name] = F.when(some, F.to_variant_object(F.struct(*odd)))
    elif RESCUED.name in schema.names and RESCUED.name not in types:
        columns[RESCUED.name] = F.lit(None).cast(RESCUED.dataType)
    rest = [c for c in rows.columns if c not in schema.names]
    return rows.select(*[columns[f.name].alias(f.name) for f in schema], *rest)


def stored_schema(store: StateLog) -> StructType | None:
    entry = store.latest()
    return StructType.fromJson(entry["schema"]) if entry else None


def landing_schema(
    spark: SparkSession, path: str, store: StateLog, options: Mapping[str, str] | None = None
) -> StructType:
    """The remembered schema, widened by all files that are there.

    Footers are read in a Spark job.
    """
    if not fs.children(spark, path):
        raise FileNotFoundError(f"nothing has landed in {path} yet")
    reader = spark.read.options(**(options or {}))
    try:
        found = reader.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in NO_FILES:
            raise
        raise FileNotFoundError(f"nothing has landed in {path} yet") from None
    except Py4JJavaError as error:
        if MERGE_CONFLICT not in str(error.java_exception):
            raise
        files = sorted(reader.schema("none int").parquet(path).inputFiles())
        found = reduce(widen, (schema for schema, _ in alike(spark, files)))
    return remember(store, found)


def alike(spark: SparkSession, files: list[str]) -> Iterator[tuple[StructType, list[str]]]:
    """The files in groups whose columns agree in type, each with its schema, in order. Few conflicts take few jobs."""
    try:
        yield spark.read.option("mergeSchema", "true").parquet(*files).schema, files
    except Py4JJavaError as error:
        if MERGE_CONFLICT not in str(error.java_exception) or len(files) == 1:
            raise
        half = len(files) // 2
        yield from alike(spark, files[:half])
        yield from alike(spark, files[half:])


def remember(store: StateLog, found: StructType) -> StructType:
    """The remembered schema widened by ``found``, and remembered."""
    known = stored_schema(store)
    schema = widen(known, found)
    if schema != known:
        store.append({"schema": json.loads(schema.json())})
    return schema


def files_with_all_columns(batch: DataFrame, store: StateLog, stamp: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """The rows of the files that a micro-batch was read from, read anew with every column they have, and stamped.

    The stream's schema was fixed when it began; these files may have come later, and hold more columns or other
    types. The list of files is bounded by ``max_files``. None if the files have no rows.
    """
    spark = batch.sparkSession
    files = sorted(row[0] for row in batch.select("input_file_path").distinct().collect())
    if not files:
        return None
    groups = list(alike(spark, files))
    schema = remember(store, reduce(widen, (found for found, _ in groups)))
    frames = [fitted(stamp(spark.read.schema(found).parquet(*some)), schema) for found, some in groups]
    return reduce(DataFrame.unionByName, frames)


def read_landing_stream(
    spark: SparkSession,
    path: str,
    store: StateLog,
    max_files: int = fixed.MAX_FILES,
    options: Mapping[str, str] | None = None,
    columns: bool = True,
) -> DataFrame:
    """New files of the folder as a stream. ``max_files`` bounds what one micro-batch takes.

    ``options`` are Spark's file-source options, such as ``pathGlobFilter``. Without ``columns`` the stream tells
    which files are new and reads none of their columns, whose types may have changed (see ``files_with_all_columns``).
    """
    schema = stored_schema(store) or landing_schema(spark, path, store, options)
    schema = schema if columns else StructType([StructField(NO_COLUMN, StringType())])
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).options(**(options or {}))
    return reader.option("maxFilesPerTrigger", max_files).parquet(path)


def read_bronze_stream(
    spark: SparkSession, path: str, store: StateLog, max_files: int = fixed.MAX_FILES
) -> DataFrame:
    """A bronze table as a stream: the landing schema remembered at ingestion, plus audit columns."""
    landed = stored_schema(store)
    if landed is None:
        raise FileNotFoundError(f"{path} has not been ingested yet")
    reader = spark.readStream.schema(StructType([*landed, *AUDIT_FIELDS])).option("maxFileAge", ANY_AGE)
    return reader.option("maxFilesPerTrigger", max_files).parquet(path).drop(BATCH)
