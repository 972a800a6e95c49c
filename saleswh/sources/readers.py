"""Scans: CSV, tab-delimited dumps, inline rows, Parquet, database tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from saleswh.functions import SALES_FILE_DATE, to_mb
from saleswh.schemas import SCHEMAS
from saleswh.storage import file_system

# Text that means "missing" in the flat sales file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _csv(spark: SparkSession, multi_line: bool):
    """Reader for CSV with a header: quotes are doubled inside quotes, a line of another width is an error.

    ``multi_line`` allows line breaks inside quotes; such a file cannot be split among tasks.
    """
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("mode", "FAILFAST").option("columnPruning", False).option("multiLine", multi_line)
    )


def read_typed_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header, typed by the target table; a malformed line is an error."""
    return _csv(spark, multi_line).schema(schema).csv(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, SCHEMAS["products"])


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types (reads the file twice)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_sales_csv(
    spark: SparkSession,
    path: str,
    date_fmt: str = SALES_FILE_DATE,
    missing: Iterable[str] = MISSING_TOKENS,
    schema: StructType = SCHEMAS["sales_file"],
    multi_line: bool = False,
) -> DataFrame:
    """The flat sales file: latin-1, dates in ``date_fmt``, ``missing`` tokens read as null.

    Columns are matched by header name, so extra file columns and any order are fine.
    Values that are neither missing nor of the column's type are an error.
    """
    raw = _csv(spark, multi_line).option("encoding", "ISO-8859-1").option("nullValue", "").csv(path)
    tokens = list(missing)

    def typed(field):
        text = F.when(~F.col(field.name).isin(tokens), F.col(field.name))
        if isinstance(field.dataType, (TimestampType, DateType)):
            return F.to_timestamp(text, date_fmt).cast(field.dataType).alias(field.name)
        return text.cast(field.dataType).alias(field.name)

    return raw.select(*[typed(f) for f in schema])


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_scaled(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a missing path raises."""
    return spark.read.parquet(path)


def table_options(
    url: str,
    name_or_query: str,
    partition_column: str | None = None,
    lower=None,
    upper=None,
    partitions: int | None = None,
    **connection: str,
) -> dict[str, str]:
    """Reader options for a database table, view or SELECT.

    With a partition column the read is split into that many range queries, so
    no single task pulls the whole table.
    """
    text = name_or_query.strip().rstrip("; \n")
    is_query = text.split(None, 1)[0].lower() in ("select", "with")
    options = {"url": url, "dbtable": f"({text}) AS src" if is_query else text, **connection}
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a split read needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_table(spark: SparkSession, url: str, name_or_query: str, **kwargs) -> DataFrame:
    """Scan a table, view or SELECT over a JDBC connection; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(**table_options(url, name_or_query, **kwargs)).load()


def dataset_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Files and their size in MB under a path, one row; zeros for a missing path.

    Lists files only: their content is not read.
    """
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return spark.createDataFrame([(0, 0.0)], "files bigint, size_mb double")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    )
    return files.agg(
        F.count("*").alias("files"), to_mb(F.coalesce(F.sum("length"), F.lit(0))).alias("size_mb")
    )


def storage_footprint(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Files, rows and bytes of a Parquet dataset, in all or per partition column; no row for a dataset without files.

    Sizes come with the files' metadata and rows are counted from their footers: no column but the partition's is read.
    """
    files = spark.read.parquet(path).groupBy(*by, F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("_rows"), F.max("_metadata.file_size").alias("_bytes")
    )
    sums = files.groupBy(*by).agg(F.count("*").alias("files"), F.sum("_rows").alias("rows"), F.sum("_bytes").alias("bytes"))
    return sums.filter("files > 0")
