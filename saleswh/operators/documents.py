"""Document collection: keyed upsert and the document-style aggregates."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from saleswh.functions import to_double
from saleswh.operators.scd2 import version_attribute_count
from saleswh.sources.writers import latest_path, publish_version, read_latest
from saleswh.storage import file_system, stage

DOCUMENT_FIELDS = (
    "order_id", "order_date", "customer_id", "customer_name", "customer_city",
    "product_id", "product_name", "product_price", "amount",
)


def to_document(view: DataFrame) -> DataFrame:
    """Rows of the as-of view as flat documents; money becomes double."""
    return view.select(*DOCUMENT_FIELDS).withColumns(
        {c: to_double(c) for c in ("product_price", "amount")}
    )


def one_per_key(source: DataFrame, key: str, last_by: str | Sequence[str] | None = None) -> DataFrame:
    """The source with one row per key: the last by ``last_by``.

    Without an order a repeated key is an error, since either row could win. A document without a key is an error too: nothing
    could ever find it again. Rows that are last together are told apart by their other columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    if last_by is None:
        newest = F.any_value(row)
        repeated = F.count("*") > 1
    else:
        order = [last_by] if isinstance(last_by, str) else list(last_by)
        rest = [f.name for f in source.schema if f.name not in order and not isinstance(f.dataType, (MapType, VariantType))]
        newest = F.max_by(row, F.struct(*order, *rest))
        repeated = F.lit(False)
    name = F.col(f"`{key}`")
    grouped = source.groupBy(name.alias("_key")).agg(newest.alias("_row"), repeated.alias("_repeated"))
    wrong = F.when(F.col("_key").isNull(), F.lit("a document has no key")).when(
        F.col("_repeated"), F.concat(F.lit("several documents of key "), F.col("_key").cast("string"))
    )
    checked = grouped.filter(F.when(wrong.isNull(), F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean")))
    # the key comes from the grouping, so rows stay in the partition they are grouped in
    return checked.select(*[(F.col("_key") if c == key else F.col("_row")[c]).alias(c) for c in source.columns])


def _merged(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full outer join by key; the source wins on its fields."""
    fields = [c for c in source.columns if c != key]
    kept = [c for c in target.columns if c != key]
    incoming = source.select(key, F.struct(F.lit(True).alias("_hit"), *fields).alias("_set"))
    hit = F.col("_set").isNotNull()
    merged = []
    for c in [*kept, *[f for f in fields if f not in kept]]:
        old = F.col(c) if c in kept else F.lit(None)
        merged.append((F.when(hit, F.col("_set")[c]).otherwise(old) if c in fields else old).alias(c))
    return target.join(incoming, key, "full_outer").select(key, *merged)


def upsert(target: DataFrame, source: DataFrame, key: str, last_by: str | Sequence[str] | None = None) -> DataFrame:
    """Set the source's fields on the target rows of equal key and add the rows that are new.

    The source wins on its fields, also with a null; other target fields stay. ``last_by``
    orders source rows of one key, the last one wins; without it a repeated key is an error (see one_per_key).
    """
    return _merged(target, one_per_key(source, key, last_by), key)


def publish_orders(
    view: DataFrame, base: str, key: str = "order_id", last_by: str | Sequence[str] | None = None
) -> tuple[str, int]:
    """Upsert the as-of view into the versioned collection at ``base``.

    Returns the path of the new version and the number of documents sent. The batch
    is written once, so counting it does not run the as-of joins again.
    """
    source = stage(one_per_key(to_document(view), key, last_by), "documents")
    target = read_latest(view.sparkSession, base)
    path = publish_version(source if target is None else _merged(target, source, key), base)
    return path, source.count()


def upsert_partitions(
    source: DataFrame, base: str, key: str, part: str, last_by: str | Sequence[str] | None = None
) -> None:
    """Upsert into a dataset laid out by ``part``, rewriting only the partitions the batch touches.

    ``part`` is a column of the documents that never changes for a key, such as the order
    month. The base is read with the batch's type of ``part``, so that "01" stays a string, and touched
    partitions are found by a null-safe join. The merged partitions are written aside first,
    since the old files are read to make them; running the batch again after a failure gives the same result.
    A key that the batch repeats is an error unless ``last_by`` orders its rows.
    """
    spark = source.sparkSession
    batch = stage(one_per_key(source, key, last_by), "batch")
    fs, path = file_system(spark, base)
    if fs.exists(path):
        kept = [batch.schema[f.name] if f.name == part else f for f in spark.read.parquet(base).schema]
        touched = batch.select(F.col(part).alias("_touched")).distinct()
        target = spark.read.schema(StructType(kept)).parquet(base)
        target = target.join(touched, F.col(part).eqNullSafe(F.col("_touched")), "left_semi")
        batch = stage(_merged(target, batch, key), "merged")
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(base)


@dataclass(frozen=True)
class Collection:
    """Documents at ``base`` in ``buckets`` hash buckets of ``key``, a new version directory per batch.

    Each bucket is one file. A batch is dealt to the stored buckets and joined there, so the stored
    documents are read where they lie: only the batch is shuffled, and what comes out is in buckets already.
    A failed batch leaves the version before it valid. ``key`` and ``buckets`` never change for a base.
    """

    base: str
    key: str
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The newest complete version, with its layout known to Spark; None when there is none."""
        found = latest_path(spark, self.base)
        return self._open(spark, found) if found else None

    def upsert(self, source: DataFrame, last_by: str | Sequence[str] | None = None) -> str:
        """Merge a batch and return the path of the new version; see ``upsert`` for the rules."""
        batch = one_per_key(source.repartition(self.buckets, self.key), self.key, last_by)
        target = self.read(source.sparkSession)
        merged = batch if target is None else _merged(target, batch, self.key)
        return publish_version(merged, self.base, self._write)

    def _write(self, df: DataFrame, path: str) -> None:
        # the catalog entry only carries the layout to the writer; the files stay when it goes
        name = f"collection_{uuid.uuid4().hex}"
        try:
            df.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).saveAsTable(name)
        finally:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def _open(self, spark: SparkSession, path: str) -> DataFrame:
        # one catalog entry per version, found again by its path
        name = f"collection_{hashlib.md5(path.encode()).hexdigest()}"
        columns = spark.read.parquet(path).schema.toDDL()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return spark.table(name)


def distinct_cities_by_customer(docs: DataFrame) -> DataFrame:
    """Cities seen on each customer's documents, and the name on the first one."""
    by = ["customer_id", "customer_name", "customer_city"]
    seen = docs.groupBy(*by).agg(F.min("order_id").alias("_first"))
    return seen.groupBy("customer_id").agg(
        F.min_by("customer_name", "_first").alias("customer_name"),
        F.countDistinct("customer_city").alias("num_distinct_cities"),
    )


def amount_by_city_desc(docs: DataFrame) -> DataFrame:
    totals = docs.groupBy("customer_city").agg(F.sum("amount").alias("total_amount"))
    return totals.orderBy(F.col("total_amount").desc(), F.col("customer_city").asc_nulls_last())


def price_gap_total_doc(docs: DataFrame) -> DataFrame:
    """Sum of price minus amount; no row at all for an empty collection."""
    gaps = docs.agg(
        F.sum(F.col("product_price") - F.col("amount")).alias("total_diff"), F.count("*").alias("_n")
    )
    return gaps.filter(F.col("_n") > 0).select("total_diff")


def distinct_cities_by_history(customers: DataFrame) -> DataFrame:
    """Distinct cities over each customer's version history."""
    return version_attribute_count(customers, "customer_id", "city", "distinct_cities")


def sales_by_city(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("customer_city")
        .agg(F.sum("amount").alias("total_sales_amount"))
        .orderBy(F.col("customer_city").asc_nulls_last())
    )


def price_gap_total(view: DataFrame) -> DataFrame:
    """Sum of list price at order time minus the paid amount; one row, null when empty."""
    return view.agg(F.sum(F.col("product_price") - F.col("amount")).alias("diff_between_price_and_paid"))
