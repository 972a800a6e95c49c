"""Star schema: build it from the flat sales file, and join it back to one wide frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions import day, day_name, in_order, month_name
from saleswh.operators.keys import assign_key
from saleswh.operators.quality import Rules, observe
from saleswh.operators.relational import conform, distinct_dim
from saleswh.operators.skew import likely_hot, lookup_join
from saleswh.schemas import CUSTOMER_COLUMNS, DATE_COLUMNS, FACT_COLUMNS, PRODUCT_COLUMNS
from saleswh.storage import stage

FLAT_COLUMNS = {
    "fact": ("order_number", "order_line_number", "quantity_ordered", "price_each", "sales", "deal_size"),
    "product": ("product_code", "product_line", "msrp"),
    "customer": ("customer_name", "city", "state", "country", "territory"),
    "date": ("order_date", "year_id", "month_id", "month_name", "qtr_id", "day_of_week"),
}


#: The stored fact lies in a folder per year and month, of the calendar columns of its date; none counts as 0.
PLACES = {"place_year": "year_id", "place_month": "month_id"}


@dataclass(frozen=True)
class Star:
    """The fact table and its three dimensions.

    placed: the fact as stored, with the columns of PLACES, when it is laid out by month. whole: every fact row is known to have
    its three dimension rows, as in a star that run_star_etl has built.
    """

    fact: DataFrame
    product: DataFrame
    customer: DataFrame
    date: DataFrame
    placed: DataFrame | None = None
    whole: bool = False
    violations: Mapping[str, int] | None = None

    def flat(self, columns: Sequence[str] | None = None) -> DataFrame:
        """Fact rows with their dimension columns, all twenty or the chosen ones.

        Dimensions that own no chosen column only filter, by their keys, so any choice gives the same rows; in a whole star
        they have nothing to filter. A fact laid out by month also joins the dates by year and month, so that a filter on
        dates reaches the folders of the fact at run time.
        """
        wanted = list(columns or [c for cols in FLAT_COLUMNS.values() for c in cols])
        out = self.fact if self.placed is None else self.placed
        for name in ("date", "product", "customer"):
            on = [f"{name}_key"]
            dim = getattr(self, name)
            if name == "date" and self.placed is not None:
                dim = dim.withColumns({p: F.coalesce(c, F.lit(0)) for p, c in PLACES.items()})
                on += PLACES
            cols = [c for c in FLAT_COLUMNS[name] if c in wanted]
            if cols:
                out = out.join(dim.select(*on, *cols), on)
            elif not self.whole:
                out = out.join(dim.select(*on), on, "left_semi")
        return out.select(*wanted)


def build_dim_product(flat: DataFrame) -> DataFrame:
    return _keyed_dim(flat, PRODUCT_COLUMNS, "product_key")


def build_dim_customer(flat: DataFrame) -> DataFrame:
    return _keyed_dim(flat, CUSTOMER_COLUMNS, "customer_key")


def build_dim_date(flat: DataFrame) -> DataFrame:
    d = "order_date"
    return _keyed_dim(_by_day(flat), DATE_COLUMNS, "date_key").withColumns(
        {"month_name": month_name(d), "day": day(d), "day_of_week": day_name(d)}
    )


def _by_day(flat: DataFrame) -> DataFrame:
    return flat.withColumn("ORDERDATE", F.to_date("ORDERDATE"))


def _keyed_dim(flat: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """Distinct natural keys of the flat frame, renamed and numbered in natural-key order."""
    rows = conform(distinct_dim(flat, list(columns)), {dst: src for src, dst in columns.items()})
    return assign_key(rows, list(columns.values()), key)


def tuple_hash(columns: Sequence[Column]) -> Column:
    """64 bits of a tuple; a null is told from any value."""
    return F.xxhash64(*[part for c in columns for part in (c, c.isNull())])


@dataclass(frozen=True)
class Lookup:
    """A dimension and its surrogate key, found by {column of the rows: column of the dimension}."""

    dim: DataFrame
    columns: Mapping[str, str]
    key: str

    def hash_of_rows(self) -> Column:
        types = self.dim.schema
        return tuple_hash([F.col(src).cast(types[c].dataType) for src, c in self.columns.items()])

    def hash_of_dim(self) -> Column:
        return tuple_hash([F.col(c) for c in self.columns.values()])


def lookup_key(df: DataFrame, dim: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """Add the surrogate key of the dimension row equal on all columns, null matching null."""
    return lookup_keys(df, [Lookup(dim, columns, key)])


def lookup_keys(
    df: DataFrame, lookups: Sequence[Lookup], covered: bool = False, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Add the surrogate keys of several dimensions, each unique on its natural columns; rows without one are dropped.

    Rows meet dimension rows by one 64-bit hash of the null-marked natural columns; those of hot hashes are dealt into parts. The
    natural columns are compared again, null matching null, unless ``covered``: the dimensions hold every natural key
    of the rows (they were made from them) and no two keys of a dimension share a hash, which is checked on the
    dimension. Then equal hashes mean equal keys, and only the hashes are shuffled.
    """
    hashes = {f"_hash_{x.key}": x.hash_of_rows() for x in lookups}
    out = df.withColumns(hashes)
    hot = likely_hot(out, list(hashes))
    for x in sorted(lookups, key=lambda x: -len(x.columns)):  # the widest first: its columns need not travel on
        name = f"_hash_{x.key}"
        natural = x.dim.select(F.col(x.key), *[F.col(c).alias(f"_dim_{c}") for c in x.columns.values()], x.hash_of_dim().alias(name))
        shared = natural.groupBy(name).agg(F.count("*").alias("_n")).filter("_n > 1")
        apart = shared.isEmpty()
        if apart and hot[name] is not None:
            out = lookup_join(out, natural, [name], "inner", hot[name], spread_by=spread_by)
        else:  # no hot key, or several candidates for some hashes
            out = out.join(natural, name)
        if not (covered and apart):
            out = out.filter(reduce(lambda a, b: a & b, [F.col(src).eqNullSafe(F.col(f"_dim_{c}")) for src, c in x.columns.items()]))
        out = out.drop(*[f"_dim_{c}" for c in x.columns.values()])
    return out.select(*df.columns, *[x.key for x in lookups])


def build_fact(
    flat: DataFrame, product: DataFrame, customer: DataFrame, date: DataFrame, covered: bool = False
) -> DataFrame:
    """Flat rows with the three natural keys replaced by surrogate keys, nine columns.

    covered: the dimensions were built from ``flat`` (see lookup_keys).
    """
    keyed = lookup_keys(
        _by_day(flat),
        [
            Lookup(date, DATE_COLUMNS, "date_key"),
            Lookup(product, PRODUCT_COLUMNS, "product_key"),
            Lookup(customer, CUSTOMER_COLUMNS, "customer_key"),
        ],
        covered,
        ["ORDERNUMBER", "ORDERLINENUMBER"],
    )
    return conform(keyed, {dst: src for src, dst in FACT_COLUMNS.items()})


#: What the star's tables must hold; counted while they are written.
RULES = {
    "dim_product": Rules(not_null=("product_code",), max_len={"product_code": 50, "product_line": 50}, least={"msrp": 0}),
    "dim_customer": Rules(not_null=("customer_name",), max_len={"customer_name": 100, "city": 50, "country": 50}),
    "dim_date": Rules(not_null=("order_date",)),
    "fact_sales": Rules(
        not_null=("order_number", "product_key", "customer_key", "date_key", "sales"),
        least={"quantity_ordered": 0, "price_each": 0, "sales": 0},
    ),
}


def run_star_etl(flat: DataFrame, out: str, by_month: bool = True) -> Star:
    """Build the star from the flat frame and write it, dimensions before the fact.

    The flat frame is read four times, so it is first written once in columnar form: a
    text file is parsed once, and each dimension reads its own columns only. The fact is
    keyed from the written dimensions, so keys agree also after a retry and Spark knows
    the dimensions' true sizes when it plans the joins. It is laid out in a folder per year and month (``by_month``), rows
    rebalanced so that a busy month has several files and a quiet one a single file. Nulls, lengths and ranges are counted by
    the writes themselves: the star's ``violations`` need no further scan.
    """
    spark = flat.sparkSession
    flat = stage(flat, "sales-file")
    found: dict[str, int] = {}

    def write(df: DataFrame, name: str, parts: Sequence[str] = ()) -> None:
        observed, violations = observe(df, RULES[name])
        if parts:
            observed = observed.hint("rebalance", *parts)
        observed.write.mode("overwrite").partitionBy(*parts).parquet(f"{out}/{name}")
        found.update({f"{name}.{k}": n for k, n in violations().items()})

    for name, build in (
        ("dim_product", build_dim_product),
        ("dim_customer", build_dim_customer),
        ("dim_date", build_dim_date),
    ):
        write(build(flat), name)
    dims = read_star_dims(spark, out)
    fact = build_fact(flat, *dims, covered=True)
    if by_month:
        places = dims[2].select("date_key", *[F.coalesce(c, F.lit(0)).alias(p) for p, c in PLACES.items()])
        write(fact.join(places, "date_key").select(*fact.columns, *PLACES), "fact_sales", list(PLACES))
    else:
        write(fact, "fact_sales")
    return replace(read_star(spark, out), violations=found)


def read_star_dims(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = ("dim_product", "dim_customer", "dim_date")
    return tuple(spark.read.parquet(f"{out}/{n}") for n in names)


def read_star(spark: SparkSession, out: str) -> Star:
    """The star that run_star_etl wrote to ``out``."""
    product, customer, date = read_star_dims(spark, out)
    fact = spark.read.parquet(f"{out}/fact_sales")
    placed = fact if set(PLACES) <= set(fact.columns) else None
    return Star(fact.drop(*PLACES), product, customer, date, placed, whole=True)


def sorted_flat(star: Star) -> DataFrame:
    """The wide frame by order date, as a listing; order and line number spread a busy day's sort."""
    return star.flat().orderBy(*in_order("order_date", "order_number", "order_line_number"))
