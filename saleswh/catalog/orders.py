"""Versioned dimensions, as-of joins, documents and the queries on them."""

from pyspark.sql import functions as F

from saleswh.catalog import query
from saleswh.catalog.sql import (
    AS_OF_ORDERS,
    CUSTOMER_HISTORY,
    EVENT_HISTORY,
    PRIORITY_VERSIONS,
    with_,
)
from saleswh.operators import asof, documents, scd2
from saleswh.operators.timeline import hot_spots
from saleswh.plans import tables
from saleswh.sources import read_latest
from saleswh.storage import new_path, stage

AS_OF = with_(AS_OF_ORDERS)
SUMMARY_SQL = (
    "SELECT order_id, order_date, customer_id, customer_name, customer_city, product_id, product_name, "
    "CAST(product_price AS DOUBLE) AS product_price, CAST(amount AS DOUBLE) AS amount FROM as_of"
)


def _as_of(spark, d, **options):
    return asof.as_of_orders(
        tables.order_facts(spark, d),
        tables.customer_history(spark, d),
        tables.price_history(spark, d),
        **options,
    )


@query(AS_OF + "SELECT * FROM as_of")
def as_of_orders(spark, d):
    return _as_of(spark, d)


@query(AS_OF + "SELECT * FROM as_of")
def as_of_orders_sweep(spark, d):
    return _as_of(spark, d, method="sweep")


@query(AS_OF + "SELECT * FROM as_of")
def as_of_orders_array(spark, d):
    """Both dimensions by binary search in sorted version arrays."""
    return _as_of(spark, d, method="array")


@query(AS_OF + "SELECT order_id, order_date, customer_id, customer_city, product_id, product_price, amount "
       "FROM as_of ORDER BY order_id")
def as_of_orders_short(spark, d):
    return asof.as_of_orders_short(_as_of(spark, d))


@query(with_(EVENT_HISTORY) + "SELECT *, valid_to IS NULL AS is_current FROM history")
def event_history(spark, d):
    return scd2.history_from_log(tables.table(spark, d, "events"), "user_id", "ts", ["event_type"], "event_id")


@query(
    with_(EVENT_HISTORY)
    + """SELECT e.event_id, e.user_id, e.event_type, h.event_type AS held_type, h.valid_from AS held_since
         FROM events e JOIN history h ON h.user_id = e.user_id AND e.ts >= h.valid_from
          AND (h.valid_to IS NULL OR e.ts < h.valid_to)"""
)
def as_of_events(spark, d):
    """Each event with the version its user was in; users have many versions, so one sweep.

    The history is written first, as a dimension is, so the sweep does not make it again.
    """
    events = tables.table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    spots = hot_spots(events, "user_id", "ts")  # a user has no more versions than events
    history = scd2.history_from_log(events, "user_id", "ts", ["event_type"], "event_id", spots=spots)
    joined = asof.as_of_join(
        events, stage(history, "history"), "user_id", "ts",
        {"held_type": "event_type", "held_since": "valid_from"}, method="sweep", spots=spots,
    )
    return joined.drop("ts")


# --- queries on the view and on the documents


@query(
    with_(CUSTOMER_HISTORY) + "SELECT customer_id, CAST(count(DISTINCT city) AS BIGINT) AS distinct_cities "
    "FROM customer_history GROUP BY customer_id ORDER BY customer_id"
)
def distinct_cities_history(spark, d):
    return documents.distinct_cities_by_history(tables.customer_history(spark, d))


@query(
    AS_OF + "SELECT customer_id, arg_min(customer_name, order_id) AS customer_name, "
    "CAST(count(DISTINCT customer_city) AS BIGINT) AS num_distinct_cities FROM as_of GROUP BY customer_id"
)
def distinct_cities_orders(spark, d):
    return documents.distinct_cities_by_customer(documents.to_document(_as_of(spark, d)))


@query(
    AS_OF + "SELECT customer_city, CAST(sum(amount) AS DECIMAL(20,2)) AS total_sales_amount FROM as_of "
    "GROUP BY customer_city ORDER BY customer_city"
)
def sales_by_city(spark, d):
    return documents.sales_by_city(_as_of(spark, d))


@query(
    AS_OF + "SELECT customer_city, round(sum(CAST(amount AS DOUBLE)), 2) AS total_amount FROM as_of "
    "GROUP BY customer_city ORDER BY total_amount DESC, customer_city"
)
def amount_by_city_desc(spark, d):
    docs = documents.to_document(_as_of(spark, d))
    return documents.amount_by_city_desc(docs).withColumn("total_amount", F.round("total_amount", 2))


@query(AS_OF + "SELECT CAST(sum(product_price - amount) AS DECIMAL(21,2)) AS diff_between_price_and_paid FROM as_of")
def price_gap_total(spark, d):
    return documents.price_gap_total(_as_of(spark, d))


@query(
    AS_OF + "SELECT round(sum(CAST(product_price AS DOUBLE) - CAST(amount AS DOUBLE)), 2) AS total_diff FROM as_of"
)
def price_gap_total_doc(spark, d):
    docs = documents.to_document(_as_of(spark, d))
    return documents.price_gap_total_doc(docs).select(F.round("total_diff", 2).alias("total_diff"))


@query(AS_OF + SUMMARY_SQL)
def to_document(spark, d):
    return documents.to_document(_as_of(spark, d))


@query(
    AS_OF
    + """SELECT order_id, order_date, customer_id, customer_name, customer_city, product_id, product_name,
                CAST(product_price AS DOUBLE) AS product_price,
                CASE WHEN order_date >= TIMESTAMP '1998-01-01 00:00:00' THEN CAST(amount AS DOUBLE) + 1
                     ELSE CAST(amount AS DOUBLE) END AS amount,
                CASE WHEN order_date < TIMESTAMP '1999-01-01 00:00:00' THEN 'checked' END AS note
         FROM as_of"""
)
def upsert(spark, d):
    """Documents before 1999 with a note, upserted with those from 1998 on at a raised amount."""
    docs = documents.to_document(_as_of(spark, d))
    target = docs.filter(F.col("order_date") < F.lit("1999-01-01")).withColumn("note", F.lit("checked"))
    source = docs.filter(F.col("order_date") >= F.lit("1998-01-01")).withColumn("amount", F.col("amount") + 1)
    return documents.upsert(target, source, "order_id")


@query(AS_OF + SUMMARY_SQL)
def publish_orders(spark, d):
    """The as-of view sent twice to a new document collection, read back."""
    base = new_path(spark, "orders_summary")
    view = _as_of(spark, d)
    documents.publish_orders(view.filter(F.col("order_date") < F.lit("1999-01-01")), base)
    documents.publish_orders(view, base)
    return read_latest(spark, base)


BUCKETED_SQL = """SELECT order_id, order_date, customer_id, customer_name, customer_city, product_id, product_name,
                CAST(product_price AS DOUBLE) AS product_price,
                CASE WHEN order_date >= TIMESTAMP '1998-01-01 00:00:00' THEN CAST(amount AS DOUBLE) + 2
                     ELSE CAST(amount AS DOUBLE) END AS amount,
                CASE WHEN order_date < TIMESTAMP '1999-01-01 00:00:00' THEN 'checked' END AS note
         FROM as_of"""


@query(AS_OF + BUCKETED_SQL)
def upsert_bucketed(spark, d):
    """A bucketed collection: documents before 1999, then a batch that sends each document from 1998 on twice, the later one last."""
    docs = stage(documents.to_document(_as_of(spark, d)), "documents")
    held = documents.Collection(new_path(spark, "orders_bucketed"), "order_id", 8)
    held.upsert(docs.filter(F.col("order_date") < F.lit("1999-01-01")).withColumn("note", F.lit("checked")))
    late = docs.filter(F.col("order_date") >= F.lit("1998-01-01"))
    twice = late.withColumn("nth", F.explode(F.array(F.lit(2), F.lit(1)))).withColumn("amount", F.col("amount") + F.col("nth"))
    held.upsert(twice, last_by="nth")
    return held.read(spark).drop("nth")


@query(
    AS_OF + SUMMARY_SQL.replace("FROM as_of", "")
    + """, CASE WHEN customer_city <> 'CITY_3' THEN strftime(order_date, '%m') END AS month,
         CASE WHEN order_date < TIMESTAMP '1997-01-01 00:00:00' THEN 1 ELSE 2 END AS batch FROM as_of
         WHERE order_date < TIMESTAMP '1997-01-01 00:00:00' OR month(order_date) IN (1, 2)"""
)
def upsert_partitions(spark, d):
    """Documents laid out by month ("01" stays text, some without a month); a second batch touches two months."""
    base = new_path(spark, "orders_by_month")
    month = F.when(F.col("customer_city") != "CITY_3", F.date_format("order_date", "MM"))
    docs = documents.to_document(_as_of(spark, d)).withColumn("month", month)
    docs = stage(docs, "documents")
    first = F.col("order_date") < F.lit("1997-01-01")
    documents.upsert_partitions(docs.filter(first).withColumn("batch", F.lit(1)), base, "order_id", "month")
    new = docs.filter(~first & F.month("order_date").isin(1, 2)).withColumn("batch", F.lit(2))
    documents.upsert_partitions(new, base, "order_id", "month")
    return spark.read.schema(new.schema).parquet(base)


# --- type 2 dimensions

PRIORITY = with_(PRIORITY_VERSIONS)


@query(
    PRIORITY + "SELECT id, customer_id, name, priority, ts AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, "
    "TRUE AS is_current FROM start_rows"
)
def scd2_init(spark, d):
    return tables.priority_dimension(spark, d)


@query(
    PRIORITY
    + """SELECT s.id, s.customer_id, s.name, s.priority, s.ts AS valid_from, b.ends AS valid_to,
                b.ends IS NULL AS is_current
         FROM start_rows s LEFT JOIN (SELECT customer_id, min(ts) AS ends FROM batch GROUP BY customer_id) b
           ON b.customer_id = s.customer_id"""
)
def scd2_expire(spark, d):
    """Close every customer's open version at the first order after the history start."""
    changes = tables.priority_changes(spark, d).filter(F.col("changed_at") > F.lit(tables.HISTORY_START))
    return scd2.scd2_expire(tables.priority_dimension(spark, d), changes, "customer_id")


@query(
    PRIORITY
    + """, newest AS (
           SELECT o_custkey AS customer_id, arg_max(o_orderpriority, o_orderkey) AS priority,
                  arg_max(o_orderdate, o_orderkey) AS ts FROM orders GROUP BY o_custkey)
         SELECT id, customer_id, name, priority, ts AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
                TRUE AS is_current FROM start_rows
         UNION ALL
         SELECT (SELECT max(id) FROM start_rows) + row_number() OVER (ORDER BY n.ts, n.customer_id),
                n.customer_id, s.name, n.priority, n.ts, NULL, TRUE
         FROM newest n JOIN start_rows s ON s.customer_id = n.customer_id"""
)
def scd2_insert(spark, d):
    """A version per customer copied from the newest row, with the last order's priority."""
    changes = scd2.latest_per_key(tables.priority_changes(spark, d), "customer_id", "change_no")
    return scd2.scd2_insert(tables.priority_dimension(spark, d), changes.drop("change_no"), "customer_id")


def _applied(spark, d):
    return scd2.scd2_apply(
        tables.priority_dimension(spark, d),
        tables.priority_changes(spark, d),
        "customer_id",
        ["priority"],
        tiebreak="change_no",
    )


@query(PRIORITY + "SELECT * FROM versions")
def scd2_apply(spark, d):
    return _applied(spark, d)


@query(PRIORITY + "SELECT * FROM versions WHERE is_current")
def scd2_current(spark, d):
    return scd2.scd2_current(_applied(spark, d))


@query(
    "SELECT o_custkey AS customer_id, o_orderdate AS changed_at, o_orderpriority AS priority, "
    "o_orderkey AS change_no FROM orders WHERE o_orderdate <= TIMESTAMP '1995-01-01 00:00:00'"
)
def scd2_late(spark, d):
    """Changes not after the start of the current version, set aside."""
    dim = tables.priority_dimension(spark, d)
    return scd2.split_late(dim, tables.priority_changes(spark, d), "customer_id")[1]


@query(
    "SELECT o_custkey AS customer_id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS changed_at, "
    "o_orderpriority AS priority, o_orderkey AS change_no, "
    "o_orderkey % 5 = 0 OR o_orderdate <= TIMESTAMP '1995-01-01 00:00:00' AS late FROM orders"
)
def scd2_split(spark, d):
    """All changes, a fifth of them without a time, as accepted or late: none is lost."""
    changes = tables.priority_changes(spark, d)
    changes = changes.withColumn("changed_at", F.when(F.col("change_no") % 5 > 0, F.col("changed_at")))
    accepted, late = scd2.split_late(tables.priority_dimension(spark, d), changes, "customer_id")
    return accepted.withColumn("late", F.lit(False)).unionAll(late.withColumn("late", F.lit(True)))


@query(
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority "
    "FROM orders GROUP BY o_custkey"
)
def latest_version(spark, d):
    orders = tables.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return scd2.latest_per_key(orders, "o_custkey", "o_orderkey")


@query(
    with_(CUSTOMER_HISTORY) + "SELECT customer_id, city FROM customer_history "
    "WHERE valid_to IS NULL OR valid_to > TIMESTAMP '1998-06-01 00:00:00'"
)
def open_end_filter(spark, d):
    """Versions that are open or end after a day."""
    open_end = F.col("valid_to").isNull() | (F.col("valid_to") > F.lit("1998-06-01"))
    return tables.customer_history(spark, d).filter(open_end).select("customer_id", "city")
