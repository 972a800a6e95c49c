"""As-of join: each fact meets the dimension version that was valid at its time.

Valid means valid_from <= t < valid_to, an open valid_to meaning "still". A fact at
the very instant of a change gets the new version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.operators.keys import number_rows
from saleswh.operators.skew import hot_keys, lookup_join
from saleswh.operators.timeline import HOT_ROWS, SLICE_UNITS, HotSpots, carry, hot_spots, slice_hot

#: Versions of a key that one row holds; longer histories are cut into slices of at most as many.
MOST_VERSIONS = 4096


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    attrs: Mapping[str, str],
    method: str = "join",
    how: str = "inner",
    spots: HotSpots | None = None,
    hot_rows: int = HOT_ROWS,
    slice_units: tuple[str, str] = SLICE_UNITS,
) -> DataFrame:
    """Add dimension attributes {new name: dim column} valid at ``ts``.

    method "join": equality on the key with the interval as a further condition. Right
    for short histories: Spark sort-merges and splits skewed keys. The dimension is never broadcast, since Spark judges its
    size by the files it was made from, which says little of versions in memory.
    method "sweep": the distinct fact times and the versions in one ordered pass per key,
    the result joined back to the facts by key and time. Linear however many versions a
    key has, hot keys cut into time slices, and facts that share a time do not pile up.
    Needs the versions of a key not to overlap. Hot keys are those with more than
    ``hot_rows`` facts and versions; ``spots`` hands them in when the caller has them.
    method "array": each key's versions are one sorted array, searched by halving steps, so a fact
    meets one row however many versions there are (see as_of_lookup). Needs versions not to overlap.
    how: "inner" drops facts without a valid version, "left" keeps them with nulls.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if method == "join":
        return _by_join(fact, dim, key, ts, attrs, how)
    if method == "sweep":
        return _by_sweep(fact, dim, key, ts, attrs, how, spots, hot_rows, slice_units)
    if method == "array":
        return as_of_lookup(fact, [History(dim, key, attrs)], ts, how)
    raise ValueError("method must be 'join', 'sweep' or 'array'")


def _by_join(fact, dim, key, ts, attrs, how):
    versions = dim.select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(src).alias(new) for new, src in attrs.items()],
    ).hint("merge")
    valid = (
        (F.col(key) == F.col("_key"))
        & (F.col(ts) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    )
    return fact.join(versions, valid, how).drop("_key", "_from", "_to")


def _both_times(fact, dim, key, ts):
    """Key and time of all facts and versions."""
    return fact.select(key, F.col(ts).alias("_ts")).union(dim.select(key, "valid_from"))


def _by_sweep(fact, dim, key, ts, attrs, how, spots, hot_rows, units):
    spots = spots or hot_spots(_both_times(fact, dim, key, ts), key, "_ts", hot_rows, units)
    known = F.col("_key").isNotNull() & F.col("_ts").isNotNull()
    times = fact.select(F.col(key).alias("_key"), F.col(ts).alias("_ts")).filter(known).distinct()
    # an empty interval is never valid; leaving it out keeps starts distinct per key
    versions = dim.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_ts"),
        F.struct("valid_to", *[F.col(src).alias(new) for new, src in attrs.items()]).alias("_version"),
    )
    line = (
        times.withColumn("_kind", F.lit(1))  # after a version that starts at the same time
        .unionByName(versions.filter(known).withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    )
    line = slice_hot(line, "_key", "_ts", spots)
    held = carry(line, "_key", ["_ts", "_kind"], {"_held": "_version"}, inclusive=True)
    end = F.col("_held.valid_to")
    valid = held.filter(
        (F.col("_kind") == 1) & F.col("_held").isNotNull() & (end.isNull() | (F.col("_ts") < end))
    ).select("_key", "_ts", *[F.col("_held")[new].alias(new) for new in attrs])
    same = (F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_ts"))
    return fact.join(valid, same, how).drop("_key", "_ts")


@dataclass(frozen=True)
class History:
    """Versions to look up: a dimension, its business key (the facts' column of that name) and {new name: dim column}."""

    dim: DataFrame
    key: str
    attrs: Mapping[str, str]


def as_of_lookup(
    fact: DataFrame, histories: Sequence[History], ts: str, how: str = "inner", most: int = MOST_VERSIONS
) -> DataFrame:
    """Add the attributes of several dimensions valid at ``ts``.

    One dimension: the facts are shuffled by its key to the arrays. Several: narrow (key, time) entries of all of them go to
    the arrays in one shuffle, what they find is gathered per combination of keys and time, and the facts
    themselves are shuffled once, to that. Versions of a key must not overlap; empty intervals and versions without
    a key or a start are never valid. Keys that many facts share are dealt into parts, histories of more than ``most`` versions
    into slices. Null keys and times find nothing: such facts go with "inner" and stay with nulls with "left".
    """
    if len(histories) == 1:
        (only,) = histories
        dealt = _search(fact.withColumn("_dim", F.lit(0)), _versions(histories), only.key, ts, how, most)
        return dealt.select(*fact.columns, *only.attrs)
    keys = [h.key for h in histories]
    at = F.struct(*keys, F.col(ts).alias("_ts"))  # equal structs also where a field is null
    kind = _common_type(fact, keys)
    entries = [F.struct(F.lit(i).alias("_dim"), F.col(h.key).cast(kind).alias("_key")) for i, h in enumerate(histories)]
    asked = fact.select(at.alias("_at"), F.col(ts).alias("_ts"), F.inline(F.array(*entries)))
    found = _search(asked, _versions(histories, kind), "_key", "_ts", "inner", most)
    every = [c for h in histories for c in h.attrs]
    gathered = found.groupBy("_at").agg(
        *[F.max(c).alias(c) for c in every],
        *[F.max(F.col("_dim") == i).alias(f"_has{i}") for i in range(len(histories))],
    )
    if how == "inner":
        gathered = gathered.filter(reduce(lambda a, b: a & b, [F.col(f"_has{i}") for i in range(len(histories))]))
    joined = fact.withColumn("_at", at).join(gathered, "_at", how)
    return joined.select(*fact.columns, *every)


def _common_type(fact: DataFrame, keys: Sequence[str]) -> str:
    kinds = {fact.schema[k].dataType.simpleString() for k in keys}
    return kinds.pop() if len(kinds) == 1 else "string"


def _versions(histories: Sequence[History], kind: str | None = None) -> DataFrame:
    """_dim, _key and _v (from, to and all attributes, null where another dimension has them) of all usable versions."""
    types = {new: h.dim.schema[src].dataType for h in histories for new, src in h.attrs.items()}
    parts = []
    for i, h in enumerate(histories):
        usable = F.col(h.key).isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
        held = [
            (F.col(h.attrs[new]) if new in h.attrs else F.lit(None).cast(t)).alias(new) for new, t in types.items()
        ]
        key = F.col(h.key).cast(kind) if kind else F.col(h.key)
        version = F.struct(F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *held)
        parts.append(
            h.dim.filter(usable & F.col("valid_from").isNotNull()).select(F.lit(i).alias("_dim"), key.alias("_key"), version.alias("_v"))
        )
    return reduce(DataFrame.unionAll, parts)


def _last_from(items: str, ts: str, most: int) -> Column:
    """The last entry of a sorted array that starts at or before ``ts``: halving steps, folded over the array."""
    steps = F.array(*[F.lit(1 << k) for k in range(most.bit_length() - 1, -1, -1)])

    def step(at, s):
        start = F.get(items, at + s - 1)["_from"]
        return F.when((at + s <= F.size(items)) & (start <= F.col(ts)), at + s).otherwise(at)

    return F.get(items, F.aggregate(steps, F.lit(0), step) - 1)


def _search(asked: DataFrame, versions: DataFrame, key: str, ts: str, how: str, most: int) -> DataFrame:
    """asked (with _dim) and the attributes of the version valid at ``ts``; each row meets one array."""
    by = ["_dim", "_key"]
    long = versions.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*by)
    sliced = not long.isEmpty()
    short = versions.join(long, by, "left_anti") if sliced else versions
    arrays = short.groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias("_array"))
    rows = asked.withColumn("_key", F.col(key))
    given = [c for c in asked.columns if c != "_key"]
    outer = "left" if sliced or how == "left" else "inner"
    held = lookup_join(rows, arrays, by, outer, hot_keys(rows, by))
    if sliced:
        # numbered over all long histories in order, so a slice never holds more than ``most`` versions
        numbered = number_rows(
            versions.join(long, by, "left_semi").withColumn("_from", F.col("_v._from")), [*by, "_from"], "_no", 0
        ).withColumn("_slice", F.floor(F.col("_no") / most))
        slices = numbered.groupBy(*by, "_slice").agg(F.sort_array(F.collect_list("_v")).alias("_part"), F.min("_from").alias("_from"))
        heads = slices.groupBy(*by).agg(
            F.sort_array(F.collect_list(F.struct("_from", "_slice"))).alias("_heads"), F.count("*").alias("_n")
        )
        largest = heads.agg(F.coalesce(F.max("_n"), F.lit(1))).collect()[0][0]
        held = lookup_join(held, heads.drop("_n"), by, "left", hot_keys(rows, by))
        held = held.withColumn("_slice", _last_from("_heads", ts, largest)["_slice"]).drop("_heads")
        near = [*by, "_slice"]
        hot = hot_keys(held.filter("_slice IS NOT NULL").select(*near), near)
        held = lookup_join(held, slices.select(*near, "_part"), near, "left", hot)
        held = held.withColumn("_array", F.coalesce("_part", "_array"))
    valid = F.filter(F.array(_last_from("_array", ts, most)), lambda v: v.isNotNull() & (v["_to"].isNull() | (F.col(ts) < v["_to"])))
    spread = F.inline_outer(valid) if how == "left" else F.inline(valid)
    return held.select(*given, spread).drop("_from", "_to")


def as_of_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    method: str = "join",
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Orders with the customer and product versions valid at order time, nine columns."""
    histories = [
        History(customers, "customer_id", {"customer_name": "name", "customer_city": "city"}),
        History(products, "product_id", {"product_name": "name", "product_price": "price"}),
    ]
    out = orders
    if method == "array":
        out = as_of_lookup(orders, histories, "order_date", how)
    else:
        for h in histories:
            spots = None
            if method == "sweep":  # counted on the orders themselves, so the second pass need not run the first
                spots = hot_spots(_both_times(orders, h.dim, h.key, "order_date"), h.key, "_ts", hot_rows)
            out = as_of_join(out, h.dim, h.key, "order_date", h.attrs, method, how, spots)
    return out.select(
        "order_id", "order_date", "customer_id", "customer_name", "customer_city",
        "product_id", "product_name", "product_price", "amount",
    )


def as_of_orders_short(view: DataFrame) -> DataFrame:
    """The second form of the view: without the two names, by order id."""
    return view.drop("customer_name", "product_name").orderBy("order_id")
