"""Slowly changing dimensions, type 2: versions with half-open validity intervals.

A dimension has a surrogate ``id``, a business key, attributes, ``valid_from``,
``valid_to`` (null while open) and ``is_current``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.operators.keys import assign_key, next_key, number_rows
from saleswh.operators.timeline import HOT_ROWS, SLICE_UNITS, HotSpots, carry, hot_spots, slice_hot
from saleswh.storage import stage

META = ("id", "valid_from", "valid_to", "is_current")


def attributes(dim: DataFrame, key: str) -> list[str]:
    return [c for c in dim.columns if c != key and c not in META]


def scd2_init(df: DataFrame, key: str, valid_from: Column) -> DataFrame:
    """First load: one open version per row, ids in key order."""
    versions = df.withColumn("valid_from", valid_from)
    from_type = versions.schema["valid_from"].dataType
    versions = versions.withColumns(
        {"valid_to": F.lit(None).cast(from_type), "is_current": F.lit(True)}
    )
    return assign_key(versions, [key], "id")


def scd2_current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def scd2_expire(dim: DataFrame, ends: DataFrame, key: str, ts: str = "changed_at") -> DataFrame:
    """Close the current version of each key in ``ends`` at its time (the earliest if several)."""
    closing = ends.groupBy(key).agg(F.min(ts).alias("_end"))
    hit = F.col("is_current") & F.col("_end").isNotNull()
    return dim.join(closing, key, "left").select(
        *[
            F.when(hit, F.col("_end")).otherwise(F.col("valid_to")).alias(c)
            if c == "valid_to"
            else (F.col(c) & ~hit).alias(c)
            if c == "is_current"
            else F.col(c)
            for c in dim.columns
        ]
    )


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key; reduced per task before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("_row"))
    return newest.select("_row.*")


def scd2_insert(dim: DataFrame, changes: DataFrame, key: str, ts: str = "changed_at") -> DataFrame:
    """Add a version per change, copied from the key's newest row with the given attributes replaced.

    A null attribute in a change keeps the old value. One change per key; a key
    without any row yields nothing.
    """
    attrs = attributes(dim, key)
    given = [a for a in attrs if a in changes.columns]
    change = changes.select(key, F.col(ts).alias("_ts"), *[F.col(a).alias(f"_new_{a}") for a in given])
    # only the history of keys in the batch is grouped
    touched = dim.join(change.select(key), key, "left_semi")
    rows = latest_per_key(touched, key, "id").join(change, key).select(
        key,
        *[F.coalesce(f"_new_{a}", a).alias(a) if a in given else F.col(a) for a in attrs],
        F.col("_ts").cast(dim.schema["valid_from"].dataType).alias("valid_from"),
        F.lit(None).cast(dim.schema["valid_to"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    numbered = number_rows(rows, ["valid_from", key], "id", next_key(dim, "id"))
    return dim.unionByName(numbered)


def split_late(dim: DataFrame, changes: DataFrame, key: str, ts: str = "changed_at") -> tuple[DataFrame, DataFrame]:
    """(accepted, late): a change is late when it is not after the start of the key's current version.

    A change without a time cannot be placed and counts as late; accepted and late together hold every change.
    """
    since = scd2_current(dim).select(key, F.col("valid_from").alias("_since"))
    marked = changes.join(since, key, "left")
    late = F.col(ts).isNull() | (F.col("_since").isNotNull() & (F.col(ts) <= F.col("_since")))
    return marked.filter(~late).drop("_since"), marked.filter(late).drop("_since")


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    key: str,
    tracked: Sequence[str] | None = None,
    ts: str = "changed_at",
    tiebreak: str | None = None,
    hot_rows: int = HOT_ROWS,
    slice_units: tuple[str, str] = SLICE_UNITS,
) -> DataFrame:
    """Apply a change batch, any number of changes per key, and return the new dimension.

    * null in a change keeps the value before it; attributes not in the batch are copied;
    * a change that alters no tracked attribute makes no version;
    * changes of one key at one instant count as one: per attribute the last by ``tiebreak``
      (by value when not given);
    * late changes (see split_late) are left out, so applying a batch twice changes nothing;
    * a key without a current version starts a new history.

    Open versions and changes meet in one shuffle by key, and everything else is windows over that partitioning. Keys
    with more than ``hot_rows`` changes are cut into time slices instead. Closed versions pass through untouched; only new
    versions are sorted, for their ids.
    """
    attrs = attributes(dim, key)
    given = [a for a in attrs if a in changes.columns]
    tracked = list(tracked or given)
    spots = hot_spots(changes, key, ts, hot_rows, slice_units)
    names = [c for c in dict.fromkeys([key, ts, *given, *([tiebreak] if tiebreak else [])])]
    changes, current = changes.select(*names), scd2_current(dim)
    if spots.keys.isEmpty():
        versions = _versions_by_window(current, changes, key, attrs, given, tracked, ts, tiebreak)
    else:
        hot = F.broadcast(spots.keys)
        rest = [df.join(hot, key, "left_anti") for df in (current, changes)]
        some = [df.join(hot, key, "left_semi") for df in (current, changes)]
        versions = _versions_by_window(*rest, key, attrs, given, tracked, ts, tiebreak).unionByName(
            _versions_by_slice(*some, key, attrs, given, tracked, ts, tiebreak, spots)
        )
    versions = stage(versions, "versions")
    new = number_rows(versions.filter("id IS NULL").drop("id"), ["valid_from", key], "id", next_key(dim, "id"))
    closed = dim.filter("NOT is_current")
    return closed.unionByName(versions.filter("id IS NOT NULL").select(*dim.columns)).unionByName(new.select(*dim.columns))


def _same_as_before(tracked: Sequence[str]) -> Column:
    """Whether a change leaves all tracked attributes as they were (``_prev_``)."""
    same = F.lit(True)
    for a in tracked:
        same = same & F.coalesce(F.col(a), F.col(f"_prev_{a}")).eqNullSafe(F.col(f"_prev_{a}"))
    return same


def _last_given(a: str, tiebreak: str | None) -> Column:
    """The value of an attribute that counts among changes of one key at one instant."""
    return F.max_by(a, F.when(F.col(a).isNotNull(), F.col(tiebreak or a)))


def _finished(versions: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    return versions.select(
        "id", key, *attrs, F.col("_ts").alias("valid_from"), F.col("_next").alias("valid_to"), F.col("_next").isNull().alias("is_current")
    )


def _versions_by_window(current, changes, key, attrs, given, tracked, ts, tiebreak) -> DataFrame:
    """Open rows and their accepted changes as versions: one shuffle by key."""
    types = dict(current.dtypes)
    same_order = tiebreak is None or tiebreak in attrs
    batch = changes.select(
        key, F.col(ts).cast(types["valid_from"]).alias("_ts"), *[F.col(a).cast(types[a]).alias(a) for a in given],
        *([] if same_order else [F.col(tiebreak).alias("_order")]),
    )
    order = (tiebreak if same_order else "_order")
    opened = current.select("id", key, F.col("valid_from").alias("_ts"), *attrs)
    line = opened.unionByName(batch, allowMissingColumns=True)
    whole = Window.partitionBy(key)
    since = F.max(F.when(F.col("id").isNotNull(), F.col("_ts"))).over(whole)
    line = line.withColumn("_since", since)
    # the open row, and changes after its start; without one, all that have a time
    line = line.filter(F.col("id").isNotNull() | (F.col("_ts").isNotNull() & (F.col("_since").isNull() | (F.col("_ts") > F.col("_since")))))
    instant = Window.partitionBy(key, "_ts")
    line = line.withColumns({f"_at_{a}": _last_given(a, order).over(instant) for a in given})
    first = F.row_number().over(instant.orderBy(F.col("id").asc_nulls_last()))
    line = line.withColumn("_nth", first).filter("_nth = 1")
    line = line.withColumns({a: F.when(F.col("id").isNull(), F.col(f"_at_{a}")).otherwise(F.col(a)) for a in given})
    earlier = Window.partitionBy(key).orderBy("_ts").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumns({f"_prev_{a}": F.last(a, ignorenulls=True).over(earlier) for a in attrs} | {"_known": F.count("*").over(earlier)})
    kept = line.filter(F.col("id").isNotNull() | (F.col("_known") == 0) | ~_same_as_before(tracked)).select(
        "id", key, "_ts", *[F.coalesce(a, f"_prev_{a}").alias(a) for a in attrs]
    )
    return _finished(kept.withColumn("_next", F.lead("_ts").over(whole.orderBy("_ts"))), key, attrs)


def _versions_by_slice(current, changes, key, attrs, given, tracked, ts, tiebreak, spots: HotSpots) -> DataFrame:
    """The same for hot keys, whose changes are collapsed by time first and handed on from slice to slice."""
    types = dict(current.dtypes)
    batch = changes.groupBy(key, F.col(ts).cast(types["valid_from"]).alias("_ts")).agg(
        *[_last_given(a, tiebreak).cast(types[a]).alias(a) for a in given]
    )
    accepted, _ = split_late(current, batch, key, "_ts")
    rows = (
        current.select("id", key, F.col("valid_from").alias("_ts"), *attrs)
        .unionByName(accepted, allowMissingColumns=True)
        .withColumn("_seen", F.lit(True))
    )
    rows = slice_hot(rows, key, "_ts", spots)
    before = {f"_prev_{a}": a for a in attrs}
    states = carry(rows, key, ["_ts"], {**before, "_known": "_seen"})
    kept = states.filter(F.col("id").isNotNull() | F.col("_known").isNull() | ~_same_as_before(tracked)).select(
        "id", key, "_ts", "_slice", *[F.coalesce(a, f"_prev_{a}").alias(a) for a in attrs]
    )
    return _finished(carry(kept, key, ["_ts"], {"_next": "_ts"}, backward=True), key, attrs)


def history_from_log(
    log: DataFrame,
    key: str,
    ts: str,
    tracked: Sequence[str],
    tiebreak: str | None = None,
    hot_rows: int = HOT_ROWS,
    slice_units: tuple[str, str] = SLICE_UNITS,
    spots: HotSpots | None = None,
) -> DataFrame:
    """Version history out of an event log: a version starts where a tracked column changes.

    Log entries of one key at one instant count as one, as in scd2_apply.
    ``spots``: the log's hot spots when the caller has them already.
    """
    entries = log.groupBy(key, F.col(ts).alias("valid_from")).agg(
        *[F.max_by(F.struct(*tracked), F.col(tiebreak) if tiebreak else F.struct(*tracked)).alias("_state")]
    )
    entries = slice_hot(entries, key, "valid_from", spots or hot_spots(log, key, ts, hot_rows, slice_units))
    seen = carry(entries, key, ["valid_from"], {"_prev": "_state"})
    # the state is a struct and never null, so a null _prev marks the first entry
    starts = seen.filter(~F.col("_state").eqNullSafe(F.col("_prev"))).drop("_prev")
    ended = carry(starts, key, ["valid_from"], {"valid_to": "valid_from"}, backward=True)
    return ended.select(
        key, "_state.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def version_attribute_count(dim: DataFrame, key: str, attr: str, name: str = "distinct_values") -> DataFrame:
    """Distinct values of an attribute over each key's whole history, by key."""
    return dim.groupBy(key).agg(F.countDistinct(attr).alias(name)).orderBy(key)
