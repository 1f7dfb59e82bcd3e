"""Slowly changing dimensions, type 1 and type 2, as DataFrame rewrites.

A merge is a join plus per-column ``coalesce``/``when``; the result is a new
snapshot the caller writes with a staged overwrite.  Both merges reject a
source with two rows for one key, as a SQL MERGE does, by failing the job
from inside the plan (``raise_error``) - no separate pass over the feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.columns import row_digest

Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_text(key: Key) -> Column:
    return F.concat_ws(", ", *[F.col(c).cast("string") for c in key_columns(key)])


def without_key(key: Key) -> Column:
    """Is any column of the key null?"""
    return F.greatest(*[F.col(c).isNull() for c in key_columns(key)], F.lit(False))


# ---------------------------------------------------------------- type 1

def _one_row_per_key(feed: DataFrame, key: Key) -> DataFrame:
    """Collapse a merge source to one row per key, failing the job (from inside
    the plan, when the key is first used) if a key has two rows."""
    keys = key_columns(key)
    rest = [c for c in feed.columns if c not in keys]
    grouped = feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                      *[F.first(c).alias(c) for c in rest])
    guard = F.when(without_key(key), F.raise_error(F.lit("merge source has a row without a key"))) \
        .when(F.col("_n") > 1, F.raise_error(F.concat(
            F.lit("merge source has more than one row for key "), key_text(key))))
    first = F.coalesce(guard.cast(feed.schema[keys[0]].dataType), F.col(keys[0])).alias(keys[0])
    return grouped.select(first, *[F.col(c) for c in keys[1:] + rest])


def scd1_upsert(dim: DataFrame, updates: DataFrame, key: Key = "agent_id",
                set_columns: Sequence[str] = ("tier",)) -> DataFrame:
    """MERGE: matched keys take ``set_columns`` from the update (others kept);
    unmatched update rows are inserted whole; no history is kept.

    One full outer join on the key: the dimension and the feed are each read
    once.  A feed row without a key fails the job.
    """
    cols = dim.columns
    src = _one_row_per_key(updates.select(*cols), key).select(
        F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in cols])
    old = dim.withColumn("_old", F.lit(True))
    merged = old.join(src, [F.col(k) == F.col(f"_u_{k}") for k in key_columns(key)], "full_outer")
    from_feed = {c: F.col("_hit") if c in set_columns else F.col("_old").isNull() for c in cols}
    return merged.select(*[F.when(from_feed[c], F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
                           for c in cols])


def change_feed(before: DataFrame, after: DataFrame, key: Key) -> DataFrame:
    """Row-level diff of two snapshots of a keyed table.

    ``_change_type`` is insert, delete, update_preimage or update_postimage;
    unchanged rows are omitted.  One full outer join on the key; rows are compared by
    a digest of all their columns, so a column that only one snapshot has counts as null
    in the other.  Rows without a key never match: they are deletes of the old and inserts
    of the new snapshot.
    """
    b, a = _same_columns(before, after)
    keys = key_columns(key)
    b = b.withColumn("_d", row_digest(b.columns)).alias("b")
    a = a.withColumn("_d", row_digest(a.columns)).alias("a")
    return _changes(b.join(a, [F.col(f"b.{k}") == F.col(f"a.{k}") for k in keys], "full_outer"),
                    [c for c in b.columns if c != "_d"])


def _same_columns(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns of ``before``, then those that only ``after`` has."""
    both = {**{f.name: f.dataType for f in after.schema}, **{f.name: f.dataType for f in before.schema}}
    names = [*before.columns, *[c for c in after.columns if c not in before.columns]]

    def filled(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(both[c]).alias(c) for c in names])
    return filled(before), filled(after)


def _changes(joined: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The images of a full outer join of snapshots ``b`` and ``a`` with row digests ``_d``."""
    kind = (F.when(F.col("b._d").isNull(), F.lit("insert"))
            .when(F.col("a._d").isNull(), F.lit("delete"))
            .when(F.col("b._d") != F.col("a._d"), F.lit("update")))
    j = joined.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    pre = F.struct(*[F.col(f"b.{c}").alias(c) for c in cols],
                   F.when(F.col("_kind") == "delete", "delete")
                   .otherwise("update_preimage").alias("_change_type"))
    post = F.struct(*[F.col(f"a.{c}").alias(c) for c in cols],
                    F.when(F.col("_kind") == "insert", "insert")
                    .otherwise("update_postimage").alias("_change_type"))
    images = F.when(F.col("_kind") == "insert", F.array(post)).when(
        F.col("_kind") == "delete", F.array(pre)).otherwise(F.array(pre, post))
    return j.select(F.explode(images).alias("r")).select("r.*")


SNAPSHOT_KEY, SNAPSHOT_ROW = "_snapshot_key", "_snapshot_row"


def write_snapshot(df: DataFrame, key: Key, name: str, path: str, buckets: int = 64) -> None:
    """``df`` as the bucketed table ``name``: its columns, a digest of its key (null is a value, as
    in a GROUP BY key) and one of the whole row, bucketed and sorted by the key's digest.  One
    shuffle, paid by the write that makes the snapshot anyway."""
    kept = df.withColumn(SNAPSHOT_KEY, row_digest(key_columns(key))).withColumn(SNAPSHOT_ROW, row_digest(df.columns))
    # bucket numbers are those of a hash partitioning, so each task writes whole buckets
    (kept.repartition(buckets, SNAPSHOT_KEY).write.mode("overwrite").bucketBy(buckets, SNAPSHOT_KEY).sortBy(SNAPSHOT_KEY)
     .option("path", path).saveAsTable(name))


def snapshot_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change feed of two snapshots that ``write_snapshot`` made with one key and number of buckets:
    equal buckets are merged as they lie, without a shuffle.  Keys are unique in a snapshot."""
    made = (SNAPSHOT_KEY, SNAPSHOT_ROW)
    cols = [c for c in before.columns if c not in made]
    new = [c for c in after.columns if c not in made and c not in cols]

    def side(df: DataFrame, name: str) -> DataFrame:
        missing = [c for c in cols + new if c not in df.columns]
        types = {f.name: f.dataType for f in (*before.schema, *after.schema)}
        return df.withColumns({"_d": F.col(SNAPSHOT_ROW), **{c: F.lit(None).cast(types[c]) for c in missing}}).alias(name)
    b, a = side(before, "b"), side(after, "a")
    return _changes(b.join(a, F.col(f"b.{SNAPSHOT_KEY}") == F.col(f"a.{SNAPSHOT_KEY}"), "full_outer"), cols + new)


def apply_change_feed(before: DataFrame, changes: DataFrame, key: Key) -> DataFrame:
    """Replay a change feed onto a snapshot (inverse of ``change_feed``); null is a key value."""
    keys = key_columns(key)
    cols = [c for c in changes.columns if c != "_change_type"]
    post = changes.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    gone = changes.filter(F.col("_change_type").isin("delete", "update_preimage")).select(
        *[F.col(k).alias(f"_gone_{k}") for k in keys])
    held, _ = _same_columns(before, post)
    return (held.join(gone, [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys], "left_anti")
            .select(*cols).unionByName(post))


# ---------------------------------------------------------------- type 2

def scd2_init(dim: DataFrame, as_of: str | Column) -> DataFrame:
    """First load: every row is version 1, current, open-ended from ``as_of``."""
    start = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return dim.select(*[F.col(c) for c in dim.columns],
                      start.alias("effective_start_date"),
                      F.lit(None).cast("timestamp").alias("effective_end_date"),
                      F.lit(True).alias("is_current"),
                      F.lit(1).alias("scd_version"))


def scd2_apply(history: DataFrame, changes: DataFrame, key: Key = "agent_id",
               tracked: Sequence[str] = ("base_city",), as_of: str | Column | None = None,
               change_time: str | None = None) -> DataFrame:
    """Apply a feed of new attribute values to a type-2 history.

    * A key's new row opens a new version when a ``tracked`` column differs
      (null-safe) from the version before it; the previous version is closed
      at the new row's start and stops being current.
    * A key not yet in the history starts at version 1.
    * Feed rows that change nothing, or that are not newer than the key's
      current version, leave the history as it is - so applying a feed twice
      changes nothing.  ``scd2_late`` returns those among them that would
      have said something new, for the caller to count and keep.
    * Several changes for one key are allowed when ``change_time`` names a
      column giving each row's effective time; otherwise every row takes
      ``as_of``.  Two feed rows for one key and time, and a feed row without
      a key, fail the job.

    Plan: history and feed are each read once, united and hash-partitioned
    on the key; every window is partitioned by the key (plus a flag), which
    that one shuffle satisfies.
    """
    meta = ["effective_start_date", "effective_end_date", "is_current", "scd_version"]
    attrs = [c for c in history.columns if c not in meta]
    feed = _dated(changes, attrs, as_of, change_time).select(
        *attrs, "effective_start_date", F.lit(None).cast("timestamp").alias("effective_end_date"),
        F.lit(None).cast("boolean").alias("is_current"),
        F.lit(None).cast("int").alias("scd_version"), F.lit(1).alias("_new"))
    u = history.select(*attrs, *meta, F.lit(0).alias("_new")).unionByName(feed)

    keys = key_columns(key)
    by_key = Window.partitionBy(*keys)
    by_time = Window.partitionBy(*keys, "effective_start_date")
    is_new = F.col("_new") == 1
    is_cur = ~is_new & F.coalesce(F.col("is_current"), F.lit(False))
    u = u.withColumns({
        "_touched": F.max("_new").over(by_key) == 1,
        "_cur_start": F.max(F.when(is_cur, F.col("effective_start_date"))).over(by_key),
        "_same_time": F.sum("_new").over(by_time),
        # highest version so far, closed ones included: new versions follow it
        "_base": F.coalesce(F.max("scd_version").over(by_key), F.lit(0))})
    guard = F.when(is_new & without_key(key), F.raise_error(F.lit("change feed has a row without a key"))) \
        .when(is_new & (F.col("_same_time") > 1), F.raise_error(F.concat(
            F.lit("change feed has more than one row for key "), key_text(key),
            F.lit(" at one effective time"))))
    # the sequence to rebuild: the current version of each touched key plus
    # the feed rows strictly newer than it.  The guard sits in the filter
    # (evaluated first for every row) rather than in the key column, which
    # must stay the partitioning attribute.
    newer = F.col("_cur_start").isNull() | (F.col("effective_start_date") > F.col("_cur_start"))
    u = (u.withColumn("_seq", F.col("_touched") & (is_cur | (is_new & newer)))
         .filter(F.coalesce(guard.cast("boolean"), ~is_new | F.col("_seq"))))

    seq = Window.partitionBy(*keys, "_seq").orderBy("effective_start_date", "_new")
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(seq))
    u = (u.withColumn("_keep", ~is_new | changed | (F.row_number().over(seq) == 1))
         .filter("_keep"))
    nxt = F.lead("effective_start_date").over(seq)
    n_new = F.sum("_new").over(seq.rowsBetween(Window.unboundedPreceding, 0))
    rebuilt = {
        "effective_end_date": F.when(F.col("_seq"), nxt).otherwise(F.col("effective_end_date")),
        "is_current": F.when(F.col("_seq"), nxt.isNull()).otherwise(F.col("is_current")),
        "scd_version": F.when(is_new, F.col("_base") + n_new).otherwise(F.col("scd_version"))
        .cast("int"),
    }
    return u.select(*attrs, "effective_start_date", *[rebuilt[c].alias(c) for c in meta[1:]])


def _dated(changes: DataFrame, attrs: Sequence[str], as_of: str | Column | None,
           change_time: str | None) -> DataFrame:
    start = (F.col(change_time).cast("timestamp") if change_time is not None
             else (F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of))
    return changes.select(*[F.col(c) for c in attrs], start.alias("effective_start_date"))


def scd2_late(history: DataFrame, changes: DataFrame, key: Key = "agent_id",
              tracked: Sequence[str] = ("base_city",), as_of: str | Column | None = None,
              change_time: str | None = None) -> DataFrame:
    """The feed rows that ``scd2_apply`` leaves out although they say something
    new: not newer than the key's current version, and different from the
    version valid at their time (or from a time before the first version)."""
    attrs = [c for c in history.columns if c not in
             ("effective_start_date", "effective_end_date", "is_current", "scd_version")]
    feed = _dated(changes, attrs, as_of, change_time)
    keys = key_columns(key)
    spans = history.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("effective_start_date").alias("_from"),
                           F.col("effective_end_date").alias("_to"), "is_current",
                           *[F.col(c).alias(f"_h_{c}") for c in tracked])
    at = F.col("effective_start_date")
    valid = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    seen = feed.join(spans, [F.col(k) == F.col(f"_k_{k}") for k in keys]).groupBy(*attrs, "effective_start_date").agg(
        F.max(F.when(F.col("is_current"), F.col("_from"))).alias("_cur_start"),
        F.coalesce(F.max(valid & same), F.lit(False)).alias("_known"))
    return seen.filter((at <= F.col("_cur_start")) & ~F.col("_known")).select(*attrs, "effective_start_date")


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current"))


def scd2_history_of(history: DataFrame, key_value: str, key: str = "agent_id") -> DataFrame:
    return history.filter(F.col(key) == key_value).orderBy("scd_version")


def scd2_changed_keys(history: DataFrame, keys: Sequence[str] = ("agent_id", "agent_name")
                      ) -> DataFrame:
    """Keys with more than one version (``GROUP BY .. HAVING COUNT(*) > 1``)."""
    return (history.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))
            .filter(F.col("versions") > 1))


def scd2_counts(history: DataFrame) -> DataFrame:
    """Total, current and historical version counts in one aggregate."""
    return history.agg(F.count(F.lit(1)).alias("total_records"),
                       F.count_if(F.col("is_current")).alias("current_records"),
                       F.count_if(~F.col("is_current")).alias("historical_records"))


def scd2_dedup(history: DataFrame,
               keys: Sequence[str] = ("agent_id", "base_city", "is_current", "scd_version")
               ) -> DataFrame:
    """Drop repeated versions left by a non-idempotent insert."""
    return history.dropDuplicates(list(keys))


def valid_at(facts: DataFrame, history: DataFrame, key: Key, time_col: str, slice_unit: str = "day") -> DataFrame:
    """Join each fact to the version valid at its time: the last one that started at or before it,
    unless that one has ended by then.

    An as-of join without a range predicate.  Facts and versions are united and sorted within
    (key, time slice); the last version is carried forward over the facts that follow it.  What is
    valid as a slice begins comes from one row per key and slice.  The facts of a key that holds
    very many are thus split by time, and each fact is compared with no version but its own.

    A key's versions must not overlap (no two of a type-2 history do); of two that start together the
    one with the greater ``effective_end_date`` (open ends last), then the greater row, counts.
    Facts without a key, a time or a valid version are left out.  Columns are those of the facts,
    then those of the history but the key.
    """
    keys = key_columns(key)
    fact_cols, version_cols = facts.columns, [c for c in history.columns if c not in keys]
    same = [F.col(k) for k in keys]
    # greatest of equal starts: open ends last, then by the other columns
    version = F.struct(F.col("effective_start_date").alias("_start"), F.col("effective_end_date").isNull().alias("_open"),
                       F.col("effective_end_date").alias("_end"), F.struct(*version_cols).alias("_v"))
    at = F.col(time_col).cast("timestamp")
    f = facts.where(~without_key(key) & at.isNotNull()).select(
        *same, at.alias("_at"), F.lit(1).alias("_kind"), F.struct(*fact_cols).alias("_f"),
        F.lit(None).cast(history.select(version.alias("v")).schema["v"].dataType).alias("_held"))
    v = history.where(~without_key(key) & F.col("effective_start_date").isNotNull()).select(
        *same, F.col("effective_start_date").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(f.schema["_f"].dataType).alias("_f"), version.alias("_held"))
    u = f.unionByName(v).withColumn("_slice", F.date_trunc(slice_unit, "_at"))
    # one row per key and slice: the last version that started in it, then in those before it
    last = u.groupBy(*keys, "_slice").agg(F.max("_held").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*same, "_slice", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    upto = Window.partitionBy(*keys, "_slice").orderBy("_at", "_kind", "_held").rowsBetween(Window.unboundedPreceding, 0)
    seen = (u.withColumn("_here", F.last("_held", ignorenulls=True).over(upto)).where("_kind = 1")
            .join(carried, [*keys, "_slice"], "left")
            .withColumn("_valid", F.coalesce("_here", "_carried")))
    valid = seen.where(F.col("_valid").isNotNull() & (F.col("_valid._open") | (F.col("_at") < F.col("_valid._end"))))
    return valid.select(*[F.col(f"_f.{c}").alias(c) for c in fact_cols], *[F.col(f"_valid._v.{c}").alias(c) for c in version_cols])
