"""Keyed table changes with an audit history of old rows.

B1 merge_upsert, B2 insert_rows, B3 update_by_key, B4 delete_by_key,
B5 history_schema, B6 insert_default, B7 audit_delete, B8 audit_update,
B9 apply_changes, A6 param_batch_update.

Tables are DataFrames; every operator returns the new table (and history)
as DataFrames. Parquet has no MERGE, so persisting a version is the
caller's ``write`` (see ``streaming.audit_stream`` for versioned folders).

Scale notes
-----------
* The change batch is usually far smaller than the table. Its distinct key
  set is checked in one bounded job (rows and bytes); under the bounds it is
  broadcast, so the table is only *streamed* (left-anti / left-semi against
  a hash table) and never shuffled. Above them Spark shuffles both sides
  by key (a table bucketed by key avoids that shuffle).
* Ordered per-key semantics (several changes to one key in one batch) use a
  two-level scan over ops and seqs only: windows over ``(key, chunk)`` then a
  carry over the chunk summaries per key. Only keys with more than
  ``HOT_CHANGES`` changes go that way; others take one window. Chunks are row
  ranks: the changes are range-partitioned by (key, seq), so a key holding a
  third of all changes is split into chunks of equal numbers of rows, however
  its seqs are spread. Row images are written once and come from an equi-join
  on ``(key, seq)``, which spreads a hot key too.
* Final per-key state is a ``groupBy`` with ``max`` over narrow rows (map-side
  partial aggregation), so hot keys collapse before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .sizing import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, fits_broadcast, row_bytes

# Fixed values of the audit history: column names/types in front of the base
# columns, change kinds, and the sentinel written when the session gives no
# address or host.
AUDIT_COLUMNS = (
    ("log_date", T.TimestampNTZType()),
    ("log_ip", T.StringType()),
    ("host", T.StringType()),
    ("type", T.StringType()),
)
OP_INSERT, OP_UPDATE, OP_DELETE, OP_MERGE = "I", "U", "D", "M"
HISTORY_UPDATE, HISTORY_DELETE = "U", "D"
UNSET_CONTEXT = "@"

# Seq given to the table's own row when it is put in front of its changes.
_TARGET_SEQ = -(2 ** 63)
_OP_TARGET = "T"
# A key with more changes than this in a batch is sequenced in chunks.
HOT_CHANGES = 10_000


@dataclass(frozen=True)
class AuditContext:
    """Time, address and host written to history rows. ``log_ts=None`` means
    the current local date-time; tests pass a literal. The time is a
    date-time without zone (``timestamp_ntz``), as a database DATE is."""

    log_ts: _dt.datetime | str | None = None
    log_ip: str | None = None
    host: str | None = None

    def ts_col(self) -> Column:
        if self.log_ts is None:
            return F.localtimestamp()
        return F.lit(str(self.log_ts)).cast(T.TimestampNTZType())

    def pinned(self, spark: SparkSession) -> AuditContext:
        """This context with the time of now, read once: every row of a job or
        micro-batch that takes several Spark actions gets the same time."""
        if self.log_ts is not None:
            return self
        return replace(self, log_ts=spark.sql("SELECT CAST(localtimestamp() AS STRING) AS t").first()["t"])

    def ip_col(self) -> Column:
        return F.lit(self.log_ip if self.log_ip is not None else UNSET_CONTEXT)

    def host_col(self) -> Column:
        return F.lit(self.host if self.host is not None else UNSET_CONTEXT)


@dataclass
class ChangeResult:
    base: DataFrame
    history: DataFrame


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _keys(keys: Sequence[str] | str) -> list[str]:
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",")]
    keys = [k for k in keys if k]
    if not keys:
        raise ValueError("empty key: a keyed change needs at least one key column")
    return list(keys)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_q(k).isNull() for k in keys])


def _small_or_none(df: DataFrame, max_rows: int) -> DataFrame | None:
    """``F.broadcast(df)`` if df is within ``max_rows`` rows and the byte
    bound (one bounded job), else None."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, DEFAULT_BROADCAST_BYTES) else None


def _check_schema(target: DataFrame, rows: DataFrame, extra: Sequence[str] = ()) -> None:
    have = {f.name: f.dataType for f in rows.schema.fields if f.name not in extra}
    want = {f.name: f.dataType for f in target.schema.fields}
    if set(have) != set(want):
        raise ValueError(f"column mismatch: missing {sorted(set(want) - set(have))}, "
                         f"extra {sorted(set(have) - set(want))}")
    bad = [n for n in want if have[n] != want[n]]
    if bad:
        raise ValueError(f"type mismatch in columns {bad}")


def _last_per_key(rows: DataFrame, keys: list[str], cols: list[str],
                  seq: str | None) -> DataFrame:
    """One row per key: the last by ``seq``. Without ``seq``, duplicate keys
    raise (the batch would be order dependent)."""
    if seq is None:
        dup = rows.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError("duplicate keys in a change batch without a seq column")
        return rows.select(*[_q(c) for c in cols])
    payload = F.struct(*[_q(c) for c in cols if c not in keys])
    return (rows.groupBy(*keys)
            .agg(F.max_by(payload, _q(seq)).alias("_last"))
            .select(*[_q(k) for k in keys], "_last.*"))


# --------------------------------------------------------------- B2, B5, B6

def history_schema(base: DataFrame) -> DataFrame:
    """Empty history frame: four audit columns, then every base column."""
    audit = [F.lit(None).cast(t).alias(n) for n, t in AUDIT_COLUMNS]
    return base.limit(0).select(*audit, *[_q(c) for c in base.columns])


def append_history(rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Append audit rows to a written history table. ``rows`` must have the
    columns of ``schema`` (``history_schema``) in any order, with its types."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    if have != want:
        raise ValueError(f"not rows of this history table: {sorted(set(have.items()) ^ set(want.items()), key=str)}")
    rows.select(*[_q(f.name) for f in schema.fields]).write.mode("append").parquet(path)


def insert_default(rows: DataFrame, column: str, value: str | Column) -> DataFrame:
    """Inserted rows with a NULL ``column`` get the session value."""
    v = value if isinstance(value, Column) else F.lit(value)
    return rows.withColumn(column, F.coalesce(_q(column), v.cast(rows.schema[column].dataType)))


def insert_rows(target: DataFrame, rows: DataFrame, check_keys: Sequence[str] | None = None
                ) -> DataFrame:
    """B2: append full rows (same column names and types), in target order.
    With ``check_keys`` a duplicate or NULL key in the result raises."""
    _check_schema(target, rows)
    out = target.unionByName(rows.select(*[_q(c) for c in target.columns]))
    if check_keys:
        from .query import key_check
        if key_check(out, _keys(check_keys)).limit(1).count():
            raise ValueError("insert breaks the key")
    return out


# --------------------------------------------------------------- B3, B4, B1

def update_by_key(target: DataFrame, updates: DataFrame, keys, seq: str | None = None,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Set all columns of rows whose key matches an update row; update
    rows with no match do nothing. Several updates of one key: last by seq."""
    keys = _keys(keys)
    _check_schema(target, updates, extra=[seq] if seq else [])
    upd = _last_per_key(updates.where(~_any_null(keys)), keys, target.columns, seq)
    non_keys = [c for c in target.columns if c not in keys]
    u = upd.select(*[_q(k) for k in keys], F.lit(True).alias("_m"),
                   *[_q(c).alias(f"_u_{c}") for c in non_keys])
    small = _small_or_none(u, max_broadcast_rows)
    j = target.join(small if small is not None else u, on=keys, how="left")
    return j.select(*[_q(c) if c in keys else
                      F.when(F.col("_m"), _q(f"_u_{c}")).otherwise(_q(c)).alias(c)
                      for c in target.columns])


def delete_by_key(target: DataFrame, deletes: DataFrame, keys,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Remove rows whose key is in the change set."""
    keys = _keys(keys)
    k = deletes.select(*keys).where(~_any_null(keys)).distinct()
    small = _small_or_none(k, max_broadcast_rows)
    return (target.join(small if small is not None else k, on=keys, how="left_anti")
            .select(*[_q(c) for c in target.columns]))


def merge_upsert(target: DataFrame, source: DataFrame, keys, seq: str | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """B1: matched on all key columns -> every non-key column set from the
    source; not matched -> inserted. NULL keys never match, so they insert.

    Small source: the table is streamed once against a broadcast hash of the
    source (left join) and its key column once more for the matched keys;
    no table shuffle. Large source: one full outer join.
    """
    keys = _keys(keys)
    _check_schema(target, source, extra=[seq] if seq else [])
    cols = target.columns
    non_keys = [c for c in cols if c not in keys]
    null_rows = source.where(_any_null(keys)).select(*[_q(c) for c in cols])
    src = _last_per_key(source.where(~_any_null(keys)), keys, cols, seq)
    s = src.select(*[_q(k) for k in keys], F.lit(True).alias("_m"),
                   *[_q(c).alias(f"_u_{c}") for c in non_keys])
    pick = [_q(c) if c in keys else
            F.when(F.col("_m"), _q(f"_u_{c}")).otherwise(_q(c)).alias(c) for c in cols]
    small = _small_or_none(s, max_broadcast_rows)
    if small is not None:
        updated = target.join(small, on=keys, how="left").select(*pick)
        matched = target.select(*keys).join(small.select(*keys), on=keys, how="left_semi")
        inserts = src.join(matched, on=keys, how="left_anti").select(*[_q(c) for c in cols])
        out = updated.unionByName(inserts)
    else:
        j = target.withColumn("_t", F.lit(True)).join(s, on=keys, how="full_outer")
        out = j.select(*[_q(c) if c in keys else
                         F.when(F.col("_m"), _q(f"_u_{c}")).otherwise(_q(c)).alias(c)
                         for c in cols])
    return out.unionByName(null_rows)


# ------------------------------------------------------------------- B7, B8

def _audit_rows(old: DataFrame, kind: str, ctx: AuditContext) -> DataFrame:
    return old.select(ctx.ts_col().alias("log_date"), ctx.ip_col().alias("log_ip"),
                      ctx.host_col().alias("host"), F.lit(kind).alias("type"),
                      *[_q(c) for c in old.columns])


def _matched_old_rows(target: DataFrame, batch: DataFrame, keys: list[str],
                      max_broadcast_rows: int) -> DataFrame:
    k = batch.select(*keys).where(~_any_null(keys)).distinct()
    small = _small_or_none(k, max_broadcast_rows)
    return (target.join(small if small is not None else k, on=keys, how="left_semi")
            .select(*[_q(c) for c in target.columns]))


def audit_delete(target: DataFrame, deletes: DataFrame, keys, ctx: AuditContext = AuditContext(),
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """History rows (type D) holding the old row of every deleted row."""
    keys = _keys(keys)
    return _audit_rows(_matched_old_rows(target, deletes, keys, max_broadcast_rows),
                       HISTORY_DELETE, ctx)


def audit_update(target: DataFrame, updates: DataFrame, keys, ctx: AuditContext = AuditContext(),
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """History rows (type U) holding the old row (not the new one) of
    every updated row. Several changes to one key in order: ``apply_changes``."""
    keys = _keys(keys)
    return _audit_rows(_matched_old_rows(target, updates, keys, max_broadcast_rows),
                       HISTORY_UPDATE, ctx)


# ----------------------------------------------------------------------- B9

def _scan_last_before(df: DataFrame, keys: list[str], seq: str, chunk: str,
                      specs: list[tuple[str, Column, Column]], multi_chunk: bool = True
                      ) -> DataFrame:
    """For each ``(name, value, when)`` add column ``name``: ``value`` of the
    last earlier row (by ``seq``, same key) where ``when`` holds, or NULL.

    Two levels so no window partition exceeds one seq chunk: (1) a running
    ``max_by`` inside ``(key, chunk)``; (2) the chunk's own result (whole-chunk
    frame, read on the chunk's last row), whose running value over earlier
    chunks of the key is the carry. Level (1) and the chunk results are one
    Window operator over one shuffle; only one summary row per ``(key,
    chunk)`` is shuffled again, by key. Values should be small (ops, seqs).
    When no key spans several chunks (``multi_chunk=False``) level (2) is
    skipped.
    """
    part = [*[_q(k) for k in keys], _q(chunk)]
    w = Window.partitionBy(*part).orderBy(_q(seq))
    # equal seqs of a key lie in one chunk: no order is defined for them
    again = F.lag(_q(seq)).over(w) == _q(seq)
    df = df.withColumn("_op", F.when(again & (_q(seq) == _TARGET_SEQ), F.raise_error(F.lit(
        "the table has duplicate keys among the changed keys"))).when(again, F.raise_error(F.lit(
            "several changes of a key have the same seq"))).otherwise(F.col("_op")))
    w_in = w.rowsBetween(Window.unboundedPreceding, -1)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if not multi_chunk:
        out = df
        for name, value, when in specs:
            out = out.withColumn(name, F.max_by(value, F.when(when, _q(seq))).over(w_in))
        return out
    w_carry = (Window.partitionBy(*[_q(k) for k in keys]).orderBy(_q(chunk))
               .rowsBetween(Window.unboundedPreceding, -1))
    inner = df.withColumn("_nx", F.lead(_q(seq)).over(w))
    carry_cols = []
    for i, (name, value, when) in enumerate(specs):
        order = F.when(when, _q(seq))
        inner = (inner.withColumn(f"{name}_in", F.max_by(value, order).over(w_in))
                 .withColumn(f"_cv{i}", F.max_by(value, order).over(w_all))
                 .withColumn(f"_co{i}", F.max(order).over(w_all)))
        carry_cols.append(F.max_by(f"_cv{i}", f"_co{i}").over(w_carry).alias(f"{name}_carry"))
    carry = inner.where(F.col("_nx").isNull()).select(*keys, chunk, *carry_cols)
    drop = ["_nx", *[f"_cv{i}" for i in range(len(specs))], *[f"_co{i}" for i in range(len(specs))]]
    out = inner.drop(*drop).join(carry, on=[*keys, chunk], how="left")
    for name, _, _ in specs:
        out = (out.withColumn(name, F.coalesce(F.col(f"{name}_in"), F.col(f"{name}_carry")))
               .drop(f"{name}_in", f"{name}_carry"))
    return out


def _change_states(target: DataFrame, changes: DataFrame, keys: list[str], *, op: str,
                   seq: str, chunk_width: int | None, max_broadcast_rows: int, materialize: bool,
                   hot_changes: int, _keys_out: list | None = None) -> tuple[DataFrame, DataFrame]:
    """One narrow row per change (and the table's own row of each changed key,
    op ``T``, smallest seq): ``_exists_before``, ``_prev_nd`` (seq of the last
    earlier non-delete change), ``_exists_after``, ``_inserts``; and the images:
    key, seq, op and all columns of the same rows, written once."""
    cols = target.columns
    _check_schema(target, changes, extra=[op, seq])
    ch = (changes.where(~_any_null(keys))
          .select(_q(seq).cast("long").alias("_seq"), _q(op).alias("_op"),
                  *[_q(c) for c in cols]))
    bad_op = ~F.col("_op").isin(OP_INSERT, OP_UPDATE, OP_DELETE, OP_MERGE) | F.col("_op").isNull()
    ch = ch.withColumn("_op", F.when(bad_op, F.raise_error(F.concat(
        F.lit("unknown change op: "), F.coalesce(F.col("_op"), F.lit("NULL")))))
        .otherwise(F.col("_op")))
    no_seq = F.col("_seq").isNull() | (F.col("_seq") == _TARGET_SEQ)
    ch = ch.withColumn("_seq", F.when(no_seq, F.raise_error(F.lit("a change without a usable seq")))
                       .otherwise(F.col("_seq")))
    # the changed keys; one job gives their size (broadcast decision)
    span = ch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if materialize:
        # narrow and used three times: size check, the table's own rows, and
        # the final anti-join
        span = cut_lineage(span, "changes-keys")
    stats = span.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(span)).alias("b"), F.max("_n").alias("most")).first()
    small = stats["n"] <= max_broadcast_rows and (stats["b"] or 0) <= DEFAULT_BROADCAST_BYTES
    span_b = F.broadcast(span) if small else span
    if _keys_out is not None:
        _keys_out.append(span_b.select(*keys))
    # the table's own row goes first in its key
    own = target.join(span_b.select(*keys), on=keys, how="inner")
    own = own.select(F.lit(_TARGET_SEQ).cast("long").alias("_seq"),
                     F.lit(_OP_TARGET).alias("_op"), *[_q(c) for c in cols])
    # the only copy of the images; sequencing reads keys, seqs and ops of it
    images = cut_lineage(own.unionByName(ch), "changes-input")
    narrow = images.select(*keys, "_seq", "_op")
    if chunk_width is not None:
        own_seq = F.col("_seq") == _TARGET_SEQ
        chunked = narrow.withColumn("_chunk", F.when(own_seq, F.lit(_TARGET_SEQ)).otherwise(
            F.floor(F.col("_seq") / F.lit(chunk_width)).cast("long")))
        steps = _sequenced(chunked, keys, True)
    elif (stats["most"] or 0) <= hot_changes:
        steps = _sequenced(narrow.withColumn("_chunk", F.lit(0).cast("long")), keys, False)
    else:
        # keys with very many changes are cut into chunks of equal numbers of rows
        hot = span.where(F.col("_n") > hot_changes).select(*keys, F.lit(True).alias("_hot"))
        small_hot = _small_or_none(hot, max_broadcast_rows)
        marked = cut_lineage(narrow.join(small_hot if small_hot is not None else hot, on=keys, how="left"), "changes-marked")
        n = int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        many = marked.where("_hot").drop("_hot")
        ranked = cut_lineage(many.repartitionByRange(n, *[_q(k) for k in keys], F.col("_seq"))
                             .withColumn("_chunk", F.spark_partition_id().cast("long")), "changes-ranked")
        few = marked.where("_hot IS NULL").drop("_hot").withColumn("_chunk", F.lit(0).cast("long"))
        steps = _sequenced(ranked, keys, True).unionByName(_sequenced(few, keys, False))
    inserts = (F.col("_op") == OP_INSERT) | ((F.col("_op") == OP_MERGE) & ~F.col("_exists_before"))
    st = steps.select(*keys, "_seq", "_op", "_chunk", "_exists_before", "_prev_nd",
                      F.when(F.col("_op") == OP_DELETE, F.lit(False))
                      .when(F.col("_op") == OP_UPDATE, F.col("_exists_before"))
                      .otherwise(F.lit(True)).alias("_exists_after"), inserts.alias("_inserts"))
    if materialize:
        st = cut_lineage(st, "changes-state")
    return st, images


def _sequenced(rows: DataFrame, keys: list[str], multi_chunk: bool) -> DataFrame:
    """keys, _seq, _op, _chunk with ``_exists_before`` and ``_prev_nd``. Which
    earlier rows matter depends on ops only: the last anchor (I/M/D or the table
    row) decides existence; the last non-delete gives the image."""
    anchor = F.col("_op").isin(OP_INSERT, OP_MERGE, OP_DELETE, _OP_TARGET)
    out = _scan_last_before(rows, keys, "_seq", "_chunk", [
        ("_prev_anchor", F.col("_op"), anchor),
        ("_prev_nd", F.col("_seq"), F.col("_op") != OP_DELETE)], multi_chunk=multi_chunk)
    out = out.withColumn("_exists_before", F.coalesce(
        F.col("_prev_anchor").isin(OP_INSERT, OP_MERGE, _OP_TARGET), F.lit(False)))
    return out.withColumn("_op", F.when(
        (F.col("_op") == OP_INSERT) & F.col("_exists_before"),
        F.raise_error(F.lit("insert of a key that already exists"))).otherwise(F.col("_op"))).drop("_prev_anchor")


def _with_image(rows: DataFrame, at: str, out: str, states: DataFrame, images: DataFrame, target: DataFrame,
                keys: list[str], ctx: AuditContext, fill_column: str | None) -> DataFrame:
    """Attach ``out``: the image after the change with seq ``at`` (an equi-join
    on ``(key, seq)``; seqs differ, so a hot key still spreads over partitions)."""
    cols = target.columns
    if fill_column is not None:
        flags = states.where("_inserts").select(*keys, F.col("_seq").alias(at), F.col("_inserts").alias("_fill"))
        rows = rows.join(flags, on=[*keys, at], how="left")
    img = images.select(*keys, F.col("_seq").alias(at), F.struct(*[_q(c) for c in cols]).alias(out))
    j = rows.join(img, on=[*keys, at], how="left")
    if fill_column is None:
        return j
    value = ctx.ip_col().cast(target.schema[fill_column].dataType)
    filled = F.struct(*[(F.when(F.col("_fill"), F.coalesce(F.col(out)[c], value)).otherwise(F.col(out)[c])
                         if c == fill_column else F.col(out)[c]).alias(c) for c in cols])
    return j.withColumn(out, F.when(F.col(out).isNotNull(), filled)).drop("_fill")


def annotate_changes(target: DataFrame, changes: DataFrame, keys, *, op: str = "op",
                     seq: str = "seq", ctx: AuditContext = AuditContext(),
                     fill_column: str | None = None, chunk_width: int | None = None,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                     materialize: bool = True, hot_changes: int = HOT_CHANGES) -> DataFrame:
    """Per change (non-NULL key): state before it and the image after it.

    Columns: keys, ``_seq``, ``_op``, ``_exists_before``, ``_before``
    (struct image before, when it existed), ``_exists_after``, ``_after``
    (struct image after). The table's own row of each changed key is
    included with op ``T`` and the smallest seq.

    With ``materialize`` the states (and, when some key spans several seq
    chunks, the per-change input) are written once to the shared checkpoint
    folder.
    """
    keys = _keys(keys)
    st, images = _change_states(target, changes, keys, op=op, seq=seq, chunk_width=chunk_width,
                                max_broadcast_rows=max_broadcast_rows, materialize=materialize, hot_changes=hot_changes)
    out = _with_image(st.withColumn("_at", F.when(F.col("_exists_before"), F.col("_prev_nd"))), "_at", "_before",
                      st, images, target, keys, ctx, fill_column)
    # after a change: its own image, or for a delete none of use; kept as the change's row gives it
    out = _with_image(out.withColumnRenamed("_at", "_was"), "_seq", "_after", st, images, target, keys, ctx, fill_column)
    return out.select(*keys, "_seq", "_op", "_chunk", "_exists_before", "_before", "_exists_after", "_after")


def apply_changes(target: DataFrame, changes: DataFrame, keys, *, op: str = "op",
                  seq: str = "seq", ctx: AuditContext = AuditContext(),
                  fill_column: str | None = None, chunk_width: int | None = None,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  checkpoint: bool = True, hot_changes: int = HOT_CHANGES) -> ChangeResult:
    """One batch of I/U/D/M change rows -> (new base table, history rows).

    Per key in ``seq`` order, as if the statements ran one after another:
    I inserts (raises if the key exists), U updates an existing row (no
    effect otherwise), D deletes an existing row, M updates or inserts. Each
    effective U/D (and M on an existing row) writes the row image just
    before it to history with type U or D. Inserted rows get
    ``fill_column`` filled from ``ctx.log_ip`` when NULL. Changes with a
    NULL key never match: I/M insert them, U/D do nothing. A change without
    a seq, two changes of a key with one seq, and a changed key that the table
    has twice fail the job, with or without ``checkpoint``.

    Images are written once; sequencing works on keys, seqs and ops alone, and
    its states (written with ``checkpoint=True``) are read by both outputs. Each
    output fetches the images that it needs by an equi-join on (key, seq): the
    history that of the change before, the base the last one of each key.
    """
    keys = _keys(keys)
    cols = target.columns
    changed_keys: list = []
    st, images = _change_states(target, changes, keys, op=op, seq=seq, chunk_width=chunk_width,
                                max_broadcast_rows=max_broadcast_rows, materialize=checkpoint,
                                hot_changes=hot_changes, _keys_out=changed_keys)

    hist_rows = st.where(F.col("_op").isin(OP_UPDATE, OP_DELETE, OP_MERGE) & F.col("_exists_before")) \
        .select(*keys, "_op", F.col("_prev_nd").alias("_at"))
    history = _with_image(hist_rows, "_at", "_before", st, images, target, keys, ctx, fill_column).select(
        ctx.ts_col().alias("log_date"), ctx.ip_col().alias("log_ip"),
        ctx.host_col().alias("host"),
        F.when(F.col("_op") == OP_DELETE, F.lit(HISTORY_DELETE))
        .otherwise(F.lit(HISTORY_UPDATE)).alias("type"),
        *[F.col("_before").getField(c).alias(c) for c in cols])

    # the last change that leaves a row gives it: one image a key is fetched
    last = (st.groupBy(*keys).agg(F.max("_seq").alias("_at"), F.max_by("_exists_after", "_seq").alias("_lives"))
            .where("_lives").drop("_lives"))
    final = _with_image(last, "_at", "_after", st, images, target, keys, ctx, fill_column) \
        .select(*[F.col("_after").getField(c).alias(c) for c in cols])

    untouched = (target.join(changed_keys[0], on=keys, how="left_anti")
                 .select(*[_q(c) for c in cols]))

    null_key = changes.where(_any_null(keys) & _q(op).isin(OP_INSERT, OP_MERGE))
    null_key = null_key.select(*[_q(c) for c in cols])
    if fill_column is not None:
        null_key = insert_default(null_key, fill_column, ctx.ip_col())
    base = untouched.unionByName(final).unionByName(null_key)
    return ChangeResult(base=base, history=history)


# ----------------------------------------------------------------------- A6

def param_batch_update(target: DataFrame, params: DataFrame, keys, *, seq: str = "seq",
                       set_columns: Sequence[str] = (), delete: bool = False,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
                       ) -> tuple[DataFrame, DataFrame]:
    """One UPDATE (``SET set_columns``) or DELETE per parameter set,
    ``WHERE keys = :keys``, run in ``seq`` order.

    Returns ``(new_table, counts)``; ``counts`` has one row per set
    ``(seq, affected)``, zero counts kept. Updates: every set matching an
    existing key counts its rows; the last set per key wins. Deletes: a key
    counts only for its first set.
    """
    keys = _keys(keys)
    p = params.where(~_any_null(keys))
    pkeys = p.select(*keys).distinct()
    small = _small_or_none(pkeys, max_broadcast_rows)
    tk = target.select(*keys)
    matched = (tk.join(small if small is not None else pkeys, on=keys, how="inner")
               .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    if delete:
        first = p.groupBy(*keys).agg(F.min(_q(seq)).alias("_first"))
        per = (params.join(first, on=keys, how="left").join(matched, on=keys, how="left")
               .select(_q(seq), F.when(_q(seq) == F.col("_first"), F.coalesce("_n", F.lit(0)))
                       .otherwise(F.lit(0)).alias("_n")))
        new = delete_by_key(target, p, keys, max_broadcast_rows)
    else:
        per = (params.join(matched, on=keys, how="left")
               .select(_q(seq), F.coalesce(F.col("_n"), F.lit(0)).alias("_n")))
        last = _last_per_key(p.select(*keys, seq, *set_columns), keys,
                             [*keys, *set_columns], seq)
        u = last.select(*keys, F.lit(True).alias("_m"),
                        *[_q(c).alias(f"_u_{c}") for c in set_columns])
        s2 = _small_or_none(u, max_broadcast_rows)
        j = target.join(s2 if s2 is not None else u, on=keys, how="left")
        new = j.select(*[F.when(F.col("_m"), _q(f"_u_{c}")).otherwise(_q(c)).alias(c)
                         if c in set_columns else _q(c) for c in target.columns])
    counts = per.groupBy(_q(seq)).agg(F.sum("_n").cast("long").alias("affected"))
    return new, counts
