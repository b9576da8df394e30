"""A6 with any WHERE: a list of parameter sets, each one UPDATE or DELETE.

A statement's WHERE is given as conjuncts on target columns:

* ``equal={column: param}``: column = :param
* ``among={column: param}``: column IN (:param), the parameter an array
* ``within={column: (low, high)}``: column BETWEEN :low AND :high
* ``also``: any further condition, a function of the parameters' lookup
  (``lambda p: F.col("x") > p("least")``), with its target columns in ``also_columns``

Sets run in ``seq`` order and a later one sees what the earlier ones did.

The sets meet the rows in one equi-join. Equalities and list members are join
keys. A range becomes the few *cells* of a dyadic grid that cover it exactly
once: the grid spans the sets' own bounds, a row has one cell on each level that
some set uses (``LEVELS`` at most), and a range has at most two on a level. So a pair
meets once however long the range is, and there is no cross or nested-loop join.
A statement with ``also`` alone is tried on every row, as a database does it,
for sets within the broadcast bounds only.

Rows that no statement can tell apart are one *class*: they agree in the looked-at
columns, and a range's column counts by its place among the sets' bounds only.
Classes meet the sets, with their number of rows, and rows get their class's result.

If no SET column occurs in the WHERE, what a set matches doesn't depend on the
others: one join, then the last set of a class. Of deletes only the first one
counts, so the sets are tried in seq order, in pieces that grow, and a class that
was hit takes no further part. If SET columns occur in equalities and lists, the
sets that fit in all else are folded over each class in seq order. Otherwise
each round finds every live class's next matching set, applies it, and goes on
with the classes that had one; a round is one join and one aggregation.

Defined cases: a NULL column or parameter matches nothing (as in SQL); an empty list
matches nothing; a set that matches no row counts 0; no sets leave the table
as it is; equal rows are rows of their own; a NULL or repeated seq raises.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package
from .sizing import broadcast_if_small, fits_broadcast

LEVELS = 20
FIRST_SETS, GROWTH = 64, 4  # sets that deletes try first, and how much longer the next piece is
_RID, _SEQ, _SINCE, _ROWS = "_rid", "_set_seq", "_since", "_rows"


def _param(name: str) -> Column:
    return F.col(f"`_p_{name}`")


@dataclass(frozen=True)
class Where:
    equal: Mapping[str, str] = field(default_factory=dict)
    among: Mapping[str, str] = field(default_factory=dict)
    within: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    also: Callable[[Callable[[str], Column]], Column] | None = None
    also_columns: Sequence[str] = ()

    def columns(self) -> list[str]:
        """Target columns that the statement looks at."""
        return list(dict.fromkeys([*self.equal, *self.among, *self.within, *self.also_columns]))


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _number(c: Column, t: T.DataType) -> Column:
    """A double that never falls as the value rises."""
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(t, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(t, T.NumericType):
        return c.cast("double")
    raise ValueError(f"a range needs a number, date or time column, not {t.simpleString()}")


class _Grid:
    """Cells of ``2^LEVELS`` equal steps between the sets' lowest and highest bound."""

    def __init__(self, sets: DataFrame, low: str, high: str, kind: T.DataType):
        self.kind, self.low, self.high = kind, low, high
        kinds = {f.name: f.dataType for f in sets.schema.fields}
        self.ends = [_number(_q(low), kinds[low]), _number(_q(high), kinds[high])]
        r = sets.agg(F.min(self.ends[0]), F.max(self.ends[1])).first()
        self.first = r[0] if r[0] is not None else 0.0
        self.span = max((r[1] if r[1] is not None else 0.0) - self.first, 0.0)

    def _cell(self, value: Column) -> Column:
        top = (1 << LEVELS) - 1
        if self.span == 0.0:
            return F.when(value.isNotNull(), F.lit(0).cast("long"))
        step = F.floor((value - F.lit(self.first)) / F.lit(self.span) * F.lit(float(1 << LEVELS)))
        # NULL stays NULL: least and greatest would skip it
        return F.when(value.isNotNull(), F.least(F.greatest(step, F.lit(0)), F.lit(top)).cast("long"))

    def cover(self, sets: DataFrame) -> DataFrame:
        """``sets`` with (_level, _cell), a row for each cell of its range."""
        a, b = self._cell(self.ends[0]), self._cell(self.ends[1])

        def of(level):
            # walking up from both ends: a cell is taken at an odd left end or an even right end
            x = F.floor((F.col("_a") + F.lit((1 << level) - 1)) / F.lit(1 << level))
            y = F.floor((F.col("_b") + 1) / F.lit(1 << level)) - 1
            left = F.when((x <= y) & (x % 2 == 1), x)
            right = F.when((x <= y) & (y % 2 == 0), y)
            only = F.array_distinct(F.array(left, right)) if level < LEVELS else F.array(F.when(x <= y, x))
            return F.transform(F.filter(only, lambda c: c.isNotNull()),
                               lambda c: F.struct(F.lit(level).alias("_level"), c.cast("long").alias("_cell")))

        cells = F.flatten(F.array(*[of(v) for v in range(LEVELS + 1)]))
        return (sets.withColumn("_a", a).withColumn("_b", b).where("_a <= _b")
                .withColumn("_c", F.explode(cells)).select("*", "_c._level", "_c._cell").drop("_a", "_b", "_c"))

    def cells_of(self, rows: DataFrame, column: str, levels: list[int]) -> DataFrame:
        value = _number(_q(column), self.kind)
        inside = value.between(F.lit(self.first), F.lit(self.first + self.span))
        at = F.array(*[F.struct(F.lit(v).alias("_level"), F.shiftright(F.col("_x"), v).alias("_cell")) for v in levels])
        return (rows.where(inside).withColumn("_x", self._cell(value)).withColumn("_c", F.explode(at))
                .select("*", "_c._level", "_c._cell").drop("_x", "_c"))


class _Matcher:
    """The sets, prepared once; ``hits`` joins rows with them."""

    def __init__(self, target: DataFrame, params: DataFrame, seq: str, where: Where):
        kinds = {f.name: f.dataType for f in target.schema.fields}
        sets = params.select(*[_q(c).alias(f"_p_{c}") for c in params.columns]).withColumn(_SEQ, _q(f"_p_{seq}").cast("long"))
        for c, p in where.among.items():
            sets = sets.withColumn(f"_k_{c}", F.explode(F.array_distinct(_q(f"_p_{p}")).cast(T.ArrayType(kinds[c]))))
        for c, p in where.equal.items():
            sets = sets.withColumn(f"_k_{c}", _q(f"_p_{p}").cast(kinds[c]))
        self.keys = [*where.among, *where.equal]
        self.where, self.grid, self.levels = where, None, []
        ranges = list(where.within.items())
        if ranges:
            self.range_column, (low, high) = ranges[0]
            self.grid = _Grid(sets, f"_p_{low}", f"_p_{high}", kinds[self.range_column])
            sets = cut_lineage(self.grid.cover(sets), "param-sets")
            self.levels = sorted(r[0] for r in sets.select("_level").distinct().collect())  # LEVELS + 1 at most
        if not self.keys and not ranges:
            if not fits_broadcast(sets):
                raise ValueError("a WHERE without equality, list or range is tried on every row; too many sets for that")
            sets, self.small = sets.withColumn("_any", F.lit(1)), True
        else:
            self.small = fits_broadcast(sets)
        self.sets = sets

    def hits(self, rows: DataFrame, *conditions: Column, sets: Column | None = None,
             keep: Sequence[Column] = ()) -> DataFrame:
        """(_rid, seq) of the rows and the sets that match them, of those that
        ``sets`` tells, with the columns ``keep`` of both."""
        on = []
        if self.grid is not None:
            rows = self.grid.cells_of(rows, self.range_column, self.levels or [0])
            on += ["_level", "_cell"]
        for c in self.keys:
            rows = rows.withColumn(f"_k_{c}", _q(c))
            on.append(f"_k_{c}")
        if not on:
            rows, on = rows.withColumn("_any", F.lit(1)), ["_any"]
        tests = [*conditions, *[_q(c).between(_param(a), _param(b)) for c, (a, b) in self.where.within.items()]]
        if self.where.also is not None:
            tests.append(self.where.also(_param))
        some = self.sets if sets is None else self.sets.where(sets)
        joined = rows.join(F.broadcast(some) if self.small else some, on, "inner")
        return (joined.where(reduce(lambda a, b: a & b, tests)) if tests else joined).select(_RID, _SEQ, *keep)


def _ordered(kinds: Sequence[T.DataType]) -> Callable[[Column], Column] | None:
    """Values of these types as doubles or longs that compare as they do; None
    if there is no exact way."""
    if all(isinstance(t, T.IntegralType) for t in kinds):
        return lambda c: c.cast("long")
    if all(isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)) for t in kinds):
        return lambda c: c.cast("double")
    if all(isinstance(t, T.DateType) for t in kinds):
        return lambda c: F.unix_date(c).cast("long")
    if all(isinstance(t, T.TimestampType) for t in kinds):
        return F.unix_micros
    return None


def _place_in(shared):
    def place(values: pd.Series) -> pd.Series:
        v = values.to_numpy()
        return pd.Series(np.searchsorted(shared.value, v, "left") + np.searchsorted(shared.value, v, "right"))
    return F.pandas_udf(place, "long")


def _places(target: DataFrame, params: DataFrame, where: Where, columns: Sequence[str]) -> dict[str, Column]:
    """For the range columns whose bounds can be held by a task: a value's place
    among the bounds, odd on a bound and even between two."""
    kinds, of = {f.name: f.dataType for f in target.schema.fields}, {f.name: f.dataType for f in params.schema.fields}
    out = {}
    for c in columns:
        low, high = where.within[c]
        number = _ordered([kinds[c], of[low], of[high]])
        ends = params.select(F.explode(F.array(_q(low), _q(high))).alias("e")).where("e IS NOT NULL").distinct()
        if number is None or not fits_broadcast(ends):
            continue
        bounds = np.sort(ends.select(number(F.col("e")).alias("e")).toPandas()["e"].to_numpy())
        value = number(_q(c))
        place = _place_in(target.sparkSession.sparkContext.broadcast(bounds))
        out[c] = F.when(value.isNotNull(), place(F.coalesce(value, F.lit(0).cast("long"))))
    return out


def _classes(target: DataFrame, params: DataFrame, where: Where, changed: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The written rows; their classes with the looked-at columns of one member,
    a number and how many rows they have; and the columns that tell classes apart."""
    looked = where.columns()
    kinds = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    if not looked or any(w in kinds[c] for c in looked for w in ("map<", "variant", "interval")):
        rows = cut_lineage(target.withColumn("_g_row", F.monotonically_increasing_id()), "param-rows")
        return rows, rows.select("_g_row", *[_q(c) for c in looked], F.col("_g_row").alias(_RID), F.lit(1).alias(_ROWS)), ["_g_row"]
    exact = {*changed, *where.equal, *where.among, *where.also_columns}
    places = _places(target, params, where, [c for c in where.within if c not in exact])
    # one written copy: the classes and the result read the same rows
    rows = cut_lineage(target.withColumns({f"_g_{c}": v for c, v in places.items()}), "param-rows")
    keys = [f"_g_{c}" if c in places else c for c in looked]
    points = (rows.groupBy(*[_q(k) for k in keys])
              .agg(F.count(F.lit(1)).alias(_ROWS), *[F.min(_q(c)).alias(c) for c in places])
              .withColumn(_RID, F.monotonically_increasing_id()))
    return rows, cut_lineage(points, "param-classes"), keys


def param_batch(target: DataFrame, params: DataFrame, where: Where, *, seq: str = "seq",
                set_columns: Mapping[str, str] | None = None, delete: bool = False) -> tuple[DataFrame, DataFrame]:
    """One UPDATE (``set_columns``: target column -> param) or DELETE for each
    row of ``params``, run in ``seq`` order. Returns (new table, counts);
    ``counts`` has (seq, affected) for each set."""
    set_columns = dict(set_columns or {})
    if delete == bool(set_columns):
        raise ValueError("give set_columns for an update, or delete=True")
    order = _q(seq).cast("long")
    if not params.groupBy(order.alias("s")).count().where("s IS NULL OR count > 1").isEmpty():
        raise ValueError("parameter sets need different seqs: they run in that order")
    kinds = {f.name: f.dataType for f in target.schema.fields}
    looked = where.columns()
    ship_package(target.sparkSession)
    rows, classes, keys = _classes(target, params, where, list(set_columns))
    points = classes.select(_RID, *[_q(c) for c in looked])
    changed = {c: p for c, p in set_columns.items() if c in looked}
    if delete:
        effects = _first_hits(points, params, _Matcher(target, params, seq, where), order)
    elif not changed:
        effects = cut_lineage(_Matcher(target, params, seq, where).hits(points), "param-hits")
    elif _foldable(params, where, changed, kinds):
        effects = _folded(points, params, seq, where, changed, kinds)
    else:
        effects = _in_order(points, params, _Matcher(target, params, seq, where), seq, changed, kinds)
    affected = (effects.join(broadcast_if_small(classes.select(_RID, _ROWS)), _RID)
                .groupBy(_SEQ).agg(F.sum(_ROWS).alias("n")))
    counts = (params.select(order.alias(_SEQ), _q(seq)).join(affected, _SEQ, "left")
              .select(_q(seq), F.coalesce("n", F.lit(0)).cast("long").alias("affected")))
    of = classes.select(_RID, *[_q(k).alias(f"_c_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [_q(k).eqNullSafe(F.col(f"_c_{i}")) for i, k in enumerate(keys)])
    if delete:
        gone = cut_lineage(of.join(effects, _RID, "left_semi").drop(_RID), "param-gone")
        return rows.join(broadcast_if_small(gone), same, "left_anti").select(*[_q(c) for c in target.columns]), counts
    values = params.select(order.alias(_SEQ), *[_q(p).cast(kinds[c]).alias(f"_v_{c}") for c, p in set_columns.items()])
    last = (effects.groupBy(_RID).agg(F.max(_SEQ).alias(_SEQ)).join(broadcast_if_small(values), _SEQ)
            .join(of, _RID).drop(_RID, _SEQ).withColumn("_hit", F.lit(True)))
    new = rows.join(broadcast_if_small(cut_lineage(last, "param-last")), same, "left").select(
        *[F.when(F.col("_hit"), _q(f"_v_{c}")).otherwise(_q(c)).alias(c) if c in set_columns else _q(c)
          for c in target.columns])
    return new, counts


def _first_hits(points: DataFrame, params: DataFrame, match: _Matcher, order: Column) -> DataFrame:
    """(_rid, seq) of the first set that matches. The sets are tried in pieces,
    in seq order; where the cuts lie doesn't matter to the result."""
    n = params.count()
    shares, upto = [], FIRST_SETS
    while upto < n:
        shares.append(upto / n)
        upto *= GROWTH
    cuts = params.select(order.cast("double").alias("s")).approxQuantile("s", shares, 0.1 / n) if shares else []
    ends = [None, *sorted({min(int(c), (1 << 63) - 1) for c in cuts}), None]
    live, found = points, []
    for low, high in zip(ends, ends[1:]):
        piece = [F.col(_SEQ) > low] if low is not None else []
        piece += [F.col(_SEQ) <= high] if high is not None else []
        some = reduce(lambda a, b: a & b, piece) if piece else None
        hit = cut_lineage(match.hits(live, sets=some).groupBy(_RID).agg(F.min(_SEQ).alias(_SEQ)), "param-hits")
        found.append(hit)
        if high is not None:
            live = cut_lineage(live.join(broadcast_if_small(hit.select(_RID)), _RID, "left_anti"), "param-live")
            if live.isEmpty():
                break
    return reduce(DataFrame.unionByName, found)


_FOLDED = (T.StringType(), T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType())


def _unchanged(where: Where, changed: Mapping[str, str]) -> Where:
    return Where({c: p for c, p in where.equal.items() if c not in changed},
                 {c: p for c, p in where.among.items() if c not in changed},
                 where.within, where.also, where.also_columns)


def _foldable(params: DataFrame, where: Where, changed: Mapping[str, str], kinds: dict[str, T.DataType]) -> bool:
    """Whether the SET columns occur in equalities and lists only, with types that
    compare in Python as in Spark."""
    rest = _unchanged(where, changed)
    return (not {*where.within, *where.also_columns} & set(changed) and all(kinds[c] in _FOLDED for c in changed)
            and bool(rest.equal or rest.among or rest.within or fits_broadcast(params)))


def _folded(points: DataFrame, params: DataFrame, seq: str, where: Where, changed: Mapping[str, str],
            kinds: dict[str, T.DataType]) -> DataFrame:
    """(_rid, seq) of the effective updates: each class's sets that fit in what
    updates don't change, in seq order, against the values so far."""
    match = _Matcher(points, params, seq, _unchanged(where, changed))
    names = list(changed)
    tests = [(names.index(c), F.array(_param(p).cast(kinds[c]))) for c, p in where.equal.items() if c in changed]
    tests += [(names.index(c), _param(p).cast(T.ArrayType(kinds[c]))) for c, p in where.among.items() if c in changed]
    which, k = [i for i, _ in tests], len(names)
    keep = [*[_q(c).alias(f"_s_{i}") for i, c in enumerate(names)], *[t.alias(f"_t_{i}") for i, (_, t) in enumerate(tests)],
            *[_param(changed[c]).cast(kinds[c]).alias(f"_v_{i}") for i, c in enumerate(names)]]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = match.hits(points, keep=keep).repartition(parts, _RID).sortWithinPartitions(_RID, _SEQ)

    def run(batches):
        now, state = None, ()
        for b in batches:
            out = []
            for rid, s, *row in zip(*(c.to_pylist() for c in b.columns)):
                if rid != now:
                    now, state = rid, row[:k]
                if all(state[i] is not None and t is not None and state[i] in t for i, t in zip(which, row[k:])):
                    state = row[-k:]
                    out.append((rid, s))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(2)], names=[_RID, _SEQ])

    return cut_lineage(pairs.mapInArrow(run, f"{_RID} long, {_SEQ} long"), "param-hits")


def _in_order(points: DataFrame, params: DataFrame, match: _Matcher, seq: str, changed: dict[str, str],
              kinds: dict[str, T.DataType]) -> DataFrame:
    """(_rid, seq) of the effective updates, where a set may change what later
    ones match: a round for each further update of some row."""
    values = broadcast_if_small(params.select(_q(seq).cast("long").alias(_SEQ),
                                              *[_q(p).cast(kinds[c]).alias(f"_v_{c}") for c, p in changed.items()]))
    live, found = points.withColumn(_SINCE, F.lit(None).cast("long")), []
    while True:
        later = F.col(_SINCE).isNull() | (F.col(_SEQ) > F.col(_SINCE))
        first = match.hits(live, later).groupBy(_RID).agg(F.min(_SEQ).alias(_SEQ))
        live = cut_lineage(live.drop(_SINCE).join(first.join(values, _SEQ), _RID).select(
            _RID, *[_q(f"_v_{c}").alias(c) if c in changed else _q(c) for c in points.columns if c != _RID],
            F.col(_SEQ).alias(_SINCE)), "param-live")
        if live.isEmpty():
            break
        found.append(live.select(_RID, F.col(_SINCE).alias(_SEQ)))
    empty = points.select(_RID, F.lit(None).cast("long").alias(_SEQ)).limit(0)
    return reduce(DataFrame.unionByName, found, empty)
