"""Parameter batches against the sets run one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import param_batch as pb

ROWS = "id long, price double, day date, status string, x int"
SETS = "seq long, lo double, hi double, sts array<string>, st string, new string, np double"


def table(rng, n=300):
    import datetime as dt
    return [(i % 250, rng.choice([None, float(rng.randint(-50, 50)), rng.random() * 100]),
             dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 400)), rng.choice(["O", "F", "P", None]), rng.randint(0, 5))
            for i in range(n)]


def some_sets(rng, n=40):
    out = []
    for k in range(n):
        lo = rng.choice([None, rng.uniform(-80, 120), float(rng.randint(-50, 50))])
        hi = None if lo is None and rng.random() < .5 else (lo or 0.0) + rng.choice([0.0, -1.0, 0.5, 30.0, 500.0])
        out.append((k * 3, lo, hi, rng.choice([None, [], ["O"], ["F", "P", "F"], ["O", None, "new2"]]),
                    rng.choice(["O", "F", None]), f"new{k % 4}", rng.choice([None, 1.0, 20.0])))
    return out


def between(v, lo, hi):
    return v is not None and lo is not None and hi is not None and lo <= v <= hi


def member(v, xs):
    return v is not None and xs is not None and v in [x for x in xs if x is not None]


def one_by_one(rows, sets, test, change=None):
    """Each set over all rows in turn."""
    rows, counts = [list(r) for r in rows], {}
    for s in sorted(sets):
        hit = [r for r in rows if test(r, s)]
        counts[s[0]] = len(hit)
        if change is None:
            rows = [r for r in rows if not test(r, s)]
        else:
            for r in hit:
                change(r, s)
    return sorted(map(tuple, rows), key=repr), counts


CASES = {
    "range": (pb.Where(within={"price": ("lo", "hi")}), lambda r, s: between(r[1], s[1], s[2])),
    "list": (pb.Where(among={"status": "sts"}), lambda r, s: member(r[3], s[3])),
    "list and range": (pb.Where(among={"status": "sts"}, within={"price": ("lo", "hi")}),
                       lambda r, s: member(r[3], s[3]) and between(r[1], s[1], s[2])),
    "equal and more": (pb.Where(equal={"status": "st"}, also=lambda p: F.col("x") > F.size(p("sts")), also_columns=["x"]),
                       lambda r, s: r[3] is not None and r[3] == s[4] and s[3] is not None and r[4] > len(s[3])),
    "condition only": (pb.Where(also=lambda p: F.col("price") < p("lo"), also_columns=["price"]),
                       lambda r, s: r[1] is not None and s[1] is not None and r[1] < s[1]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("what", ["delete", "update other", "update looked at"])
def test_equals_sets_one_by_one(spark, case, what):
    rng = random.Random(f"{case}{what}")
    rows, sets = table(rng), some_sets(rng)
    where, test = CASES[case]
    target, params = spark.createDataFrame(rows, ROWS), spark.createDataFrame(sets, SETS)
    if what == "delete":
        new, counts = pb.param_batch(target, params, where, delete=True)
        want = one_by_one(rows, sets, test)
    elif what == "update other":
        new, counts = pb.param_batch(target, params, where, set_columns={"id": "seq"})
        want = one_by_one(rows, sets, test, lambda r, s: r.__setitem__(0, s[0]))
    else:
        def change(r, s):
            r[3], r[1] = s[5], s[6]
        new, counts = pb.param_batch(target, params, where, set_columns={"status": "new", "price": "np"})
        want = one_by_one(rows, sets, test, change)
    assert sorted(map(tuple, new.collect()), key=repr) == want[0]
    assert {r["seq"]: r["affected"] for r in counts.collect()} == want[1]
    assert any(want[1].values())


def test_date_range_and_point_ranges(spark):
    rng = random.Random(4)
    rows = table(rng)
    sets = [(k, r[2], r[2]) for k, r in enumerate(rows[:50])]
    params = spark.createDataFrame(sets, "seq long, a date, b date")
    _, counts = pb.param_batch(spark.createDataFrame(rows, ROWS), params, pb.Where(within={"day": ("a", "b")}),
                               set_columns={"x": "seq"})
    assert {r["seq"]: r["affected"] for r in counts.collect()} == {
        k: sum(r[2] == a for r in rows) for k, a, _ in sets}


def test_plan_has_no_nested_loop_and_cells_meet_once(spark):
    sets = [(k, float(a), float(b)) for k, (a, b) in enumerate((a, b) for a in range(0, 60, 7) for b in range(a, 64, 5))]
    target = spark.range(64).select(F.col("id").cast("double").alias("v"))
    params = spark.createDataFrame(sets, "seq long, lo double, hi double")
    m = pb._Matcher(target, params, "seq", pb.Where(within={"v": ("lo", "hi")}))
    hits = m.hits(target.withColumn("_rid", F.monotonically_increasing_id()))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert hits.count() == hits.distinct().count() == sum(len([v for v in range(64) if a <= v <= b]) for _, a, b in sets)


def test_empty_sides_and_bad_seqs(spark):
    rows = table(random.Random(1), 5)
    target, none = spark.createDataFrame(rows, ROWS), spark.createDataFrame([], SETS)
    where = pb.Where(within={"price": ("lo", "hi")})
    new, counts = pb.param_batch(target, none, where, delete=True)
    assert sorted(map(tuple, new.collect()), key=repr) == sorted(rows, key=repr) and counts.collect() == []
    sets = spark.createDataFrame([(1, 0.0, 9.0, [], "O", "n", 1.0)], SETS)
    new, counts = pb.param_batch(target.limit(0), sets, where, set_columns={"status": "new"})
    assert new.collect() == [] and [tuple(r) for r in counts.collect()] == [(1, 0)]
    with pytest.raises(ValueError):
        pb.param_batch(target, sets.union(sets), where, delete=True)
    with pytest.raises(ValueError):
        pb.param_batch(target, sets, pb.Where(within={"status": ("lo", "hi")}), delete=True)


def test_work_does_not_grow_with_rows_times_sets(spark, monkeypatch):
    """Rows that no set tells apart meet the sets once; a delete's sets come in pieces."""
    rng = random.Random(7)
    rows = [(i, rng.random() * 100, None, rng.choice(["O", "F", None]), i % 3) for i in range(3000)]
    sets = [(k, float(k * 7 % 10 * 10), float(k * 7 % 10 * 10 + k % 3 * 15), ["O", f"S{k % 5}"], None, f"S{(k + 2) % 5}", None)
            for k in range(300)]
    target, params = spark.createDataFrame(rows, ROWS), spark.createDataFrame(sets, SETS)
    where = pb.Where(among={"status": "sts"}, within={"price": ("lo", "hi")})
    met, rounds, hits = [], [], pb._Matcher.hits

    def counted(self, some, *conditions, **more):
        rounds.append(some.count())
        out = hits(self, some, *conditions, **more)
        met.append(out.count())
        return out

    monkeypatch.setattr(pb._Matcher, "hits", counted)
    new, counts = pb.param_batch(target, params, where, set_columns={"status": "new"})
    want = one_by_one(rows, sets, lambda r, s: member(r[3], s[3]) and between(r[1], s[1], s[2]),
                      lambda r, s: r.__setitem__(3, s[5]))
    assert sorted(map(tuple, new.collect()), key=repr) == want[0]
    assert {r["seq"]: r["affected"] for r in counts.collect()} == want[1]
    assert len(rounds) == 1 and rounds[0] < 200  # one pass over the classes, however often a row is updated

    met.clear(), rounds.clear()
    where = pb.Where(within={"price": ("lo", "hi")}, also=lambda p: F.col("x") < F.size(p("sts")), also_columns=["x"])
    new, counts = pb.param_batch(target, params, where, delete=True)
    want = one_by_one(rows, sets, lambda r, s: between(r[1], s[1], s[2]) and r[4] < len(s[3]))
    assert sorted(map(tuple, new.collect()), key=repr) == want[0]
    assert {r["seq"]: r["affected"] for r in counts.collect()} == want[1]
    assert len(rounds) > 1 and rounds[-1] < rounds[0] < 300 and sum(met) < 64 * 300
