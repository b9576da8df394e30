import pytest
from pyspark.sql import functions as F

from tidepool.operators import changes as chg

CTX = chg.AuditContext("2026-01-01 00:00:00", "1.2.3.4", "host-a")
WORKED = [
    (1, 1, "U", "a1"), (2, 1, "D", None), (3, 1, "I", "a2"), (4, 1, "U", "a3"),
    (5, 9, "U", "x"), (6, 3, "M", "c"), (7, 3, "M", "c2"), (8, 2, "D", None), (9, 2, "U", "zz")]


def _target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")


def _changes(spark, rows=WORKED):
    return spark.createDataFrame(rows, "seq long, k long, op string, v string").select("seq", "op", "k", "v")


@pytest.mark.parametrize("chunk", [1 << 20, 3, 1])
def test_worked_example(spark, chunk):
    r = chg.apply_changes(_target(spark), _changes(spark), ["k"], ctx=CTX, chunk_width=chunk)
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "a3"), (3, "c2")]
    hist = sorted((x.type, x.k, x.v) for x in r.history.collect())
    assert hist == [("D", 1, "a1"), ("D", 2, "b"), ("U", 1, "a"), ("U", 1, "a2"), ("U", 3, "c")]
    h = r.history.first()
    assert (h.log_ip, h.host, str(h.log_date)) == ("1.2.3.4", "host-a", "2026-01-01 00:00:00")
    assert r.history.columns[:4] == ["log_date", "log_ip", "host", "type"]


def test_null_key_merge_inserts_and_update_noop(spark):
    ch = _changes(spark, [(1, None, "M", "n1"), (2, None, "M", "n2"), (3, None, "U", "n3")])
    r = chg.apply_changes(_target(spark), ch, ["k"], ctx=CTX)
    assert sorted((str(x.k), x.v) for x in r.base.collect()) == [
        ("1", "a"), ("2", "b"), ("None", "n1"), ("None", "n2")]
    assert r.history.count() == 0


def test_empty_feed_keeps_table(spark):
    ch = _changes(spark, [])
    r = chg.apply_changes(_target(spark), ch, ["k"], ctx=CTX)
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "a"), (2, "b")]
    assert r.history.count() == 0


def test_insert_of_existing_key_raises(spark):
    ch = _changes(spark, [(1, 1, "I", "dup")])
    with pytest.raises(Exception, match="already exists"):
        chg.apply_changes(_target(spark), ch, ["k"], ctx=CTX).base.collect()


def test_delete_then_insert_same_batch(spark):
    ch = _changes(spark, [(1, 2, "D", None), (2, 2, "I", "b2")])
    r = chg.apply_changes(_target(spark), ch, ["k"], ctx=CTX)
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "a"), (2, "b2")]
    assert [(x.type, x.v) for x in r.history.collect()] == [("D", "b")]


def test_fill_column_only_on_inserted_rows(spark):
    t = spark.createDataFrame([(1, "a", None)], "k long, v string, ip string")
    ch = spark.createDataFrame([(1, "M", 1, "a1", None), (2, "I", 5, "e", None), (3, "M", 6, "f", None)],
                               "seq long, op string, k long, v string, ip string")
    r = chg.apply_changes(t, ch, ["k"], ctx=CTX, fill_column="ip")
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "a1", None), (5, "e", "1.2.3.4"),
                                                            (6, "f", "1.2.3.4")]


def test_unset_context_sentinel(spark):
    r = chg.apply_changes(_target(spark), _changes(spark, [(1, 1, "D", None)]), ["k"])
    h = r.history.first()
    assert (h.log_ip, h.host) == ("@", "@")


def test_counts_property(spark, sf_dir):
    from tidepool.plans.change_plans import change_feed
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    feed = change_feed(orders)
    r = chg.apply_changes(orders, feed, ["o_orderkey"], ctx=CTX, fill_column="o_orderpriority")
    base = r.base
    assert base.where(F.col("o_orderkey").isNotNull()).groupBy("o_orderkey").count().where("count > 1").count() == 0


@pytest.mark.parametrize("bound", [0, 10_000])
def test_merge_upsert_both_paths(spark, bound):
    t = _target(spark)
    src = spark.createDataFrame([(1, "A"), (3, "C"), (None, "N")], "k long, v string")
    out = chg.merge_upsert(t, src, ["k"], max_broadcast_rows=bound)
    assert sorted((str(r.k), r.v) for r in out.collect()) == [
        ("1", "A"), ("2", "b"), ("3", "C"), ("None", "N")]


def test_merge_duplicates_need_seq(spark):
    src = spark.createDataFrame([(1, "A"), (1, "B")], "k long, v string")
    with pytest.raises(ValueError, match="duplicate"):
        chg.merge_upsert(_target(spark), src, ["k"])
    src2 = spark.createDataFrame([(1, 1, "A"), (2, 1, "B")], "seq long, k long, v string")
    out = chg.merge_upsert(_target(spark), src2, ["k"], seq="seq")
    assert sorted(tuple(x) for x in out.collect()) == [(1, "B"), (2, "b")]


def test_empty_key_raises(spark):
    with pytest.raises(ValueError, match="empty key"):
        chg.merge_upsert(_target(spark), _target(spark), [])


def test_update_delete_insert(spark):
    t = _target(spark)
    upd = spark.createDataFrame([(2, "B"), (7, "x")], "k long, v string")
    assert sorted(tuple(x) for x in chg.update_by_key(t, upd, ["k"]).collect()) == [(1, "a"), (2, "B")]
    assert sorted(tuple(x) for x in chg.delete_by_key(t, upd, ["k"]).collect()) == [(1, "a")]
    ins = spark.createDataFrame([(3, "c")], "k long, v string")
    assert chg.insert_rows(t, ins).count() == 3
    with pytest.raises(ValueError):
        chg.insert_rows(t, spark.createDataFrame([(3,)], "k long"))
    with pytest.raises(ValueError, match="breaks the key"):
        chg.insert_rows(t, spark.createDataFrame([(1, "z")], "k long, v string"), check_keys=["k"])


def test_history_schema(spark):
    h = chg.history_schema(_target(spark))
    assert h.columns == ["log_date", "log_ip", "host", "type", "k", "v"]
    assert h.count() == 0


def test_audit_single_statement(spark):
    t = _target(spark)
    batch = spark.createDataFrame([(2, "B"), (7, "x")], "k long, v string")
    d = chg.audit_delete(t, batch, ["k"], CTX).collect()
    assert [(x.type, x.k, x.v) for x in d] == [("D", 2, "b")]
    u = chg.audit_update(t, batch, ["k"], CTX).collect()
    assert [(x.type, x.k, x.v) for x in u] == [("U", 2, "b")]


def test_param_batch_update(spark):
    t = _target(spark)
    p = spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, 5, "z")], "seq long, k long, v string")
    new, counts = chg.param_batch_update(t, p, ["k"], set_columns=["v"])
    assert sorted(tuple(x) for x in new.collect()) == [(1, "y"), (2, "b")]
    assert sorted(tuple(x) for x in counts.collect()) == [(1, 1), (2, 1), (3, 0)]
    new, counts = chg.param_batch_update(t, p, ["k"], delete=True)
    assert sorted(tuple(x) for x in new.collect()) == [(2, "b")]
    assert sorted(tuple(x) for x in counts.collect()) == [(1, 1), (2, 0), (3, 0)]


def test_column_order_kept(spark):
    t = spark.createDataFrame([("a", 1)], "v string, k long")
    ch = spark.createDataFrame([(1, "U", "b", 1)], "seq long, op string, v string, k long")
    r = chg.apply_changes(t, ch, ["k"], ctx=CTX)
    assert r.base.columns == ["v", "k"]
    assert r.history.columns == ["log_date", "log_ip", "host", "type", "v", "k"]
    assert chg.delete_by_key(t, ch, ["k"]).columns == ["v", "k"]
    assert chg.audit_delete(t, ch, ["k"], CTX).columns[4:] == ["v", "k"]
    assert chg.merge_upsert(t, ch.drop("op"), ["k"], seq="seq").columns == ["v", "k"]


def _brute_force(target, changes):
    """Sequential reference: apply change rows one by one in seq order."""
    table = {k: v for k, v in target}
    history = []
    for seq, k, op, v in sorted(changes):
        exists = k in table
        if op == "I":
            assert not exists
            table[k] = v
        elif op == "M":
            if exists:
                history.append(("U", k, table[k]))
            table[k] = v
        elif op == "U" and exists:
            history.append(("U", k, table[k]))
            table[k] = v
        elif op == "D" and exists:
            history.append(("D", k, table[k]))
            del table[k]
    return sorted(table.items()), sorted(history)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_feed_with_hot_key_matches_brute_force(spark, seed):
    import random
    rnd = random.Random(seed)
    target = [(k, f"t{k}") for k in range(0, 20, 2)]
    changes, present = [], {k for k, _ in target}
    for seq in range(400):
        k = 7 if rnd.random() < 0.4 else rnd.randrange(0, 25)   # key 7 holds ~40% of changes
        ops = ["U", "D", "M"] + ([] if k in present else ["I"])
        op = rnd.choice(ops)
        if op in ("I", "M"):
            present.add(k)
        elif op == "D":
            present.discard(k)
        changes.append((seq, k, op, f"v{seq}"))
    want_base, want_hist = _brute_force(target, changes)
    t = spark.createDataFrame(target, "k long, v string")
    ch = spark.createDataFrame(changes, "seq long, k long, op string, v string").select("seq", "op", "k", "v")
    r = chg.apply_changes(t, ch, ["k"], ctx=CTX, chunk_width=16)
    assert sorted(tuple(x) for x in r.base.collect()) == want_base
    assert sorted((x.type, x.k, x.v) for x in r.history.collect()) == want_hist


@pytest.mark.parametrize("compact_every", [1, 2, 16])
def test_audit_log_matches_brute_force(spark, tmp_path, compact_every):
    """B10 append-only form across micro-batches, with compactions and a replay."""
    import random
    from tidepool.streaming.audit_log import AuditLogJob
    rnd = random.Random(5)
    changes, present = [], set()
    for seq in range(120):
        k = 3 if rnd.random() < 0.4 else rnd.randrange(0, 8)
        op = rnd.choice(["U", "D", "M"] + ([] if k in present else ["I"]))
        present.add(k) if op in ("I", "M") else present.discard(k) if op == "D" else None
        changes.append((seq, k, op, f"v{seq}"))
    want_base, want_hist = _brute_force([], changes)
    schema = "seq long, op string, k long, v string"
    feed, table_schema = tmp_path / "feed", spark.createDataFrame([], "k long, v string").schema
    job = AuditLogJob(root=str(tmp_path / "log"), keys=["k"], schema=table_schema, ctx=CTX, compact_every=compact_every)
    for b in range(3):
        part = [(s, o, k, v) for s, k, o, v in changes if b * 40 <= s < (b + 1) * 40]
        spark.createDataFrame(part, schema).write.parquet(str(feed / f"{b:03d}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(feed))
        job.start(stream, str(tmp_path / "ck")).awaitTermination()
    job.apply_batch(spark.createDataFrame(part, schema), 2)  # replayed after a failure
    assert sorted(tuple(r) for r in job.table(spark).collect()) == want_base
    assert sorted((r.type, r.k, r.v) for r in job.history(spark).collect()) == want_hist


def test_audit_log_batch_opens_its_buckets_only(spark, tmp_path):
    """What a batch of one key reads: one bucket's level and the images above it,
    whatever other batches wrote and however large the table is in other buckets."""
    from tidepool.streaming.audit_log import AuditLogJob
    initial = spark.range(3000).selectExpr("id as k", "concat('v', id) as v")
    job = AuditLogJob(root=str(tmp_path / "log"), keys=["k"], schema=initial.schema, initial=initial, ctx=CTX,
                      compact_every=3, buckets=8)

    def batch(keys, b):
        job.apply_batch(spark.createDataFrame([(10 * b, "U", k, f"b{b}") for k in keys], "seq long, op string, k long, v string"), b)

    own = spark.createDataFrame([(7,)], "k long").select(job._bucket()).first()[0]
    for b, keys in enumerate([[7], [1, 2, 3], [7, 8, 9], [4], [7], [11, 12], [13]]):
        batch(keys, b)
        level, *above = job._paths(spark, None, {own})[own]
        assert "/compact/" in level and len(above) <= job.compact_every
        read = job._images(spark, None, {own})
        assert all(f"_bucket={own}/" in f for f in read.inputFiles())
        assert read.count() < 3000 / 8 * 1.5
    # a bucket without changes keeps its first level
    levels = {k: p[0] for k, p in job._paths(spark, None, None).items()}
    assert "b=5" in levels[own] and len(levels) == 8
    rows = {r.k: r.v for r in job.table(spark).collect()}
    assert len(rows) == 3000 and rows[7] == "b4" and rows[13] == "b6" and rows[9] == "b2" and rows[100] == "v100"
    assert job.history(spark).count() == 12


def test_audit_log_values_and_late_seqs(spark, tmp_path):
    """Large longs beside NULLs, NaN, arrays, NULL keys, and a seq that comes late."""
    from tidepool.streaming.audit_log import AuditLogJob
    schema = "k long, big long, d double, a array<int>"
    initial = spark.createDataFrame([(1, 9007199254740993, float("nan"), [1]), (2, None, None, None)], schema)
    job = AuditLogJob(root=str(tmp_path / "log"), keys=["k"], schema=initial.schema, initial=initial, ctx=CTX)

    def batch(rows):
        return spark.createDataFrame(rows, "seq long, op string, " + schema)

    job.apply_batch(batch([(10, "M", 1, 9007199254740995, 1.0, [2, 3]), (11, "I", None, 5, 2.0, None)]), 0)
    job.apply_batch(batch([(5, "U", 1, 7, None, []), (6, "D", 2, None, None, None), (7, "U", None, 1, 1.0, None)]), 1)
    assert sorted((tuple(r) for r in job.table(spark).collect()), key=str) == [(1, 7, None, []), (None, 5, 2.0, None)]
    hist = sorted(((r.type, r.k, r.big, str(r.d), r.a) for r in job.history(spark).collect()), key=str)
    assert hist == [("D", 2, None, "None", None), ("U", 1, 9007199254740993, "nan", [1]),
                    ("U", 1, 9007199254740995, "1.0", [2, 3])]


def test_large_batch_on_bucketed_table_does_not_shuffle_table(spark, sf_dir):
    """Large-batch path (no broadcast): a table bucketed by key is joined
    without an exchange on its side."""
    from tidepool.sources.tables import write_bucketed
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    t = write_bucketed(orders, "orders_bucketed", ["o_orderkey"], 4)
    ch = orders.select(F.col("o_orderkey").alias("seq"), F.lit("U").alias("op"), *orders.columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = chg.apply_changes(t, ch, ["o_orderkey"], ctx=CTX, max_broadcast_rows=0)
        plan = r.base._jdf.queryExecution().executedPlan().toString()
        scan = [ln for ln in plan.splitlines() if "FileScan" in ln and "orders_bucketed" in ln]
        assert scan and all("SelectedBucketsCount: 4 out of 4" in ln for ln in scan)
        # the bucketed scan feeds its join directly: no Exchange between them
        lines = plan.splitlines()
        for i, ln in enumerate(lines):
            if "FileScan" in ln and "orders_bucketed" in ln:
                parent = "\n".join(lines[max(0, i - 3):i])
                assert "Exchange hashpartitioning" not in parent
        assert r.base.count() == orders.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_properties_on_orders_feed(spark, sf_dir):
    """SURVEY §5.3: B4 after B2 of new keys = start; base count = before +
    effective inserts - effective deletes; history rows = effective U + D."""
    from tidepool.plans.change_plans import change_feed
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    new = orders.select((-(F.col("o_orderkey") + 1)).alias("o_orderkey"),
                        *[c for c in orders.columns if c != "o_orderkey"]).select(orders.columns)
    back = chg.delete_by_key(chg.insert_rows(orders, new), new, ["o_orderkey"])
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0

    feed = change_feed(orders)
    ann = chg.annotate_changes(orders, feed, ["o_orderkey"], ctx=CTX, fill_column="o_orderpriority")
    a = ann.where(F.col("_op") != "T")
    inserts = a.where(((F.col("_op") == "I") | (F.col("_op") == "M")) & ~F.col("_exists_before")).count()
    deletes = a.where((F.col("_op") == "D") & F.col("_exists_before")).count()
    updates = a.where(F.col("_op").isin("U", "M") & F.col("_exists_before")).count()
    r = chg.apply_changes(orders, feed, ["o_orderkey"], ctx=CTX, fill_column="o_orderpriority")
    null_inserts = feed.where(F.col("o_orderkey").isNull() & F.col("op").isin("I", "M")).count()
    assert r.base.count() == orders.count() + inserts - deletes + null_inserts
    assert r.history.count() == updates + deletes


@pytest.mark.parametrize("checkpoint", [True, False])
@pytest.mark.parametrize("table,rows,message", [
    ([(1, "a"), (1, "b")], [(5, "U", 1, "x")], "duplicate keys"),
    ([(1, "a")], [(None, "U", 1, "x")], "usable seq"),
    ([(1, "a")], [(1, "U", 1, "x"), (1, "U", 1, "y"), (2, "U", 1, "z")], "same seq")])
def test_undefined_orders_raise(spark, checkpoint, table, rows, message):
    t = spark.createDataFrame(table, "k int, v string")
    ch = spark.createDataFrame(rows, "seq long, op string, k int, v string")
    with pytest.raises(Exception, match=message):
        chg.apply_changes(t, ch, ["k"], ctx=CTX, checkpoint=checkpoint).base.collect()


def test_seqs_spread_wide(spark):
    """Row-rank chunks: one hot key with seqs over 10^15, in many partitions."""
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ch = spark.range(400).selectExpr("id * 2500000000007 as seq", "'U' as op", "cast(1 as int) as k",
                                     "concat('v', id) as v")
    r = chg.apply_changes(t, ch, ["k"], ctx=CTX)
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "v399"), (2, "b")]
    assert sorted(x.v for x in r.history.collect()) == sorted(["a"] + [f"v{i}" for i in range(399)])


@pytest.mark.parametrize("chunk", [1, 1 << 20, None])
def test_worked_example_without_materialization(spark, chunk):
    r = chg.apply_changes(_target(spark), _changes(spark), ["k"], ctx=CTX, chunk_width=chunk,
                          checkpoint=False)
    assert sorted(tuple(x) for x in r.base.collect()) == [(1, "a3"), (3, "c2")]
    assert sorted((x.type, x.k, x.v) for x in r.history.collect()) == [
        ("D", 1, "a1"), ("D", 2, "b"), ("U", 1, "a"), ("U", 1, "a2"), ("U", 3, "c")]


def test_keys_with_many_changes_equal_the_rest(spark):
    """Chunked and single-window keys of one batch give what one window gives."""
    import random
    rng = random.Random(12)
    target = spark.createDataFrame([(k, f"t{k}") for k in range(0, 40, 2)], "k long, v string")
    live, rows, seq = set(range(0, 40, 2)), [], 0
    for _ in range(600):
        k = 0 if rng.random() < 0.4 else rng.randrange(40)
        op = rng.choice("UDM" if k in live else "IMU")
        seq += rng.randint(1, 10**6)
        rows.append((seq, op, k, f"v{seq}"))
        live = live | {k} if op in "IM" else live - {k} if op == "D" else live
    changes = spark.createDataFrame(rows, "seq long, op string, k long, v string")
    got = [chg.apply_changes(target, changes, ["k"], ctx=CTX, hot_changes=n) for n in (1, 25, 10_000)]
    bases, histories = [[sorted(map(tuple, f.collect())) for f in fs] for fs in zip(*[(r.base, r.history) for r in got])]
    assert bases[0] == bases[1] == bases[2] and {r[0] for r in bases[0]} == live
    assert histories[0] == histories[1] == histories[2] and len(histories[0]) > 100
