import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import changes as chg
from tidepool.operators import folding, ordering
from tidepool.operators import query as q


def test_position_is_the_sorted_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(5), i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    got = sorted(ordering.with_position(df, ["g", "k"], base=10).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(10, 410))
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [(r.g, r.k, r.v) for r in got] == want
    down = sorted(ordering.with_position(df, [F.col("g").desc_nulls_last(), "k"]).collect(), key=lambda r: r.position)
    assert [r.g for r in down] == sorted([r[0] for r in rows if r[0]], reverse=True) + [None] * sum(r[0] is None for r in rows)


def test_position_of_equal_rows_and_odd_frames(spark):
    same = spark.range(0, 3000, 1, 6).select(F.lit("x").alias("g"), F.create_map(F.lit("m"), F.lit(1)).alias("m"))
    pos = ordering.with_position(same, ["g"])
    assert sorted(r.position for r in pos.select("position").collect()) == list(range(3000))
    none = spark.createDataFrame([], "g string, `a b` int")
    out = ordering.with_position(none, ["g"])
    assert out.columns == ["g", "a b", "position"] and out.count() == 0
    with pytest.raises(ValueError):
        ordering.with_position(pos, ["g"])


def _pieces(text, n):
    return {k // n: text[k:k + n] for k in range(0, max(len(text), 1), n)}


def _byte_pieces(raw, n):
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return {0: ""}
    out, at = {}, 0
    for ch in text:
        out[at // n] = out.get(at // n, "") + ch
        at += len(ch.encode())
    return out or {0: ""}


def test_fold_in_pieces(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for key in [None, "a", "b", "empty", "one"]:
        chunks = {"empty": ["", "", None], "one": ["x"]}.get(
            key, ["".join(rng.choice("aé字😀 ") for _ in range(rng.randrange(30))) for _ in range(60)] + [None, ""])
        rows += [(key, i, c) for i, c in enumerate(chunks)]
        want[key] = "".join(c or "" for c in chunks)
    rows.append(("nothing", 0, None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq long, chunk string")
    got = {}
    for r in folding.ordered_fold_pieces(df, ["k"], "seq", "chunk", piece=16).collect():
        got.setdefault(r.k, {})[r.piece] = r.content
    assert got == {k: _pieces(t, 16) for k, t in want.items()}
    assert folding.ordered_fold_pieces(df.limit(0), ["k"], "seq", "chunk").count() == 0


def test_bytes_in_pieces_and_validity_of_the_whole_key(spark):
    rng = random.Random(9)
    texts = {"a": "é字😀x" * 40, "b": "plain words only", "end": "abc😀", None: "字" * 33, "empty": ""}
    raw = {k: t.encode() for k, t in texts.items()}
    raw |= {"broken": ("字" * 20).encode() + b"\xff" + b"later", "cut": "字".encode()[:2] + b"a" * 30,
            "tails": b"a" * 8 + b"\x80" * 12, "head": b"\x80abc", "half": b"abcdefg" + "😀".encode()[:3]}
    rows = []
    for k, b in raw.items():
        at = i = 0
        while at < len(b) or i == 0:  # chunks cut characters anywhere
            n = rng.randrange(1, 6)
            rows.append((k, i, bytearray(b[at:at + n])))
            at, i = at + n, i + 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq long, chunk binary")
    for size in (4, 8, 64):
        got = {}
        for r in folding.ordered_fold_pieces(df, ["k"], "seq", "chunk", piece=size, binary=True).collect():
            got.setdefault(r.k, {})[r.piece] = r.content
        assert got == {k: _byte_pieces(b, size) for k, b in raw.items()}, size


def test_one_key_is_spread_over_tasks(spark):
    one = spark.range(0, 40_000, 1, 4).select(F.lit("k").alias("k"), F.col("id").alias("seq"), F.lit("ab").alias("chunk"))
    offs = folding.chunk_offsets(one.withColumnRenamed("chunk", "_chunk"), ["k"], "seq", F.length("_chunk"))
    assert offs.where(F.col("_start") != 2 * F.col("seq")).count() == 0
    out = folding.ordered_fold_pieces(one, ["k"], "seq", "chunk", piece=1000)
    r = out.agg(F.count(F.lit(1)), F.max(F.length("content")), F.sum(F.length("content"))).first()
    assert tuple(r) == (80, 1000, 80_000)
    parts = offs.select(F.shiftright("_row", 33).alias("p")).groupBy("p").count().collect()
    assert len(parts) == 4 and max(p["count"] for p in parts) < 20_000


def test_parameter_rows_and_clock(spark, tmp_path):
    df = q.param_rows(spark, "a int, b string, c timestamp_ntz", [{"a": 1, "b": "it's :x"}, {"c": None, "a": None}])
    assert [tuple(r) for r in df.collect()] == [(1, "it's :x", None), (None, None, None)]
    assert q.param_rows(spark, "a int", []).count() == 0
    with pytest.raises(ValueError):
        q.param_rows(spark, "a int", [{"z": 1}])
    ctx = chg.AuditContext(log_ip="1.2.3.4").pinned(spark)
    assert ctx.log_ts is not None and ctx.pinned(spark) == ctx
    one = spark.range(3).select(ctx.ts_col().alias("t"))
    assert one.union(spark.range(2).select(ctx.ts_col())).distinct().count() == 1


def test_history_takes_only_its_own_schema(spark, tmp_path):
    base = spark.createDataFrame([(1, "x")], "id int, v string")
    empty = chg.history_schema(base)
    path = str(tmp_path / "h")
    empty.write.parquet(path)
    back = spark.read.schema(empty.schema).parquet(path)
    assert back.count() == 0 and back.schema.simpleString() == empty.schema.simpleString()
    ctx = chg.AuditContext(log_ts="2026-01-01 00:00:00")
    rows = base.select(F.lit("D").alias("type"), "id", "v", ctx.ts_col().alias("log_date"),
                       ctx.ip_col().alias("log_ip"), ctx.host_col().alias("host"))
    chg.append_history(rows, path, empty.schema)
    r = spark.read.schema(empty.schema).parquet(path).collect()
    assert len(r) == 1 and (r[0].type, r[0].id, r[0].v, r[0].log_ip) == ("D", 1, "x", "@")
    with pytest.raises(ValueError):
        chg.append_history(rows.drop("v"), path, empty.schema)
    with pytest.raises(ValueError):
        chg.append_history(rows.withColumn("id", F.col("id").cast("string")), path, empty.schema)
