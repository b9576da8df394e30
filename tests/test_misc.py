import pytest
from pyspark.sql import functions as F

from tidepool.functions import jsonx
from tidepool.functions import text as TX
from tidepool.operators import scoring as SC


def test_json_read_write(spark):
    df = spark.createDataFrame([(1, '{"k": 69}'), (2, "{'k': 70}"), (3, "{oops"), (4, ""), (5, None)],
                               "id int, js string")
    lenient = jsonx.json_map_read("js", "string", "int", mode="PERMISSIVE")["k"]
    assert [r[0] for r in df.orderBy("id").select(lenient).collect()] == [69, 70, None, None, None]
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select(jsonx.json_map_read("js", "string", "int")).collect()
    lst = spark.createDataFrame([("['a','b']",)], "js string").select(jsonx.json_list_read("js")).first()[0]
    assert lst == ["a", "b"]
    m = spark.range(1).select(jsonx.json_map_write(F.create_map(F.lit("k"), F.lit(None).cast("int"))))
    assert m.first()[0] == '{"k":null}'
    assert spark.range(1).select(jsonx.json_list_write(F.array(F.lit(1), F.lit(2)))).first()[0] == "[1,2]"


def test_text_functions(spark):
    df = spark.createDataFrame([("a, b ,c", "x.tar.gz")], "s string, p string")
    r = df.select(TX.split_trim("s", ","), TX.strip_extension("p"), TX.extension("p"),
                  TX.split_drop_trailing(F.lit("F|P||")), TX.split_drop_trailing(F.lit("|")),
                  TX.zip_shorter(F.array(F.lit(1), F.lit(2)), F.array(F.lit("a"))),
                  TX.list_minus(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit("b")))).first()
    assert r[0] == ["a", "b", "c"] and r[1] == "x.tar" and r[2] == ".gz"
    assert r[3] == ["F", "P"] and r[4] == []
    assert [tuple(x) for x in r[5]] == [(1, "a")]
    assert r[6] == ["a"]


def test_scoring(spark):
    plays = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (2, 0, 1), (2, 0, 2), (3, 2, 0)],
                                  "round long, p1 int, p2 int")
    scored = SC.outcome_score(plays)
    assert sorted((r.round, r.score) for r in scored.collect()) == [(1, 0), (1, 0), (2, -1), (2, 1), (3, 1)]
    sh = {r.round: (r.first_share, r.second_share, r.draw_share) for r in SC.round_shares(scored).collect()}
    assert sh[1] == (0.0, 0.0, 1.0) and sh[2] == (0.5, 0.5, 0.0) and sh[3] == (0.0, 1.0, 0.0)
    w = SC.round_winners(SC.round_shares(scored)).first()
    assert (w.first_wins, w.second_wins, w.rounds) == (0, 1, 3)


def test_stream_equals_batch(spark, sf_dir):
    """B10 final state = B9 on all changes at once."""
    from tidepool.operators.changes import apply_changes
    from tidepool.plans import misc_plans as mp
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    job = mp._run_audit_stream(spark, sf_dir)
    streamed = sorted(tuple(r) for r in job.table(spark).collect())
    feed = events.select(F.col("event_id").alias("seq"), F.lit("M").alias("op"), *events.columns)
    batch = apply_changes(spark.createDataFrame([], events.schema), feed, ["user_id"])
    assert streamed == sorted(tuple(r) for r in batch.base.collect())
    assert job.history(spark).count() == batch.history.count()


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 80


def test_json_unknown_shape_as_variant(spark):
    df = spark.createDataFrame([('{"k": [1, "x", null]}',), ("{'k': 69}",)], "js string")
    v = df.select(jsonx.json_list_read("js", None).alias("v"))
    got = [r[0] for r in v.select(F.to_json("v")).collect()]
    assert got == ['{"k":[1,"x",null]}', '{"k":69}']
    kinds = [r[0] for r in v.select(F.schema_of_variant(F.variant_get("v", "$.k", "variant"))).collect()]
    assert kinds[0].startswith("ARRAY") and kinds[1].startswith("BIGINT")


def test_stream_cleans_intermediates_and_retains_versions(spark, tmp_path):
    import os
    from tidepool.operators.changes import AuditContext
    from tidepool.session import checkpoint_dir
    from tidepool.streaming.audit_stream import AuditStreamJob, complete_versions
    schema = "seq long, op string, k long, v string"
    feed = tmp_path / "feed"
    for b in range(3):
        spark.createDataFrame([(b * 10 + i, "M", i, f"b{b}") for i in range(3)], schema) \
            .coalesce(1).write.parquet(str(feed / f"{b:03d}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(feed)))
    table_schema = spark.createDataFrame([], "k long, v string").schema
    ck = checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(ck)) if os.path.isdir(ck) else set()
    job = AuditStreamJob(table_root=str(tmp_path / "t"), history_root=str(tmp_path / "h"),
                         keys=["k"], schema=table_schema, ctx=AuditContext("2026-01-01 00:00:00"),
                         retain_versions=1)  # raised to the safe minimum of 2
    q = job.start(stream, str(tmp_path / "ck"))
    q.awaitTermination()
    assert sorted(tuple(r) for r in job.table(spark).collect()) == [(0, "b2"), (1, "b2"), (2, "b2")]
    assert job.history(spark).count() == 6
    assert complete_versions(spark, str(tmp_path / "t")) == [1, 2]
    after = set(os.listdir(ck)) if os.path.isdir(ck) else set()
    assert not [p for p in after - before if p.startswith("changes-")]


def test_versioned_sink_replay_is_idempotent(spark, tmp_path):
    from tidepool.operators.changes import AuditContext
    from tidepool.streaming.audit_stream import AuditStreamJob
    table_schema = spark.createDataFrame([], "k long, v string").schema
    job = AuditStreamJob(table_root=str(tmp_path / "t"), history_root=str(tmp_path / "h"),
                         keys=["k"], schema=table_schema, ctx=AuditContext("2026-01-01 00:00:00"))
    b0 = spark.createDataFrame([(1, "M", 1, "a"), (2, "M", 2, "b")], "seq long, op string, k long, v string")
    b1 = spark.createDataFrame([(3, "U", 1, "a2"), (4, "D", 2, None)], "seq long, op string, k long, v string")
    job.apply_batch(b0, 0)
    job.apply_batch(b1, 1)
    first = (sorted(tuple(r) for r in job.table(spark).collect()),
             sorted(tuple(r) for r in job.history(spark).collect()))
    job.apply_batch(b1, 1)          # replay after a failure
    second = (sorted(tuple(r) for r in job.table(spark).collect()),
              sorted(tuple(r) for r in job.history(spark).collect()))
    assert first == second
    assert first[0] == [(1, "a2")]
    assert [(h[3], h[4], h[5]) for h in first[1]] == [("D", 2, "b"), ("U", 1, "a")]


def test_cli_list_and_run(spark, tmp_path, sf_dir):
    from tidepool.__main__ import main
    assert main(["run", "key_check", "--sf", sf_dir, "--out", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() > 0
    assert main(["run", "nope", "--sf", sf_dir, "--out", str(tmp_path / "x")]) == 2
