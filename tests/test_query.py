import pytest
from pyspark.sql import functions as F

from tidepool.operators import query as q


@pytest.mark.parametrize("value,expected", [
    ("F|P", ["F", "P"]), ("F|P||", ["F", "P"]), ("|", []), ("", [""]), ("a||b", ["a", "", "b"])])
def test_split_param(value, expected):
    assert q.split_param(value) == expected


def test_param_in_list(spark):
    df = spark.createDataFrame([("F",), ("P",), ("O",), ("",)], "s string")
    assert sorted(r.s for r in q.param_in_list(df, "s", "F|P||").collect()) == ["F", "P"]
    assert q.param_in_list(df, "s", "|").count() == 0
    assert [r.s for r in q.param_in_list(df, "s", "").collect()] == [""]
    assert sorted(r.s for r in q.param_in_list(df, "s", "F|O", max_inline=1).collect()) == ["F", "O"]


def test_param_query_markers(spark):
    out = q.param_query(spark, "select ':s' as lit, :s as val -- :zzz", {"s": "x"}).first()
    assert (out.lit, out.val) == (":s", "x")
    with pytest.raises(Exception):
        q.param_query(spark, "select :missing as v").collect()
    assert q.param_query(spark, "select :a as v", defaults={"a": 7}).first().v == 7
    hangul = q.param_query(spark, "select :가격 as v", {"가격": 3}).first().v
    assert hangul == 3


def test_bounded_read(spark):
    assert q.bounded_read(spark.range(100_000)).count() == 100_000
    with pytest.raises(q.RowLimitExceeded):
        q.bounded_read(spark.range(100_001))


def test_stringify_and_iterate(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b string, c double")
    assert tuple(q.stringify_rows(df).first()) == ("1", "", "")
    assert tuple(q.iterate_rows(df).first()) == ("1", None, None)
    assert list(q.local_rows(df)) == [{"a": "1", "b": None, "c": None}]
    dup = spark.createDataFrame([(1, 2)], "a int, b int").select("a", F.col("b").alias("A"))
    with pytest.raises(ValueError):
        q.stringify_rows(dup)


def test_sequence_years():
    assert q.sequence_years(1995, 2001) == list(range(1995, 2002))
    assert q.sequence_years(1999, 1999) == [1999]
    assert q.sequence_years(2001, 1995) == [2001]


def test_union_sequence_pushdown_and_single_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = q.union_sequence(orders, "o_orderdate", 1995, 2001,
                          predicate=~F.col("o_orderstatus").isin("F", "P"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "Not(In(o_orderstatus" in plan
    frames = q.union_sequence_frames(
        lambda y: orders.where(F.year("o_orderdate") == y), 2001, 1995, with_source=True)
    assert {r.shard_year for r in frames.select("shard_year").distinct().collect()} == {2001}


def test_union_sequence_sql(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = q.union_sequence_sql(spark, "SELECT {y} AS yr FROM {o} LIMIT 1".replace("{y}", "{YEAR}"),
                              r"\{YEAR\}", 1996, 1998, o=orders)
    assert sorted(r.yr for r in df.collect()) == [1996, 1997, 1998]


def test_tenants(spark):
    t = spark.createDataFrame([("A",), ("B_OLD",), ("MARKET",), (None,), ("C",)], "u string")
    lst = q.tenant_list(t, "u", exclude_suffix="OLD", exclude_names=["MARKET"])
    assert sorted(r.tenant for r in lst.collect()) == ["A", "C"]
    data = spark.createDataFrame([("A", 1), ("B_OLD", 2), ("C", 3)], "u string, x int")
    out = q.union_tenants(data, "u", lst, with_source=True)
    assert sorted((r.tenant, r.x) for r in out.collect()) == [("A", 1), ("C", 3)]
    empty = q.union_tenant_frames(lambda n: data, [], schema=data.schema, spark=spark)
    assert empty.count() == 0


def test_star_join_hangul_keys(spark):
    keys = "회사코드, 출고일자"
    a = spark.createDataFrame([(1, 2, "m")], "`회사코드` int, `출고일자` int, v string")
    b = spark.createDataFrame([(1, 2, "s")], "`회사코드` int, `출고일자` int, v string")
    c = spark.createDataFrame([(9, 9, "t")], "`회사코드` int, `출고일자` int, v string")
    out = q.star_join(a, {"A": b, "B": b, "C": c}, keys, outer=True).first()
    assert (out.v, out.B_v, out.C_v) == ("m", "s", None)
    assert q.star_join(a, {"C": c}, keys, outer=False).count() == 0


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 3)], "a int, b int")
    out = sorted((r.a, r.b, r.n_rows) for r in q.key_check(df, ["a", "b"]).collect())
    assert out == [(1, 1, 2), (2, None, 1)]


def test_missing_file_report(spark, tmp_path):
    root = tmp_path / "photos"
    (root / "ABC").mkdir(parents=True)
    (root / "ABC" / "ABC123.jpg").write_bytes(b"x")
    from tidepool.sources.tables import list_files
    listing = list_files(spark, str(root))
    keys = spark.createDataFrame([("ABC123",), ("ABC999",)], "k string")
    out = q.missing_file_report(keys, "k", listing, str(root)).collect()
    assert [r.key for r in out] == ["ABC999"]


def test_broadcast_check_bounds_rows_and_bytes(spark):
    from tidepool.operators.sizing import fits_broadcast
    df = spark.range(10).select(F.repeat(F.lit("x"), 1_000_000).alias("s"), "id")
    assert fits_broadcast(df, max_rows=100, max_bytes=20_000_000)
    assert not fits_broadcast(df, max_rows=100, max_bytes=5_000_000)
    assert not fits_broadcast(df, max_rows=5, max_bytes=20_000_000)


def test_union_sequence_paths_one_scan(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    for y in (1995, 1996, 1997):
        orders.where(F.year("o_orderdate") == y).write.parquet(str(tmp_path / f"orders_{y}"))
    tpl = str(tmp_path / "orders_{Y}")
    df = q.union_sequence_paths(spark, tpl, "{Y}", 1995, 1997, with_source=True)
    got = {r.shard_year: r.n for r in df.groupBy("shard_year").agg(F.count("*").alias("n")).collect()}
    want = {r.y: r.n for r in orders.where(F.year("o_orderdate").between(1995, 1997))
            .groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n")).collect()}
    assert got == want
    plan = df.where(F.col("o_orderstatus") == "F")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    tenants = q.read_shards(spark, str(tmp_path / "orders_{T}"), "{T}", ["1996"], source_name="t")
    assert {r.t for r in tenants.select("t").distinct().collect()} == {"1996"}


def test_jdbc_read_validates_partitioning(spark):
    """A8 without a database: a partitioned read needs bounds and a count."""
    from tidepool.sources.tables import jdbc_read
    with pytest.raises(ValueError, match="bounds"):
        jdbc_read(spark, "jdbc:none://x", "t", partition_column="id", lower_bound=0)


def test_read_shards_names_with_special_characters(spark, tmp_path):
    names = ["A.B", "A.B+1", "X(y)"]
    for i, n in enumerate(names):
        spark.createDataFrame([(i,)], "v int").write.parquet(str(tmp_path / f"t_{n}" / "data"))
    df = q.read_shards(spark, str(tmp_path / "t_{T}" / "data"), "{T}", names, source_name="tenant")
    assert sorted((r.tenant, r.v) for r in df.collect()) == [("A.B", 0), ("A.B+1", 1), ("X(y)", 2)]
