import pytest
from pyspark.sql import functions as F

from tallywright.operators import bi, joins, keys
from tallywright.operators.bloom import bloom_filter, may_hold
from tallywright.operators.keystats import KeyStats, combine_sketches, read_sketches, sketch_keys, write_sketches
from tallywright.operators.register import by_status
from tallywright.operators.bi import OTHER_PRIORITY, STATUS_PRIORITY


def test_first_per_key(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), ("b", 2, "only"), (None, 0, "no key")]
    df = spark.createDataFrame(rows, "k string, src_row long, v string").repartition(3, "src_row")
    got = keys.first_per_key(df, "k", ["src_row"])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, "first"), ("b", 2, "only")]
    plan = got.select("k")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Exchange")[1].count("WindowGroupLimit") == 1  # pruned before the shuffle, too


def test_highest_priority_wins_and_ties_go_to_the_last_row(spark):
    rows = [
        ("t", "MATCHED", 1),
        ("t", "MISSING_BANK_SETTLEMENT", 2),
        ("t", "AMOUNT_MISMATCH", 3),
        ("u", "DUPLICATE", 1),
        ("u", "DUPLICATE", 2),
        (None, "UNEXPECTED_PAYMENT", 1),
        (None, "UNEXPECTED_PAYMENT", 2),
    ]
    df = spark.createDataFrame(rows, "k string, reconciliation_status string, src_row long")
    got = keys.last_by_priority(df, "k", by_status(STATUS_PRIORITY, OTHER_PRIORITY), ["src_row"])
    assert {(r.k, r.src_row) for r in got.collect()} == {("t", 2), ("u", 2), (None, 2)}


def test_repeated_ids_include_repeated_nulls(spark, low_bar):
    ids = ["a"] * 50 + [None] * 40 + ["b", "c", "c"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "k string, src_row long")
    got = keys.flag_repeated(df, "k", ["src_row"]).collect()
    assert len(got) == len(ids)
    assert {(r.k, r.is_repeated) for r in got} == {
        ("a", True), (None, True), ("b", False), ("c", True)
    }


def test_assert_unique(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert keys.assert_unique(df, ["k"]) is df
    with pytest.raises(ValueError, match="not unique"):
        keys.assert_unique(df, ["v"])


@pytest.mark.parametrize("shuffle", [1, 7])
def test_running_number_over_many_buckets(spark, partitions, shuffle):
    partitions(shuffle)
    rows = [(b, r * r) for b in (1, 0) for r in range(300)]
    df = spark.createDataFrame(rows, "src_branch int, src_row long").repartition(5)
    got = keys.running_number(df, "src_branch", "src_row", "n", width=1000).collect()
    want = {row: i for i, row in enumerate(sorted(rows), 1)}
    assert {(r.src_branch, r.src_row): r.n for r in got} == want


def heavy_set(df, key):
    return set(joins.heavy_keys(df, key))


def test_heavy_keys_are_found(spark, low_bar):
    ids = ["hot"] * 1000 + [None] * 500 + [str(i) for i in range(1500)]
    df = spark.createDataFrame([(k,) for k in ids], "k string")
    assert heavy_set(df, "k") == {"hot"}


def test_a_key_of_a_three_hundredth_is_heavy_where_partitions_are_many(spark, low_bar, partitions):
    df = spark.range(60_000).selectExpr("IF(id % 300 = 0, -1, id) AS k")
    partitions(200)
    assert heavy_set(df, "k") == {-1}
    partitions(8)  # a few partitions would not notice it
    assert heavy_set(df, "k") == set()


def test_no_heavy_keys_in_a_small_table(spark):
    assert heavy_set(spark.createDataFrame([("a",)] * 100, "k string"), "k") == set()
    assert heavy_set(spark.createDataFrame([], "k string"), "k") == set()


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_look_up_gives_what_a_plain_join_gives(spark, low_bar, how):
    ids = ["hot"] * 400 + ["warm"] * 100 + [None] * 300 + [str(i % 150) for i in range(300)]
    ids += ["\0null"] * 3  # a text like any other
    left = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "k string, src_row long")
    names = ["hot", *map(str, range(0, 150, 2)), "unused", "\0null"]
    right = spark.createDataFrame([(k, f"v{k}") for k in names], "_key string, v string")
    got = joins.look_up(left, "k", [right], ["src_row"], how=how)
    want = left.join(right, left.k == right["_key"], how).drop("_key")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_null_key_finds_the_right_row_without_key(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, src_row long")
    right = spark.createDataFrame([(None, "none"), ("a", "A")], "_key string, v string")
    got = joins.look_up(left, "k", [right], ["src_row"], keyless=(0,))
    assert {tuple(r) for r in got.collect()} == {(None, 1, "none"), ("a", 2, "A"), ("b", 3, None)}


def test_a_heavy_key_is_dealt_over_many_keys(spark, low_bar, partitions):
    partitions(8)
    left = spark.range(4000).selectExpr("'hot' AS k", "id AS src_row")
    dealt = joins.deal(left, "k", joins.heavy_keys(left, "k"), ["src_row"])
    assert dealt.select("_key").distinct().count() > 3900
    assert dealt.where("_dealt").count() == 4000


def test_only_right_rows_of_heavy_keys_are_broadcast(spark, low_bar):
    left = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(str(i), i) for i in range(600)], "k string, n long"
    )
    right = spark.createDataFrame([("hot",), ("1",), ("2",)], "_key string")
    got = joins.look_up(left, "k", [right.withColumn("v", F.lit(1))], ["n"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and "(_key#" in plan and "= hot)" in plan
    easy = joins.look_up(left.where("k <> 'hot'"), "k", [right.withColumn("v", F.lit(1))], ["n"])
    assert "strategy=broadcast" not in easy._jdf.queryExecution().optimizedPlan().toString()


def test_one_exchange_for_each_side(spark):
    """A right side of one row per key is not shuffled again; nor is the left for a second right."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(1000).selectExpr("id % 700 AS k", "id AS src_row")
        right = spark.range(900).selectExpr("id % 500 AS k", "id AS src_row", "id AS v")
        first = keys.first_per_key(right, "k", ["src_row"]).selectExpr("k AS _key", "v")
        twice = keys.repeated_keys(left, "k").select("_key", "copies")
        got = joins.look_up(left, "k", [first, twice], ["src_row"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        # by key: left, first rows and copies
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "merger" not in x]
        joined = [x for x in plan.splitlines() if "SortMergeJoin" in x]
        assert len(joined) == 2
        assert len(shuffles) == 3
        assert sum("_key" in x for x in shuffles) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sketches_of_parts_are_stored_and_merged(spark, tmp_path):
    whole = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS a", "IF(id % 2 = 0, NULL, id % 5) AS b", "id"
    )
    parts = [whole.where("id < 2000"), whole.where("id >= 2000"), whole.limit(0)]
    for i, part in enumerate(parts):
        write_sketches(part, ["a", "b"], str(tmp_path / str(i)))
    paths = [str(tmp_path / str(i)) for i in range(3)]
    merged = read_sketches(spark, paths, whole, ["a", "b"])
    at_once = KeyStats.of(sketch_keys(whole, ["a", "b"]), ["a", "b"])
    assert merged.rows == at_once.rows == {"a": 9000, "b": 4500}
    assert merged.top["a"][0] == ("hot", 3000)
    assert sorted(merged.top["b"]) == sorted(at_once.top["b"]) == [(k, 900) for k in range(5)]
    assert merged.above("a", 100, 8) == ["hot"] and merged.above("b", 901, 100) == []
    assert merged.above("b", 1, 4) == []
    nothing = read_sketches(spark, paths[2:], whole, ["a", "b"])
    assert nothing.rows == {"a": 0, "b": 0} and nothing.above("a", 1, 1) == []
    assert combine_sketches(spark.read.parquet(*paths), ["a"]).count() == 1


def test_look_up_with_statistics_needs_no_pass(spark, low_bar):
    left = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(str(i), i) for i in range(600)], "k string, n long"
    )
    right = spark.createDataFrame([("hot", 1), ("1", 2)], "_key string, v int")
    stats = KeyStats.of(sketch_keys(left, ["k"]), ["k"])
    assert joins.heavy_keys(left, "k", stats) == joins.heavy_keys(left, "k") == ["hot"]
    got = joins.look_up(left, "k", [right], ["n"], stats=stats)
    want = left.join(right, left.k == right["_key"], "left").drop("_key")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # statistics only choose the way: wrong ones change nothing
    wrong = KeyStats({"k": 900}, {"k": [("1", 900)]})
    other = joins.look_up(left, "k", [right], ["n"], stats=wrong)
    assert sorted(map(str, other.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("places", [1 << 15, 1 << 27])
def test_a_bloom_filter_loses_no_key(spark, places):
    held = spark.range(0, 3000, 3).selectExpr("CAST(id AS STRING) AS k").union(
        spark.sql("SELECT CAST(NULL AS STRING)")
    )
    rows = spark.range(30_000).selectExpr("CAST(id AS STRING) AS k", "id").union(
        spark.sql("SELECT CAST(NULL AS STRING), -1")
    )
    passed = {r.k for r in may_hold(rows, "k", bloom_filter(held, "k", places), places).collect()}
    keys_held = {str(i) for i in range(0, 3000, 3)}
    assert keys_held <= passed and None not in passed
    assert len(passed - keys_held) < (10 if places > 1 << 20 else 2500)
    empty = may_hold(rows, "k", bloom_filter(held.limit(0), "k", places), places)
    assert empty.count() == 0


def test_bloom_filter_sizes(spark):
    for places in (0, 1000, 1 << 32):
        with pytest.raises(ValueError):
            bloom_filter(spark.range(1), "id", places)


def test_one_per_key_fails_in_the_job(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, "z")], "k string, v int, w string")
    assert sorted(map(str, keys.one_per_key(df, "k").collect())) == sorted(map(str, df.collect()))
    assert keys.one_per_key(df.select("k"), "k").columns == ["k"]
    for again in (df.where("k = 'a'"), df.where("k IS NULL")):
        twice = keys.one_per_key(df.union(again), "k")  # nothing runs yet
        with pytest.raises(Exception, match="k is not unique"):
            twice.collect()


def exception_tables(spark, ids):
    """A register of two ids, and reconciliation and anomaly rows of ``ids``."""
    register = spark.createDataFrame([("E1", "t1"), ("E2", "t2"), ("E3", None)], "exception_id string, transaction_id string")
    for c in bi.FROM_REGISTER[2:]:
        register = register.withColumn(c, F.lit(None).cast("string"))
    rows = spark.createDataFrame(ids, "transaction_id string, src_branch int, src_row long")
    recon = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in bi.FROM_RECONCILIATION])
    recon = recon.withColumn("store_id", F.col("src_row").cast("string"))
    flags = rows.select("*", *[F.lit(None).cast("boolean").alias(c) for c in bi.ANOMALY_COLUMNS])
    return register, recon, flags


def test_a_doubled_right_side_fails_the_exception_table(spark):
    register, recon, flags = exception_tables(spark, [("t1", 0, 5), ("t1", 0, 2), ("t9", 0, 1), (None, 0, 3)])
    # repeated rows of an id are expected: the first one counts
    got = {r.exception_id: r.store_id for r in bi.exception_table(register, recon, flags).collect()}
    assert got == {"E1": "2", "E2": None, "E3": None}
    with pytest.raises(Exception, match="not unique: t1"):
        bi.join_exceptions(register, recon, flags.limit(0)).collect()
    with pytest.raises(Exception, match="not unique: t1"):
        bi.join_exceptions(register, recon.limit(0), flags).collect()


def test_rows_that_fail_the_filter_are_not_shuffled(spark, partitions):
    """A third of the rows on one id, and nearly all others not in the register."""
    partitions(16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(k, v)
    try:
        register, recon, flags = exception_tables(spark, [("t1", 0, 0)])
        many = spark.range(0, 60_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 't1', concat('u', id)) AS transaction_id", "0 AS src_branch", "id AS src_row"
        )
        recon = many.join(recon.drop(*many.columns).limit(1), how="cross").select(*recon.columns)
        first = bi.exception_table(register, recon, flags)
        plan = first._jdf.queryExecution().executedPlan().toString()
        # the filter is tested, and ids are ranked, below the exchange of the rows
        ranked = plan.split("Exchange hashpartitioning(transaction_id")[1]
        assert ranked.index("WindowGroupLimit") < ranked.index("BroadcastHashJoin")
        bits = bloom_filter(register, "transaction_id")
        near = keys.first_per_key(may_hold(recon, "transaction_id", bits), "transaction_id", ["src_row"])
        assert [r.transaction_id for r in near.collect()] == ["t1"]
        # of the hot id, one row for each task is shuffled
        passed = may_hold(recon, "transaction_id", bits).groupBy(F.spark_partition_id()).count()
        assert passed.agg(F.max("count") / F.min("count")).first()[0] < 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
