"""Nesting, unnesting, first-by, reshaping, look-ups."""

from pyspark.sql import functions as F

from procura.operators.nesting import first_by, nest, to_json_text, unnest
from procura.operators.reshape import concat_distinct, decode, fallback_lookup, melt, with_headings


def test_first_by_keeps_null_value_of_first_row(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (2, None, "x"), (2, 5, "y")], "k int, o int, v string")
    got = dict(df.groupBy("k").agg(first_by("v", ["o"]).alias("f")).collect())
    assert got == {1: None, 2: "y"}  # null order values sort last


def test_nest_orders_and_counts(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, None, "z"), (2, None, None)],
                               "k int, o int, v string")
    out = {r.k: r for r in nest(df, "k", ["o", "v"], ["o"], "arr", count_of="o", count_out="n").collect()}
    assert [(e.o, e.v) for e in out[1].arr] == [(1, "a"), (2, "b"), (None, "z")]
    assert out[1].n == 2
    # a parent without children (all-null row from a left join): one all-null element, count 0
    assert [(e.o, e.v) for e in out[2].arr] == [(None, None)] and out[2].n == 0


def test_unnest_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, a array<int>")
    s = spark.createDataFrame([(1, [(1, "x")]), (2, [])], "k int, a array<struct<p:int,q:string>>")
    assert sorted(r.k for r in df.select("k", F.explode("a")).collect()) == [1, 1]
    assert [(r.k, r.p, r.q) for r in unnest(s, "a").collect()] == [(1, 1, "x")]


def test_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([([(1, None)],)], "a array<struct<p:int,q:string>>")
    assert df.select(to_json_text("a")).first()[0] == '[{"p":1,"q":null}]'


def test_melt(spark):
    df = spark.createDataFrame([("f1", 1, 2)], "id string, a int, b int")
    got = sorted(tuple(r) for r in melt(df, ["id"], ["a", "b"], "var", "val").collect())
    assert got == [("f1", "a", 1), ("f1", "b", 2)]


def test_headings_union_resolves_mixed_types(spark):
    d = spark.createDataFrame([(1, 7)], "inv int, x int")
    h = spark.createDataFrame([(1, "01/02/2003")], "inv int, x string")
    out = with_headings(d, h, types={"x": "string"})
    assert dict(out.dtypes)["x"] == "string"
    assert sorted(r.x for r in out.collect()) == ["01/02/2003", "7"]


def test_concat_distinct_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None)], "k int, v string")
    assert df.groupBy("k").agg(concat_distinct("v").alias("s")).first().s == "a, b"


def test_fallback_lookup_and_decode(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    p = spark.createDataFrame([("x", "P1")], "k string, v string")
    s = spark.createDataFrame([("x", "S1"), ("y", "S2")], "k string, v string")
    got = dict((r.c, r.o) for r in fallback_lookup(df, F.col("c"), p, s, "o").collect())
    assert got == {"x": "P1", "y": "S2", "z": None}
    codes = spark.createDataFrame([("x", "Ex")], "code string, name string")
    assert dict((r.c, r.n) for r in decode(df, "c", codes, "n").collect()) == {"x": "Ex", "y": None, "z": None}


def test_nest_can_put_nulls_first(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (1, 1)], "k int, o int")
    assert [e.o for e in nest(df, "k", ["o"], ["o"], "a", nulls_first=True).first().a] == [None, 1, 2]


def test_row_number_chunked_matches_window(spark):
    import random

    from pyspark.sql.window import Window

    from procura.operators.sizing import row_number_chunked
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 0, 1, 2]), rnd.choice([None, *range(20)]), rnd.randint(0, 1000), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, a int, b int, u int")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("a", "b", "u")))
    want = sorted(map(repr, ref.select("g", "a", "b", "u", "rn").collect()))
    for levels in ([F.col("a")], [F.col("a"), F.floor(F.col("b") / 100)], [F.col("a"), F.col("b"), F.col("u")]):
        got = row_number_chunked(df, ["g"], ["a", "b", "u"], levels, "rn")
        assert sorted(map(repr, got.select("g", "a", "b", "u", "rn").collect())) == want


def test_offsets_of_one_dense_group_are_shared_out(spark):
    """One group whose rows each have a chunk of their own: the offsets are
    prefix sums per coarse chunk, so no window holds the group's chunks."""
    from procura.operators.sizing import row_number_chunked
    df = spark.range(0, 20_000, 1, 8).selectExpr("id div 100000 as g", "id div 200 as a", "id")
    out = row_number_chunked(df, ["g"], ["a", "id"], [F.col("a"), F.col("id")], "rn", zero_based=True)
    assert out.filter("rn <> id").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "_rn_0" in plan
    # the fine level's window is partitioned by (group, coarse chunk), not by the group alone
    windows = [line for line in plan.split("\n") if "Window" in line and "_rn_1" in line]
    assert windows and all("_rn_0" in w.split("windowspecdefinition(")[1].split(" ASC")[0] for w in windows)


def test_nest_sorts_a_huge_parent_chunk_by_chunk(spark):
    """A parent with a third of all rows: no group that is sorted is larger
    than a chunk of positions, and the result is that of one sort."""
    import random
    from collections import defaultdict

    from procura.operators.nesting import NEST_CHUNK, in_runs, nest_parts
    r = random.Random(5)
    rows = [(1, k, f"v{k}") for k in range(30_000)] + [(k % 4000 + 2, r.randrange(3), f"w{k}") for k in range(60_000)]
    rows += [(1, None, f"n{k}") for k in range(5)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(6)
    parts = nest_parts(df, ["k"], ["o", "v"], ["o", "v"], [in_runs("o")])
    sizes = [x[0] for x in parts.filter("k = 1").select(F.size("_part")).collect()]
    assert max(sizes) <= NEST_CHUNK and sum(sizes) == 30_005 and len(sizes) == 30_000 // NEST_CHUNK + 2
    got = {x.k: [(e.o, e.v) for e in x.arr] for x in nest(df, "k", ["o", "v"], ["o", "v"], "arr").collect()}
    want = defaultdict(list)
    for k, o, v in rows:
        want[k].append((o, v))
    assert got == {k: sorted(v, key=lambda e: (e[0] is None, e[0] or 0, e[1])) for k, v in want.items()}


def test_nest_by_several_chunk_levels_with_aggregates(spark):
    rows = [(1, "b", 9000, 3), (1, "a", 10, 4), (1, None, 1, 5), (1, "a", 9000, None), (1, "a", None, 6), (2, None, None, None)]
    df = spark.createDataFrame(rows, "k int, t string, p int, x int")
    d = nest(df, "k", ["t", "p"], ["t", "p"], "a", count_of="x", count_out="n", chunks=[F.col("t"), F.floor(F.col("p") / 4096)],
             aggs={"s": (F.sum("x"), F.sum("s")), "most": (F.max("x"), F.max("most"))})
    got = {r.k: r for r in d.collect()}
    assert [tuple(e) for e in got[1].a] == [("a", 10), ("a", 9000), ("a", None), ("b", 9000), (None, 1)]
    assert (got[1].n, got[1].s, got[1].most) == (4, 18, 6) and (got[2].n, got[2].s) == (0, None)
    first = nest(df, "k", ["t", "p"], ["t", "p"], "a", nulls_first=True, chunks=[F.col("t")]).filter("k = 1").first().a
    assert [tuple(e) for e in first] == [(None, 1), ("a", None), ("a", 10), ("a", 9000), ("b", 9000)]


def test_ordinary_groups_are_numbered_with_one_shuffle_of_the_rows(spark):
    from procura.operators.sizing import row_number_chunked
    df = spark.range(0, 3000, 1, 4).selectExpr("nullif(id % 7, 6) as g", "nullif(id % 11, 10) as a", "id as b", "id * 2 as payload")
    out = row_number_chunked(df, ["g"], ["a", "b"], [F.col("a")], "rn")
    assert out.count() == 3000
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # one of the rows, one of the groups' sizes
    assert final.count("Exchange hashpartitioning") <= 2, final


def test_large_and_ordinary_groups_are_numbered_alike(spark):
    from pyspark.sql.window import Window

    from procura.operators.sizing import row_number_chunked
    # groups of 1000, 100, 10 rows and one null group of 40
    df = spark.range(0, 1150, 1, 4).selectExpr(
        "case when id < 1000 then 0 when id < 1100 then 1 when id < 1110 then 2 end as g", "nullif(id % 13, 12) as a", "id as b")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("a", "b"))).collect()
    for whole in (0, 10, 39, 500, 1000):
        got = row_number_chunked(df, ["g"], ["a", "b"], [F.col("a")], "rn", whole=whole)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want)), whole
