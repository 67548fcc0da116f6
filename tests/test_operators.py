"""Unit tests: operators on small hand-made frames, one trap at a time."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.bridge import append_bridge, build_bridge
from starloom.operators.detail import KeyMap, changed_rows, resolve_keys, upsert_detail
from starloom.operators.dimensions import (build_child_dimension, extend_child_dimension,
                                           upsert_dimension)
from starloom.operators import joins
from starloom.operators.facts import rollup_fact, star_rows
from starloom.operators.ids import dense_ids, global_rank
from starloom.operators.joins import broadcast_if_small, known_bytes, measured_bytes
from starloom.operators.lookups import build_lookup, build_lookups, extend_lookup
from starloom.operators.newest import latest_per_key
from starloom.operators.quality import (assert_checks, check_not_empty, check_unique,
                                        profile_table, run_checks)


@pytest.mark.parametrize("parts", [5, None])
def test_dense_ids_equal_row_number(spark, parts):
    rnd = random.Random(7)
    keys = rnd.sample(range(10_000_000), 5000)
    df = spark.createDataFrame([(k, f"v{k % 13}") for k in keys], "k long, v string") \
        .repartition(7)
    got = dense_ids(df, ["v", "k"], "id", num_partitions=parts)
    expected = sorted(((f"v{k % 13}", k) for k in keys))
    rows = sorted(((r.v, r.k), r.id) for r in got.collect())
    assert [r[1] for r in rows] == list(range(1, 5001))
    assert [r[0] for r in rows] == expected


@pytest.mark.parametrize("parts", [3, None])
def test_dense_ids_start_nulls_first_and_desc(spark, parts):
    df = spark.createDataFrame([(None,), (3,), (1,), (2,)], "k int")
    asc = {r.k: r.id for r in dense_ids(df, ["k"], start=10, num_partitions=parts).collect()}
    assert asc == {None: 10, 1: 11, 2: 12, 3: 13}
    desc = {r.k: r.id for r in dense_ids(df, [F.col("k").desc()],
                                          num_partitions=parts).collect()}
    assert desc == {3: 1, 2: 2, 1: 3, None: 4}


@pytest.mark.parametrize("parts", [4, None])
def test_global_rank_ties(spark, parts):
    df = spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", None), ("e", 1)],
                               "g string, x int")
    got = {r.g: r.rnk for r in global_rank(df, "x", tiebreak=["g"],
                                           num_partitions=parts).collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "e": 4, "d": 5}


def test_build_lookup_blank_rules(spark):
    df = spark.createDataFrame([("Tools",), ("  ",), ("",), (None,), ("Art",), ("Tools",)],
                               "c string")
    lk = {r.d: r.id for r in build_lookup(df, "c", "id", "d").collect()}
    assert lk == {"Art": 1, "Tools": 2}
    keep_ws = {r.d for r in build_lookup(df, "c", "id", "d", keep="nonempty").collect()}
    assert keep_ws == {"Art", "Tools", "  "}


def test_extend_lookup_keeps_ids_and_is_idempotent(spark):
    first = spark.createDataFrame([("b",), ("d",)], "c string")
    lk = build_lookup(first, "c", "id", "d")
    more = spark.createDataFrame([("a",), ("d",), ("c",)], "c string")
    once = extend_lookup(lk, more, "c", "id", "d")
    got = {r.d: r.id for r in once.collect()}
    assert got == {"b": 1, "d": 2, "a": 3, "c": 4}
    twice = extend_lookup(once, more, "c", "id", "d")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    empty = spark.createDataFrame([], "id int, d string")
    assert {r.d: r.id for r in extend_lookup(empty, more, "c", "id", "d").collect()} == \
        {"a": 1, "c": 2, "d": 3}


def test_latest_per_key_null_dates_and_ties(spark):
    rows = [("x", "2021-01-01", "w1"), ("x", None, "w0"), ("x", "2021-03-01", "w2"),
            ("y", None, "a"), ("y", None, "b"), ("z", "2020-01-01", "p"),
            ("z", "2020-01-01", "q")]
    df = spark.createDataFrame(rows, "k string, d string, w string") \
        .withColumn("d", F.to_date("d"))
    got = {r.k: r.w for r in latest_per_key(df, "k", ["d"], ["w"]).collect()}
    # newest date wins, NULL dates lose, ties go to the largest attribute
    assert got == {"x": "w2", "y": "b", "z": "q"}


def test_upsert_dimension_scd1(spark):
    existing = spark.createDataFrame(
        [(1, "a", "old", "e1"), (2, "b", None, "e2"), (3, "c", "keep", "e3")],
        "id int, k string, site string, mail string")
    src = spark.createDataFrame(
        [("a", "new", "e1", "2021-02-01"), ("a", "older", "e1", "2021-01-01"),
         ("b", "now-set", "e2", "2021-01-01"), ("d", "fresh", "e4", "2021-01-01"),
         ("", "blank", "e5", "2021-01-01")],
        "k string, site string, mail string, d string").withColumn("d", F.to_date("d"))
    out = upsert_dimension(existing, src, "k", ["site", "mail"], ["d"], "id")
    got = {r.k: (r.id, r.site) for r in out.collect()}
    assert got == {"a": (1, "new"), "b": (2, "now-set"), "c": (3, "keep"), "d": (4, "fresh")}
    again = upsert_dimension(out, src, "k", ["site", "mail"], ["d"], "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_resolve_keys_unknown_member(spark):
    dim = spark.createDataFrame([(1, "USD"), (2, "EUR")], "id int, d string")
    df = spark.createDataFrame([("USD",), ("GBP",), (None,), ("EUR",)], "cur string")
    for size in (0, 10_000):  # shuffle join and broadcast join
        out = resolve_keys(df, [KeyMap("cur", dim, "d", "id", out="cur_id")], broadcast_bytes=size)
        assert sorted((r.cur or "", r.cur_id) for r in out.collect()) == \
            [("", -1), ("EUR", 2), ("GBP", -1), ("USD", 1)]


def test_child_dimension_and_bridge_by_pair(spark):
    types = spark.createDataFrame([(1, "Contacts"), (2, "Personal")], "tid int, t string")
    perms = spark.createDataFrame(
        [("app1", "read", "Contacts"), ("app1", "read", "Personal"), ("app2", "net", "Other"),
         ("app2", "read", "Contacts")], "app string, p string, t string")
    dim = build_child_dimension(perms, "p", "t", types, "t", "tid", "pid")
    got = sorted(map(tuple, dim.collect()))
    assert got == [(1, "net", -1), (2, "read", 1), (3, "read", 2)]
    typed = resolve_keys(perms, [KeyMap("t", types, "t", "tid", out="tid")])
    pair = build_bridge(typed, "app", [("p", "p"), ("tid", "tid")], dim, "pid")
    assert sorted(map(tuple, pair.collect())) == [("app1", 2), ("app1", 3), ("app2", 1),
                                                   ("app2", 2)]
    by_desc = build_bridge(perms, "app", [("p", "p")], dim, "pid")
    # matching the text alone fans a two-type permission out to both ids
    assert by_desc.where(F.col("app") == "app2").count() == 3
    more = spark.createDataFrame([("app3", "cam", "Camera"), ("app3", "read", "Contacts")],
                                 "app string, p string, t string")
    ext = extend_child_dimension(dim, more, "p", "t", types, "t", "tid", "pid")
    assert sorted(map(tuple, ext.collect())) == got + [(4, "cam", -1)]


def test_append_bridge(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "app string, pid int")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "pid int, app string")
    assert append_bridge(a, b).count() == 4
    assert append_bridge(a, b, dedupe=True).count() == 3


def test_upsert_detail_and_changes(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)],
                                "k int, s string, v double")
    new = spark.createDataFrame([(2, "b", 2.0), (3, "c", 3.0), (4, "d", 4.0)],
                                "k int, s string, v double")
    got = sorted(map(tuple, upsert_detail(old, new, "k").collect()))
    assert got == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, "d", 4.0)]
    ch = sorted(r.k for r in changed_rows(old, new, "k").collect())
    assert ch == [2, 4]  # NULL -> 2.0 is a change; unchanged 3 is not


def test_rollup_fact_equals_one_shot_sql(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(3000):
        rows.append((rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]),
                     rnd.choice([f"app{i}" for i in range(40)] + [None]),
                     rnd.choice([10, 11, 12, 13, None]),
                     rnd.choice([None, 1, 2, 3, 4]),
                     rnd.choice(["Y", "N", None])))
    df = spark.createDataFrame(rows, "k1 string, k2 int, app string, perm int, v int, flag string")
    df.createOrReplaceTempView("fact_rows")
    expected = spark.sql("""
        select k1, k2, count(distinct perm) n_children, count(distinct app) n_items,
               sum(v) total, sum(v) / count(distinct app) ratio,
               count(distinct case when flag = 'Y' then app end) n_y,
               count(distinct case when flag = 'N' then app end) n_n
        from fact_rows group by k1, k2""")
    got = rollup_fact(df, [("k1", F.col("k1")), ("k2", F.col("k2"))], "app", "perm",
                      sums=[("total", F.col("v"))],
                      flags=[("n_y", F.col("flag") == "Y"), ("n_n", F.col("flag") == "N")],
                      ratios=[("ratio", "total")])

    def norm(d):
        return sorted((tuple(r[c] for c in sorted(d.columns)) for r in d.collect()), key=repr)
    assert norm(got) == norm(expected.select(*got.columns))


def test_large_stars_are_dealt_by_their_number_of_rows(spark, monkeypatch, capsys):
    detail = spark.createDataFrame([(i % 50 if i % 9 else None, "ab"[i % 2], float(i)) for i in range(60)], "i long, g string, v double")
    bridge = spark.createDataFrame([(j % 50, j % 7 if j % 11 else None) for j in range(400)], "i long, c long")
    child = spark.createDataFrame([(c % 6, "xyz"[c % 3]) for c in range(8)], "c long, t string")

    def fact(limit):
        rows = star_rows(detail, bridge, child, "i", "c", broadcast_bytes=limit)
        return rollup_fact(rows, [("g", F.col("g")), ("t", F.col("t"))], "i", "c", sums=[("v", F.col("v"))],
                           flags=[("f", F.col("v") > 20)], ratios=[("m", "v")])

    few = {limit: sorted(fact(limit).collect()) for limit in (0, 1 << 20)}
    monkeypatch.setattr(joins, "TASK_ROWS", 10)  # as many rows a task at most: 40 tasks
    for limit, want in few.items():
        many = fact(limit)
        many.explain()
        plan = capsys.readouterr().out
        assert "hashpartitioning(i#" in plan and ", 40), REPARTITION_BY_NUM" in plan
        assert sorted(many.collect()) == want


def test_rollup_fact_once_per_item(spark):
    df = spark.createDataFrame([("g", "a1", 1, 10.0), ("g", "a1", 2, 10.0), ("g", "a2", 1, 4.0)],
                               "g string, app string, perm int, rating double")
    fan = rollup_fact(df, [("g", F.col("g"))], "app", "perm", sums=[("r", F.col("rating"))],
                      ratios=[("avg", "r")]).first()
    once = rollup_fact(df, [("g", F.col("g"))], "app", "perm", sums=[("r", F.col("rating"))],
                       ratios=[("avg", "r")], once_per_item=True).first()
    assert (fan.r, fan.avg, fan.n_children) == (24.0, 12.0, 2)
    assert (once.r, once.avg, once.n_children, once.n_items) == (14.0, 7.0, 2, 2)


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    row = check_unique(df, "k").first()
    assert (row.row_count, row.dup_flg) == (4, 0)  # NULL keys repeat
    empty = spark.createDataFrame([], "k string")
    res = {r.check: r.passed for r in run_checks({
        "dups": check_unique(df, "k"), "empty": check_not_empty(empty),
        "ok": check_unique(df.where("k is not null"), "k")}).collect()}
    assert res == {"dups": False, "empty": False, "ok": True}
    with pytest.raises(AssertionError):
        assert_checks({"empty": check_not_empty(empty)})


def test_profile_table(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "s string, n int")
    got = {r.col: (r.n, r.nulls, r.distincts, r.min_value, r.max_value)
           for r in profile_table(df, with_range=True).collect()}
    assert got == {"s": (3, 1, 1, "a", "a"), "n": (3, 1, 2, "1", "3")}


def test_profile_table_holds_one_column_a_task(spark, capsys):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", None, -0.0), (None, 3, float("nan"))], "s string, n int, d double")
    out = profile_table(df, with_range=True)
    out.explain()
    plan = capsys.readouterr().out
    assert "Expand" not in plan and not any("SortAggregate(key=[" in line and "key=[]" not in line for line in plan.splitlines())
    assert {r.col: (r.n, r.nulls, r.distincts) for r in out.collect()} == {"s": (3, 1, 1), "n": (3, 1, 2), "d": (3, 0, 2)}


def test_join_helpers(spark):
    a = spark.createDataFrame([(None, 1), ("x" * 100, 2)], "k string, a int")
    assert measured_bytes(a) == 2 * 32 + 100
    assert broadcast_if_small(a, 163) is a
    assert broadcast_if_small(a, 164) is not a
    ids = dense_ids(a, ["k"])  # measured when it was built
    assert known_bytes(ids) == 2 * 32 + 100 + 2 * 16


def test_global_rank_of_one_value_over_many_partitions(spark):
    """A value that fills several range partitions keeps one rank."""
    df = spark.range(3000).select(F.col("id").alias("g"), F.when(F.col("id") < 2500, 7).otherwise(F.col("id") % 5).alias("x"))
    got = {(r.x, r.rnk) for r in global_rank(df, "x", tiebreak=["g"], num_partitions=6).collect()}
    assert got == {(7, 1), (4, 2501), (3, 2601), (2, 2701), (1, 2801), (0, 2901)}


def test_ids_plan_no_single_partition_exchange(spark):
    """No row of the data goes through a single partition."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        global_rank(spark.range(100), "id").explain("formatted")
    assert "SinglePartition" not in buf.getvalue()


def test_once_per_item_takes_one_version(spark):
    """Items a (v = 10 and 20, flag on one version) and b (v = 5): two items."""
    df = spark.createDataFrame([("g", "a", 1, 10.0, "Y"), ("g", "a", 2, 20.0, "N"), ("g", "b", 1, 5.0, "N"),
                                ("g", None, 1, 100.0, "Y")], "g string, app string, perm int, v double, f string")
    for child in ("perm", None):
        got = rollup_fact(df, [("g", F.col("g"))], "app", child, sums=[("t", F.col("v"))],
                          flags=[("n_y", F.col("f") == "Y")], ratios=[("avg", "t")], once_per_item=True).first()
        assert (got.n_items, got.t, got.n_y, got.avg) == (2, 25.0, 1, 12.5)


def test_child_dimension_has_one_row_per_resolved_parent(spark):
    types = spark.createDataFrame([(1, "Photos")], "tid int, t string")
    rows = spark.createDataFrame([("a", "camera", None), ("b", "camera", ""), ("c", "camera", "Photos"), ("d", "camera", "?")],
                                 "app string, p string, t string")
    dim = build_child_dimension(rows, "p", "t", types, "t", "tid", "id")
    assert sorted(map(tuple, dim.collect())) == [(1, "camera", -1), (2, "camera", 1)]
    more = spark.createDataFrame([("a", "mic", None), ("b", "mic", ""), ("b", "camera", "  ")], "app string, p string, t string")
    grown = extend_child_dimension(dim, more, "p", "t", types, "t", "tid", "id")
    assert sorted(map(tuple, grown.collect())) == [(1, "camera", -1), (2, "camera", 1), (3, "mic", -1)]
    renumbered = extend_child_dimension(dim, more, "p", "t", types, "t", "tid", "id", keep_existing=False)
    assert sorted(map(tuple, renumbered.collect())) == [(3, "camera", -1), (4, "mic", -1)]


def test_upsert_detail_is_keyed_and_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (None, "m"), (2, "x")], "k int, v string")
    once = upsert_detail(old, new, "k")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted([(1, "c"), (2, "x"), (None, "m")], key=repr)
    again = upsert_detail(once, new, "k")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    assert changed_rows(once, new.where("v <> 'b'"), "k").count() == 0


def test_measure_by_child(spark):
    from starloom.operators.ranks import measure_by_child

    detail = spark.createDataFrame([("a", 4.0), ("b", 2.0), ("c", None)], "app string, r double")
    bridge = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("a", 1)], "app string, pid int")
    child = spark.createDataFrame([(1, "x", 9), (2, "y", 9)], "pid int, p string, tid int")
    by = lambda cols: sorted(map(tuple, measure_by_child(detail, bridge, child, "app", "pid", F.col("r"), cols).collect()))
    assert by(["p"]) == [("x", 3, 3.0), ("y", 1, 4.0)]
    assert by(["tid"]) == [(9, 3, 3.0)]


def test_build_lookups_one_pass_equals_separate_builds(spark):
    df = spark.createDataFrame([("Tools", "USD", 3), ("Art", " ", 3), (None, "EUR", None),
                                ("Tools", "", 1)], "cat string, cur string, n int")
    many = build_lookups(df, [("cat", "cid", "cd"), ("cur", "uid", "ud"), ("n", "nid", "nd")])
    for src, id_col, desc in [("cat", "cid", "cd"), ("cur", "uid", "ud")]:
        one = sorted(map(tuple, build_lookup(df, src, id_col, desc).collect()))
        assert sorted(map(tuple, many[src].collect())) == one
    assert sorted(map(tuple, many["n"].collect())) == [(1, "1"), (2, "3")]


def test_profile_table_approx(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"),
                                     (F.col("id") % 1000).alias("b"))
    exact = {r.col: r.distincts for r in profile_table(df).collect()}
    approx = {r.col: r.distincts for r in profile_table(df, approx=True).collect()}
    assert exact == {"a": 97, "b": 1000}
    assert all(abs(approx[c] - exact[c]) <= 0.05 * exact[c] for c in exact)


def test_measure_by_child_deals_its_pairs_once(spark, capsys):
    from starloom.operators.ranks import measure_by_child

    detail = spark.createDataFrame([(1, 2.0), (2, 4.0), (2, 6.0), (3, None), (None, 9.0)], "i long, r double")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (1, 1), (2, 1), (3, 1), (4, 1), (None, 1), (2, None), (2, 9)], "i long, c long")
    child = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (None, "z"), (9, None)], "c long, t string")
    out = measure_by_child(detail, bridge, child, "i", "c", F.col("r"), ["t"])
    out.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(c#" not in plan  # the bridge isn't dealt by its few children
    assert plan.count("Exchange hashpartitioning(i#") == 2  # the pairs once, and the detail
    assert sorted(out.collect(), key=str) == sorted([("x", 4, 4.0), (None, 2, 5.0)], key=str)


def test_latest_per_key_holds_each_column_once(spark, capsys):
    df = spark.createDataFrame([(1, 5, "a", None), (1, 5, "b", 1), (1, None, "z", 9), (2, None, None, 3), (2, None, "c", None)],
                               "k int, o int, s string, n int")
    out = latest_per_key(df, "k", ["o"], ["s", "o", "n"])
    out.explain("extended")
    analyzed = capsys.readouterr().out.split("== Analyzed Logical Plan ==")[1].split("== Optimized")[0]
    struct = analyzed.split("max(struct(")[1].split(")")[0]
    assert struct.count("#") == 3  # o, s and n; they stood there as order, tiebreak and payload
    assert sorted(out.collect()) == [(1, "b", 5, 1), (2, "c", None, None)]
    assert latest_per_key(df, "k", "o", ["n"], tiebreak=["s"]).where("k = 1").collect() == [(1, 1)]


def test_upsert_of_rows_known_to_be_one_a_key_does_not_group_them_again(spark):
    from starloom.operators.detail import upsert_detail

    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, s string")
    new = spark.createDataFrame([(2, "x"), (None, None), (3, "y")], "k long, s string")
    got = upsert_detail(old, new, "k", one_per_key=True)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, upsert_detail(old, new, "k").collect()), key=repr)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
