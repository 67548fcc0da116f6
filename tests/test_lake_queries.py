"""What the lake queries' SQL does not show: which buckets are written, which ids stay, which plans shuffle."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators.dimensions import build_dimension, classify
from starloom.operators.newest import latest_per_key
from starloom.operators.refresh import refresh_fact
from starloom.plans import lake_queries
from starloom.sources.lake import bucket_folders, bucket_of, read_table, replace_buckets
from starloom.sources.versions import current_number
from starloom.sources.warehouse import create_database, create_table, overwrite_table

SF = "/root/testdata/sf0.001"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def simple(df) -> str:
    return formatted(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("fact"))
    paths = [f"{root}/{n}" for n in ("fact", "orders", "items", "parts")]
    spec = lake_queries.order_fact()
    lake_queries.deliver_orders(spark, SF, root, second=False)
    assert refresh_fact(spark, *paths, spec, buckets=256).whole
    first, folders = read_table(spark, paths[0]).collect(), bucket_folders(spark, paths[0])
    lake_queries.deliver_orders(spark, SF, root, second=True)
    done = refresh_fact(spark, *paths, spec, buckets=256)
    return {"root": root, "paths": paths, "spec": spec, "first": first, "folders": folders, "done": done}


def keyed(rows, spec):
    return {tuple(r[k] for k in spec.key_names): r for r in rows}


def test_increment_keeps_ids_and_untouched_groups(spark, fact):
    spec, done = fact["spec"], fact["done"]
    before, after = keyed(fact["first"], spec), keyed(read_table(spark, fact["paths"][0]).collect(), spec)
    assert not done.whole
    touched = {tuple(r) for r in done.touched.collect()}
    assert 0 < len(touched & set(before)) < len(before)        # a part of the groups only
    for key in set(before) - touched:
        assert after[key] == before[key]                       # the others: same id, same values
    ids = {key: r["fact_id"] for key, r in after.items()}
    assert len(set(ids.values())) == len(ids)
    assert all(ids[key] == before[key]["fact_id"] for key in set(before) & set(after))
    new = sorted(ids[key] for key in set(after) - set(before))
    last = max(r["fact_id"] for r in fact["first"])
    assert new == list(range(last + 1, last + 1 + len(new)))
    assert any(key[0] == "0-MOVED" for key in after)


def test_increment_writes_only_the_buckets_of_touched_groups(spark, fact):
    now = bucket_folders(spark, fact["paths"][0])
    changed = {b for b in now.keys() | fact["folders"].keys() if now.get(b) != fact["folders"].get(b)}
    names = fact["spec"].key_names
    of_touched = {r[0] for r in fact["done"].touched.select(bucket_of(names, 256)).collect()}
    assert changed <= set(fact["done"].buckets) == of_touched and len(of_touched) < 256


def test_increment_equals_a_full_build(spark, fact):
    spec, paths = fact["spec"], fact["paths"]
    full = refresh_fact(spark, f"{fact['root']}/again", *paths[1:], spec)
    assert full.whole
    cols = [c for c in read_table(spark, paths[0]).columns if c not in ("fact_id", "_bucket")]
    a, b = (sorted(map(tuple, read_table(spark, p).select(cols).collect()), key=repr) for p in (paths[0], f"{fact['root']}/again"))
    assert a == b and a


def test_refresh_without_changes_writes_nothing(spark, fact):
    number = current_number(spark, fact["paths"][0])
    done = refresh_fact(spark, *fact["paths"], fact["spec"], buckets=256)
    assert not done.whole and done.buckets == [] and current_number(spark, fact["paths"][0]) == number


def test_lost_input_versions_lead_to_a_full_build_that_keeps_ids(spark, fact):
    spec, paths = fact["spec"], fact["paths"]
    ids = {k: r["fact_id"] for k, r in keyed(read_table(spark, paths[0]).collect(), spec).items()}
    rows = read_table(spark, paths[0])
    replace_buckets(spark, paths[0], rows.where("_bucket = -1"), [], current_number(spark, paths[0]),
                    {"detail": "99", "bridge": "99", "child": "99"})
    done = refresh_fact(spark, *paths, spec, buckets=256)
    assert done.whole
    assert {k: r["fact_id"] for k, r in keyed(read_table(spark, paths[0]).collect(), spec).items()} == ids


def test_groups_without_rows_go(spark, tmp_path):
    """An item that moves leaves its only group, which goes; null keys are groups."""
    from starloom.operators.refresh import FactSpec
    from starloom.sources.lake import publish_table
    spec = FactSpec(detail_keys=[("k", F.col("d"))], child_keys=[("t", F.col("c"))], item="i", child="p",
                    detail_columns=("d", "v"), child_columns=("c",), sums=[("s", F.col("v"))], id_col="id")
    paths = [str(tmp_path / n) for n in ("f", "i", "b", "c")]
    item = lambda *rows: spark.createDataFrame(rows, "i int, d string, v int")
    publish_table(item((1, "a", 10), (2, "b", 5), (3, None, 7)), paths[1])
    publish_table(spark.createDataFrame([(1, 1), (2, 1), (3, 1), (3, 2), (9, 1)], "i int, p int"), paths[2])
    publish_table(spark.createDataFrame([(1, "x"), (2, None)], "p int, c string"), paths[3])
    refresh_fact(spark, *paths, spec, buckets=4)
    key = lambda r: repr(r)
    read = lambda: sorted((tuple(r[c] for c in ("k", "t", "s", "n_items", "n_children"))
                           for r in read_table(spark, paths[0]).collect()), key=key)
    assert read() == sorted([("a", "x", 10, 1, 1), ("b", "x", 5, 1, 1), (None, "x", 7, 1, 1), (None, None, 7, 1, 1)], key=key)
    publish_table(item((1, "b", 10), (2, "b", 5), (3, None, 8)), paths[1])
    done = refresh_fact(spark, *paths, spec, buckets=4)
    assert not done.whole
    assert read() == sorted([("b", "x", 15, 2, 1), (None, "x", 8, 1, 1), (None, None, 8, 1, 1)], key=key)


def test_many_rows_are_dealt_before_versions_are_compared(spark, tmp_path, monkeypatch):
    """Rows that hardly repeat aren't held by the map tasks; rows more often in one version are changes."""
    from starloom.operators import joins
    from starloom.sources.lake import changed_between, publish_table
    monkeypatch.setattr(joins, "TASK_ROWS", 4)
    path, rows = str(tmp_path / "t"), [(i, i % 3) for i in range(40)] + [(None, None)] * 2
    for now in (rows, [r for r in rows if r[0] != 7] + [(5, 2), (50, 1), (None, None)]):
        publish_table(spark.createDataFrame(now, "i int, p int"), path)
    found = changed_between(spark, path, 1, 2, ["i", "p"])
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, [(7, 1), (5, 2), (50, 1), (None, None)]))
    assert re.search(r"REPARTITION_BY_NUM", formatted(found))


def test_fact_groups_by_numbers_of_its_keys(spark):
    """The star carries a number for the detail's and one for the child's keys; the fact is the one of the keys
    themselves, for all groups and for some, with null keys and rows that come twice."""
    from starloom.operators.refresh import FactSpec
    spec = FactSpec(detail_keys=[("k", F.col("d")), ("m", F.col("v") % 2)], child_keys=[("t", F.col("c"))], item="i", child="p",
                    detail_columns=("d", "v"), child_columns=("c",), sums=[("s", F.col("v"))], flags=[("f", F.col("v") > 4)],
                    ratios=[("a", "s")], order=("k", "m", "t"))
    detail = spark.createDataFrame([(i % 30, None if i % 5 == 0 else f"d{i % 4}", i % 7 or None) for i in range(40)], "i int, d string, v int")
    bridge = spark.createDataFrame([(i % 32, i % 9) for i in range(200)] + [(None, 1), (1, None)], "i int, p int")
    child = spark.createDataFrame([(p, None if p == 3 else f"c{p % 3}") for p in (1, 2, 3, 4, 5, 5, 6)], "p int, c string")
    got = lambda df: sorted(map(repr, map(tuple, df.collect())))
    whole = spec.rollup(spec.rows(detail, bridge, child))
    fact = spec.fact(detail, bridge, child)
    assert fact.columns == whole.columns and fact.dtypes == whole.dtypes
    assert got(fact) == got(whole)
    assert re.search(r"hashpartitioning\(_sl_nd#\d+L, _sl_nc#\d+L", formatted(fact))
    touched = whole.select("k", "m", "t").where("k is null or t is null or k = 'd1'").checkpoint()
    some = whole.where("k is null or t is null or k = 'd1'")
    assert 0 < some.count() < whole.count()
    assert got(spec.fact(detail, bridge, child, touched, 200)) == got(some)


def test_bucketed_tables_join_without_a_shuffle(spark):
    orders, items = lake_queries.bucketed_star(spark, SF, buckets=4)
    text = simple(orders.join(items, orders.o_orderkey == items.l_orderkey))
    assert "Join" in text and "Exchange" not in text
    assert len(items.inputFiles()) == 4                         # one task wrote a bucket
    # the whole fact: only the branches' aggregates shuffle, not the join
    text = formatted(lake_queries.q_bucketed_fact(spark, SF))
    assert not re.search(r"Exchange\n.*\n.*hashpartitioning\(o_orderkey", text)


def test_upsert_meets_its_sides_once(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    attrs, newest = ["o_orderstatus"], ["o_orderdate", "o_orderkey"]
    old = build_dimension(orders.where("o_orderkey % 2 = 0"), "o_custkey", attrs, newest, "id")
    latest = latest_per_key(orders, "o_custkey", newest, attrs)
    text = simple(classify(old, latest, "o_custkey", attrs, "id"))
    # (the other join is the broadcast of the ids' offsets, inside the existing side)
    assert text.count("FullOuter") == 1 and text.count("SortMergeJoin") == 1 and len(re.findall(r"- Exchange ", text)) == 2


def test_classes_with_nulls(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, None, "z")], "id int, k string, v string")
    new = spark.createDataFrame([("a", None), ("b", None), ("d", "n")], "k string, v string")
    got = sorted(((r.id, r.k, r.v, r["class"]) for r in classify(old, new, "k", ["v"], "id").collect()), key=repr)
    assert got == sorted([(1, "a", None, "same"), (2, "b", None, "changed"), (3, "c", "y", "gone"), (4, None, "z", "gone"),
                          (None, "d", "n", "new")], key=repr)


def test_declared_tables(spark, tmp_path):
    db = create_database(spark, "starloom_test_decl", str(tmp_path / "db"))
    create_database(spark, db)
    schema = spark.createDataFrame([], "Id int, Day date").schema
    create_table(spark, f"{db}.t", schema)
    create_table(spark, f"{db}.t", schema)
    with pytest.raises(ValueError, match="other columns"):
        create_table(spark, f"{db}.t", spark.createDataFrame([], "Id string").schema)
    df = spark.createDataFrame([("1", "2020-01-05"), ("x", "2020-13-05"), (None, None)], "id string, day string")
    assert overwrite_table(df, f"{db}.t") == {"_rows": 3, "Id": 1, "Day": 1}
    assert overwrite_table(df.limit(1), f"{db}.t") == {"_rows": 1, "Id": 0, "Day": 0}
    assert [tuple(map(str, r)) for r in spark.table(f"{db}.t").collect()] == [("1", "2020-01-05")]
    with pytest.raises(ValueError, match="no column"):
        overwrite_table(df.drop("day"), f"{db}.t")


def test_merged_sketches_stay_within_their_error(spark):
    from starloom.operators.profiles import merge_profiles, profile_part, read_profile
    df = spark.range(60000).select(F.col("id").alias("a"), (F.col("id") % 700).alias("b"), F.lit(None).cast("int").alias("c"),
                                   F.sha2(F.col("id").cast("string"), 256).alias("d"))
    parts = [profile_part(df.where(f"a % 5 = {k}")) for k in range(5)] + [profile_part(df.limit(0))]
    one = parts[0]
    for p in parts[1:]:
        one = one.unionByName(p)
    got = {r.col: r for r in read_profile(merge_profiles(one)).collect()}
    assert [got[c].n for c in "abcd"] == [60000] * 4 and got["c"].nulls == 60000
    for c, n in (("a", 60000), ("b", 700), ("d", 60000)):
        assert abs(got[c].distincts - n) <= 0.05 * n              # three standard errors
    assert got["c"].distincts == 0 and got["c"].quantiles is None and got["d"].quantiles is None
    for q, value in zip((0.25, 0.5, 0.75), got["a"].quantiles):
        assert abs(value - q * 60000) <= 0.02 * 60000
    assert (got["a"].min_number, got["a"].max_number) == (0, 59999) and got["d"].min_number is None


@pytest.mark.parametrize("indent", [1, 4])
@pytest.mark.parametrize("block", [150, 4000])
def test_array_files_split_anywhere(spark, tmp_path, indent, block):
    import json
    import random

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from starloom.sources.json_array import read_array_documents
    rng = random.Random(block + indent)
    texts = ['x', '{"a": [', ']}', '\\"', '\n  {', '"', 'é' * 30, 'z' * 900]
    docs = [{"n": i, "t": rng.choice(texts), "in": [{"n": -1, "t": rng.choice(texts)} for _ in range(rng.randint(0, 3))]} for i in range(120)]
    for name, some in (("a", docs[:80]), ("b", docs[80:]), ("c", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=False))
    # elements that are cut off, and an open string: only they are rejects
    broken = json.dumps([{"n": i, "t": "ok"} for i in range(1000, 1005)], indent=indent).split("\n")
    del broken[3]                                                   # the second line's value and the first end
    broken[6] = broken[6][:-1]
    (tmp_path / "d.json").write_text("\n".join(broken))
    schema = StructType([StructField("n", LongType()), StructField("t", StringType())])
    for conf, value in (("spark.sql.files.maxPartitionBytes", str(block)), ("spark.sql.files.openCostInBytes", "0")):
        spark.conf.set(conf, value)
    try:
        rows = read_array_documents(spark, str(tmp_path), schema).collect()
    finally:
        for conf in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(conf)
    good = sorted((r.n, r.t) for r in rows if r["_corrupt_record"] is None)
    assert [g for g in good if g[0] < 1000] == [(d["n"], d["t"]) for d in docs]
    assert sum(n >= 1000 for n, _ in good) + sum(r["_corrupt_record"] is not None for r in rows) == 5
    assert sum(n >= 1000 for n, _ in good) == 3


def test_array_files_of_compact_elements(spark, tmp_path):
    from pyspark.sql.types import LongType, StructField, StructType

    from starloom.sources.json_array import read_array_documents
    (tmp_path / "e.json").write_text('[{"n": 1},\n{"n": 2, "x": [{"n": 5}]},\n{"n": 3]\n, {"n": 9}]')
    rows = read_array_documents(spark, str(tmp_path), StructType([StructField("n", LongType())])).collect()
    assert sorted(r.n for r in rows if r["_corrupt_record"] is None) == [1, 2]
    assert [r["_corrupt_record"][:7] for r in rows if r["_corrupt_record"]] == ['{"n": 3']
