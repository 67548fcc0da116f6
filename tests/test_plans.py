"""Plan-shape tests: the physical plans keep the properties the design relies on."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from starloom.functions.clean import strip_quotes
from starloom.operators.detail import KeyMap, resolve_keys
from starloom.operators.ids import dense_ids
from starloom.operators.lookups import build_lookup
from starloom.operators.newest import latest_per_key
from starloom.plans.catalog import permission_documents, permission_rows, q_rollup_fact, table

SF = "/root/testdata/sf0.01"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_does_not_expand_and_prunes_scans(spark):
    text = formatted(q_rollup_fact(spark, SF))
    assert "Expand" not in text                      # no 8x distinct-aggregate expansion
    assert "Generate" not in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(s.startswith("l_orderkey:bigint,l_partkey:bigint") and s.count(":") == 2
               for s in schemas)                     # lineitem: 2 of 11 columns
    assert all("o_custkey" not in s for s in schemas)


def test_lookup_join_is_broadcast(spark):
    orders = table(spark, SF, "orders")
    lk = build_lookup(orders, "o_orderpriority", "id", "d")
    out = resolve_keys(orders, [KeyMap("o_orderpriority", lk, "d", "id")])
    p = formatted(out)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    p = formatted(latest_per_key(table(spark, SF, "events"), "user_id", ["ts", "event_id"],
                                 ["event_type", "value"]))
    assert "Window" not in p and "Aggregate" in p


def test_distributed_ids_have_no_single_partition_data_exchange(spark):
    df = table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber")
    ided = dense_ids(df, ["l_orderkey", "l_linenumber"])
    text = formatted(ided)
    assert "SinglePartition" not in text
    # rows are read from the checkpointed range layout, not re-shuffled
    assert "Scan ExistingRDD" in text and "RangePartitioning" not in text
    assert ided.count() == df.count()
    assert ided.agg(F.countDistinct("id")).first()[0] == df.count()


def test_no_registered_query_plans_a_cross_product(spark):
    import importlib.util
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("entry", os.path.join(root, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    for name, query in mod.queries().items():
        text = formatted(query(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_permission_documents_are_dealt_before_they_are_collected(spark, scratch):
    """A document's rows meet by one shuffle of plain rows; no lists are made in the map tasks."""
    spark.createDataFrame([(1, 10, 1), (1, 10, 1), (1, 11, 4), (2, 12, 2), (None, 11, 7), (None, 10, 5), (3, None, 1)],
                          "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{scratch}/lineitem.parquet")
    spark.createDataFrame([(10, "p", "x"), (11, None, "y"), (12, "q", None)],
                          "p_partkey long, p_name string, p_type string").write.parquet(f"{scratch}/part.parquet")
    plan = permission_documents(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("hashpartitioning(l_orderkey")  # printed from the top
    rows = [tuple(r) for r in permission_rows(spark, scratch).select("appId", "permission", "type").collect()]
    assert sorted(rows, key=repr) == sorted([("app.1", "p", "x"), ("app.1", "p", "x"), ("app.1", None, "y"), ("app.2", "q", None),
                                             (None, None, "y"), (None, "p", "x")], key=repr)


def test_stripping_quotes_walks_only_texts_that_have_some_at_an_end(spark):
    texts = [None, "", "a", '"', '""', '"a"', 'a"', '"a', 'a"b', '"a""b"', '""a""', ' "a" ', 'é"']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip_quotes("t").alias("s"))
    assert [r["s"] for r in df.collect()] == [t if t is None else t.strip('"') for t in texts]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert re.search(r"CASE WHEN \(?startswith.*endswith.*THEN btrim", plan, re.I), plan
