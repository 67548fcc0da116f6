"""Registered queries over the driver tables.

Each query exercises one library operator on the generated TPC-H-like tables
(whole tables, no sampling) with a role mapping taken from the app-store
model: category = order priority, app = order, bridge = lineitem,
permission = part, permission type = part type. ``oracle_sql()`` in
``__spark_entry__`` holds the DuckDB statement that must give the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bridge import append_bridge, build_bridge
from ..operators.detail import KeyMap, resolve_keys, upsert_detail
from ..operators.dimensions import (build_child_dimension, build_dimension,
                                    extend_child_dimension, upsert_dimension)
from ..operators.facts import rollup_fact, star_rows
from ..operators.ids import dense_ids
from ..operators.joins import TASK_ROWS
from ..operators.lookups import build_lookup, extend_lookup
from ..operators.newest import latest_per_key
from ..operators.quality import check_not_empty, check_unique, profile_table, run_checks
from ..operators.ranks import measure_by_child_count, rank_by, register_views
from ..functions.clean import (clean_date, clean_double, clean_flag, clean_int_parity,
                               clean_long, clean_size, clean_timestamp)
from ..session import checkpoint_dir, free_finished
from ..sources.documents import PERMISSION_SCHEMA, explode_documents, read_permission_feed
from ..sources.lake import read_table
from ..sources.text import APP_COLUMNS, APP_HEADER_PREFIX, parse_quoted_lines, quote_field
from ..sources.versions import delete
from .app_store import (NAMES, Model, Options, build_model, category_rank, developer_rank, model_fact, rating_by_permission,
                        rating_by_permission_count, rating_by_permission_type, run_all)


Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_rows(spark: SparkSession, sf_dir: str, priority_keys: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    if priority_keys:
        # two independent lookups: their jobs are submitted side by side
        with ThreadPoolExecutor(max_workers=2) as pool:
            prio_job = pool.submit(build_lookup, orders, "o_orderpriority", "priority_id",
                                   "priority_desc")
            types_job = pool.submit(build_lookup, part, "p_type", "type_id", "type_desc")
            prio, types = prio_job.result(), types_job.result()
        orders = resolve_keys(orders, [KeyMap("o_orderpriority", prio, "priority_desc", "priority_id")])
        part = resolve_keys(part, [KeyMap("p_type", types, "type_desc", "type_id")])
    return star_rows(orders, lineitem, part, "o_orderkey", "p_partkey",
                     bridge_item_key="l_orderkey", bridge_child_key="l_partkey")


def _price() -> F.Column:
    # decimal sums are exact in both engines; doubles differ in the last bits
    return F.col("o_totalprice").cast("decimal(18,2)")


def _date_keys() -> list[tuple[str, F.Column]]:
    return [("k2", F.year("o_orderdate").cast("int")), ("k3", F.month("o_orderdate").cast("int"))]


def q_star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: scan -> lookups (C1) -> key resolution (C6) -> fact (C12) -> ids."""
    rows = _order_rows(spark, sf_dir, priority_keys=True)
    fact = rollup_fact(
        rows,
        keys=[("priority_id", F.col("priority_id")),
              ("yr", F.year("o_orderdate").cast("int")),
              ("mo", F.month("o_orderdate").cast("int")),
              ("type_id", F.col("type_id"))],
        item="o_orderkey", child="p_partkey",
        sums=[("total_price", _price())],
        flags=[("n_f", F.col("o_orderstatus") == "F"),
               ("n_o", F.col("o_orderstatus") == "O"),
               ("n_p", F.col("o_orderstatus") == "P")],
        ratios=[("avg_price", "total_price")],
        items_name="n_orders", children_name="n_parts")
    fact = fact.withColumn("total_price", F.col("total_price").cast("double"))
    fact = dense_ids(fact, ["yr", "mo", "priority_id", "type_id"], "fact_id")
    return fact.select("fact_id", "priority_id", "yr", "mo", "type_id", "n_parts", "n_orders",
                       "avg_price", "total_price", "n_f", "n_o", "n_p")


def q_rollup_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_rows(spark, sf_dir, priority_keys=False)
    fact = rollup_fact(
        rows,
        keys=[("k1", F.col("o_orderpriority")), *_date_keys(), ("k4", F.col("p_type"))],
        item="o_orderkey", child="p_partkey",
        sums=[("total_price", _price())],
        flags=[("n_f", F.col("o_orderstatus") == "F"), ("n_o", F.col("o_orderstatus") == "O")],
        ratios=[("avg_price", "total_price")])
    return fact.withColumn("total_price", F.col("total_price").cast("double"))


def q_rollup_fact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_rows(spark, sf_dir, priority_keys=False)
    fact = rollup_fact(
        rows,
        keys=[("k1", F.col("o_orderpriority")), *_date_keys(), ("k4", F.col("p_type"))],
        item="o_orderkey", sums=[("total_price", _price())],
        ratios=[("avg_price", "total_price")], once_per_item=True)
    return fact.withColumn("total_price", F.col("total_price").cast("double"))


def q_build_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return build_lookup(part, "p_brand", "brand_id", "brand_desc")


def q_resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    known = build_lookup(orders.where(F.col("o_orderpriority") < "4"),
                         "o_orderpriority", "id", "p")
    out = resolve_keys(orders.select("o_orderkey", "o_orderpriority"),
                       [KeyMap("o_orderpriority", known, "p", "id", out="priority_id")])
    return out.select("o_orderkey", "priority_id")


def _before(col: str, ts: str) -> F.Column:
    return F.col(col) < F.lit(ts).cast("timestamp_ntz")


def _from(col: str, ts: str) -> F.Column:
    return F.col(col) >= F.lit(ts).cast("timestamp_ntz")


def q_extend_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers known from the first quarter, extended by all later orders."""
    orders = table(spark, sf_dir, "orders")
    q1 = orders.where(_before("o_orderdate", "1995-04-01"))
    q2 = orders.where(_from("o_orderdate", "1995-04-01"))
    existing = build_lookup(q1, "o_custkey", "id", "o_custkey")
    return extend_lookup(existing, q2, "o_custkey", "id", "o_custkey")


def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ["ts", "event_id"], ["event_type", "value"])


_ORDER_ATTRS = ["o_orderstatus", "o_totalprice"]
_NEWEST = ["o_orderdate", "o_orderkey"]


def q_build_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return build_dimension(orders, "o_custkey", _ORDER_ATTRS, _NEWEST, "cust_id")


def q_upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension of the first quarter upserted with all later orders."""
    orders = table(spark, sf_dir, "orders")
    q1 = orders.where(_before("o_orderdate", "1995-04-01"))
    q2 = orders.where(_from("o_orderdate", "1995-04-01"))
    existing = build_dimension(q1, "o_custkey", _ORDER_ATTRS, _NEWEST, "cust_id")
    return upsert_dimension(existing, q2, "o_custkey", _ORDER_ATTRS, _NEWEST, "cust_id")


def _brands(part: DataFrame) -> DataFrame:
    return build_lookup(part, "p_brand", "brand_id", "brand_desc")


def q_build_child_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return build_child_dimension(part, "p_name", "p_brand", _brands(part), "brand_desc",
                                 "brand_id", "id")


def q_extend_child_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child dimension of small parts, extended with all parts."""
    part = table(spark, sf_dir, "part")
    brands = _brands(part)
    existing = build_child_dimension(part.where(F.col("p_size") <= 25), "p_name", "p_brand",
                                     brands, "brand_desc", "brand_id", "id")
    return extend_child_dimension(existing, part, "p_name", "p_brand", brands, "brand_desc",
                                  "brand_id", "id")


def q_build_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    dim = dense_ids(part.where(F.col("p_size") <= 25).select("p_partkey"), ["p_partkey"], "id")
    lineitem = table(spark, sf_dir, "lineitem")
    return build_bridge(lineitem, "l_orderkey", [("l_partkey", "p_partkey")], dim, "id",
                        id_name="part_id")


def q_append_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the bridge that overlap by a year of shipments:
    UNION ALL keeps the re-delivered rows twice."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    first = lineitem.where(_before("l_shipdate", "1998-01-01")).select("l_orderkey", "l_partkey")
    second = lineitem.where(_from("l_shipdate", "1997-01-01")).select("l_orderkey", "l_partkey")
    return append_bridge(first, second)


def q_upsert_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order snapshot up to 1997 upserted with a later extract in which open
    orders have been fulfilled."""
    orders = table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = orders.where(_before("o_orderdate", "1998-01-01")).select(*cols)
    new = orders.where(_from("o_orderdate", "1997-07-01")).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("F")).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        "o_totalprice")
    return upsert_detail(old, new, "o_orderkey")


def q_check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_empty(table(spark, sf_dir, "orders"))


def q_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(table(spark, sf_dir, "part"), "p_name")


def q_run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return run_checks({
        "orders_not_empty": check_not_empty(table(spark, sf_dir, "orders")),
        "part_name_unique": check_unique(part, "p_name"),
        "part_key_unique": check_unique(part, "p_partkey"),
    }).withColumnRenamed("check", "check_name")


def q_profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_table(table(spark, sf_dir, "part"), with_range=True)


def q_rank_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands ranked by quantity sold."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    ranked = rank_by(rows, "p_brand", F.col("l_quantity").cast("decimal(18,2)"))
    return ranked.select("p_brand", F.col("total").cast("double").alias("total"), "rnk")


def q_rank_by_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: customers ranked by average order value."""
    orders = table(spark, sf_dir, "orders")
    return rank_by(orders, "o_custkey", F.col("o_totalprice").cast("decimal(18,2)"),
                   how="avg", value_name="avg_price")


def q_measure_by_child_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order value by number of line items."""
    return measure_by_child_count(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)"), bridge_item="l_orderkey")


def q_adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over registered lake tables."""
    register_views(spark, {n: table(spark, sf_dir, n) for n in ("lineitem", "part")})
    return spark.sql("""
        select p_type, count(distinct l_orderkey) n_orders,
               cast(sum(cast(l_quantity as decimal(18,2))) as double) qty
        from lineitem join part on l_partkey = p_partkey
        group by p_type""")


def q_parse_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C21 round trip: customers written as quoted lines (a name with a comma
    inside quotes) and parsed back; a header line per run is dropped."""
    customer = table(spark, sf_dir, "customer")
    lines = customer.select(F.concat_ws(
        ",", F.col("c_custkey").cast("string"),
        quote_field(F.concat(F.col("c_name"), F.lit(", Inc"))),
        F.col("c_mktsegment")).alias("value"))
    header = spark.range(1).select(F.lit("c_custkey,c_name,c_mktsegment").alias("value"))
    records, _ = parse_quoted_lines(lines.unionByName(header),
                                    ["c_custkey", "c_name", "c_mktsegment"],
                                    header_prefix="c_custkey,c_name", unescape=True)
    return records.withColumn("c_custkey", clean_long("c_custkey"))


def q_explode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20 round trip: conversation turns packed into JSON documents of at
    most eight turns (conv_id, turns[]) and flattened again."""
    conv = table(spark, sf_dir, "conversations")
    docs = (conv.groupBy("conv_id", F.floor(F.col("turn") / 8).alias("chunk"))
                .agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns")))
    as_json = docs.select(F.to_json(F.struct("conv_id", "turns")).alias("doc"))
    schema = "conv_id bigint, turns array<struct<turn:bigint, role:string, text:string>>"
    parsed = as_json.select(F.from_json("doc", schema).alias("d")).select("d.*")
    return explode_documents(parsed, "turns", ["conv_id"], fields=["role", "text"])


def q_clean_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3: 'Jan 5, 2020' text parses; ISO text ('2020-01-05') is not the
    feed's format and becomes NULL instead of failing the job."""
    orders = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")) \
        .otherwise(F.date_format("o_orderdate", "MMM d, yyyy"))
    return orders.select("o_orderkey", clean_date(text).alias("d"))


def q_clean_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return events.select("event_id", clean_timestamp(text).alias("t"))


def q_clean_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the exact text 'True' is 'Y' ('true', NULL, '' are 'N')."""
    orders = table(spark, sf_dir, "orders")
    text = (F.when(F.col("o_orderstatus") == "F", F.lit("True"))
            .when(F.col("o_orderstatus") == "O", F.lit("true"))
            .otherwise(F.lit(None).cast("string")))
    return orders.select("o_orderkey", clean_flag(text).alias("f"))


def q_clean_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes as '<n>M', '<n>k', '<n/10>G' or 'Varies with device'."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    text = (F.when(size <= 16, F.concat(size.cast("string"), F.lit("M")))
            .when(size <= 33, F.concat(size.cast("string"), F.lit("k")))
            .when(size <= 40, F.concat((size / 10.0).cast("string"), F.lit("G")))
            .otherwise(F.lit("Varies with device")))
    return part.select("p_partkey", clean_size(text).alias("mb"))


def q_clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5: '23.0' -> 23 (bigint); values beyond 2^31-1 stay exact as bigint
    and are NULL in the int parity form; rating/price text -> double."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("string")
    big = F.concat(F.col("l_orderkey").cast("string"), F.lit("000000000001"))
    return li.select("l_orderkey", "l_linenumber",
                     clean_long(qty).alias("qty"),
                     clean_long(big).alias("big"),
                     clean_int_parity(big).alias("big_int"),
                     clean_double(F.col("l_discount").cast("string")).alias("disc"))


def app_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An app feed in the source's quoted-line format, derived from
    orders ⋈ customer (one app per order; the developer is the customer's
    nation). Names and dates carry a comma inside quotes; orders in status
    'P' have no release date (the fact falls back to the update date);
    measures are multiples of 1/1024 so sums are exact in binary and the
    engines agree bit for bit."""
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = lambda c: c.cast("string")
    status, nation = F.col("o_orderstatus"), F.col("c_nationkey")
    day = F.to_date("o_orderdate")
    fields = [
        quote_field(F.concat(F.col("c_name"), F.lit(", "), F.col("o_orderpriority"))),
        F.concat(F.lit("app."), s(F.col("o_orderkey"))),
        F.col("o_orderpriority"),
        s(F.length("c_mktsegment") / 2.0),
        s(F.col("o_custkey")),
        F.lit('"1,000+"'),
        F.concat(s(F.col("o_custkey") * 10), F.lit(".0")),
        s(F.col("o_orderkey") * 1000000),
        F.when(status == "F", "True").otherwise("False"),
        s(F.floor("o_totalprice")),
        F.col("c_mktsegment"),
        F.when(nation < 10, F.concat(s(nation), F.lit("M")))
         .when(nation < 20, F.concat(s(nation), F.lit("k")))
         .otherwise(F.lit("Varies with device")),
        F.lit("5.0 and up"),
        F.concat(F.lit("Dev "), s(nation)),
        F.concat(F.lit("http://dev"), s(nation), F.lit(".example/"), F.col("c_mktsegment")),
        F.concat(F.lit("dev"), s(nation), F.lit("@"), F.lower("c_mktsegment")),
        F.when(status == "P", F.lit("")).otherwise(quote_field(F.date_format(day, "MMM d, yyyy"))),
        quote_field(F.date_format(F.date_add(day, 30), "MMM d, yyyy")),
        F.when(status == "F", "Everyone").when(status == "O", "Teen").otherwise("Mature 17+"),
        F.concat(F.lit("http://p/"), s(F.col("o_orderkey"))),
        F.when(F.col("c_acctbal") > 0, "True").otherwise("False"),
        F.when(F.col("o_totalprice") > 200000, "True").otherwise("False"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "True").otherwise("False"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    ]
    lines = o.select(F.concat_ws(",", *fields).alias("value"))
    header = spark.range(1).select(
        F.lit(APP_HEADER_PREFIX + ",Category,Rating").alias("value"))
    return lines.unionByName(header)


def permission_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permission documents (JSON text, one a row) derived from lineitem ⋈
    part (permission = part name, type = part type). A document holds at most
    four line items, so no group grows with the data. Few of a document's line
    items stand together, so the rows are dealt by document before they are
    collected: lists made in the map tasks would hold one row or two."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("l_orderkey", F.floor(F.col("l_linenumber") / 4).alias("_chunk"),
                       F.struct(F.col("p_name").alias("permission"), F.col("p_type").alias("type")).alias("_permission"))
    docs = (rows.repartition("l_orderkey", "_chunk").groupBy("l_orderkey", "_chunk")
                .agg(F.collect_list("_permission").alias("allPermissions"))
                .select(F.concat(F.lit("app."), F.col("l_orderkey").cast("string")).alias("appId"),
                        F.lit("app").alias("appName"), "allPermissions"))
    return docs.select(F.to_json(F.struct("appId", "appName", "allPermissions")).alias("doc"))


def permission_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived permission documents, parsed with the feed's schema and flattened."""
    as_json = permission_documents(spark, sf_dir)
    parsed = as_json.select(F.from_json("doc", PERMISSION_SCHEMA).alias("d")).select("d.*")
    return explode_documents(parsed, "allPermissions", ["appId", "appName"])


def q_app_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source pipeline end to end (C21 -> C7/C1-C6 -> C8-C11 -> C12):
    quoted lines and JSON documents -> detail snowflake -> APP_FACT."""
    records, _ = parse_quoted_lines(app_feed_lines(spark, sf_dir), APP_COLUMNS,
                                    APP_HEADER_PREFIX)
    return model_fact(build_model(records, permission_rows(spark, sf_dir)))


def q_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are too short are kept as rejects, none is lost."""
    customer = table(spark, sf_dir, "customer")
    head = F.concat_ws(",", F.col("c_custkey").cast("string"), quote_field(F.concat(F.col("c_name"), F.lit(", Inc"))))
    line = F.when(F.col("c_custkey") % 7 == 0, head).otherwise(F.concat_ws(",", head, F.col("c_mktsegment")))
    _, rejects = parse_quoted_lines(customer.select(line.alias("value")), ["c_custkey", "c_name", "c_mktsegment"])
    return rejects


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder among the session's shared ones, for derived feeds and tables."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q_corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files in which every fifth document is cut off: whole documents
    are flattened, the others come back as rejects."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    doc = F.concat(F.lit('{"appId":"'), key, F.lit('","appName":"'), name,
                   F.lit('","allPermissions":[{"permission":"'), F.col("c_mktsegment"), F.lit('","type":"x"}'))
    doc = F.when(F.col("c_custkey") % 5 == 0, doc).otherwise(F.concat(doc, F.lit("]}")))
    folder = _scratch(spark, "documents")
    table(spark, sf_dir, "customer").select(doc.alias("value")).write.text(folder)
    rows, rejects = read_permission_feed(spark, folder, multiline=False)
    return rows.select("appId", "permission", F.lit(None).cast("string").alias("line")).unionByName(
        rejects.select(F.lit(None).cast("string").alias("appId"), F.lit(None).cast("string").alias("permission"), "line"))


def _load(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    """Derived feeds written as files and loaded in two deliveries (the second
    one holds everything again and some damaged records), APP and the fact
    hash-bucketed: lake root, warehouse root and the checks. A delivery is made
    when its turn comes and its files go once it is loaded, so that disk holds
    one delivery's compressed text beside the tables."""
    base = _scratch(spark, "load")
    lines = app_feed_lines(spark, sf_dir)
    docs = permission_documents(spark, sf_dir).withColumnRenamed("doc", "value")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    bad_lines = nation.select(F.concat(F.lit("cut,"), F.col("n_nationkey").cast("string")).alias("value"))
    bad_docs = region.select(F.concat(F.lit('{"appId":"'), F.col("r_name")).alias("value"))
    early = F.regexp_extract("value", r"app\.(\d+)", 1) != ""
    early = early & (F.substring(F.regexp_extract("value", r"app\.(\d+)", 1), -1, 1) < "5") | ~early
    deliveries = [{"apps1": lines.where(early), "docs1": docs.where(early)},
                  {"apps2": lines.unionByName(bad_lines), "docs2": docs.unionByName(bad_docs)}]
    root, warehouse = f"{base}/lake", f"{base}/warehouse"
    opts = Options(app_buckets=8, fact_buckets=8)
    for feeds in deliveries:
        for name, df in feeds.items():
            _write_feed(df, f"{base}/{name}")
        apps, documents = [f"{base}/{name}" for name in feeds]
        checks = run_all(spark, apps, documents, root, warehouse, opts, multiline=False)
        for name in feeds:
            delete(spark, f"{base}/{name}")
    return root, warehouse, checks


def _write_feed(feed: DataFrame, path: str) -> None:
    """A feed as compressed text files. Such a file is read by one task, so it holds at most ``TASK_ROWS`` lines."""
    feed.write.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": TASK_ROWS}).text(path)
    free_finished(feed.sparkSession)


def q_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load path (S1, S4, S6, K1-K5, C15, C16, C22, C23) from files, two
    deliveries: rows of every published table, and the checks (1 or 0)."""
    root, warehouse, checks = _load(spark, sf_dir)
    out = checks.select(F.col("check").alias("what"), F.col("passed").cast("long").alias("n"))
    lake = [NAMES.app, NAMES.category, NAMES.content_rating, NAMES.developer, NAMES.currency, NAMES.app_permission,
            NAMES.permission, NAMES.permission_type, NAMES.app_rejects, NAMES.permission_rejects]
    for where, names in ((root, lake), (warehouse, list(NAMES.warehouse.values()))):
        for name in names:
            label = name if where == root else f"warehouse {name}"
            out = out.unionByName(read_table(spark, f"{where}/{name}").agg(F.count("*").alias("n")).select(
                F.lit(label).alias("what"), "n"))
    return out


def q_load_fact_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse's APP_FACT after the second delivery, of which
    only the touched groups were computed again (ids follow the deliveries)."""
    _, warehouse, _ = _load(spark, sf_dir)
    return read_table(spark, f"{warehouse}/APP_FACT").drop("Auto_App_Id")


def q_load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """APP_FACT as the warehouse holds it after one delivery of the derived feeds, loaded from files."""
    base = _scratch(spark, "load")
    app_feed_lines(spark, sf_dir).write.text(f"{base}/apps")
    permission_documents(spark, sf_dir).write.text(f"{base}/docs")
    run_all(spark, f"{base}/apps", f"{base}/docs", f"{base}/lake", f"{base}/warehouse", multiline=False)
    return read_table(spark, f"{base}/warehouse/APP_FACT")


def q_rollup_fact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 on items with many versions: an order counts once per group with its
    largest quantity, under each flag that one of its rows has."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    fact = rollup_fact(rows, keys=[("k", F.col("l_returnflag"))], item="l_orderkey",
                       sums=[("total", F.col("l_quantity").cast("decimal(18,2)"))],
                       flags=[("n_open", F.col("l_linestatus") == "O"), ("n_done", F.col("l_linestatus") == "F")],
                       ratios=[("mean", "total")], once_per_item=True)
    return fact.withColumn("total", F.col("total").cast("double"))


def q_child_dimension_blank_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 where a third of the parents are NULL and a third are empty."""
    part = table(spark, sf_dir, "part")
    parent = F.when(F.col("p_size") % 3 == 0, F.lit(None)).when(F.col("p_size") % 3 == 1, F.lit("")).otherwise(F.col("p_brand"))
    rows = part.select("p_name", parent.alias("brand"))
    return build_child_dimension(rows, "p_name", "brand", _brands(part), "brand_desc", "brand_id", "id")


def q_upsert_detail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14 with a NULL key on both sides and keys that repeat in the delivery,
    run twice."""
    old = table(spark, sf_dir, "customer").select(
        F.expr("nullif(c_custkey, 7)").alias("k"), F.lit(0).cast("long").alias("v"))
    new = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("k"), F.col("o_orderkey").alias("v"))
    return upsert_detail(upsert_detail(old, new, "k"), new, "k")


def _app_model(spark: SparkSession, sf_dir: str, *columns: str) -> Model:
    """The model over the derived feeds; a report names the columns of APP that it reads."""
    records, _ = parse_quoted_lines(app_feed_lines(spark, sf_dir), APP_COLUMNS,
                                    APP_HEADER_PREFIX)
    return Model(records, permission_rows(spark, sf_dir), app_columns=columns)


def q_app_category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 on the model: categories ranked by installs."""
    m = _app_model(spark, sf_dir, "Category_Id", "Maximum_Installs")
    return category_rank(m[NAMES.app], m[NAMES.category])


def q_app_developer_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 on the model: developers ranked by average app rating."""
    m = _app_model(spark, sf_dir, "Developer_Id", "Rating")
    return developer_rank(m[NAMES.app], m[NAMES.developer])


def q_app_rating_by_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 on the model: rating against the number of permissions."""
    m = _app_model(spark, sf_dir, "App_Id", "Rating")
    return rating_by_permission_count(*m.side_by_side(NAMES.app, NAMES.app_permission))


def q_app_rating_by_permission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 on the model: rating per permission."""
    m = _app_model(spark, sf_dir, "App_Id", "Rating")
    return rating_by_permission(*m.side_by_side(NAMES.app, NAMES.app_permission), m[NAMES.permission])


def q_app_rating_by_permission_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 on the model: rating per permission type."""
    m = _app_model(spark, sf_dir, "App_Id", "Rating")
    return rating_by_permission_type(*m.side_by_side(NAMES.app, NAMES.app_permission), m[NAMES.permission],
                                     m[NAMES.permission_type])


QUERIES: dict[str, Query] = {
    "star_fact": q_star_fact,
    "rollup_fact": q_rollup_fact,
    "rollup_fact_distinct": q_rollup_fact_distinct,
    "build_lookup": q_build_lookup,
    "resolve_keys": q_resolve_keys,
    "extend_lookup": q_extend_lookup,
    "latest_per_key": q_latest_per_key,
    "build_dimension": q_build_dimension,
    "upsert_dimension": q_upsert_dimension,
    "build_child_dimension": q_build_child_dimension,
    "extend_child_dimension": q_extend_child_dimension,
    "build_bridge": q_build_bridge,
    "append_bridge": q_append_bridge,
    "upsert_detail": q_upsert_detail,
    "check_not_empty": q_check_not_empty,
    "check_unique": q_check_unique,
    "run_checks": q_run_checks,
    "profile_table": q_profile_table,
    "rank_by": q_rank_by,
    "rank_by_average": q_rank_by_average,
    "measure_by_child_count": q_measure_by_child_count,
    "adhoc_sql": q_adhoc_sql,
    "parse_quoted_lines": q_parse_quoted_lines,
    "explode_documents": q_explode_documents,
    "clean_date": q_clean_date,
    "clean_timestamp": q_clean_timestamp,
    "clean_flag": q_clean_flag,
    "clean_size": q_clean_size,
    "clean_numbers": q_clean_numbers,
    "app_fact": q_app_fact,
    "app_category_rank": q_app_category_rank,
    "app_developer_rank": q_app_developer_rank,
    "app_rating_by_permissions": q_app_rating_by_permissions,
    "app_rating_by_permission": q_app_rating_by_permission,
    "app_rating_by_permission_type": q_app_rating_by_permission_type,
    "parse_rejects": q_parse_rejects,
    "corrupt_documents": q_corrupt_documents,
    "load_counts": q_load_counts,
    "load_fact": q_load_fact,
    "load_fact_increment": q_load_fact_increment,
    "rollup_fact_versions": q_rollup_fact_versions,
    "child_dimension_blank_parents": q_child_dimension_blank_parents,
    "upsert_detail_keys": q_upsert_detail_keys,
}
