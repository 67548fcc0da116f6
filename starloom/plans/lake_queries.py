"""Registered queries over published tables: declared warehouse tables, stars
read as one snapshot, bucketed upserts, gated loads and incremental facts.

Each query derives its deliveries from whole driver tables, writes them through
the library to a new folder among the session's shared ones, and returns what a
reader gets. The DuckDB statement that must give the same rows stands below
each query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, LongType, ShortType, StringType, StructField, StructType)

from ..operators.detail import changed_rows
from ..operators.dimensions import build_dimension, upsert_dimension
from ..operators.facts import rollup_fact, star_rows
from ..operators.lookups import build_lookup
from ..operators.profiles import store_part, stored_profile
from ..operators.quality import check_not_empty, check_unique
from ..operators.refresh import FactSpec, refresh_fact
from ..session import checkpoint_dir
from ..sources.documents import PERMISSION_SCHEMA, explode_documents, split_corrupt
from ..sources.json_array import read_array_documents
from ..sources.lake import (CheckFailed, publish_star, publish_table, read_star, read_table, upsert_buckets)
from ..sources.warehouse import create_database, create_table, load_tables, overwrite_table, publish_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query with its DuckDB statement."""
    def register(f: Query) -> Query:
        name = f.__name__.removeprefix("q_")
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    """A new folder among the session's shared ones."""
    return f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    name = f"starloom_{uuid.uuid4().hex[:12]}"
    return create_database(spark, name, _scratch(spark))


def _day(col: str, day: str) -> F.Column:
    return F.col(col) < F.lit(day).cast("timestamp_ntz")


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t) for n, t in cols])


ORDERS = _schema(("o_orderkey", LongType()), ("o_custkey", IntegerType()), ("o_totalprice", ShortType()),
                 ("o_orderpriority", IntegerType()), ("o_orderdate", DateType()))
CUSTOMERS = _schema(("c_custkey", IntegerType()), ("c_mktsegment", StringType()), ("c_acctbal", ShortType()))


def _load_twice(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Two full refreshes of two declared tables, the first one of a part; database and report."""
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    database = _database(spark)
    load_tables({"ORDERS": (orders.where(_day("o_orderdate", "1996-01-01")), ORDERS), "CUSTOMERS": (customer, CUSTOMERS)}, database)
    return database, load_tables({"ORDERS": (orders, ORDERS), "CUSTOMERS": (customer, CUSTOMERS)}, database)


@query("""
select 'ORDERS' as table_name, column_name, (select count(*) from orders) as n_rows, cast(n_lost as bigint) as n_lost
from (select 0 as o_orderkey, 0 as o_custkey, count(*) filter (where trunc(o_totalprice) not between -32768 and 32767) as o_totalprice,
             count(o_orderpriority) as o_orderpriority, 0 as o_orderdate from orders) as o
unpivot (n_lost for column_name in (o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderdate))
union all
select 'CUSTOMERS', column_name, (select count(*) from customer), cast(n_lost as bigint)
from (select 0 as c_custkey, 0 as c_mktsegment, count(*) filter (where trunc(c_acctbal) not between -32768 and 32767) as c_acctbal
      from customer) as c
unpivot (n_lost for column_name in (c_custkey, c_mktsegment, c_acctbal))
""")
def q_warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second refresh of declared tables reports: rows, and
    per column the values that did not fit (prices over a smallint, a text as integer)."""
    return _load_twice(spark, sf_dir)[1]


@query("""
select c_mktsegment, year(o_orderdate) as yr, count(*) as n_orders,
       count(*) filter (where trunc(o_totalprice) not between -32768 and 32767) as n_unknown,
       cast(sum(case when trunc(o_totalprice) between -32768 and 32767 then trunc(o_totalprice) end) as bigint) as total
from orders join customer on o_custkey = c_custkey group by all
""")
def q_warehouse_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL by table name over the declared tables after two refreshes."""
    db, _ = _load_twice(spark, sf_dir)
    return spark.sql(f"""
        select c_mktsegment, year(o_orderdate) as yr, count(*) as n_orders,
               count_if(o_totalprice is null) as n_unknown, sum(o_totalprice) as total
        from {db}.ORDERS join {db}.CUSTOMERS on o_custkey = c_custkey
        group by c_mktsegment, year(o_orderdate)""")


def _star_tables(spark: SparkSession, sf_dir: str, day: str) -> dict[str, DataFrame]:
    """A dimension of the customers who ordered before a day, and a fact that refers to it."""
    orders = _table(spark, sf_dir, "orders").where(_day("o_orderdate", day))
    dim = build_lookup(orders, "o_custkey", "id", "custkey")
    fact = orders.join(dim, F.col("o_custkey") == F.col("custkey")).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("last_order"))
    return {"DIM": dim, "FACT": fact}


def _with_schemas(tables: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, StructType]]:
    return {n: (df, df.schema) for n, df in tables.items()}


_STAR_ROWS = """
select '{name}' as snapshot, o_custkey as custkey, row_number() over (order by o_custkey) as id, count(*) as n_orders,
       max(o_orderkey) as last_order
from orders where o_orderdate < timestamp '{day}' group by o_custkey
"""


@query(" union all ".join(f"(select snapshot, custkey, cast(id as integer) as id, n_orders, last_order from ({_STAR_ROWS.format(name=n, day=d)}))"
                         for n, d in (("stopped", "1996-01-01"), ("done", "1998-01-01"), ("earlier", "1996-01-01"))))
def q_star_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension and fact read by one manifest: after a load that
    stopped between the two tables, after one that went through, and the earlier
    snapshot by its number."""
    root = f"{_scratch(spark)}/star"
    publish_star(_with_schemas(_star_tables(spark, sf_dir, "1996-01-01")), root)
    later = _star_tables(spark, sf_dir, "1998-01-01")
    # the second table's rows fail while they are written
    broken = later["FACT"].withColumn("n_orders", F.when(F.col("id") > 0, F.raise_error(F.lit("the load stops here"))).cast("long"))
    try:
        publish_star(_with_schemas({"DIM": later["DIM"], "FACT": broken}), root)
        raise AssertionError("the broken load was published")
    except AssertionError:
        raise
    except Exception:  # the load died; nothing of it is visible
        pass

    def rows(name: str, version: int | None = None) -> DataFrame:
        star = read_star(spark, root, version)
        return star["DIM"].join(star["FACT"], "id").select(F.lit(name).alias("snapshot"), "custkey", "id", "n_orders", "last_order")

    stopped = rows("stopped")
    publish_star(_with_schemas(later), root)
    return stopped.unionByName(rows("done")).unionByName(rows("earlier", 1))


@query("""
with early as (select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '1998-01-01'),
late as (select o_orderkey, case when o_orderstatus = 'O' and o_orderkey % 1000 = 1 then 'F' else o_orderstatus end as o_orderstatus,
                o_totalprice from orders where o_orderdate >= timestamp '1997-07-01')
select 'before' as version, * from early
union all
select 'after', * from late
union all
select 'after', * from early where o_orderkey not in (select o_orderkey from late)
""")
def q_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed order table before and after an upsert. The rows
    ``before`` are read by the frame that was opened before the upsert, which
    writes only the buckets of inserts and real changes."""
    orders = _table(spark, sf_dir, "orders")
    path = f"{_scratch(spark)}/orders"
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    upsert_buckets(spark, path, orders.where(_day("o_orderdate", "1998-01-01")).select(*cols), "o_orderkey", buckets=64)
    before = read_table(spark, path).select(F.lit("before").alias("version"), *cols)
    filled = F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 1000 == 1), "F").otherwise(F.col("o_orderstatus"))
    new = orders.where(~_day("o_orderdate", "1997-07-01")).withColumn("o_orderstatus", filled).select(*cols)
    upsert_buckets(spark, path, new, "o_orderkey", buckets=64)
    return before.unionByName(read_table(spark, path).select(F.lit("after").alias("version"), *cols))


@query("""
select n.o_orderkey, n.o_orderstatus, n.comment
from (select o_orderkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus,
             case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then 'y' else 'x' end as comment from orders) n
left join (select o_orderkey, o_orderstatus, case when o_orderkey % 13 = 0 then null else 'x' end as comment, 1 as old from orders
           where o_orderdate < timestamp '1998-01-01') o using (o_orderkey)
where o.old is null or n.o_orderstatus is distinct from o.o_orderstatus or n.comment is distinct from o.comment
""")
def q_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inserts and real changes of a delivery, changes to and from NULL included."""
    orders = _table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    old = orders.where(_day("o_orderdate", "1998-01-01")).select(
        "o_orderkey", "o_orderstatus", F.when(key % 13 != 0, "x").alias("comment"))
    new = orders.select("o_orderkey", F.when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                        F.when(key % 11 == 0, None).when(key % 13 == 0, "y").otherwise("x").alias("comment"))
    return changed_rows(old, new, "o_orderkey")


@query("""
select cast(row_number() over (order by brand) as integer) as id, brand
from (select distinct case when p_size % 5 = 1 then ' ' when p_size % 5 = 2 then p_brand end as brand from part)
where brand is not null and brand <> ''
""")
def q_lookup_nonempty_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a lookup that drops NULL and empty keys but keeps blank ones."""
    size = F.col("p_size") % 5
    brand = F.when(size == 0, "").when(size == 1, " ").when(size == 2, F.col("p_brand"))
    return build_lookup(_table(spark, sf_dir, "part").select(brand.alias("brand")), "brand", "id", "brand", keep="nonempty")


@query("""
with src as (select case when p_size % 5 = 0 then '' when p_size % 5 <> 1 then p_brand end as brand, p_name, p_partkey from part),
last as (select *, row_number() over (partition by brand order by p_partkey desc) as n from src where brand is not null)
select cast(row_number() over (order by brand) as integer) as id, brand, p_name from last where n = 1
""")
def q_dimension_notnull_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a dimension that drops NULL keys only; the empty key is a member."""
    size = F.col("p_size") % 5
    src = _table(spark, sf_dir, "part").select(F.when(size == 0, "").when(size != 1, F.col("p_brand")).alias("brand"), "p_name", "p_partkey")
    return build_dimension(src, "brand", ["p_name"], ["p_partkey"], "id", keep="notnull")


@query("""
with early as (select o_custkey, o_orderstatus, o_orderpriority, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
               from orders where o_orderdate < timestamp '1996-01-01'),
late as (select o_custkey, o_orderstatus, o_orderpriority, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n
         from orders where o_orderdate >= timestamp '1996-01-01'),
old as (select row_number() over (order by o_custkey) as cust_id, * from early where n = 1),
both_sides as (
  select old.cust_id, coalesce(l.o_custkey, old.o_custkey) as o_custkey,
         case when l.n is null then old.o_orderstatus else l.o_orderstatus end as o_orderstatus,
         case when l.n is null then old.o_orderpriority else l.o_orderpriority end as o_orderpriority,
         case when old.n is null then 'new' when l.n is null then 'gone'
              when l.o_orderstatus is distinct from old.o_orderstatus or l.o_orderpriority is distinct from old.o_orderpriority
              then 'changed' else 'same' end as class
  from old full join (select * from late where n = 1) l on old.o_custkey = l.o_custkey)
select cast(coalesce(cust_id, (select max(cust_id) from old) + row_number() over (partition by cust_id is null order by o_custkey)) as integer) as cust_id,
       o_custkey, o_orderstatus, o_orderpriority, class
from both_sides
""")
def q_upsert_dimension_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert with the class of every row (new, changed, same, gone) from one full outer join."""
    orders = _table(spark, sf_dir, "orders")
    attrs, newest = ["o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    old = build_dimension(orders.where(_day("o_orderdate", "1996-01-01")), "o_custkey", attrs, newest, "cust_id")
    return upsert_dimension(old, orders.where(~_day("o_orderdate", "1996-01-01")), "o_custkey", attrs, newest, "cust_id",
                            class_col="class")


@query("""
select 'refused' as load, 'key unique' as what, cast(0 as bigint) as n
union all select 'refused', 'not empty', 1
union all select 'current', 'rows', count(distinct o_custkey) from orders where o_orderdate < timestamp '1996-01-01'
union all select 'current', 'last order', max(o_orderkey) from orders where o_orderdate < timestamp '1996-01-01'
""")
def q_gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17-C19 as a gate: a delivery in which every key comes twice is written,
    checked and refused; the earlier version stays current."""
    orders = _table(spark, sf_dir, "orders")
    path = f"{_scratch(spark)}/customers"

    def checks(df: DataFrame) -> dict[str, DataFrame]:
        return {"key unique": check_unique(df, "o_custkey"), "not empty": check_not_empty(df)}

    def last_orders(rows: DataFrame) -> DataFrame:
        return rows.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"))

    publish_table(last_orders(orders.where(_day("o_orderdate", "1996-01-01"))), path, checks=checks)
    try:
        publish_table(last_orders(orders).unionByName(last_orders(orders)), path, checks=checks)
        raise AssertionError("a table with duplicate keys was published")
    except CheckFailed as refused:
        results = [("refused", what, int(ok)) for what, ok in refused.results]
    current = read_table(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.max("last_order").alias("last order"))
    return spark.createDataFrame(results, "load string, what string, n long").unionByName(
        current.select(F.lit("current").alias("load"), F.expr("stack(2, 'rows', rows, 'last order', `last order`) as (what, n)")))


def order_fact() -> FactSpec:
    return FactSpec(
        detail_keys=[("k1", F.col("o_orderpriority")), ("k2", F.year("o_orderdate").cast("int")), ("k3", F.month("o_orderdate").cast("int"))],
        child_keys=[("k4", F.col("p_type"))], item="o_orderkey", child="p_partkey",
        detail_columns=("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus"), child_columns=("p_type",),
        sums=[("total_price", F.col("o_totalprice").cast("decimal(18,2)"))],
        flags=[("n_f", F.col("o_orderstatus") == "F"), ("n_o", F.col("o_orderstatus") == "O")],
        ratios=[("avg_price", "total_price")], order=("k2", "k3", "k1", "k4"))


def deliver_orders(spark: SparkSession, sf_dir: str, root: str, second: bool) -> None:
    """The two deliveries of orders, line items and parts that the incremental fact is tested on.

    The second one brings the last month's orders, moves the orders of one week to another
    priority, adds line items to them, and brings new parts.
    """
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus")
    items = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
    moved = (F.col("o_orderdate") >= F.lit("1997-12-25").cast("timestamp_ntz")) & _day("o_orderdate", "1998-01-01")
    early = orders.where(_day("o_orderdate", "2001-07-01"))
    if not second:
        upsert_buckets(spark, f"{root}/orders", early, "o_orderkey", buckets=32)
        publish_table(items.join(early.select("o_orderkey"), "o_orderkey"), f"{root}/items")
        publish_table(part.where("p_partkey % 10 <> 3"), f"{root}/parts")
        return
    late = orders.where(moved).withColumn("o_orderpriority", F.lit("0-MOVED")).unionByName(orders.where(~_day("o_orderdate", "2001-07-01")))
    upsert_buckets(spark, f"{root}/orders", late, "o_orderkey", buckets=32)
    extra = orders.where(moved).select("o_orderkey", F.lit(1).cast("long").alias("p_partkey"))
    publish_table(items.unionByName(extra), f"{root}/items")
    publish_table(part.where("p_partkey % 10 <> 3 or p_partkey % 100 = 3"), f"{root}/parts")


@query("""
with o as (
  select o_orderkey, o_orderdate, o_totalprice, o_orderstatus,
         case when o_orderdate >= timestamp '1997-12-25' and o_orderdate < timestamp '1998-01-01' then '0-MOVED' else o_orderpriority end as o_orderpriority
  from orders),
links as (
  select l_orderkey, l_partkey from lineitem
  union all select o_orderkey, 1 from orders where o_orderdate >= timestamp '1997-12-25' and o_orderdate < timestamp '1998-01-01')
select o_orderpriority as k1, year(o_orderdate) as k2, month(o_orderdate) as k3, p_type as k4,
       count(distinct l_partkey) as n_children, count(distinct o_orderkey) as n_items,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(distinct o_orderkey) as avg_price,
       count(distinct case when o_orderstatus = 'F' then o_orderkey end) as n_f,
       count(distinct case when o_orderstatus = 'O' then o_orderkey end) as n_o
from o join links on o_orderkey = l_orderkey join part on l_partkey = p_partkey
where p_partkey % 10 <> 3 or p_partkey % 100 = 3
group by all
""")
def q_incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 in increments: the fact after a second delivery, of which only the
    groups were computed again that the delivery touches (old and new groups of
    changed orders, of new line items and of new parts)."""
    root = _scratch(spark)
    paths = [f"{root}/{n}" for n in ("fact", "orders", "items", "parts")]
    deliver_orders(spark, sf_dir, root, second=False)
    refresh_fact(spark, *paths, order_fact())
    deliver_orders(spark, sf_dir, root, second=True)
    done = refresh_fact(spark, *paths, order_fact())
    if done.whole:
        raise AssertionError("the second delivery was not taken as an increment")
    fact = read_table(spark, paths[0]).drop("_bucket", "fact_id")
    return fact.withColumn("total_price", F.col("total_price").cast("double"))


@query("""
select o_orderpriority as k1, year(o_orderdate) as k2, p_type as k3, count(distinct l_partkey) as n_children,
       count(distinct o_orderkey) as n_items, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price
from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey group by all
""")
def q_bucketed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail and bridge as declared tables in equal buckets of the
    item key: their join needs no shuffle."""
    rows = star_rows(*bucketed_star(spark, sf_dir), _table(spark, sf_dir, "part").select("p_partkey", "p_type"),
                     "o_orderkey", "p_partkey", bridge_item_key="l_orderkey", bridge_child_key="l_partkey")
    fact = rollup_fact(rows, keys=[("k1", F.col("o_orderpriority")), ("k2", F.year("o_orderdate").cast("int")), ("k3", F.col("p_type"))],
                       item="o_orderkey", child="p_partkey", sums=[("total_price", F.col("o_totalprice").cast("decimal(18,2)"))])
    return fact.withColumn("total_price", F.col("total_price").cast("double"))


def bucketed_star(spark: SparkSession, sf_dir: str, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    """Orders and line items as catalog tables in equal buckets of the order key."""
    db = _database(spark)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    for name, df, key in (("ORDERS", orders, "o_orderkey"), ("ITEMS", items, "l_orderkey")):
        create_table(spark, f"{db}.{name}", df.schema, cluster_by=[key], buckets=buckets)
        overwrite_table(df, f"{db}.{name}")
    return spark.table(f"{db}.ORDERS"), spark.table(f"{db}.ITEMS")


_VIEW_ROWS = """
select '{name}' as load, n_orders, count(*) as n_customers, max(last_order) as last_order
from (select o_custkey, count(*) as n_orders, max(o_orderkey) as last_order from orders where o_orderdate < timestamp '{day}' group by o_custkey)
group by n_orders
"""


@query(" union all ".join(f"({_VIEW_ROWS.format(name=n, day=d)})" for n, d in (
    ("first", "1996-01-01"), ("second", "1998-01-01"), ("named", "1996-01-01"))))
def q_views_follow_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the names of a published star, before and after a
    second load, and over a named earlier version."""
    root, db, earlier = f"{_scratch(spark)}/star", _database(spark), _database(spark)
    ask = ("select '{0}' as load, n_orders, count(*) as n_customers, max(last_order) as last_order "
           "from {1}.FACT join {1}.DIM using (id) group by n_orders")
    publish_star(_with_schemas(_star_tables(spark, sf_dir, "1996-01-01")), root)
    publish_views(spark, db, root)
    first = spark.sql(ask.format("first", db))
    publish_star(_with_schemas(_star_tables(spark, sf_dir, "1998-01-01")), root)
    publish_views(spark, db, root)
    publish_views(spark, earlier, root, version=1)
    return first.unionByName(spark.sql(ask.format("second", db))).unionByName(spark.sql(ask.format("named", earlier)))



def array_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Pretty-printed JSON arrays of customers (at most 50,000 in a file), with
    brackets and quotes inside strings; every 50th document lacks its end."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("c_custkey").cast("string")
    doc = F.concat(F.lit('  {\n    "appId": "'), key, F.lit('",\n    "appName": "'), F.col("c_name"), F.lit(' \\"]}[{\\\\",\n    "allPermissions": [\n'
                   '      {\n        "permission": "'), F.col("c_mktsegment"), F.lit('",\n        "type": "{x"\n      }'))
    doc = F.concat(doc, F.when(F.col("c_custkey") % 50 != 0, F.lit("\n    ]\n  },")).otherwise(F.lit(",")))
    group = F.floor(F.col("c_custkey") / 50000).cast("int")
    rows = customer.select(group.alias("g"), F.col("c_custkey").alias("n"), doc.alias("value"))
    groups = rows.select("g").distinct()
    ends = groups.select("g", F.lit(-1).cast("long").alias("n"), F.lit("[").alias("value")).unionByName(
        groups.select("g", F.lit(1 << 62).alias("n"), F.lit(']').alias("value")))
    (rows.select("g", F.col("n").cast("long").alias("n"), "value").unionByName(ends).repartition("g").sortWithinPartitions("g", "n")
     .select("g", "value").write.partitionBy("g").text(folder))


@query("""
select cast(c_custkey as varchar) as appId, case when c_custkey % 50 <> 0 then c_name || ' "]}[{\\' end as appName,
       case when c_custkey % 50 <> 0 then c_mktsegment end as permission, c_custkey % 50 = 0 as rejected
from customer
""")
def q_split_array_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large pretty-printed arrays read in many tasks (64 kB blocks here);
    a damaged document is a reject, its neighbours are not."""
    folder = f"{_scratch(spark)}/arrays"
    array_files(spark, sf_dir, folder)
    size = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(size)
    spark.conf.set(size, str(64 * 1024))
    try:
        docs = read_array_documents(spark, folder, PERMISSION_SCHEMA).checkpoint(eager=True)
    finally:
        spark.conf.set(size, given)
    good, rejects = split_corrupt(docs)
    flat = explode_documents(good, "allPermissions", ["appId", "appName"]).select("appId", "appName", "permission", F.lit(False).alias("rejected"))
    none = F.lit(None).cast("string")
    return flat.unionByName(rejects.select(F.regexp_extract("line", r'"appId": "(\d+)"', 1).alias("appId"), none.alias("appName"),
                                           none.alias("permission"), F.lit(True).alias("rejected")))


@query("""
select 'o_orderkey' as col, count(*) as n, count(*) - count(o_orderkey) as nulls, cast(min(o_orderkey) as double) as min_number,
       cast(max(o_orderkey) as double) as max_number, null as min_text, null as max_text from orders
union all select 'o_orderstatus', count(*), count(*) - count(o_orderstatus), null, null, min(o_orderstatus), max(o_orderstatus) from orders
union all select 'o_totalprice', count(*), count(*) - count(o_totalprice), cast(cast(min(o_totalprice) as decimal(38,9)) as double),
       cast(cast(max(o_totalprice) as decimal(38,9)) as double), null, null from orders
union all select 'late', count(*), count(*) - count(case when o_orderkey % 3 = 0 then o_orderpriority end), null, null,
       min(case when o_orderkey % 3 = 0 then o_orderpriority end), max(case when o_orderkey % 3 = 0 then o_orderpriority end) from orders
""")
def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a table from the stored parts of three deliveries; none is read twice."""
    orders = _table(spark, sf_dir, "orders").withColumn("late", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")))
    path = f"{_scratch(spark)}/profile"
    days = ["1996-01-01", "1998-01-01"]
    for part in (orders.where(_day("o_orderdate", days[0])), orders.where(~_day("o_orderdate", days[0]) & _day("o_orderdate", days[1])),
                 orders.where(~_day("o_orderdate", days[1]))):
        store_part(spark, path, part, ["o_orderkey", "o_orderstatus", "o_totalprice", "late"])
    return stored_profile(spark, path).select("col", "n", "nulls", F.col("min_number").cast("double").alias("min_number"),
                                              F.col("max_number").cast("double").alias("max_number"), "min_text", "max_text")
