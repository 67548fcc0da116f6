"""DuckDB statements that define the expected rows of each registered query.

Sums go through ``decimal(18,2)`` (exact in both engines) and are cast to
double; ids are cast to ``int``; ascending window orders say NULLS FIRST,
which is Spark's default and not DuckDB's.
"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["star_fact"] = """
with pr as (
  select cast(row_number() over (order by p) as int) priority_id, p
  from (select distinct o_orderpriority p from orders
        where o_orderpriority is not null and length(trim(o_orderpriority)) > 0) x),
ty as (
  select cast(row_number() over (order by t) as int) type_id, t
  from (select distinct p_type t from part
        where p_type is not null and length(trim(p_type)) > 0) x),
o as (select o_orderkey, o_orderdate, o_totalprice, o_orderstatus,
             coalesce(priority_id, -1) priority_id
      from orders left join pr on o_orderpriority = p),
pt as (select p_partkey, coalesce(type_id, -1) type_id from part left join ty on p_type = t),
f as (
  select priority_id, cast(year(o_orderdate) as int) yr, cast(month(o_orderdate) as int) mo, type_id,
         count(distinct l_partkey) n_parts, count(distinct o_orderkey) n_orders,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(distinct o_orderkey) avg_price,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) total_price,
         count(distinct case when o_orderstatus = 'F' then o_orderkey end) n_f,
         count(distinct case when o_orderstatus = 'O' then o_orderkey end) n_o,
         count(distinct case when o_orderstatus = 'P' then o_orderkey end) n_p
  from o join lineitem on o_orderkey = l_orderkey join pt on l_partkey = p_partkey
  group by 1, 2, 3, 4)
select cast(row_number() over (order by yr nulls first, mo nulls first,
                               priority_id nulls first, type_id nulls first) as int) fact_id, *
from f
"""

ORACLE_SQL["rollup_fact"] = """
select o_orderpriority k1, cast(year(o_orderdate) as int) k2, cast(month(o_orderdate) as int) k3,
       p_type k4, count(distinct l_partkey) n_children, count(distinct o_orderkey) n_items,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(distinct o_orderkey) avg_price,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) total_price,
       count(distinct case when o_orderstatus = 'F' then o_orderkey end) n_f,
       count(distinct case when o_orderstatus = 'O' then o_orderkey end) n_o
from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey
group by o_orderpriority, year(o_orderdate), month(o_orderdate), p_type
"""

ORACLE_SQL["rollup_fact_distinct"] = """
select k1, k2, k3, k4, count(*) n_items,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) avg_price,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) total_price
from (select distinct o_orderpriority k1, cast(year(o_orderdate) as int) k2,
             cast(month(o_orderdate) as int) k3, p_type k4, o_orderkey, o_totalprice
      from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey) x
group by k1, k2, k3, k4
"""

ORACLE_SQL["build_lookup"] = """
select cast(row_number() over (order by p_brand) as int) brand_id, p_brand brand_desc
from (select distinct p_brand from part
      where p_brand is not null and length(trim(p_brand)) > 0) x
"""

ORACLE_SQL["resolve_keys"] = """
with k as (select cast(row_number() over (order by p) as int) id, p
           from (select distinct o_orderpriority p from orders where o_orderpriority < '4') x)
select o_orderkey, coalesce(id, -1) priority_id from orders left join k on o_orderpriority = p
"""

ORACLE_SQL["extend_lookup"] = """
with e as (select cast(row_number() over (order by o_custkey) as int) id, o_custkey
           from (select distinct o_custkey from orders
                 where o_orderdate < timestamp '1995-04-01' and o_custkey is not null) x),
n as (select distinct o_custkey from orders
      where o_orderdate >= timestamp '1995-04-01' and o_custkey is not null)
select id, o_custkey from e
union all
select cast(row_number() over (order by n.o_custkey) + (select max(id) from e) as int), n.o_custkey
from n left join e on n.o_custkey = e.o_custkey where e.id is null
"""

ORACLE_SQL["latest_per_key"] = """
select user_id, event_type, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
      from events) t
where rn = 1
"""

_LATEST_ORDER = """
select o_custkey, o_orderstatus, o_totalprice
from (select *, row_number() over (partition by o_custkey
                                   order by o_orderdate desc, o_orderkey desc) rn
      from orders where o_custkey is not null and {cond}) x
where rn = 1
"""

ORACLE_SQL["build_dimension"] = (
    "select cast(row_number() over (order by o_custkey) as int) cust_id, * from ("
    + _LATEST_ORDER.format(cond="true") + ") d")

ORACLE_SQL["upsert_dimension"] = (
    "with t as (select cast(row_number() over (order by o_custkey) as int) cust_id, * from ("
    + _LATEST_ORDER.format(cond="o_orderdate < timestamp '1995-04-01'") + ") d), s as ("
    + _LATEST_ORDER.format(cond="o_orderdate >= timestamp '1995-04-01'")
    + """)
select cust_id, o_custkey, o_orderstatus, o_totalprice from t
where o_custkey not in (select o_custkey from s)
union all
select t.cust_id, t.o_custkey, s.o_orderstatus, s.o_totalprice from t join s on t.o_custkey = s.o_custkey
union all
select cast(row_number() over (order by s.o_custkey) + (select max(cust_id) from t) as int),
       s.o_custkey, s.o_orderstatus, s.o_totalprice
from s left join t on s.o_custkey = t.o_custkey where t.cust_id is null
""")

_BRANDS = """
par as (select cast(row_number() over (order by p_brand) as int) brand_id, p_brand brand_desc
        from (select distinct p_brand from part
              where p_brand is not null and length(trim(p_brand)) > 0) x)
"""

ORACLE_SQL["build_child_dimension"] = "with " + _BRANDS + """
select cast(row_number() over (order by p_name nulls first, p_brand nulls first) as int) id,
       p_name, coalesce(brand_id, -1) brand_id
from (select distinct p_name, p_brand from part) x left join par on brand_desc = p_brand
"""

ORACLE_SQL["extend_child_dimension"] = "with " + _BRANDS + """,
e as (select cast(row_number() over (order by p_name nulls first, p_brand nulls first) as int) id,
             p_name, coalesce(brand_id, -1) brand_id
      from (select distinct p_name, p_brand from part where p_size <= 25) x
      left join par on brand_desc = p_brand),
n as (select p_name, p_brand, coalesce(brand_id, -1) brand_id
      from (select distinct p_name, p_brand from part) x left join par on brand_desc = p_brand),
fresh as (select n.* from n
          where not exists (select 1 from e where e.p_name = n.p_name and e.brand_id = n.brand_id))
select id, p_name, brand_id from e
union all
select cast(row_number() over (order by p_name nulls first, p_brand nulls first)
            + (select max(id) from e) as int), p_name, brand_id
from fresh
"""

ORACLE_SQL["build_bridge"] = """
with k as (select cast(row_number() over (order by p_partkey) as int) id, p_partkey
           from part where p_size <= 25)
select l_orderkey, coalesce(id, -1) part_id from lineitem left join k on l_partkey = p_partkey
"""

ORACLE_SQL["append_bridge"] = """
select l_orderkey, l_partkey from lineitem where l_shipdate < timestamp '1998-01-01'
union all
select l_orderkey, l_partkey from lineitem where l_shipdate >= timestamp '1997-01-01'
"""

ORACLE_SQL["upsert_detail"] = """
with t as (select o_orderkey, o_orderstatus, o_totalprice from orders
           where o_orderdate < timestamp '1998-01-01'),
s as (select o_orderkey, case when o_orderstatus = 'O' then 'F' else o_orderstatus end o_orderstatus,
             o_totalprice
      from orders where o_orderdate >= timestamp '1997-07-01')
select * from s
union all
select t.* from t left join s on t.o_orderkey = s.o_orderkey where s.o_orderkey is null
"""

ORACLE_SQL["check_not_empty"] = "select count(*) row_count from orders"

ORACLE_SQL["check_unique"] = """
select (select count(*) from part) row_count,
       case when (select count(*) from (select p_name from part group by p_name
                                        having count(*) > 1) d) > 0 then 0 else 1 end dup_flg
"""

ORACLE_SQL["run_checks"] = """
select 'orders_not_empty' check_name, (select count(*) from orders) <> 0 passed
union all
select 'part_name_unique', (select count(*) from part) <> 0
       and (select count(*) from (select p_name from part group by p_name having count(*) > 1) d) = 0
union all
select 'part_key_unique', (select count(*) from part) <> 0
       and (select count(*) from (select p_partkey from part group by p_partkey
                                  having count(*) > 1) d) = 0
"""

ORACLE_SQL["profile_table"] = " union all ".join(
    f"""select '{c}' col, count(*) n, count(*) - count({c}) nulls, count(distinct {c}) distincts,
       cast(min({c}) as varchar) min_value, cast(max({c}) as varchar) max_value from part"""
    for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))

ORACLE_SQL["rank_by"] = """
select p_brand, cast(sum(cast(l_quantity as decimal(18,2))) as double) total,
       cast(rank() over (order by sum(cast(l_quantity as decimal(18,2))) desc) as int) rnk
from lineitem join part on l_partkey = p_partkey
group by p_brand
"""

ORACLE_SQL["rank_by_average"] = """
select o_custkey, avg_price, cast(rank() over (order by avg_price desc) as int) rnk
from (select o_custkey,
             cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(o_totalprice) avg_price
      from orders group by o_custkey) x
"""

ORACLE_SQL["measure_by_child_count"] = """
with c as (select l_orderkey, count(*) n_children from lineitem group by l_orderkey)
select n_children, count(*) n_items,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(o_totalprice) avg_value
from orders join c on o_orderkey = l_orderkey
group by n_children
"""

ORACLE_SQL["adhoc_sql"] = """
select p_type, count(distinct l_orderkey) n_orders,
       cast(sum(cast(l_quantity as decimal(18,2))) as double) qty
from lineitem join part on l_partkey = p_partkey
group by p_type
"""

ORACLE_SQL["parse_quoted_lines"] = """
select c_custkey, concat(c_name, ', Inc') c_name, c_mktsegment from customer
"""

ORACLE_SQL["explode_documents"] = "select conv_id, role, text from conversations"

ORACLE_SQL["clean_date"] = """
select o_orderkey, case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end d
from orders
"""

ORACLE_SQL["clean_timestamp"] = "select event_id, date_trunc('second', ts) t from events"

ORACLE_SQL["clean_flag"] = """
select o_orderkey, case when o_orderstatus = 'F' then 'Y' else 'N' end f from orders
"""

ORACLE_SQL["clean_size"] = """
select p_partkey,
       case when p_size <= 16 then cast(p_size as double)
            when p_size <= 33 then p_size / 1024.0e0
            when p_size <= 40 then (p_size / 10.0e0) * 1024.0e0
            else null end mb
from part
"""

ORACLE_SQL["clean_numbers"] = """
select l_orderkey, l_linenumber, cast(trunc(l_quantity) as bigint) qty,
       cast(concat(cast(l_orderkey as varchar), '000000000001') as bigint) big,
       case when cast(concat(cast(l_orderkey as varchar), '000000000001') as bigint) > 2147483647
            then null
            else cast(concat(cast(l_orderkey as varchar), '000000000001') as integer) end big_int,
       l_discount disc
from lineitem
"""

ORACLE_SQL["app_fact"] = """
with src as (
  select 'app.' || cast(o_orderkey as varchar) app_id, o_orderpriority category,
         c_mktsegment currency, 'Dev ' || cast(c_nationkey as varchar) dev,
         case o_orderstatus when 'F' then 'Everyone' when 'O' then 'Teen' else 'Mature 17+' end cont,
         length(c_mktsegment) / 2.0e0 rating, o_custkey rating_num, o_orderkey * 1000000 max_inst,
         case when o_orderstatus = 'F' then 'Y' else 'N' end is_free,
         cast(floor(o_totalprice) as double) price,
         case when c_nationkey < 10 then cast(c_nationkey as double)
              when c_nationkey < 20 then c_nationkey / 1024.0e0 end size_mb,
         case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end rel,
         cast(o_orderdate as date) + 30 upd,
         case when c_acctbal > 0 then 'Y' else 'N' end ad,
         case when o_totalprice > 200000 then 'Y' else 'N' end iap,
         case when o_orderpriority = '1-URGENT' then 'Y' else 'N' end ec
  from orders join customer on o_custkey = c_custkey),
cat as (select cast(row_number() over (order by v) as int) id, v from (select distinct category v from src) x),
cur as (select cast(row_number() over (order by v) as int) id, v from (select distinct currency v from src) x),
cont as (select cast(row_number() over (order by v) as int) id, v from (select distinct cont v from src) x),
dev as (select cast(row_number() over (order by v) as int) id, v from (select distinct dev v from src) x),
app as (
  select src.*, coalesce(cat.id, -1) category_id, coalesce(cur.id, -1) currency_id,
         coalesce(dev.id, -1) developer_id, coalesce(cont.id, -1) cont_id
  from src left join cat on src.category = cat.v left join cur on src.currency = cur.v
  left join dev on src.dev = dev.v left join cont on src.cont = cont.v),
pl as (select 'app.' || cast(l_orderkey as varchar) app_id, p_name, p_type
       from lineitem join part on l_partkey = p_partkey),
pt as (select cast(row_number() over (order by t) as int) type_id, t
       from (select distinct p_type t from pl where p_type is not null and length(trim(p_type)) > 0) x),
perm as (
  select cast(row_number() over (order by p_name nulls first, p_type nulls first) as int) permission_id,
         p_name, coalesce(type_id, -1) type_id
  from (select distinct p_name, p_type from pl) x left join pt on p_type = t),
bridge as (
  select distinct pl.app_id, perm.permission_id
  from pl left join pt on pl.p_type = pt.t
  join perm on perm.p_name = pl.p_name and perm.type_id = coalesce(pt.type_id, -1)),
f as (
  select category_id, currency_id, developer_id,
         cast(year(coalesce(rel, upd)) as int) yr, cast(month(coalesce(rel, upd)) as int) mo,
         cont_id, perm.type_id ptype_id,
         count(distinct bridge.permission_id) Total_Num_Permissions,
         count(distinct app.app_id) Count_Of_Apps,
         sum(rating) / count(distinct app.app_id) Average_Rating,
         cast(sum(rating_num) as double) Total_Rating_Num,
         cast(sum(max_inst) as bigint) Total_Installs,
         count(distinct case when is_free = 'Y' then app.app_id end) Count_Of_Free,
         count(distinct case when is_free = 'N' then app.app_id end) Count_Of_Paid,
         sum(price) Total_Price, sum(size_mb) Total_Size_In_MB,
         count(distinct case when ad = 'Y' then app.app_id end) Count_Ad_Supported,
         count(distinct case when iap = 'Y' then app.app_id end) Count_In_App_Purchase,
         count(distinct case when ec = 'Y' then app.app_id end) Count_Of_Editor_Choice
  from app join bridge on app.app_id = bridge.app_id
  join perm on bridge.permission_id = perm.permission_id
  group by 1, 2, 3, 4, 5, 6, 7)
select cast(row_number() over (order by yr nulls first, mo nulls first, developer_id nulls first,
                               category_id nulls first, currency_id nulls first,
                               cont_id nulls first, ptype_id nulls first) as int) Auto_App_Id,
       category_id Category_Id, currency_id Currency_Type_Id, developer_id Developer_Id,
       yr Release_Year, mo Release_Month, cont_id Cont_Rating_Id, ptype_id Permission_Type_Id,
       Total_Num_Permissions, Count_Of_Apps, Average_Rating, Total_Rating_Num, Total_Installs,
       Count_Of_Free, Count_Of_Paid, Total_Price, Total_Size_In_MB, Count_Ad_Supported,
       Count_In_App_Purchase, Count_Of_Editor_Choice
from f
"""

# Reports on the derived app model (same feed derivation as app_fact).
_APP_SRC = ORACLE_SQL["app_fact"].split("cat as (")[0].rstrip().rstrip(",")

ORACLE_SQL["app_category_rank"] = _APP_SRC + """
select category Category_Desc, cast(sum(max_inst) as bigint) Total_Installs,
       cast(rank() over (order by sum(max_inst) desc) as int) Category_Rank
from src group by category
"""

ORACLE_SQL["app_developer_rank"] = _APP_SRC + """
select dev Developer_Name, sum(rating) / count(rating) Average_Rating,
       cast(rank() over (order by sum(rating) / count(rating) desc) as int) Developer_Rank
from src group by dev
"""

ORACLE_SQL["app_rating_by_permissions"] = _APP_SRC + """,
pl as (select distinct 'app.' || cast(l_orderkey as varchar) app_id, p_name, p_type
       from lineitem join part on l_partkey = p_partkey),
c as (select app_id, count(*) Num_Permissions from pl group by app_id)
select Num_Permissions, count(*) Count_Of_Apps, sum(rating) / count(rating) Average_Rating
from src join c on src.app_id = c.app_id
group by Num_Permissions
"""

_APP_PL = _APP_SRC + """,
pl as (select distinct 'app.' || cast(l_orderkey as varchar) app_id, p_name, p_type
       from lineitem join part on l_partkey = p_partkey)"""

ORACLE_SQL["app_rating_by_permission"] = _APP_PL + """
select p_name Permisison_Desc, count(*) Count_Of_Apps, sum(rating) / count(rating) Average_Rating
from src join (select distinct app_id, p_name from pl) p on src.app_id = p.app_id
group by p_name
"""

ORACLE_SQL["app_rating_by_permission_type"] = _APP_PL + """
select p_type Permission_Type_Desc, count(*) Count_Of_Apps, sum(rating) / count(rating) Average_Rating
from src join (select distinct app_id, p_type from pl) p on src.app_id = p.app_id
group by p_type
"""

ORACLE_SQL["parse_rejects"] = """
select cast(c_custkey as varchar) || ',"' || c_name || ', Inc"' line, 2 n_fields
from customer where c_custkey % 7 = 0
"""

ORACLE_SQL["corrupt_documents"] = """
select cast(c_custkey as varchar) "appId", c_mktsegment permission, cast(null as varchar) line
from customer where c_custkey % 5 <> 0
union all
select null, null, '{"appId":"' || c_custkey || '","appName":"' || c_name
  || '","allPermissions":[{"permission":"' || c_mktsegment || '","type":"x"}'
from customer where c_custkey % 5 = 0
"""

ORACLE_SQL["load_fact"] = ORACLE_SQL["app_fact"]

ORACLE_SQL["load_counts"] = """
with app as (select o_orderpriority, o_orderstatus, c_mktsegment, c_nationkey
             from orders join customer on o_custkey = c_custkey),
pl as (select distinct l_orderkey, p_name, p_type from lineitem join part on l_partkey = p_partkey),
counts as (
  select 'APP' what, count(*) n from app
  union all select 'APP_CATEGORY', count(distinct o_orderpriority) from app
  union all select 'CONTENT_RATING', count(distinct o_orderstatus) from app
  union all select 'DEVELOPER', count(distinct c_nationkey) from app
  union all select 'CURRENCY_TYPE', count(distinct c_mktsegment) from app
  union all select 'APP_PERMISSION', count(*) from pl
  union all select 'PERMISSION', count(*) from (select distinct p_name, p_type from pl) x
  union all select 'PERMISSION_TYPE', count(distinct p_type) from pl),
checks(what, n) as (values
  ('APP_FACT not empty', 1), ('APP_CATEGORY_DIM not empty', 1), ('APP_CATEGORY_DIM unique Category_Desc', 1),
  ('CURRENCY_TYPE_DIM not empty', 1), ('CURRENCY_TYPE_DIM unique Currency_Type_Desc', 1),
  ('DEVELOPER_DIM not empty', 1), ('DEVELOPER_DIM unique Developer_Name', 1),
  ('CONTENT_RATING_DIM not empty', 1), ('CONTENT_RATING_DIM unique Cont_Rating_Desc', 1),
  ('PERMISSION_TYPE_DIM not empty', 1), ('PERMISSION_TYPE_DIM unique Permission_Type_Desc', 1),
  ('APP_FACT values kept', 1), ('APP_CATEGORY_DIM values kept', 1), ('CURRENCY_TYPE_DIM values kept', 1),
  ('DEVELOPER_DIM values kept', 1), ('CONTENT_RATING_DIM values kept', 1), ('PERMISSION_TYPE_DIM values kept', 1),
  ('APP_REJECTS empty', 0), ('PERMISSION_REJECTS empty', 0))
select what, cast(n as bigint) n from counts
union all select 'warehouse ' || what || '_DIM', cast(n as bigint) from counts
  where what not in ('APP', 'APP_PERMISSION', 'PERMISSION')
union all select what, cast(n as bigint) from checks
union all select 'APP_REJECTS', count(*) from nation
union all select 'PERMISSION_REJECTS', count(*) from region
union all select 'warehouse APP_FACT', count(*) from (""" + ORACLE_SQL["app_fact"] + """)
"""

ORACLE_SQL["load_fact_increment"] = "select * exclude (Auto_App_Id) from (" + ORACLE_SQL["app_fact"] + ")"

ORACLE_SQL["rollup_fact_versions"] = """
select l_returnflag k, count(distinct l_orderkey) n_items,
  (select cast(sum(m) as double) from (select max(cast(l_quantity as decimal(18,2))) m from lineitem b
     where b.l_returnflag = a.l_returnflag group by b.l_orderkey) x) total,
  (select cast(sum(m) as double) from (select max(cast(l_quantity as decimal(18,2))) m from lineitem b
     where b.l_returnflag = a.l_returnflag group by b.l_orderkey) x) / count(distinct l_orderkey) mean,
  count(distinct case when l_linestatus = 'O' then l_orderkey end) n_open,
  count(distinct case when l_linestatus = 'F' then l_orderkey end) n_done
from lineitem a group by l_returnflag
"""

ORACLE_SQL["child_dimension_blank_parents"] = "with " + _BRANDS + """,
typed as (
  select p_name, brand, coalesce(brand_id, -1) brand_id from (
    select distinct p_name, case when p_size % 3 = 0 then null when p_size % 3 = 1 then '' else p_brand end brand from part) x
  left join par on brand_desc = brand),
pairs as (select p_name, brand_id, case when count(*) > count(brand) then null else min(brand) end low
          from typed group by p_name, brand_id)
select cast(row_number() over (order by p_name nulls first, low nulls first, brand_id) as int) id, p_name, brand_id from pairs
"""

ORACLE_SQL["upsert_detail_keys"] = """
with old as (select nullif(c_custkey, 7) k, cast(0 as bigint) v from customer),
new as (select case when o_orderkey % 10 <> 0 then o_custkey end k, o_orderkey v from orders)
select k, max(v) v from new group by k
union all
select k, v from old where not exists (select 1 from new where new.k is not distinct from old.k)
"""
