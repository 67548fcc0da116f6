"""End-to-end app-store model on small hand-made feeds (initial + incremental)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starloom.plans import app_store
from starloom.sources.lake import current_path, read_table
from starloom.sources.text import APP_COLUMNS, read_app_feed

HEADER = ("App Name,App Id,Category,Rating,Rating Count,Installs,Minimum Installs,"
          "Maximum Installs,Free,Price,Currency,Size,Minimum Android,Developer Id,"
          "Developer Website,Developer Email,Released,Last Updated,Content Rating,"
          "Privacy Policy,Ad Supported,In App Purchases,Editors Choice,Scraped Time")

RUN1 = [
    HEADER,
    'Plain App,com.x.plain,Tools,4.5,10,"1,000+",1000,1500,True,0.0,USD,15M,5.0 and up,'
    'Dev A,http://a,a@a,"Jan 5, 2020","Feb 11, 2021",Everyone,http://p,True,False,False,'
    '2021-06-15 20:19:35',
    '"Say ""hi"", now",com.x.q,Tools,,,"0+",0.0,5,False,1.99,EUR,900k,4.1 and up,Dev B,,b@b,,'
    '"Mar 1, 2021",Teen,,False,True,False,2021-06-15 20:19:36',
    'Big App,com.x.big,Games,3.0,5,"5,000,000,000+",5000000000,6000000000,True,0,USD,1.2G,8.0,'
    'Dev A,http://a2,a2@a,"Jan 1, 2019","Mar 3, 2021",Everyone,,False,False,True,'
    '2021-06-15 20:19:37',
    'Blank Cat,com.x.blank,   ,2.0,1,"1+",1,1,False,0.5,USD,Varies with device,4.0,Dev C,,,'
    ',"Apr 2, 2021",Everyone,,False,False,False,2021-06-15 20:19:38',
    ",".join(["short"] * 23),
]

PERMS1 = [
    {"appId": "com.x.plain", "appName": "Plain App", "allPermissions": [
        {"permission": "read contacts", "type": "Contacts"},
        {"permission": "full network access", "type": "Other"}]},
    {"appId": "com.x.q", "appName": "Q", "allPermissions": []},
    {"appId": "com.x.n", "appName": "N"},
    {"appId": "com.x.big", "appName": "Big", "allPermissions": [
        {"permission": "read contacts", "type": "Contacts"},
        {"permission": "read contacts", "type": "Personal"},
        {"permission": "full network access", "type": "Other"},
        {"permission": "full network access", "type": "Other"}]},
]

RUN2 = [
    HEADER,
    'Plain App,com.x.plain,Tools,4.0,12,"1,000+",1000,1700,True,0.0,USD,16M,5.0 and up,'
    'Dev A,http://a3,a3@a,"Jan 5, 2020","May 1, 2021",Everyone,http://p,True,False,False,'
    '2021-07-15 20:19:35',
    'New App,com.x.new,Art,4.9,2,"10+",10,20,False,2.5,GBP,3M,6.0,Dev D,http://d,d@d,'
    '"Jun 1, 2021","Jun 2, 2021",Everyone,,False,False,False,2021-07-15 20:19:36',
]

PERMS2 = [
    {"appId": "com.x.new", "appName": "New", "allPermissions": [
        {"permission": "camera", "type": "Camera"},
        {"permission": "read contacts", "type": "Contacts"}]},
]

# The fact's formulas item by item: each app's permissions per type, then sums over apps.
FACT_BY_APP = """
with per_app as (
  select a.*, p.Permission_Type_Id as ptype, count(*) as copies
  from APP a, APP_PERMISSION b, PERMISSION p
  where b.App_Id = a.App_Id and p.Permission_Id = b.Permission_Id
  group by all),
kinds as (
  select a.Category_Id c1, a.Currency_Type_Id c2, a.Developer_Id c3, coalesce(a.Release_Dt, a.Last_Update_Dt) day,
         a.Cont_Rating_Id c4, p.Permission_Type_Id c5, p.Permission_Id
  from APP a, APP_PERMISSION b, PERMISSION p
  where b.App_Id = a.App_Id and p.Permission_Id = b.Permission_Id),
permissions as (select c1, c2, c3, year(day) y, month(day) m, c4, c5, count(distinct Permission_Id) n from kinds group by all),
apps as (
  select Category_Id c1, Currency_Type_Id c2, Developer_Id c3, year(coalesce(Release_Dt, Last_Update_Dt)) y,
         month(coalesce(Release_Dt, Last_Update_Dt)) m, Cont_Rating_Id c4, ptype c5, count(*) n_apps,
         sum(Rating * copies) ratings, cast(sum(Rating_Num * copies) as double) votes, sum(Maximum_Installs * copies) installs,
         count_if(Is_Free = 'Y') free, count_if(Is_Free = 'N') paid, sum(Price * copies) price, sum(Size_In_MB * copies) mb,
         count_if(Is_Ad_Supported = 'Y') ads, count_if(Is_In_App_Purchase = 'Y') purchase, count_if(Is_Editor_Choice = 'Y') choice
  from per_app group by all)
select a.c1, a.c2, a.c3, a.y, a.m, a.c4, a.c5, p.n, n_apps, ratings / n_apps, votes, installs, free, paid, price, mb, ads, purchase, choice
from apps a join permissions p on a.c1 = p.c1 and a.c2 = p.c2 and a.c3 = p.c3 and a.y = p.y and a.m = p.m and a.c4 = p.c4 and a.c5 = p.c5
"""


def _write(folder, name, lines=None, docs=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        if lines is not None:
            f.write("\n".join(lines) + "\n")
        else:
            f.write(json.dumps(docs, indent=1))
    return path


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    feeds = os.path.join(base, "feeds")
    root = os.path.join(base, "dl")
    wh = os.path.join(base, "wh")
    apps = _write(feeds, "apps1.csv", lines=RUN1)
    perms = _write(feeds, "perms1.json", docs=PERMS1)
    checks = app_store.run_all(spark, apps, perms, root, wh)
    return {"base": base, "root": root, "wh": wh, "feeds": feeds, "checks": checks}


def t(spark, lake, name):
    return read_table(spark, os.path.join(lake["root"], name))


def test_parse_rejects_short_line(spark, lake):
    records, rejects = read_app_feed(spark, os.path.join(lake["feeds"], "apps1.csv"))
    assert records.count() == 4
    assert [r.n_fields for r in rejects.collect()] == [23]
    assert records.columns == APP_COLUMNS


def test_app_detail(spark, lake):
    app = {r.App_Id: r for r in t(spark, lake, "APP").collect()}
    assert set(app) == {"com.x.plain", "com.x.q", "com.x.big", "com.x.blank"}
    assert app["com.x.q"].App_Name == 'Say ""hi"", now'
    assert app["com.x.q"].Size_In_MB == pytest.approx(900 / 1024)
    assert app["com.x.big"].Size_In_MB == pytest.approx(1.2 * 1024)
    assert app["com.x.blank"].Size_In_MB is None
    assert app["com.x.big"].Maximum_Installs == 6_000_000_000
    assert app["com.x.q"].Rating is None and app["com.x.q"].Release_Dt is None
    assert app["com.x.blank"].Category_Id == -1
    assert app["com.x.plain"].Is_Free == "Y" and app["com.x.q"].Is_Free == "N"
    assert str(app["com.x.plain"].Release_Dt) == "2020-01-05"


def test_lookups_and_developer(spark, lake):
    cats = {r.Category_Desc: r.Category_Id for r in t(spark, lake, "APP_CATEGORY").collect()}
    assert cats == {"Games": 1, "Tools": 2}
    dev = {r.Developer_Name: r for r in t(spark, lake, "DEVELOPER").collect()}
    assert dev["Dev A"].Developer_Website == "http://a2"  # newest Last_Updated wins
    assert sorted(r.Developer_Id for r in dev.values()) == [1, 2, 3]


def test_permissions_and_bridge(spark, lake):
    types = {r.Permission_Type_Desc: r.Permission_Type_Id
             for r in t(spark, lake, "PERMISSION_TYPE").collect()}
    assert types == {"Contacts": 1, "Other": 2, "Personal": 3}
    perm = sorted((r.Permission_Id, r.Permisison_Desc, r.Permission_Type_Id)
                  for r in t(spark, lake, "PERMISSION").collect())
    assert perm == [(1, "full network access", 2), (2, "read contacts", 1),
                    (3, "read contacts", 3)]
    bridge = sorted((r.App_Id, r.Permission_Id) for r in t(spark, lake, "APP_PERMISSION").collect())
    assert bridge == [("com.x.big", 1), ("com.x.big", 2), ("com.x.big", 3),
                      ("com.x.plain", 1), ("com.x.plain", 2)]


def test_fact_equals_its_formulas(spark, lake):
    for name in ("APP", "APP_PERMISSION", "PERMISSION"):
        t(spark, lake, name).createOrReplaceTempView(name)
    expected = sorted(tuple(r) for r in spark.sql(FACT_BY_APP).collect())
    fact = t(spark, lake, "APP_FACT")
    got = sorted(tuple(r) for r in fact.drop("Auto_App_Id").collect())
    assert got == expected
    ids = sorted(r.Auto_App_Id for r in fact.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_warehouse_checks_pass(spark, lake):
    rows = lake["checks"].collect()
    failed = [r.check for r in rows if not r.passed]
    assert len(rows) == 19 and failed == ["APP_REJECTS empty"]   # the short line
    assert [(r.table_name, r.n_rejects) for r in app_store.reject_counts(spark, lake["root"]).collect()] == [
        ("APP_REJECTS", 1), ("PERMISSION_REJECTS", 0)]
    wh_fact = read_table(spark, os.path.join(lake["wh"], "APP_FACT"))
    assert dict(wh_fact.dtypes)["Auto_App_Id"] == "int"
    assert dict(wh_fact.dtypes)["Total_Installs"] == "bigint"


def test_incremental_run_keeps_ids(spark, lake):
    root = lake["root"]
    before_cat = {r.Category_Desc: r.Category_Id for r in t(spark, lake, "APP_CATEGORY").collect()}
    before_perm = {(r.Permisison_Desc, r.Permission_Type_Id): r.Permission_Id
                   for r in t(spark, lake, "PERMISSION").collect()}
    apps = _write(lake["feeds"], "apps2.csv", lines=RUN2)
    perms = _write(lake["feeds"], "perms2.json", docs=PERMS2)
    app_store.load_app_layer(spark, apps, root)
    app_store.load_permission_layer(spark, perms, root)
    app_store.load_fact_layer(spark, root)

    cats = {r.Category_Desc: r.Category_Id for r in t(spark, lake, "APP_CATEGORY").collect()}
    assert {k: cats[k] for k in before_cat} == before_cat
    assert cats["Art"] == 3
    dev = {r.Developer_Name: r for r in t(spark, lake, "DEVELOPER").collect()}
    assert dev["Dev A"].Developer_Website == "http://a3" and dev["Dev A"].Developer_Id == 1
    assert dev["Dev D"].Developer_Id == 4 and "Dev B" in dev
    app = {r.App_Id: r for r in t(spark, lake, "APP").collect()}
    assert len(app) == 5 and app["com.x.plain"].Maximum_Installs == 1700
    assert app["com.x.q"].Maximum_Installs == 5  # untouched app kept
    perm = {(r.Permisison_Desc, r.Permission_Type_Id): r.Permission_Id
            for r in t(spark, lake, "PERMISSION").collect()}
    assert {k: perm[k] for k in before_perm} == before_perm
    assert perm[("camera", 4)] == 4
    bridge = t(spark, lake, "APP_PERMISSION")
    assert bridge.count() == 7
    assert bridge.where(F.col("App_Id") == "com.x.new").count() == 2


def test_fact_partitioned_by_year_prunes(spark, lake, tmp_path):
    root = str(tmp_path / "dl2")
    import shutil
    for name in ("APP", "APP_PERMISSION", "PERMISSION"):
        shutil.copytree(os.path.join(lake["root"], name), os.path.join(root, name))
    app_store.load_fact_layer(spark, root, partition_by=["Release_Year"])
    fact = read_table(spark, os.path.join(root, "APP_FACT"))
    one_year = fact.where(F.col("Release_Year") == 2020)
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Release_Year" in plan
    assert one_year.count() == t(spark, lake, "APP_FACT").where("Release_Year = 2020").count()


def test_bucketed_incremental_app_matches_full_rewrite(spark, lake, tmp_path):
    feeds = lake["feeds"]
    root = str(tmp_path / "dl_b")
    opts = app_store.Options(app_buckets=4)
    for name in ("apps1.csv", "apps2.csv"):
        app_store.load_app_layer(spark, os.path.join(feeds, name), root, opts)
    bucketed = read_table(spark, os.path.join(root, "APP")).drop("_bucket")
    full = t(spark, lake, "APP")
    cols = sorted(full.columns)
    assert sorted(map(tuple, bucketed.select(cols).collect()), key=repr) == \
        sorted(map(tuple, full.select(cols).collect()), key=repr)


def test_permissions_matched_by_description_only(spark, lake, tmp_path):
    """``by_description``: a text listed under two types gives every app both ids."""
    root = str(tmp_path / "dl_d")
    app_store.load_permission_layer(spark, os.path.join(lake["feeds"], "perms1.json"), root, app_store.Options(by_description=True))
    bridge = sorted((r.App_Id, r.Permission_Id) for r in read_table(spark, os.path.join(root, "APP_PERMISSION")).collect())
    assert bridge == [("com.x.big", 1), ("com.x.big", 2), ("com.x.big", 3), ("com.x.plain", 1), ("com.x.plain", 2), ("com.x.plain", 3)]


def test_renumbered_permissions(spark, lake, tmp_path):
    """``renumber_permissions``: the second delivery's pairs get new ids, the old rows go."""
    root = str(tmp_path / "dl_r")
    opts = app_store.Options(renumber_permissions=True)
    for name in ("perms1.json", "perms2.json"):
        app_store.load_permission_layer(spark, _write(lake["feeds"], name, docs=PERMS1 if "1" in name else PERMS2), root, opts)
    perm = sorted((r.Permission_Id, r.Permisison_Desc) for r in read_table(spark, os.path.join(root, "PERMISSION")).collect())
    assert perm == [(4, "camera"), (5, "read contacts")]
    assert current_path(spark, os.path.join(root, "PERMISSION")).split("/")[-1].startswith("v0000000002")


def _order_tables(spark, scratch):
    """Twelve orders of three lines each, and what the derived feeds join to them."""
    tables = {"orders": ([(n, n % 2 + 1, "OFP"[n % 3], 10.5 * n, "1-URGENT") for n in range(1, 13)],
                         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
              "customer": ([(1, "A", 3, 1.0, "AUTO"), (2, "B", 12, -1.0, "HOME")],
                           "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
              "lineitem": ([(n, 10, line) for n in range(1, 13) for line in (1, 2, 4)], "l_orderkey long, l_partkey long, l_linenumber int"),
              "part": ([(10, "p", "x")], "p_partkey long, p_name string, p_type string"),
              "nation": ([(n,) for n in range(3)], "n_nationkey int"), "region": ([("EU",), ("ASIA",)], "r_name string")}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", F.lit("1996-01-02").cast("timestamp_ntz"))
        df.write.parquet(f"{scratch}/{name}.parquet")


def test_a_delivery_is_made_in_its_turn_and_goes_once_it_is_loaded(spark, scratch, monkeypatch):
    """Compressed, in files of few lines, every line of the derived feeds; one delivery on disk at a time."""
    import glob
    import gzip

    from starloom.plans import catalog

    _order_tables(spark, scratch)
    seen, bases = [], []

    def run_all(spark, apps, documents, root, warehouse, opts, multiline):
        base = os.path.dirname(apps.removeprefix("file:"))
        bases.append(base)
        text = {}
        for name in os.listdir(base):
            files = glob.glob(f"{base}/{name}/part-*")
            assert files and all(f.endswith(".gz") for f in files)
            lines = [gzip.open(f, "rt").read().splitlines() for f in files]
            assert max(map(len, lines)) <= 5
            text[name] = sorted(x for one in lines for x in one)
        seen.append(text)

    monkeypatch.setattr(catalog, "run_all", run_all)
    monkeypatch.setattr(catalog, "TASK_ROWS", 5)
    catalog._load(spark, scratch)
    apps = [r[0] for r in catalog.app_feed_lines(spark, scratch).collect()]
    docs = [r[0] for r in catalog.permission_documents(spark, scratch).collect()]
    early = {f"app.{n}" for n in (1, 2, 3, 4, 10, 11, 12)}
    assert seen[0] == {"apps1": sorted(a for a in apps if a.startswith("App Name") or a.split(",")[2] in early),
                       "docs1": sorted(d for d in docs if json.loads(d)["appId"] in early)}
    assert seen[1] == {"apps2": sorted([*apps, *[f"cut,{n}" for n in range(3)]]),
                       "docs2": sorted([*docs, *[f'{{"appId":"{r}' for r in ("EU", "ASIA")]])}
    assert not os.path.exists(bases[0]) or os.listdir(bases[0]) == []


def test_load_counts_leaves_the_tables_and_no_feeds(spark, scratch, monkeypatch):
    from starloom.plans import catalog

    _order_tables(spark, scratch)
    base = os.path.join(scratch, "load")
    monkeypatch.setattr(catalog, "_scratch", lambda spark, name: base)
    got = {r["what"]: r["n"] for r in catalog.q_load_counts(spark, scratch).collect()}
    assert sorted(os.listdir(base)) == ["lake", "warehouse"]
    want = {"APP": 12, "APP_CATEGORY": 1, "CONTENT_RATING": 3, "DEVELOPER": 2, "CURRENCY_TYPE": 2, "APP_PERMISSION": 12, "PERMISSION": 1,
            "PERMISSION_TYPE": 1, "APP_REJECTS": 3, "PERMISSION_REJECTS": 2, "APP_FACT not empty": 1, "APP_REJECTS empty": 0}
    assert {k: got.get(k) for k in want} == want and len(got) == 35
