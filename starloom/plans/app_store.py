"""The app-store model end to end: feeds -> detail snowflake -> star fact ->
warehouse tables + checks (C22, C23, fact layer, C16, C19).

Every step is a library operator; this module only supplies the model's
names and column rules. Tables live under one lake root as Parquet folders
and each is replaced through a staged publish, so a run can read the
previous version of a table it is rewriting (incremental loads).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..functions.clean import (clean_date, clean_double, clean_flag, clean_int_parity,
                               clean_long, clean_size, clean_timestamp)
from ..operators.bridge import append_bridge, build_bridge
from ..operators.detail import KeyMap, build_detail, resolve_keys, upsert_detail
from ..operators.dimensions import (build_child_dimension, build_dimension,
                                    extend_child_dimension, upsert_dimension)
from ..operators.ids import dense_ids
from ..operators.joins import carry_known
from ..operators.lookups import build_lookup, build_lookups, extend_lookup
from ..operators.quality import check_not_empty, check_unique, run_checks
from ..operators.refresh import FactSpec, Refresh, refresh_fact
from ..operators.ranks import measure_by_child, measure_by_child_count, rank_by
from ..sources.documents import permission_rows_of, read_permission_documents
from ..sources.lake import (StarReport, append_rows, publish_star, publish_table, read_if_exists, read_star,
                            read_table, table_exists, upsert_buckets)
from ..session import checkpoint_dir, free_finished
from ..sources.text import APP_COLUMNS, APP_HEADER_PREFIX, parse_lines, read_lines


@dataclass(frozen=True)
class LakeNames:
    """Lake and warehouse table names (fixed values of the model)."""
    app: str = "APP"
    category: str = "APP_CATEGORY"
    content_rating: str = "CONTENT_RATING"
    developer: str = "DEVELOPER"
    currency: str = "CURRENCY_TYPE"
    app_permission: str = "APP_PERMISSION"
    permission: str = "PERMISSION"
    permission_type: str = "PERMISSION_TYPE"
    app_fact: str = "APP_FACT"
    app_rejects: str = "APP_REJECTS"
    permission_rejects: str = "PERMISSION_REJECTS"
    warehouse: dict = field(default_factory=lambda: {
        "APP_FACT": "APP_FACT",
        "APP_CATEGORY": "APP_CATEGORY_DIM",
        "CONTENT_RATING": "CONTENT_RATING_DIM",
        "DEVELOPER": "DEVELOPER_DIM",
        "CURRENCY_TYPE": "CURRENCY_TYPE_DIM",
        "PERMISSION_TYPE": "PERMISSION_TYPE_DIM",
    })


@dataclass(frozen=True)
class Options:
    """Choices between the source's behaviour and the corrected one."""
    size_parity: bool = False        # True: '900k' -> 900 (drop last char)
    int_parity: bool = False         # True: installs beyond 2^31-1 -> NULL
    by_description: bool = False     # True: bridge matches permission text only
    renumber_permissions: bool = False  # True: source renumbering of PERMISSION
    dedupe_bridge: bool = True       # enforce the (app, permission) key
    incremental_app: bool = True     # upsert APP instead of replacing it
    app_buckets: int | None = None   # store APP hash-bucketed; loads write changed buckets only
    fact_buckets: int | None = None  # store APP_FACT hash-bucketed; loads write touched groups only


NAMES = LakeNames()

# Lookup tables: (source column, table, id column, description column).
LOOKUPS = [
    ("Category", "category", "Category_Id", "Category_Desc"),
    ("Content_Rating", "content_rating", "Cont_Rating_Id", "Cont_Rating_Desc"),
    ("Currency", "currency", "Currency_Type_Id", "Currency_Type_Desc"),
]

# The permission table keeps the source's column spelling so existing
# queries keep working (fixed value).
PERMISSION_DESC = "Permisison_Desc"


# Of several versions of one app in a delivery the newest one is taken.
APP_NEWEST = ("Last_Update_Dt", "Scrapped_Dttm")


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder, and read again."""
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a staged frame's files once nothing reads it any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def clean_dates(records: DataFrame) -> DataFrame:
    """Parse the three date/time columns of the feed once."""
    return records.withColumns({
        "Released": clean_date("Released"),
        "Last_Updated": clean_date("Last_Updated"),
        "Scraped_Time": clean_timestamp("Scraped_Time"),
    })


def app_columns(opts: Options) -> list[tuple[str, F.Column]]:
    """C7 column rules of APP (21 columns, output order)."""
    installs = clean_int_parity if opts.int_parity else clean_long
    return [
        ("App_Id", F.col("App_Id")),
        ("App_Name", F.col("App_Name")),
        ("Category_Id", F.col("Category_Id")),
        ("Rating", clean_double("Rating")),
        ("Rating_Num", clean_long("Rating_Count")),
        ("Minimum_Installs", installs("Minimum_Installs")),
        ("Maximum_Installs", installs("Maximum_Installs")),
        ("Is_Free", clean_flag("Free")),
        ("Price", clean_double("Price")),
        ("Currency_Type_Id", F.col("Currency_Type_Id")),
        ("Size_In_MB", clean_size("Size", parity=opts.size_parity)),
        ("Supp_OS_Version", F.col("Minimum_Android")),
        ("Developer_Id", F.col("Developer_Key")),
        ("Release_Dt", F.col("Released")),
        ("Last_Update_Dt", F.col("Last_Updated")),
        ("Cont_Rating_Id", F.col("Cont_Rating_Id")),
        ("Privacy_Policy", F.col("Privacy_Policy")),
        ("Is_Ad_Supported", clean_flag("Ad_Supported")),
        ("Is_In_App_Purchase", clean_flag("In_App_Purchases")),
        ("Is_Editor_Choice", clean_flag("Editors_Choice")),
        ("Scrapped_Dttm", F.col("Scraped_Time")),
    ]


def app_dimensions(records: DataFrame, existing: dict[str, DataFrame | None] | None = None
                   ) -> dict[str, DataFrame]:
    """DEVELOPER and the lookups from cleaned records; each extends or
    upserts its previous version when ``existing`` holds one. The developer
    dimension and the lookups are independent and built side by side."""
    existing = existing or {}

    def developer() -> DataFrame:
        attrs = ["Developer_Website", "Developer_Email"]
        src = records.select(F.col("Developer_Id").alias("Developer_Name"), *attrs,
                             "Last_Updated")
        old_dev = existing.get(NAMES.developer)
        if old_dev is None:
            return build_dimension(src, "Developer_Name", attrs, ["Last_Updated"],
                                   "Developer_Id")
        return upsert_dimension(old_dev, src, "Developer_Name", attrs, ["Last_Updated"],
                                "Developer_Id")

    def lookups() -> dict[str, DataFrame]:
        fresh = [(col, id_col, desc_col) for col, attr, id_col, desc_col in LOOKUPS
                 if existing.get(getattr(NAMES, attr)) is None]
        built = build_lookups(records, fresh) if fresh else {}
        out = {}
        for col, attr, id_col, desc_col in LOOKUPS:
            name = getattr(NAMES, attr)
            old = existing.get(name)
            out[name] = built[col] if old is None else extend_lookup(old, records, col, id_col,
                                                                      desc_col)
        return out

    with ThreadPoolExecutor(max_workers=2) as pool:
        dev_job, lookup_job = pool.submit(developer), pool.submit(lookups)
        return {NAMES.developer: dev_job.result(), **lookup_job.result()}


def key_maps(dims: Mapping[str, DataFrame]) -> list[KeyMap]:
    """How APP's keys resolve, for the dimensions given."""
    maps = [KeyMap(col, dims[getattr(NAMES, attr)], desc_col, id_col)
            for col, attr, id_col, desc_col in LOOKUPS if getattr(NAMES, attr) in dims]
    if NAMES.developer in dims:
        maps.append(KeyMap("Developer_Id", dims[NAMES.developer], "Developer_Name",
                           "Developer_Id", out="Developer_Key"))
    return maps


def app_detail(records: DataFrame, dims: dict[str, DataFrame], opts: Options = Options(),
               existing: DataFrame | None = None) -> DataFrame:
    """APP (C7) from cleaned records and the dimensions; upserted into
    ``existing`` by ``App_Id`` when given."""
    app = build_detail(records, key_maps(dims), app_columns(opts))
    if existing is not None and opts.incremental_app:
        app = upsert_detail(existing, app, "App_Id", APP_NEWEST)
    return app


def permission_types(perms: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """PERMISSION_TYPE (C1/C2) from flattened rows."""
    if existing is None:
        return build_lookup(perms, "type", "Permission_Type_Id", "Permission_Type_Desc")
    return extend_lookup(existing, perms, "type", "Permission_Type_Id", "Permission_Type_Desc")


def permissions(perms: DataFrame, ptype: DataFrame, opts: Options = Options(),
                existing: DataFrame | None = None) -> DataFrame:
    """PERMISSION (C8/C9) from flattened rows and the type table."""
    if existing is None:
        return build_child_dimension(perms, "permission", "type", ptype, "Permission_Type_Desc",
                                     "Permission_Type_Id", "Permission_Id", child_name=PERMISSION_DESC)
    return extend_child_dimension(existing, perms, "permission", "type", ptype,
                                  "Permission_Type_Desc", "Permission_Type_Id", "Permission_Id",
                                  existing_child=PERMISSION_DESC,
                                  keep_existing=not opts.renumber_permissions)


def app_permission(perms: DataFrame, ptype: DataFrame, perm: DataFrame,
                   opts: Options = Options(), existing: DataFrame | None = None) -> DataFrame:
    """APP_PERMISSION (C10/C11): (App_Id, Permission_Id) matched on
    (permission, type id) -- or on the text alone with ``by_description``."""
    typed = resolve_keys(perms, [KeyMap("type", ptype, "Permission_Type_Desc",
                                        "Permission_Type_Id", out="_type_id")])
    match = [("permission", PERMISSION_DESC)]
    if not opts.by_description:
        match.append(("_type_id", "Permission_Type_Id"))
    bridge = build_bridge(typed, "appId", match, perm, "Permission_Id", item_name="App_Id")
    if existing is not None:
        return append_bridge(existing, bridge, dedupe=opts.dedupe_bridge)
    return bridge.distinct() if opts.dedupe_bridge else bridge


# Where an APP column's key comes from: (dimension, its source column); the others copy or clean one column.
KEY_DIMENSIONS = {id_col: (getattr(NAMES, attr), col) for col, attr, id_col, _ in LOOKUPS} | {
    "Developer_Id": (NAMES.developer, "Developer_Id")}


class Model(Mapping):
    """The lake tables but APP_FACT as frames (initial load), each built when it is first asked for.

    ``app_columns`` names the columns of APP that are wanted (all by default):
    only the dimensions behind them are built and only their inputs parsed.
    The parsed inputs, APP and APP_PERMISSION are staged as Parquet in the
    shared folder and read again with the columns each step needs, so each
    feed is parsed once and a lost executor costs no second parse.
    """

    def __init__(self, records: DataFrame, perms: DataFrame, opts: Options = Options(),
                 app_columns: Sequence[str] | None = None):
        self.records, self.perms, self.opts, self.app_columns = records, perms, opts, app_columns
        self._made: dict[str, DataFrame] = {}
        self._locks = {name: RLock() for name in (*self, "records", "perms")}

    def __iter__(self):
        return iter([NAMES.developer, *[getattr(NAMES, attr) for _, attr, _, _ in LOOKUPS], NAMES.app,
                     NAMES.permission_type, NAMES.permission, NAMES.app_permission])

    def __len__(self):
        return len(list(iter(self)))

    def _once(self, name: str, make) -> DataFrame:
        with self._locks[name]:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def _cleaned(self) -> DataFrame:
        def make():
            if self.app_columns is None:
                return stage(clean_dates(self.records))
            # keys stay text until they are resolved, the other columns' rules apply at once
            keys = [KEY_DIMENSIONS[c][1] for c in self.app_columns if c in KEY_DIMENSIONS]
            rules = dict(app_columns(self.opts))
            plain = [rules[c].alias(c) for c in self.app_columns if c not in KEY_DIMENSIONS]
            return stage(clean_dates(self.records).select(*dict.fromkeys(keys), *plain))
        return self._once("records", make)

    def _dims(self) -> list[str]:
        return list(dict.fromkeys(KEY_DIMENSIONS[c][0] for c in self.app_columns if c in KEY_DIMENSIONS))

    def _app(self) -> DataFrame:
        if self.app_columns is None:
            return stage(app_detail(self._cleaned(), self, self.opts))
        resolved = resolve_keys(self._cleaned(), key_maps({n: self[n] for n in self._dims()}))
        return resolved.select(*["Developer_Key" if c == "Developer_Id" else c for c in self.app_columns]).withColumnsRenamed(
            {"Developer_Key": "Developer_Id"})

    def _dimension(self, name: str) -> DataFrame:
        if self.app_columns is None:
            self._made.update(app_dimensions(self._cleaned()))
            return self._made[name]
        for col, attr, id_col, desc_col in LOOKUPS:
            if getattr(NAMES, attr) == name:
                return build_lookup(self._cleaned(), col, id_col, desc_col)
        # a report reads the developers' names and ids, which no attribute changes
        return build_lookup(self._cleaned(), "Developer_Id", "Developer_Id", "Developer_Name")

    def _rows(self) -> DataFrame:
        return self._once("perms", lambda: stage(self.perms))

    def __getitem__(self, name: str) -> DataFrame:
        if name == NAMES.app:
            return self._once(name, self._app)
        if name == NAMES.permission_type:
            return self._once(name, lambda: permission_types(self._rows()))
        if name == NAMES.permission:
            return self._once(name, lambda: permissions(self._rows(), self[NAMES.permission_type], self.opts))
        if name == NAMES.app_permission:
            return self._once(name, lambda: stage(app_permission(
                self._rows(), self[NAMES.permission_type], self[NAMES.permission], self.opts)))
        if name not in self._locks:
            raise KeyError(name)
        with self._locks[NAMES.developer]:  # with all columns one pass builds every dimension
            return self._once(name, lambda: self._dimension(name))

    def side_by_side(self, *names: str) -> list[DataFrame]:
        """Several tables, built at the same time where they don't need each other."""
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            return list(pool.map(self.__getitem__, names))


def build_model(records: DataFrame, perms: DataFrame, opts: Options = Options()) -> Model:
    """Every lake table but APP_FACT (initial load), both feeds' sides built at once."""
    model = Model(records, perms, opts)
    model.side_by_side(NAMES.app, NAMES.app_permission)
    return model


def model_fact(model: Mapping[str, DataFrame]) -> DataFrame:
    """APP_FACT of ``build_model``'s tables."""
    return app_fact(model[NAMES.app], model[NAMES.app_permission], model[NAMES.permission])


def load_app_layer(spark: SparkSession, feed: str, root: str,
                   opts: Options = Options()) -> dict[str, str]:
    """App feed files -> DEVELOPER, APP_CATEGORY, CONTENT_RATING,
    CURRENCY_TYPE, then APP (which resolves its keys against the
    just-published tables). Lines that don't parse go to APP_REJECTS."""
    # each line is parsed once: records and rejects are taken from the staged result
    parsed = stage(clean_dates(parse_lines(read_lines(spark, feed), APP_COLUMNS, APP_HEADER_PREFIX)))
    published = load_app_records(spark, parsed.where("_reject is null").drop("_reject"), root, opts, cleaned=True)
    rejects = parsed.where("_reject is not null").select("_reject.*")
    published[NAMES.app_rejects] = keep_rejects(rejects, _path(root, NAMES.app_rejects))
    unstage(parsed)
    free_finished(spark)
    return published


def keep_rejects(rejects: DataFrame, path: str) -> str:
    """Append a delivery's rejects: (line, n_fields, file, n_lines), one row per
    file and different line. Rows of files known before are not added again, so
    a delivery that is repeated changes nothing; no earlier delivery is rewritten."""
    spark = rejects.sparkSession
    if "file" not in rejects.columns:
        rejects = rejects.withColumn("file", F.lit(None).cast("string"))
    new = rejects.groupBy("line", "n_fields", "file").agg(F.count(F.lit(1)).alias("n_lines"))
    if table_exists(spark, path):
        old = read_table(spark, path)
        same = new["line"].eqNullSafe(old["line"]) & new["file"].eqNullSafe(old["file"])
        new = new.join(old, same, "left_anti")
        if new.isEmpty():
            return path
    return append_rows(spark, path, new)


def load_app_records(spark: SparkSession, records: DataFrame, root: str,
                     opts: Options = Options(), cleaned: bool = False) -> dict[str, str]:
    """C22 on already parsed records (24 string columns; with ``cleaned`` their
    dates are parsed and the caller has staged them).

    The cleaned records are staged once as Parquet and read by all five
    tables. Every step extends or upserts, so loading the same records twice
    changes nothing. Each table is read again after it was published.
    """
    staged = None if cleaned else stage(clean_dates(records))
    records = records if cleaned else staged
    names = [NAMES.developer] + [getattr(NAMES, attr) for _, attr, _, _ in LOOKUPS]
    old = {n: read_if_exists(spark, _path(root, n)) for n in names}
    frames = app_dimensions(records, old)
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:  # independent tables
        published = dict(zip(frames, pool.map(lambda n: publish_table(frames[n], _path(root, n)), frames)))
    # what is known of the frames' sizes holds for the tables written from them
    dims = {n: carry_known(frames[n], read_table(spark, _path(root, n))) for n in names}
    path = _path(root, NAMES.app)
    if opts.app_buckets and opts.incremental_app:
        # of an app's versions in one delivery the last updated one stays, as in the upsert below
        published[NAMES.app] = upsert_buckets(spark, path, app_detail(records, dims, opts), "App_Id",
                                              buckets=opts.app_buckets, order=APP_NEWEST)
    elif table_exists(spark, path) and opts.incremental_app:
        published[NAMES.app] = publish_table(
            app_detail(records, dims, opts, read_table(spark, path)), path)
    else:
        published[NAMES.app] = publish_table(app_detail(records, dims, opts), path)
    if staged is not None:
        unstage(staged)
    return published


def load_permission_layer(spark: SparkSession, feed: str, root: str,
                          opts: Options = Options(), multiline: bool = True) -> dict[str, str]:
    """Permission documents -> PERMISSION_TYPE, PERMISSION, APP_PERMISSION;
    records that don't parse go to PERMISSION_REJECTS."""
    docs = stage(read_permission_documents(spark, feed, multiline))  # each document is parsed once
    perms, rejects = permission_rows_of(docs)
    published = load_permission_rows(spark, perms, root, opts, staged=True)
    published[NAMES.permission_rejects] = keep_rejects(rejects, _path(root, NAMES.permission_rejects))
    unstage(docs)
    free_finished(spark)
    return published


def load_permission_rows(spark: SparkSession, perms: DataFrame, root: str,
                         opts: Options = Options(), staged: bool = False) -> dict[str, str]:
    """C23 on flattened (appId, appName, permission, type) rows (``staged`` by the caller, or here)."""
    perms = perms if staged else stage(perms)

    def old(name: str) -> DataFrame | None:
        return read_if_exists(spark, _path(root, name))

    def publish(name: str, df: DataFrame) -> DataFrame:
        published[name] = publish_table(df, _path(root, name))
        return carry_known(df, read_table(spark, _path(root, name)))

    published: dict[str, str] = {}
    ptype = publish(NAMES.permission_type, permission_types(perms, old(NAMES.permission_type)))
    perm = publish(NAMES.permission, permissions(perms, ptype, opts, old(NAMES.permission)))
    publish(NAMES.app_permission, app_permission(perms, ptype, perm, opts, old(NAMES.app_permission)))
    if not staged:
        unstage(perms)
    return published


FACT_KEYS = ["Category_Id", "Currency_Type_Id", "Developer_Id", "Release_Year",
             "Release_Month", "Cont_Rating_Id", "Permission_Type_Id"]
FACT_ORDER = ["Release_Year", "Release_Month", "Developer_Id", "Category_Id",
              "Currency_Type_Id", "Cont_Rating_Id", "Permission_Type_Id"]
FACT_COLUMNS = ["Auto_App_Id", *FACT_KEYS, "Total_Num_Permissions", "Count_Of_Apps",
                "Average_Rating", "Total_Rating_Num", "Total_Installs", "Count_Of_Free",
                "Count_Of_Paid", "Total_Price", "Total_Size_In_MB", "Count_Ad_Supported",
                "Count_In_App_Purchase", "Count_Of_Editor_Choice"]


def fact_spec(once_per_app: bool = False) -> FactSpec:
    """APP_FACT: its keys, measures and the order of ``Auto_App_Id``."""
    released = F.coalesce(F.col("Release_Dt"), F.col("Last_Update_Dt"))
    return FactSpec(
        detail_keys=[("Category_Id", F.col("Category_Id")),
                     ("Currency_Type_Id", F.col("Currency_Type_Id")),
                     ("Developer_Id", F.col("Developer_Id")),
                     ("Release_Year", F.year(released).cast("int")),
                     ("Release_Month", F.month(released).cast("int")),
                     ("Cont_Rating_Id", F.col("Cont_Rating_Id"))],
        child_keys=[("Permission_Type_Id", F.col("Permission_Type_Id"))],
        item="App_Id", child="Permission_Id",
        detail_columns=("Category_Id", "Currency_Type_Id", "Developer_Id", "Release_Dt", "Last_Update_Dt", "Cont_Rating_Id",
                        "Rating", "Rating_Num", "Maximum_Installs", "Price", "Size_In_MB", "Is_Free", "Is_Ad_Supported",
                        "Is_In_App_Purchase", "Is_Editor_Choice"),
        child_columns=("Permission_Type_Id",),
        sums=[("_rating", F.col("Rating")),
              ("Total_Rating_Num", F.col("Rating_Num").cast("double")),
              ("Total_Installs", F.col("Maximum_Installs")),
              ("Total_Price", F.col("Price")),
              ("Total_Size_In_MB", F.col("Size_In_MB"))],
        flags=[("Count_Of_Free", F.col("Is_Free") == "Y"),
               ("Count_Of_Paid", F.col("Is_Free") == "N"),
               ("Count_Ad_Supported", F.col("Is_Ad_Supported") == "Y"),
               ("Count_In_App_Purchase", F.col("Is_In_App_Purchase") == "Y"),
               ("Count_Of_Editor_Choice", F.col("Is_Editor_Choice") == "Y")],
        ratios=[("Average_Rating", "_rating")],
        items_name="Count_Of_Apps", children_name="Total_Num_Permissions",
        once_per_item=once_per_app, id_col="Auto_App_Id", order=FACT_ORDER)


def app_fact(app: DataFrame, app_permission: DataFrame, permission: DataFrame,
             once_per_app: bool = False) -> DataFrame:
    """APP_FACT (C12; ``once_per_app`` gives the corrected C13 sums).

    ``Auto_App_Id`` follows (year, month, developer) and then the remaining
    keys, so ids are reproducible.
    """
    spec = fact_spec(once_per_app)
    fact = spec.rollup(spec.rows(app, app_permission, permission))
    return dense_ids(fact, FACT_ORDER, "Auto_App_Id").select(*FACT_COLUMNS)


def refresh_fact_layer(spark: SparkSession, root: str, buckets: int = 64, once_per_app: bool = False) -> Refresh:
    """Fact entry for repeated loads: recompute and write only the groups of
    APP_FACT that changes of APP, APP_PERMISSION and PERMISSION touch; groups keep their ids."""
    return refresh_fact(spark, *[_path(root, n) for n in (NAMES.app_fact, NAMES.app, NAMES.app_permission, NAMES.permission)],
                        fact_spec(once_per_app), buckets)


def load_fact_layer(spark: SparkSession, root: str, once_per_app: bool = False,
                    partition_by: list[str] | None = None) -> str:
    """Fact entry: reads APP, APP_PERMISSION, PERMISSION and publishes APP_FACT.

    ``partition_by=["Release_Year"]`` lays the fact out for partition pruning
    on year filters (the partition column then comes last when read back).
    """
    def t(name: str) -> DataFrame:
        return read_table(spark, _path(root, name))
    fact = app_fact(t(NAMES.app), t(NAMES.app_permission), t(NAMES.permission), once_per_app)
    return publish_table(fact, _path(root, NAMES.app_fact), partition_by=partition_by)


def category_rank(app: DataFrame, category: DataFrame) -> DataFrame:
    """Categories ranked by installs (sum of Maximum_Installs over the
    detail table, so each app counts once)."""
    rows = app.join(category, "Category_Id", "left")
    return rank_by(rows, "Category_Desc", F.col("Maximum_Installs"),
                   value_name="Total_Installs", rank_name="Category_Rank")


def developer_rank(app: DataFrame, developer: DataFrame) -> DataFrame:
    """R2: developers ranked by the average rating of their apps (apps
    without a rating are left out of the mean)."""
    rows = app.join(developer.select("Developer_Id", "Developer_Name"), "Developer_Id", "left")
    return rank_by(rows, "Developer_Name", F.col("Rating"), how="avg",
                   value_name="Average_Rating", rank_name="Developer_Rank")


def rating_by_permission_count(app: DataFrame, app_permission: DataFrame) -> DataFrame:
    """Mean rating of apps by their number of permissions."""
    return measure_by_child_count(app, app_permission, "App_Id", F.col("Rating"),
                                  count_name="Num_Permissions", items_name="Count_Of_Apps",
                                  avg_name="Average_Rating")


def rating_by_permission(app: DataFrame, app_permission: DataFrame, permission: DataFrame) -> DataFrame:
    """Number of apps and mean rating per permission text."""
    return measure_by_child(app, app_permission, permission, "App_Id", "Permission_Id", F.col("Rating"),
                            [PERMISSION_DESC], items_name="Count_Of_Apps", avg_name="Average_Rating")


def rating_by_permission_type(app: DataFrame, app_permission: DataFrame, permission: DataFrame,
                              ptype: DataFrame) -> DataFrame:
    """Number of apps and mean rating per permission type (apps with
    several permissions of a type count once; unknown types are NULL)."""
    by_id = measure_by_child(app, app_permission, permission, "App_Id", "Permission_Id", F.col("Rating"),
                             ["Permission_Type_Id"], items_name="Count_Of_Apps", avg_name="Average_Rating")
    return by_id.join(ptype, "Permission_Type_Id", "left").select(
        "Permission_Type_Desc", "Count_Of_Apps", "Average_Rating")


# Declared warehouse schemas (fixed values of the model; K3).
def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t) for n, t in cols])


WAREHOUSE_SCHEMAS = {
    "APP_FACT": _schema(
        ("Auto_App_Id", IntegerType()), ("Category_Id", IntegerType()),
        ("Currency_Type_Id", IntegerType()), ("Developer_Id", IntegerType()),
        ("Release_Year", IntegerType()), ("Release_Month", IntegerType()),
        ("Cont_Rating_Id", IntegerType()), ("Permission_Type_Id", IntegerType()),
        ("Total_Num_Permissions", LongType()), ("Count_Of_Apps", LongType()),
        ("Average_Rating", DoubleType()), ("Total_Rating_Num", DoubleType()),
        ("Total_Installs", LongType()), ("Count_Of_Free", LongType()),
        ("Count_Of_Paid", LongType()), ("Total_Price", DoubleType()),
        ("Total_Size_In_MB", DoubleType()), ("Count_Ad_Supported", LongType()),
        ("Count_In_App_Purchase", LongType()), ("Count_Of_Editor_Choice", LongType())),
    "APP_CATEGORY_DIM": _schema(("Category_Id", IntegerType()), ("Category_Desc", StringType())),
    "CURRENCY_TYPE_DIM": _schema(("Currency_Type_Id", IntegerType()),
                                 ("Currency_Type_Desc", StringType())),
    "DEVELOPER_DIM": _schema(("Developer_Id", IntegerType()), ("Developer_Name", StringType()),
                             ("Developer_Website", StringType()),
                             ("Developer_Email", StringType())),
    "CONTENT_RATING_DIM": _schema(("Cont_Rating_Id", IntegerType()),
                                  ("Cont_Rating_Desc", StringType())),
    "PERMISSION_TYPE_DIM": _schema(("Permission_Type_Id", IntegerType()),
                                   ("Permission_Type_Desc", StringType())),
}

# Natural keys the warehouse checks guard (C18 per dimension).
UNIQUE_CHECKS = {
    "APP_CATEGORY_DIM": "Category_Desc",
    "CURRENCY_TYPE_DIM": "Currency_Type_Desc",
    "DEVELOPER_DIM": "Developer_Name",
    "CONTENT_RATING_DIM": "Cont_Rating_Desc",
    "PERMISSION_TYPE_DIM": "Permission_Type_Desc",
}


def star_checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Fact not empty; every dimension not empty and unique on its natural key."""
    checks = {"APP_FACT not empty": check_not_empty(tables["APP_FACT"])}
    for name, key in UNIQUE_CHECKS.items():
        checks[f"{name} not empty"] = check_not_empty(tables[name])
        checks[f"{name} unique {key}"] = check_unique(tables[name], key)
    return checks


def load_warehouse(spark: SparkSession, root: str, warehouse_root: str,
                   report: StarReport | None = None) -> dict[str, str]:
    """Conform the lake tables to the warehouse schemas and replace them,
    all in one snapshot and only if ``star_checks`` pass on it (``CheckFailed``)."""
    tables = {}
    for lake_name, wh_name in NAMES.warehouse.items():
        tables[wh_name] = (read_table(spark, _path(root, lake_name)), WAREHOUSE_SCHEMAS[wh_name])
    return publish_star(tables, warehouse_root, star_checks, report)


def warehouse_checks(spark: SparkSession, warehouse_root: str, root: str | None = None,
                     report: StarReport | None = None) -> DataFrame:
    """One row (check, passed) per check of ``star_checks``. With the
    ``report`` of the load they come from it (and were passed before the
    snapshot was public), with a row per table that no value was lost in its
    cast; with the lake's ``root`` also that no feed record was rejected. Lost
    values and rejects are warnings: the load is whole without them."""
    parts = []
    if report is None:
        parts.append(run_checks(star_checks(read_star(spark, warehouse_root))))
    else:
        rows = [*report.checks, *[(f"{name} values kept", all(not n for c, n in counts.items() if c != "_rows"))
                                  for name, counts in sorted(report.lost.items())]]
        parts.append(spark.createDataFrame(rows, "check string, passed boolean"))
    if root:
        parts.append(run_checks({f"{r} empty": read_table(spark, _path(root, r)).agg((F.count("*") == 0).alias("ok"))
                                 for r in (NAMES.app_rejects, NAMES.permission_rejects)}))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def reject_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, n_rejects) of both feeds."""
    out = None
    for name in (NAMES.app_rejects, NAMES.permission_rejects):
        one = read_table(spark, _path(root, name)).agg(F.count("*").alias("n_rejects")).select(
            F.lit(name).alias("table_name"), "n_rejects")
        out = one if out is None else out.unionByName(one)
    return out


def run_all(spark: SparkSession, app_feed: str, permission_feed: str, root: str,
            warehouse_root: str, opts: Options = Options(), multiline: bool = True) -> DataFrame:
    """Both detail entries, the fact entry, the warehouse load and its checks.

    The two detail entries write disjoint tables and run side by side.
    """
    with ThreadPoolExecutor(max_workers=2) as pool:
        done = [pool.submit(load_app_layer, spark, app_feed, root, opts),
                pool.submit(load_permission_layer, spark, permission_feed, root, opts, multiline)]
        for job in done:
            job.result()
    if opts.fact_buckets:
        refresh_fact_layer(spark, root, opts.fact_buckets)
    else:
        load_fact_layer(spark, root)
    free_finished(spark)
    report = StarReport()
    load_warehouse(spark, root, warehouse_root, report)
    return warehouse_checks(spark, warehouse_root, root, report)
