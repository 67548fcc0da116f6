"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a file (here: every row) is addressed by the SHA-256 of its
text, its blob. The ledger has a row per blob with the rule versions it was
scanned with and the spans found. A scan takes the distinct blobs, leaves out
every pair of blob and rule version that the ledger knows, and adds the rest
to the ledger, a Parquet table; findings are joined back to all paths that hold
the blob. A span names the rule version that found it, so what an older version
found is no longer reported once a newer one has taken its place. The query and
the pipeline's stage keep their ledger in the session's shared folder; where a
caller names one that stays, later scans read unseen blobs only.

Text is shuffled once, one row per distinct blob: equal blobs fold in partial
aggregates before the shuffle, so a blob that a third of all rows hold costs
no more than one row per task. The way back to the paths is a join on the
blob without texts, salted: the paths of one blob are dealt over several tasks.

Positions come from cutting the text at the matches: the start of a match is
the length of all pieces and matches before it (a running sum per blob).

Special cases: a null text is the empty text; repeated rows, and rows with a
null path, each get their own result; an empty table gives an empty result;
columns other than path and text are not read. A rule drops a whole match that
fails its length test, as it was found (leftmost, non-overlapping).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import salted_left_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern (Java), and the least length of a group of it."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


#: Fixed patterns; keywords in either case.
RULES = (
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # a run of fewer characters can't pass, so only runs of 24 and more are taken as matches
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)

SPAN = "array<struct<rule:string,version:int,start:bigint,end:bigint>>"
LEDGER = f"blob string, scanned array<string>, spans {SPAN}"


def content_address(versions: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, text): every version with its content address."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return versions.select(F.col(f"`{path}`").alias("path"), F.sha2(whole, 256).alias("blob"), whole.alias("text"))


def _hit(rule: Rule, number: int, pieces: str):
    """A match as (rule number, place, characters before it, its length, whether it passes)."""
    def hit(match, i):
        value = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
        return F.struct(F.lit(number).alias("rule"), i.alias("i"), F.length(F.get(F.col(pieces), i)).alias("gap"),
                        F.length(match).alias("len"), (F.length(value) >= rule.least).alias("ok"))

    return hit


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows for the unseen pairs of blob and rule version of ``content_address`` rows."""
    every = F.array(*[F.lit(r.key) for r in rules])
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("todo", every)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen")
        blobs = blobs.where(F.size("todo") > 0)
    none = F.expr("cast(array() as array<struct<rule:int,i:int,gap:int,len:int,ok:boolean>>)")
    parts = []
    for number, rule in enumerate(rules):
        matches = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        blobs = blobs.withColumn(f"m{number}", F.when(F.array_contains("todo", rule.key), matches))
        pieces = F.split("text", rule.pattern, -1)

        blobs = blobs.withColumn(f"p{number}", F.when(F.size(f"m{number}") > 0, pieces))
        parts.append(F.when(F.size(f"m{number}") > 0, F.transform(f"m{number}", _hit(rule, number, f"p{number}"))).otherwise(none))
    rows = blobs.select("blob", "todo", F.explode_outer(F.concat(*parts)).alias("h")).select("blob", "todo", "h.*")
    before = Window.partitionBy("blob").orderBy("rule", "i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # sums run over the rules of a blob one after the other; a rule's own sum is what it adds to the rules before
    rows = rows.withColumn("upto", F.sum(F.col("gap").cast("long") + F.col("len")).over(before)).withColumn(
        "base", F.max(F.when(F.col("i") == 0, F.col("upto") - F.col("gap") - F.col("len"))).over(before))
    end = F.col("upto") - F.col("base")
    names = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(n), F.lit(r.kind))])
    numbers = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(n), F.lit(r.version))])
    span = F.struct((end - F.col("len")).alias("start"), F.col("rule").alias("n"), end.alias("end"))
    grouped = rows.groupBy("blob").agg(F.first("todo").alias("scanned"),
                                       F.array_sort(F.collect_list(F.when(F.col("ok"), span))).alias("s"))
    return grouped.select("blob", "scanned", F.transform("s", lambda s: F.struct(
        names[s["n"]].alias("rule"), numbers[s["n"]].alias("version"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def report(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path, blob, spans): the ledger's findings on all paths that hold a blob."""
    with_any = ledger.where(F.size("spans") > 0).select("blob", "spans")
    return salted_left_join(versions.select("path", "blob"), with_any, "blob").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def update_ledger(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` (Parquet) doesn't know and append it;
    (blob, spans) of every blob in it with a finding of these rule versions.

    Ledger rows of one blob (from scans with different rules) are united. A run
    that failed halfway leaves no row of its own, as Parquet appends are
    committed at the end; running it again scans the same pairs.
    """
    spark = versions.sparkSession
    known = None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        known = spark.read.schema(LEDGER).parquet(ledger_path)
    scan(versions, known, rules).write.mode("append").parquet(ledger_path)
    keys = [r.key for r in rules]
    current = F.filter("spans", lambda s: F.concat_ws(":", s["rule"], s["version"]).isin(keys))
    rows = spark.read.schema(LEDGER).parquet(ledger_path).select("blob", current.alias("spans")).where(F.size("spans") > 0)
    return rows.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans"))), _by_start).alias("spans"))


def load_increment(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to ``versions`` (``update_ledger``) and report all their paths."""
    return report(versions, update_ledger(versions, ledger_path, rules))


def own_ledger(df: DataFrame) -> str:
    """A new ledger's place in the session's shared folder."""
    return f"{checkpoint_dir(df.sparkSession)}/ledger-{uuid.uuid4().hex}"


def _by_start(a: Column, b: Column) -> Column:
    order = {r.kind: i for i, r in enumerate(RULES)}
    place = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
    pa_, pb = place[a["rule"]], place[b["rule"]]
    return (F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
            .when(pa_ < pb, -1).when(pa_ > pb, 1).otherwise(0))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of ``report``'s rows."""
    def n(kind):
        return F.size(F.filter("spans", lambda s: s["rule"] == kind)).cast("long").alias(f"n_{kind}")

    text = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])))
    return found.select(F.col("path").alias("doc_id"), *[n(r.kind) for r in RULES],
                        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def scan_documents(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """(path, blob, spans) of every row of ``docs``; without a ledger's place nothing was scanned before."""
    return load_increment(content_address(docs), ledger_path or own_ledger(docs))


def redact(docs: DataFrame, mask: str = "[SECRET]", ledger_path: str | None = None) -> DataFrame:
    """``docs`` (same columns) with every found secret in the text replaced by ``mask``.

    ``n_chars`` follows the new text. The text's findings come from the ledger
    by its content address; texts without a finding stay as they are.
    """
    found = update_ledger(content_address(docs), ledger_path or own_ledger(docs))
    whole = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.sha2(whole, 256).alias("blob"))
    joined = salted_left_join(kept, found, "blob").select("row.*", F.col("spans").alias("__spans"))
    # spans in order; one that begins inside the last is part of it
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        cut = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], cut, F.lit(mask))).otherwise(acc["out"]).alias("out"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text")))

    new = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.aggregate("__spans", start, step, finish))
    joined = joined.withColumn("__new", new)
    cols = []
    for c, kind in docs.dtypes:
        if c == "text":
            cols.append(F.col("__new").alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("__spans").isNull(), F.col(c)).otherwise(F.length("__new").cast(kind)).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return joined.select(*cols)


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORD = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = _KEYWORD.join(("(?:", ")")) + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

#: The same digest columns in DuckDB.
ORACLE = rf"""
with rules(n, kind) as (values (0, 'assign'), (1, 'access'), (2, 'hex')),
texts as (select doc_id, row_number() over () rid, coalesce(text, '') t from documents),
cuts as (
  select rid, n, kind, t,
    case n when 0 then regexp_extract_all(t, '{_ASSIGN}', 0) when 1 then regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0)
      else regexp_extract_all(t, '[0-9a-f]+', 0) end ms,
    case n when 0 then regexp_extract_all(t, '{_ASSIGN}', 1) when 1 then regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0)
      else regexp_extract_all(t, '[0-9a-f]+', 0) end vs,
    case n when 0 then string_split_regex(t, '{_ASSIGN}') when 1 then string_split_regex(t, 'AKIA[A-Z0-9]+')
      else string_split_regex(t, '[0-9a-f]+') end ps
  from texts, rules),
hits as (select rid, n, kind, i, length(ms[i]) len, length(ps[i]) gap, length(vs[i]) vlen from (
  select *, unnest(range(1, len(ms) + 1)) i from cuts) x),
placed as (select *, sum(gap + len) over (partition by rid, n order by i) e from hits),
good as (select rid, n, kind, cast(e - len as bigint) s, cast(e as bigint) e from placed
  where vlen >= case n when 0 then 6 when 1 then 20 else 24 end),
found as (select rid, count(*) filter (n = 0) a, count(*) filter (n = 1) c, count(*) filter (n = 2) h,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, n) spans from good group by rid)
select doc_id, cast(coalesce(a, 0) as bigint) n_assign, cast(coalesce(c, 0) as bigint) n_access,
  cast(coalesce(h, 0) as bigint) n_hex, sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans
from texts left join found using (rid)
"""
