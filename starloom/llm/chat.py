"""Chat formatting in budgeted windows, in DataFrame operations only.

The turns of a conversation, in order, are cut into windows of whole turns. A
window has the system turn (the first turn, if its role is system), then turns
repeated from the window before, then its own. Own turns are taken as long as
their tokens stay within the budget less the system turn and the ``history``;
what is then left of the budget, ``history`` at most, goes to the last turns of
the window before. So a window's tokens are at most the budget, unless one own
turn and the system turn alone exceed it: no turn is cut. The loss mask covers
the assistant's own turns; what is repeated is masked out, so each assistant
text is a target once.

Template: a turn is ``<s>`` role newline text ``</s>``. Control strings of this
and of the common instruction templates inside a role or text are broken up
with a backslash (and backslashes doubled), which ``unescape`` undoes.

Positions come from counts by ``CHUNK`` turn numbers, and the windows are cut in
blocks of ``CHUNK`` positions (a block's edge is a window's), so the turns of a
very long conversation, or of very many equal turn numbers, are dealt to many
tasks; of a block only its last few turns go to the next one.

Special cases: a null text or role is empty; rows are ordered by turn (null
first), role, text; repeated rows are turns of their own; a null conv_id is a
conversation like any other; an empty table gives an empty result; columns
other than the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
CHUNK = 512
BEGIN, END = "<s>", "</s>"

#: Fixed control strings: sentence marks, unknown, instruction and system marks, and <| of other templates.
CONTROL = r"(<(?=/?s>|unk>|</?SYS>>|\|)|\[(?=/?INST\]))"


def tokens(text: Column) -> Column:
    """Estimated tokens of a turn: one for four characters, and four for its marks."""
    return F.ceil(F.length(text) / 4).cast("long") + 4


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    """Undo ``escape``: a single backslash behind < or [ was put in, all others are doubled."""
    return F.replace(F.regexp_replace(text, r"([<\[])\\(?!\\)", "$1"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role also ends at a newline, so it has none (the letter n behind one backslash stands for it)."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # an odd backslash before n is a newline; pairs before it are doubled ones
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def _positions(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text, size of every turn; positions are counted by chunks of turn numbers."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", tokens(F.col("text")).alias("size"),
                       F.floor(F.coalesce("turn", F.lit(-(1 << 62))) / CHUNK).cast("long").alias("chunk"))
    totals = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    own = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(own))
    return rows.join(totals, rows["conv_id"].eqNullSafe(totals["c"]) & (rows["chunk"] == totals["k"])).select(
        "conv_id", (F.col("n0") + F.col("pos")).alias("pos"), "role", "text", "size")


def _total(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda acc, t: acc + t["size"])


def _suffix(turns: Column, limit: Column, kind: str) -> Column:
    """The longest run of last turns, without the system turn, whose sizes sum up to ``limit`` at most."""
    zero = F.struct(limit.cast("long").alias("left"), F.expr(f"cast(array() as {kind})").alias("kept"))

    def step(acc, t):
        fits = (acc["left"] >= t["size"]) & ~t["system"]
        # what does not fit ends the run
        return F.struct(F.when(fits, acc["left"] - t["size"]).otherwise(F.lit(-1).cast("long")).alias("left"),
                        F.when(fits, F.concat(F.array(t), acc["kept"])).otherwise(acc["kept"]).alias("kept"))

    return F.aggregate(F.reverse(turns), zero, step, lambda acc: acc["kept"])


_TURN = "struct<window:int,system:boolean,pos:bigint,size:bigint,role:string,text:string>"


def _cut(turns: Column, room: Column) -> Column:
    """A block's turns with the number of their window in it: own turns (the system
    turn counts elsewhere) go on while their sizes stay within ``room``."""
    zero = F.struct(F.lit(0).cast("long").alias("own"), F.lit(0).alias("window"), F.expr(f"cast(array() as array<{_TURN}>)").alias("out"))

    def step(acc, t):
        system = (t["pos"] == 1) & (t["role"] == "system")
        size = F.when(system, F.lit(0).cast("long")).otherwise(t["size"])
        cut = (acc["own"] > 0) & (acc["own"] + size > room)
        window = (acc["window"] + cut.cast("int")).alias("window")
        turn = F.struct(window, system.alias("system"), t["pos"].alias("pos"), size.alias("size"), t["role"].alias("role"),
                        t["text"].alias("text"))
        return F.struct(F.when(cut, size).otherwise(acc["own"] + size).alias("own"), window,
                        F.concat(acc["out"], F.array(turn.cast(_TURN))).alias("out"))

    return F.aggregate(turns, zero, step, lambda acc: acc["out"])


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window (ascending, not dense), turns: array of (pos, repeated, role, text), in order."""
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    rows = _positions(conversations)
    block = F.floor((F.col("pos") - 1) / CHUNK).cast("long")
    packed = rows.groupBy("conv_id", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "size", "role", "text"))).alias("turns"))
    # every block's copy of the conversation's system turn
    whole = rows.groupBy("conv_id").agg(
        F.count("*").alias("n"),
        F.max(F.when((F.col("pos") == 1) & (F.col("role") == "system"), F.struct("size", "role", "text"))).alias("system"))
    blocks = whole.select(F.col("conv_id").alias("c"), "system", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK).cast("long"))).alias("k"))
    packed = packed.join(blocks, packed["conv_id"].eqNullSafe(blocks["c"]) & (packed["block"] == blocks["k"])).drop("c", "k")
    charged = F.coalesce("system.size", F.lit(0))
    cut = packed.withColumn("turns", _cut(F.col("turns"), F.lit(budget - history) - charged))

    # the turns at a block's end that the next block may repeat
    last = F.filter("turns", lambda t: t["window"] == F.element_at("turns", -1)["window"])
    ends = cut.select(F.col("conv_id").alias("c"), F.col("block").alias("k"), _suffix(last, F.lit(history), f"array<{_TURN}>").alias("end"))
    ends = ends.withColumn("before", F.lag("end").over(Window.partitionBy("c").orderBy("k"))).drop("end")
    cut = cut.join(ends, cut["conv_id"].eqNullSafe(ends["c"]) & (cut["block"] == ends["k"])).drop("c", "k")

    numbered = cut.select("conv_id", "block", "system", F.coalesce("before", F.expr(f"cast(array() as array<{_TURN}>)")).alias("before"), "turns",
                          F.explode(F.sequence(F.lit(0), F.element_at("turns", -1)["window"])).alias("w"))
    own = F.filter("turns", lambda t: t["window"] == F.col("w"))
    previous = F.when(F.col("w") > 0, F.filter("turns", lambda t: t["window"] == F.col("w") - 1)).otherwise(F.col("before"))
    numbered = numbered.select("conv_id", "block", "w", "system", own.alias("own"), previous.alias("previous"))
    left = F.least(F.lit(history), F.lit(budget) - charged - _total(F.col("own")))
    again = _suffix(F.col("previous"), left, f"array<{_TURN}>")

    def placed(turns, repeated):
        return F.transform(turns, lambda t: F.struct(t["pos"].alias("pos"), F.lit(repeated).alias("repeated"), t["role"].alias("role"),
                                                     t["text"].alias("text")))

    first = F.when((F.col("system").isNotNull()) & ((F.col("block") > 0) | (F.col("w") > 0)), F.array(F.struct(
        F.lit(1).cast("long").alias("pos"), F.lit(1).alias("repeated"), F.col("system.role").alias("role"), F.col("system.text").alias("text"))))
    none = F.expr("cast(array() as array<struct<pos:bigint,repeated:int,role:string,text:string>>)")
    return numbered.select("conv_id", (F.col("block") * CHUNK + F.col("w")).alias("window"),
                           F.concat(F.coalesce(first, none), placed(again, 1), placed(F.col("own"), 0)).alias("turns"))


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, loss (spans of characters that are targets), n_repeated.

    The first ``n_repeated`` turns of a window stand in an earlier window as well.
    """
    parts = F.transform("turns", lambda t: F.struct(
        t["repeated"].alias("repeated"), t["role"].alias("role"),
        F.concat(F.lit(BEGIN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body")))
    made = windows(conversations, budget, history).select("conv_id", "window", parts.alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("loss"))

    def step(acc, p):
        a = acc["at"] + F.length(p["head"])
        b = a + F.length(p["body"])
        target = (p["repeated"] == 0) & (p["role"] == "assistant")
        span = F.array(F.struct(a.cast("long").alias("start"), b.cast("long").alias("end")))
        return F.struct((b + len(END)).cast("long").alias("at"),
                        F.when(target, F.concat(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    return made.select(
        "conv_id", "window",
        F.concat_ws("", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))).alias("text"),
        F.aggregate("parts", zero, step, lambda acc: acc["loss"]).alias("loss"),
        F.size(F.filter("parts", lambda p: p["repeated"] == 1)).alias("n_repeated"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text; repeated ones left out), targets (texts), n_chars, from the output alone."""
    cut = F.split("text", END, -1)
    new = F.slice(cut, F.col("n_repeated") + 1, F.size(cut) - 1 - F.col("n_repeated"))

    def turn(part):
        line = F.instr(part, "\n")
        return F.struct(unescape_role(F.substring(part, F.lit(len(BEGIN) + 1), line - len(BEGIN) - 1)).alias("role"),
                        unescape(F.substring(part, line + 1, F.length(part))).alias("text"))

    target = F.transform("loss", lambda s: unescape(
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "window", F.transform(new, turn).alias("turns"), target.alias("targets"),
                            F.length("text").cast("long").alias("n_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest of a whole conversation needs its text in one row; the windows don't.
    """
    back = read_back(formatted).select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), "n_chars",
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns"),
        F.concat_ws("", "targets").alias("loss"))
    whole = back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    loss = F.concat_ws("", "w.loss")
    return whole.select("conv_id", "n_turns", F.sha2(F.concat_ws("", "w.turns"), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        "formatted_chars")


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """The table and conversation -7: two turns whose text is full of control strings."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


#: The control strings without look-ahead, to count them.
_COUNTED = r"</?s>|<unk>|<</?SYS>>|<\||\[/?INST\]"


def _escaped_length(col: str) -> str:
    return f"length(replace({col}, '\\', '\\\\')) + len(regexp_extract_all({col}, '{_COUNTED}'))"


#: The same digest columns in DuckDB; a turn at a time decides where the windows begin.
ORACLE = rf"""
with recursive rows as (
  select dense_rank() over (order by conv_id nulls first) c, * from (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) x),
sized as (
  select *, cast(ceil(length(text) / 4.0) as bigint) + 4 tokens,
    {len(BEGIN) + 1 + len(END)} + {_escaped_length("role")} + length(role) - length(replace(role, chr(10), ''))
      + {_escaped_length("text")} chars,
    row_number() over (partition by c order by turn nulls first, role, text) pos from rows),
known as (
  select *, pos = 1 and role = 'system' system, case when pos = 1 and role = 'system' then 0 else tokens end size,
    max(case when pos = 1 and role = 'system' then tokens else 0 end) over (partition by c) charged from sized),
cut as (
  select c, pos, size own, pos win from known where pos = 1
  union all
  select k.c, k.pos,
    case when (k.pos - 1) % {CHUNK} = 0 or cut.own > 0 and cut.own + k.size > {BUDGET - HISTORY} - k.charged then k.size else cut.own + k.size end,
    case when (k.pos - 1) % {CHUNK} = 0 or cut.own > 0 and cut.own + k.size > {BUDGET - HISTORY} - k.charged then k.pos else cut.win end
  from cut join known k on k.c = cut.c and k.pos = cut.pos + 1),
placed as (
  select k.*, cut.win, sum(k.size) over (partition by k.c, cut.win order by k.pos desc) to_end from known k join cut using (c, pos)),
wins as (
  select c, win, sum(size) own, max(charged) charged, lead(win) over (partition by c order by win) follows from placed group by c, win),
counted as (
  select p.c, sum(p.chars) + coalesce(sum(p.chars) filter (
      not p.system and n.win is not null and p.to_end <= least({HISTORY}, {BUDGET} - n.charged - n.own)), 0)
    + coalesce(max(p.chars) filter (p.system), 0) * (count(distinct p.win) - 1) formatted_chars
  from placed p join wins w on w.c = p.c and w.win = p.win left join wins n on n.c = p.c and n.win = w.follows group by p.c)
select any_value(r.conv_id) conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) loss_sha256,
  cast(any_value(formatted_chars) as bigint) formatted_chars
from rows r join counted using (c) group by c
"""
