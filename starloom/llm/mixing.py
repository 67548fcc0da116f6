"""Mixing sources to target weights by Sainte-Laguë apportionment.

Method: the words of all sources are dealt in blocks of equal size. Blocks go
to sources by the highest quotients target / (2k + 1) (Sainte-Laguë), and a
source's blocks to its shards by their words in the same way, so every shard
has a whole-number quota. A shard's documents stand in a seeded order, its
words are cut into b blocks, and its quota q is drawn from them by a seeded
place: every block is taken q div b times, and the q mod b blocks from the
seeded one on (the last block is followed by the first) once more. As the
documents' order is seeded, that is a random choice which cuts two documents
of a shard and takes all others whole. The words taken up to a place in the
shard are one formula, and a document's are the difference of its two ends: no
block is ever a row.

Sources share ``share`` times all words by weight; a source's target stops at
``most`` times its words and the excess is shared again: target = min(most x
words, level x weight), with the level found by a few aggregates over the
table of sources. A block has a 1024th of the smallest target (one word at
least), so rounding costs no source much.

Documents meet once, as (source, id, size) with the number of their copies; a
group of very many copies is dealt over shards in chunks, and becomes rows
again only at the end. Nothing depends on the layout of the input: reruns give
the same rows.

Special cases: a null text has no words; null is a source of its own, the last
one; a document or source without words takes none (target 0); documents of
one source with equal id and size are interchangeable; an empty table gives an
empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import dense_ids
from ..operators.joins import broadcast_if_small
from .common import checkpoint

#: Weights of the sources in their order, over and over.
WEIGHTS = (3, 1, 2)
#: Words of a shard, about: a shard is one sorted window.
SHARD_WORDS = 500_000
#: Copies of one document that one row stands for, at most.
CHUNK_COPIES = 65_536
#: Blocks of the smallest target.
LEAST_BLOCKS = 1024


def _hash(*parts: Column) -> Column:
    """32 hex digits of the parts, null as ''."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _number(hex_digits: Column) -> Column:
    """The first 8 hex digits as a number."""
    return F.conv(F.substring(hex_digits, 1, 8), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, copies): documents with the words of their texts, equal rows folded."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return (docs.select("source", "doc_id", words.cast("long").alias("size"))
            .groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")))


def targets(runs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Decimal = Decimal("1.5"), most: int = 2) -> DataFrame:
    """Per source: place (0, 1, ... by code point, null last), source_size, weight, target."""
    each = runs.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    placed = dense_ids(each, [F.col("source").asc_nulls_last()], "place", start=0, id_type="long")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = checkpoint(placed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most))

    wide = "decimal(38,0)"
    whole, parts = share.as_integer_ratio()
    total = placed.agg(F.sum(F.col("source_size").cast(wide))).first()[0] or 0

    def at_level(num, den):
        """Whether a source's cap is at or under its share by weight at the level num / den."""
        return (F.col("cap").cast(wide) * F.lit(Decimal(den)).cast(wide)
                <= F.col("weight").cast(wide) * F.lit(Decimal(num)).cast(wide))

    # what capped sources leave raises the level for the others, until no other is capped
    capped, over, num, den = -1, F.lit(False), 0, 0
    while True:
        caps, open_weights, n = placed.agg(F.sum(F.when(over, F.col("cap").cast(wide))),
                                           F.sum(F.when(~over, F.col("weight").cast(wide))), F.count(F.when(over, 1))).first()
        if n == capped:
            break
        capped, num, den = n, int(whole * total - parts * (caps or 0)), int(parts * (open_weights or 0))
        if not den:
            return placed.withColumn("target", F.col("cap").cast("double"))
        over = at_level(num, den)
    level = (F.col("weight").cast(wide) * F.lit(Decimal(num)).cast(wide)).cast("double") / F.lit(float(den))
    return placed.withColumn("target", F.when(over, F.col("cap").cast("double")).otherwise(level))


def apportion(parties: DataFrame, group: str, party: str, votes: str, seats: str, limit: str) -> DataFrame:
    """Sainte-Laguë: ``quota``, the seats of each party of a group, ``limit`` at most.

    ``seats`` is the group's number. The highest quotients votes / (2k + 1) of
    a group get its seats, ties to the smaller party. A party's seats are near
    its exact share, so only the quotients about that share are ranked (over
    all tasks, by range); if one end of a party's stretch decides, the stretch
    is doubled.
    """
    sums = parties.groupBy(group).agg(F.sum(votes).alias("__all"))
    known = parties.join(broadcast_if_small(sums), group)
    exact = F.when(F.col("__all") > 0, F.floor(F.col(votes) * F.col(seats) / F.col("__all"))).otherwise(0)
    width = 1
    while True:
        base = F.least(F.greatest(exact - width, F.lit(0)), F.col(limit)).cast("long")
        based = checkpoint(known.withColumn("__base", base))
        left = based.groupBy(group).agg((F.max(seats) - F.sum("__base")).alias("__left"))
        last = F.least(F.col("__base") + 2 * width, F.col(limit) - 1)
        stretch = F.when(last >= F.col("__base"), F.sequence("__base", last)).otherwise(F.array().cast("array<long>"))
        quotients = based.where(F.col(votes) > 0).select(group, party, F.explode(stretch).alias("__k"), votes)
        quotients = quotients.withColumn("__quotient", F.col(votes) / (2 * F.col("__k") + 1)).drop(votes)
        ranked = dense_ids(quotients, [group, F.col("__quotient").desc(), party, "__k"], "__at", id_type="long")
        first = ranked.groupBy(group).agg(F.min("__at").alias("__first")).join(left, group)
        won = (ranked.join(broadcast_if_small(first), group).where(F.col("__at") - F.col("__first") < F.col("__left"))
               .groupBy(group, party).agg(F.count(F.lit(1)).alias("__won")))
        done = checkpoint(based.join(won, [group, party], "left").withColumn("__won", F.coalesce("__won", F.lit(0).cast("long"))))
        at_end = (F.col("__won") > 2 * width) & (F.col("__base") + F.col("__won") < F.col(limit))
        at_start = (F.col("__won") == 0) & (F.col("__base") > 0) & (F.col("__base") < F.col(limit))
        if not done.where((F.col(votes) > 0) & (at_end | at_start)).limit(1).count():
            return done.withColumn("quota", F.col("__base") + F.col("__won")).drop("__all", "__base", "__won")
        width *= 2


def _arcs(block: int) -> tuple[Column, Column, Column]:
    """Places in a shard between which words are taken once more: from the first to the
    second, and up to the third (columns quota, blocks, turn)."""
    upto = F.col("turn") + F.col("quota") % F.col("blocks")
    return F.col("turn") * block, F.least(upto, F.col("blocks")) * block, F.greatest(upto - F.col("blocks"), F.lit(0)) * block


def taken_before(at: Column, block: int) -> Column:
    """Words taken of a shard's first ``at`` words."""
    low, high, wrapped = _arcs(block)
    once_more = F.greatest(F.least(at, high) - low, F.lit(0)) + F.least(at, wrapped)
    return _div(F.col("quota"), F.col("blocks")) * at + once_more


def taken_spans(start: Column, end: Column, block: int) -> Column:
    """(start, end, times) of the words that are taken between two places, counted from ``start``."""
    low, high, wrapped = _arcs(block)
    cuts = F.array_sort(F.array_distinct(F.array(*[F.greatest(start, F.least(end, p)) for p in (start, low, high, wrapped, end)])))

    def span(i):
        a, b = F.get(cuts, i), F.get(cuts, i + 1)
        more = ((a >= low) & (a < high)) | (a < wrapped)
        return F.struct((a - start).alias("start"), (b - start).alias("end"),
                        (_div(F.col("quota"), F.col("blocks")) + more.cast("long")).alias("times"))

    parts = F.when(F.size(cuts) > 1, F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), span)).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint,times:bigint>>"))
    return F.filter(parts, lambda s: s["times"] > 0)


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient of non-negative longs."""
    return F.call_function("div", a, b)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Decimal = Decimal("1.5"), most: int = 2, seed: int = 1,
        spans: bool = False) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target (its source's), taken.

    With ``spans`` also ``spans``: (start, end, times) of the document's words
    that the mix takes.
    """
    runs = checkpoint(sizes(docs))
    sources = checkpoint(targets(runs, weights, share, most).drop("cap"))
    whole, parts = share.as_integer_ratio()
    got = sources.agg(F.min(F.when(F.col("target") > 0, F.col("target"))), F.sum(F.col("source_size").cast("decimal(38,0)"))).first()
    block = max(1, int((got[0] or 0) // LEAST_BLOCKS))
    total = int(got[1] or 0)
    seats = (2 * whole * total + parts * block) // (2 * parts * block)  # share x total / block, rounded
    size = F.col("source_size")
    dealt = apportion(
        sources.withColumn("__one", F.pmod("place", F.lit(1))).withColumn("__seats", F.lit(seats).cast("long"))
        .withColumn("__limit", F.lit(most) * _div(size + (block - 1), F.lit(block))),
        "__one", "place", "target", "__seats", "__limit").select(
            F.col("source").alias("of"), "place", "source_size", "target", F.col("quota").alias("source_quota"),
            (_div(size, F.lit(SHARD_WORDS)) + 1).alias("shards"))

    per = F.greatest(F.least(_div(F.lit(SHARD_WORDS).cast("long"), F.greatest("size", F.lit(1))), F.lit(CHUNK_COPIES)), F.lit(1))
    chunks = (runs.withColumn("per", per)
              .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("copies") - 1, F.col("per")))))
              .withColumn("copies", F.least(F.col("copies") - F.col("chunk") * F.col("per"), "per"))
              .withColumn("order", _hash(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("chunk"))))
    placed = chunks.join(broadcast_if_small(dealt), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "place", "source_size", "target", "source_quota", "doc_id", "size", "copies", "chunk", "order",
        (_number(F.col("order")) % F.col("shards")).alias("shard"))
    lane = Window.partitionBy("place", "shard")
    words = F.col("size") * F.col("copies")
    laid = checkpoint(placed.withColumn("start", F.sum(words).over(
        lane.orderBy("order", "doc_id", "size", "chunk").rowsBetween(Window.unboundedPreceding, 0)) - words))

    shards = laid.groupBy("place", "shard").agg(F.sum(words).alias("words"), F.max("source_quota").alias("source_quota"))
    shards = shards.withColumn("blocks", _div(F.col("words") + (block - 1), F.lit(block)))
    quotas = apportion(shards.withColumn("__limit", most * F.col("blocks")), "place", "shard", "words", "source_quota", "__limit")
    quotas = quotas.select("place", "shard", "quota", F.greatest("blocks", F.lit(1)).alias("blocks")).withColumn(
        "turn", _number(_hash(F.lit(seed), F.col("place"), F.col("shard"))) % F.col("blocks"))

    one = (laid.join(broadcast_if_small(quotas), ["place", "shard"])
           .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
           .withColumn("start", F.col("start") + F.col("copy") * F.col("size")))
    end = F.col("start") + F.col("size")
    columns = ["doc_id", "source", "size", "source_size", "target",
               (taken_before(end, block) - taken_before(F.col("start"), block)).alias("taken")]
    if spans:
        columns.append(taken_spans(F.col("start"), end, block).alias("spans"))
    return one.select(*columns)


ORACLE = r"""
with runs as (
  select source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, count(*) as copies
  from documents group by all),
sums as (select source, cast(sum(size * copies) as hugeint) as words from runs group by all),
placed as (select *, row_number() over (order by source nulls last) - 1 as place from sums),
weighed as (select *, [3, 1, 2][place % 3 + 1] as weight, 2 * words as cap, sum(words) over () as total from placed),
level as (
  select 3 * max(total) - 2 * coalesce(sum(cap) filter (where not open), 0) as num, 2 * sum(weight) filter (where open) as den
  from (
    select *, bool_or(at_level) over (order by cap / weight, place rows unbounded preceding) as open
    from (
      select *, 2 * cap * sum(weight) over (order by cap / weight, place rows between current row and unbounded following)
             > weight * (3 * total - 2 * coalesce(sum(cap) over (order by cap / weight, place
                         rows between unbounded preceding and 1 preceding), 0)) as at_level
      from weighed))),
aimed as (
  select weighed.*, case when den is null or cap * den <= weight * num then cast(cap as double)
                         else cast(weight * num as double) / cast(den as double) end as target
  from weighed, level),
blocked as (
  select *, cast(greatest(1, coalesce(floor((select min(target) from aimed where target > 0) / 1024), 0)) as bigint) as block from aimed),
seated as (
  select *, cast((3 * total + block) // (2 * block) as bigint) as seats, cast(2 * ((words + block - 1) // block) as bigint) as most,
         cast(words // 500000 + 1 as bigint) as shards
  from blocked),
source_quotients as (
  select place, seats, row_number() over (order by target / (2 * k + 1) desc, place, k) as spot
  from (select place, target, seats, unnest(range(most)) as k from seated where target > 0)),
source_quota as (select place, count(*) as quota from source_quotients where spot <= seats group by all),
chunked as (
  select source, doc_id, size, copies, per, unnest(range((copies - 1) // per + 1)) as chunk
  from (select *, greatest(least(500000 // greatest(size, 1), 65536), 1) as per from runs)),
ordered as (
  select source, doc_id, size, chunk, least(copies - chunk * per, per) as copies,
         md5('1:' || coalesce(cast(doc_id as varchar), '') || ':' || size || ':' || chunk) as hash
  from chunked),
sharded as (
  select o.*, s.place, s.words as source_size, s.target, s.block, ('0x' || substr(o.hash, 1, 8))::bigint % s.shards as shard
  from ordered o join seated s on o.source is not distinct from s.source),
laid as (
  select *, cast(sum(size * copies) over (partition by place, shard order by hash, doc_id nulls first, size, chunk rows unbounded preceding)
            - size * copies as bigint) as start
  from sharded),
lanes as (
  select place, shard, block, cast(sum(size * copies) as bigint) as words, cast((sum(size * copies) + block - 1) // block as bigint) as blocks
  from laid group by place, shard, block),
lane_quotients as (
  select place, shard, row_number() over (partition by place order by words / (2 * k + 1) desc, shard, k) as spot
  from (select place, shard, words, unnest(range(2 * blocks)) as k from lanes)),
lane_quota as (
  select q.place, q.shard, count(*) as quota from lane_quotients q join source_quota s using (place) where q.spot <= s.quota group by all),
drawn as (
  select l.place, l.shard, l.block, greatest(l.blocks, 1) as blocks, coalesce(q.quota, 0) as quota,
         ('0x' || substr(md5('1:' || l.place || ':' || l.shard), 1, 8))::bigint % greatest(l.blocks, 1) as turn
  from lanes l left join lane_quota q using (place, shard)),
each as (
  select place, shard, doc_id, size, source_size, target, start + unnest(range(copies)) * size as start from laid),
ends as (
  select e.*, d.quota // d.blocks as q, d.turn * d.block as low, least(d.turn + d.quota % d.blocks, d.blocks) * d.block as high,
         greatest(d.turn + d.quota % d.blocks - d.blocks, 0) * d.block as wrapped, e.start + e.size as stop
  from each e join drawn d using (place, shard))
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target, cast(
    q * size + greatest(least(stop, high) - low, 0) + least(stop, wrapped)
  - greatest(least(start, high) - low, 0) - least(start, wrapped) as bigint) as taken
from ends
"""
