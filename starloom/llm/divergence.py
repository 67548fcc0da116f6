"""Source divergence audit: how far each source's vocabulary is from the others'.

Method: one 256-entry translate table lowers A-Z and turns every separator
byte into a blank, ``bytes.split`` gives a document's terms and a Counter its
frequencies; a task adds them up per (lang, source, term), first in Python and
then in the map side of the aggregate, so the shuffle carries sparse counts
and no words. Terms that enough documents of a language
have are kept, each group gets smoothed whole-number shares of them, and the
shares are compared between the sources of a language (summed absolute
differences) and with the language as a whole (telling terms).

All arithmetic is on whole numbers (decimals where a long could overflow). The
sums over pairs of sources come from blocks of terms, dealt by the terms'
hash: a block is a small matrix of terms by sources, and only one number per
block and pair of sources leaves it, so neither a frequent term nor a large
source makes a task large. The work is kept terms x sources x sources of a
language; the pairs themselves are the result.

Special cases: null text, lang and source count as ''; every row is one
document, repeated rows too; groups without terms, and languages without kept
terms, are compared too (value 0); ties are ordered by the item's UTF-8 bytes;
an empty table gives an empty result; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import checkpoint, small_batches

#: Lowers A-Z, blanks every ASCII byte that is no letter, keeps all other bytes.
TRANSLATE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: (lang, source, term) entries a task holds before it hands them on.
TASK_ENTRIES = 200_000
#: Cells (terms x sources) of one block's matrix, about; a block has at least as
#: many terms as sources, so that the sums leaving it are no more than its cells.
BLOCK_CELLS = 100_000


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts, several rows a term."""
    frame = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                        F.col("text").cast("string").cast("binary").alias("text"))

    def rows_of(groups):
        lang, source, term, n, docs = [], [], [], [], []
        for (lg, src), (words, seen) in groups.items():
            lang += [lg] * len(words)
            source += [src] * len(words)
            term += words.keys()
            n += words.values()
            docs += [seen[t] for t in words]
        return pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.string()), "source": pa.array(source, pa.string()),
                                           "term": pa.array(term, pa.binary()), "n": pa.array(n, pa.int64()),
                                           "docs": pa.array(docs, pa.int64())})

    def run(batches):
        groups, entries = {}, 0
        for batch in small_batches(batches, "text"):
            for lang, source, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if not text:
                    continue
                words, seen = groups.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(text.translate(TRANSLATE).split())
                entries -= len(words)
                words.update(own)
                seen.update(own.keys())
                entries += len(words)
                if entries > TASK_ENTRIES:
                    yield rows_of(groups)
                    groups, entries = {}, 0
        yield rows_of(groups)

    made = frame.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return made.withColumn("term", F.col("term").cast("string"))


def _share(n: Column, total: Column, kept: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (n + smooth) / (total + smooth * kept)); 0 where nothing is kept."""
    over = F.lit(scale).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + F.lit(smooth).cast("decimal(4,0)"))
    under = total.cast("decimal(19,0)") + F.lit(smooth).cast("decimal(4,0)") * kept.cast("decimal(15,0)")
    # % is exact on decimals; the quotient of the difference has no fraction
    whole = ((over - over % under) / under).cast("long")
    return F.when(kept > 0, whole + 1).otherwise(F.lit(0).cast("long"))


def vocabulary(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, n_lang) of each language's kept terms."""
    counts = term_counts(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    counts = counts.withColumn("n_lang", F.sum("n").over(over)).withColumn("docs_lang", F.sum("docs").over(over))
    return counts.where(F.col("docs_lang") >= min_docs).select("lang", "source", "term", "n", "n_lang")


def group_shares(docs: DataFrame, kept: DataFrame, smooth: int, scale: int) -> DataFrame:
    """Per (lang, source) that occurs: total, its language's total and kept terms, share of a term it lacks."""
    groups = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                         F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).distinct()
    langs = (kept.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("lang_total")))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    return (groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
            .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"),
                    F.coalesce("kept", zero).alias("kept"))
            .withColumn("absent", _share(zero, F.col("total"), F.col("kept"), smooth, scale)))


def pair_distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) of each pair of sources of a language.

    ``shares`` has (lang, source, term, p) of the terms that a source has,
    ``groups`` the share ``absent`` of those that it lacks.
    """
    sources = F.count(F.lit(1))
    cells = F.greatest(F.lit(BLOCK_CELLS), sources * sources)
    sizes = groups.groupBy("lang").agg((F.max("kept") * sources / cells + 1).cast("int").alias("blocks"))
    sized = groups.join(sizes, "lang")
    lacks = sized.where("kept > 0").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                           "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"))
    has = shares.join(broadcast_if_small(sizes), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "p")

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows["term"].isna()
        absent = rows[head].sort_values("source")
        column = {s: i for i, s in enumerate(absent["source"])}
        rows = rows[~head]
        codes, terms = pd.factorize(rows["term"])
        cells = np.tile(absent["p"].to_numpy(np.int64), (len(terms), 1))
        cells[codes, rows["source"].map(column).to_numpy(np.int64)] = rows["p"].to_numpy(np.int64)
        names, out = absent["source"].to_numpy(object), []
        for i in range(len(names) - 1):
            far = np.abs(cells[:, i + 1:] - cells[:, i:i + 1]).sum(axis=0)
            out.append(pd.DataFrame({"source": names[i], "other": names[i + 1:], "value": far}))
        made = pd.concat(out) if out else pd.DataFrame({"source": [], "other": [], "value": []})
        made.insert(0, "lang", absent["lang"].iloc[0] if len(absent) else "")
        return made

    parts = has.unionByName(lacks).groupBy("lang", "block").applyInPandas(
        block, "lang string, source string, other string, value long")
    half = parts.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    names = groups.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "other"), "lang").where("source <> other")
    return pairs.join(both, ["lang", "source", "other"], "left").select(
        "lang", "source", "other", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def audit(docs: DataFrame, min_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank).

    ``part`` "pair": item is another source of the language, value the distance
    of their shares, every rank. ``part`` "term": item is a kept term that the
    source has more of than its language, value by how much, the ``top`` ranks.
    """
    kept = checkpoint(vocabulary(docs, min_docs))
    groups = checkpoint(group_shares(docs, kept, smooth, scale))
    shares = kept.join(broadcast_if_small(groups), ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kept"), smooth, scale).alias("p"),
        _share(F.col("n_lang"), F.col("lang_total"), F.col("kept"), smooth, scale).alias("q"))
    pairs = pair_distances(shares.drop("q"), groups).select("lang", "source", F.lit("pair").alias("part"),
                                                           F.col("other").alias("item"), "value")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)),
              terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1])


ORACLE = r"""
with d as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents),
words as (
  select row, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
counts as (select lang, source, term, count(*) as n, count(distinct row) as docs from words group by all),
kept as (select lang, term, sum(n) as n_lang from counts group by all having sum(docs) >= 30),
langs as (select lang, count(*) as v, sum(n_lang) as total from kept group by all),
names as (select distinct lang, source from d),
cells as (
  select names.lang, names.source, kept.term, kept.n_lang, coalesce(counts.n, 0) as n
  from names join kept using (lang) left join counts using (lang, source, term)),
totals as (select lang, source, sum(n) as total from cells group by all),
shares as (
  select c.lang, c.source, c.term, c.n,
         1 + (1000000000::hugeint * (c.n + 5)) // (t.total + 5 * l.v) as p,
         1 + (1000000000::hugeint * (c.n_lang + 5)) // (l.total + 5 * l.v) as q
  from cells c join totals t using (lang, source) join langs l on l.lang = c.lang),
far as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(far.value, 0) as bigint) as value
  from names a join names b on a.lang = b.lang and a.source <> b.source
  left join far on far.lang = a.lang and far.source = a.source and far.item = b.source)
select lang, source, 'pair' as part, item, value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank
from pairs
union all
select lang, source, 'term', term, cast(p - q as bigint),
       cast(row_number() over (partition by lang, source order by p - q desc, term) as integer) as rank
from shares where n > 0 and p > q
qualify rank <= 50
"""
