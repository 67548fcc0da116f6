"""Benchmark decontamination with an FM-index per shard of documents.

Words are lower-cased in A-Z and taken whole (``WORD``). Each window of
``width`` consecutive benchmark words is a phrase; an item with fewer words,
but at least one, is one phrase. A task cuts its documents into shards, builds
an FM-index over a shard's words, finds all phrases by backward search through
wavelet-tree ranks, locates the occurrences through sampled suffix positions
and merges them into the spans to remove.

The index's alphabet is the benchmark's words. A word that no item has can
stand in no occurrence, so it ends a run, and runs shorter than the shortest
phrase are left out of the index; nothing else is.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text; each block
is one pass of the same stage over the documents (``remove_spans``: over each
batch of them, as a text is cut at the spans of all blocks). Nothing is shuffled.

Special cases: a null text has no words; items without words (or null) match
nothing; repeated items count once per item_id, an item with a null item_id
marks words and spans but is not listed; repeated documents each get their own
row; empty tables give empty results, or documents without hits; columns other
than those named are passed through ``remove_spans`` as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, small_batches
from .fm_index import FMIndex

WIDTH = 10
#: Benchmark text that one pass holds, at most (one longer item is one block).
BLOCK_BYTES = 8_000_000
#: Words that one FM-index covers, about; a longer run is one shard of its own.
SHARD_WORDS = 1 << 19

#: Fixed word pattern: letters, digits and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_WORD_BYTES = bytes(ASCII_LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

HITS = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, item_ids array<string>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split() if text else []


class Phrases:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.vocab: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                windows.setdefault(tuple(ids[i:i + width]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set]]] = {}
        for n in sorted({len(w) for w in windows}):
            own = [w for w in windows if len(w) == n]
            self.by_length[n] = np.array(own, np.int64), [windows[w] for w in own]
        self.shortest = min(self.by_length, default=0)


class Shard:
    """Runs of benchmark words of some documents, and where they stand."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.runs, self.size = phrases, [], 0

    def add(self, doc: int, words: list[bytes]) -> None:
        get = self.phrases.vocab.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.r_[0, ids > 0, 0]))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= self.phrases.shortest:
                self.runs.append((doc, a, ids[a:b]))
                self.size += b - a

    def find(self) -> dict[int, tuple[list[tuple[int, int]], set]]:
        """doc -> its occurrences (start, end in words) and the items they are from."""
        out: dict[int, tuple[list, set]] = {}
        if not self.runs:
            return out
        text = np.concatenate([x for _, _, ids in self.runs for x in (ids, np.zeros(1, np.int64))])
        index = FMIndex(text, len(self.phrases.vocab))
        begins = np.cumsum([0] + [len(ids) + 1 for _, _, ids in self.runs])
        for n, (patterns, items) in self.phrases.by_length.items():
            which, lo, hi = index.search(patterns)
            many = hi - lo
            rows = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(int(many.sum()))
            at, phrase = index.locate(rows), np.repeat(which, many)
            run = np.searchsorted(begins, at, "right") - 1
            for r, p, i in zip(run.tolist(), (at - begins[run]).tolist(), phrase.tolist()):
                doc, start, _ = self.runs[r]
                spans, found = out.setdefault(doc, ([], set()))
                spans.append((start + p, start + p + n))
                found |= items[i]
        return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans: overlapping and touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search(texts: list[list[bytes]], phrases: Phrases) -> dict[int, tuple[list[tuple[int, int]], set]]:
    """Search word lists, one FM-index per shard."""
    out, shard = {}, Shard(phrases)
    for doc, words in enumerate(texts):
        shard.add(doc, words)
        if shard.size >= SHARD_WORDS:
            out.update(shard.find())
            shard = Shard(phrases)
    out.update(shard.find())
    return out


def blocks_of(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`").cast("string")).toLocalIterator():
        if r[1]:
            if block and size + len(r[1]) > limit:
                yield block
                block, size = [], 0
            block.append((r[0], r[1]))
            size += len(r[1])
    yield block


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: tuple = ("doc_id",), text: str = "text",
              item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_words, merged spans (in words) and item_ids."""
    keep = [c for c in keep if c not in ("n_words", "spans", "item_ids")]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep if c != text],
                        F.col(f"`{text}`").cast("string").alias("__text"))
    passed = frame.columns[:-1]
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema)
    frame = frame.select("*", F.lit(0).cast("long").alias("n_words"),
                         F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
                         F.expr("cast(array() as array<string>)").alias("item_ids"))
    sc = docs.sparkSession.sparkContext
    for items in blocks_of(benchmark, item_id, item_text, block_bytes):
        shared = sc.broadcast(items)  # at most block_bytes of text

        def run(batches, shared=shared):
            phrases = Phrases(shared.value, width)
            for batch in small_batches(batches, "__text"):
                words = [words_of(t) for t in batch.column("__text").to_pylist()]
                hits = search(words, phrases)
                spans, ids = batch.column("spans").to_pylist(), batch.column("item_ids").to_pylist()
                for i, (found, of) in hits.items():
                    spans[i] = [{"start": a, "end": b} for a, b in
                                merge([(s["start"], s["end"]) for s in spans[i]] + found)]
                    ids[i] = sorted({*ids[i], *(x for x in of if x is not None)})
                cols = {n: batch.column(n) for n in [*passed, "__text"]}
                cols["n_words"] = pa.array([len(w) for w in words], pa.int64())
                cols["spans"] = pa.array(spans, batch.schema.field("spans").type)
                cols["item_ids"] = pa.array(ids, pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(cols)

        frame = frame.mapInArrow(run, head + HITS)
    return frame.withColumnRenamed("__text", text) if text in keep else frame.drop("__text")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join(out) + text[last:]


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str | None = "n_chars",
                 width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (same columns) with the benchmark's spans cut out of the text.

    A text is cut at the merged spans of all blocks of the benchmark. A cut can
    bring the words of another window together, so a text that was cut is
    searched again for all blocks until no window occurs. Texts without a hit
    stay as they are; a text may become empty. ``n_chars`` follows the new text
    where the table has that column. Of several blocks a task holds the phrases
    of one at a time and builds them again for each round of a batch.
    """
    sc = docs.sparkSession.sparkContext
    kinds = dict(docs.dtypes)
    blocks = [sc.broadcast(items) for items in blocks_of(benchmark, "item_id", "text", block_bytes)]

    def run(batches):
        only = Phrases(blocks[0].value, width) if len(blocks) == 1 else None

        def find(texts):
            words, found = [words_of(t) for t in texts], {}
            for shared in blocks:
                for i, (spans, _) in search(words, only or Phrases(shared.value, width)).items():
                    found[i] = merge(found.get(i, []) + spans)
            return found

        for batch in small_batches(batches, text):
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            hits = find(texts)
            changed = {}
            while hits:
                todo = list(hits)
                for i in todo:
                    changed[i] = texts[i] = cut(texts[i], hits[i])
                again = find([texts[i] for i in todo])
                hits = {todo[k]: v for k, v in again.items()}
            if changed:
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if n_chars and kinds.get(n_chars) in ("bigint", "int"):
                    c = batch.schema.get_field_index(n_chars)
                    count = batch.column(c).to_pylist()
                    for i, t in changed.items():
                        count[i] = len(t)
                    batch = batch.set_column(c, batch.schema.field(c), pa.array(count, batch.schema.field(c).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def hit_digests(hits: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and the spans and items)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                       (n_hit > 0).alias("contaminated"))


#: The same digest columns in DuckDB, by a join of windows.
ORACLE = r"""
with bw as (
  select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) i from (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark) x where len(ws) > 0),
phrases as (select distinct item_id, least(len(ws), 10) k, array_to_string(ws[i:i + 9], ' ') phrase from bw),
docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
dwin as (
  select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') phrase from (
    select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) i from docs, (select distinct k from phrases) ks where len(ws) >= k) x),
occ as (select doc_id, dwin.k, i, item_id from dwin join phrases on dwin.k = phrases.k and dwin.phrase = phrases.phrase),
hits as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from occ) x group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
  from (select distinct doc_id, cast(item_id as varchar) item from occ) x group by doc_id)
select d.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from docs d left join hits using (doc_id) left join items using (doc_id)
"""
