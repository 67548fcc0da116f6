"""Fill-in-the-middle transformation over a sparse exception index.

Method: texts stay UTF-8 bytes. Of a batch only the multibyte characters are
recorded, by their byte positions and their excess bytes (``ExceptionIndex``);
``searchsorted`` over that list turns byte cuts into code points and code
points into byte cuts, and between two exceptions the conversion is plain
arithmetic: an ASCII text has an empty index. Tokens (``[A-Za-z]+`` or one
other code point) begin at the bytes that a mask marks, so a cut after k
tokens is the k-th marked byte.

Each row is transformed alone: nothing is shuffled, and memory follows one
batch of texts (``BATCH_CHARS``, or a single longer text).

Special cases: a null text counts as empty and is plain; a null id hashes as
the empty text, so equal ids and repeated rows get equal results; texts that
hold a sentinel are plain; an empty table gives an empty result; input columns
other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text one step works on, at most (one longer text is a step alone).
BATCH_CHARS = 2_000_000

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


class ExceptionIndex:
    """Where bytes and code points of a UTF-8 buffer part."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        #: excess bytes before each exception, and of all of them at the end
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        #: the exceptions' own places in code points
        self.chars_at = self.at - self.excess[:-1]

    def to_chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before byte positions that begin a character (or end the buffer)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte positions of code point positions."""
        return chars + self.excess[np.searchsorted(self.chars_at, chars)]


class Units:
    """Cuts of the texts of one buffer; text i is ``data[edges[i]:edges[i + 1]]``."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, unit: str):
        self.edges, self.index, self.unit = edges, ExceptionIndex(data), unit
        if unit == "char":
            self.first = self.index.to_chars(edges)
        else:
            letter = _LETTER[data]
            after = np.concatenate([[False], letter[:-1]]) if len(data) else letter
            after[edges[:-1][edges[:-1] < len(data)]] = False  # no word runs on into the next text
            self.starts = np.flatnonzero(((data & 0xC0) != 0x80) & ~(letter & after))
            self.first = np.searchsorted(self.starts, edges)
        self.n = np.diff(self.first)

    def byte_cut(self, k: np.ndarray) -> np.ndarray:
        """Byte position after the first ``k`` units of each text."""
        if self.unit == "char":
            return self.index.to_bytes(self.first[:-1] + k)
        starts = np.append(self.starts, self.edges[-1])
        return np.where(k < self.n, starts[self.first[:-1] + k], self.edges[1:])


def _bytes_and_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null(b"")
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[edges[0]:edges[-1]], edges - edges[0]


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, unit: str = "token",
              text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: the id, ``n`` (units of the text), ``form`` (plain, psm or spm),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain) and ``output``.

    The cuts, and whether a row is transformed, come from the SHA-256 of
    ``seed:id``: a rerun, or another layout of the rows, gives the same rows.
    ``unit="char"`` cuts at code points instead of tokens.
    """
    if unit not in ("token", "char"):
        raise ValueError(f"unknown unit {unit!r}")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), 256)
    frame = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"),
                        *[F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    sentinels = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = sentinels

    def run(batches):
        for batch in small_batches(batches, "text", BATCH_CHARS):
            data, edges = _bytes_and_edges(batch.column(1))
            h = [batch.column(i).to_numpy() for i in range(2, 6)]
            units = Units(data, edges, unit)
            one, two = h[0] % (units.n + 1), h[1] % (units.n + 1)
            low, high = units.byte_cut(np.minimum(one, two)), units.byte_cut(np.maximum(one, two))
            prefix = units.index.to_chars(low) - units.index.to_chars(edges[:-1])
            middle = units.index.to_chars(high) - units.index.to_chars(low)
            whole, forms, outputs = data.tobytes(), [], []
            for i in range(batch.num_rows):
                body = whole[edges[i]:edges[i + 1]]
                if not body or h[2][i] % 100 >= 100 - plain_percent or any(x in body for x in sentinels):
                    forms.append("plain")
                    outputs.append(body)
                    continue
                a, b, c = whole[edges[i]:low[i]], whole[low[i]:high[i]], whole[high[i]:edges[i + 1]]
                spm = h[3][i] % 100 < spm_percent
                forms.append("spm" if spm else "psm")
                outputs.append(b"".join((s, c, p, a, m, b) if spm else (p, a, s, c, m, b)))
            plain = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n": pa.array(units.n, pa.int64()), "form": pa.array(forms, pa.string()),
                "prefix_chars": pa.array(prefix, pa.int64(), mask=plain),
                "middle_chars": pa.array(middle, pa.int64(), mask=plain), "output": pa.array(outputs, pa.binary())})

    kind = frame.schema["doc_id"].dataType.simpleString()
    made = frame.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form came from.

    A transformed text holds no sentinel of its own, and none can arise where
    two parts meet, so the first of each is the one that was put there.
    """
    def after(sentinel, end=None):
        start = F.instr(output, sentinel) + len(sentinel)
        return F.substring(output, start, (F.instr(output, end) if end else F.char_length(output) + 1) - start)

    psm = F.concat(after(PREFIX, SUFFIX), after(MIDDLE), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE), after(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(made: DataFrame) -> DataFrame:
    """The columns of ``transform`` with digests in place of the output."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
with cut as (
  select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hash
  from documents),
placed as (
  select *, len(units) as n, ('0x' || substr(hash, 1, 8))::bigint as h1, ('0x' || substr(hash, 9, 8))::bigint as h2,
         ('0x' || substr(hash, 17, 8))::bigint as h3, ('0x' || substr(hash, 25, 8))::bigint as h4
  from cut),
parts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
         case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from placed),
texts as (
  select *, array_to_string(units[1:low], '') as prefix, array_to_string(units[low + 1:high], '') as middle,
         array_to_string(units[high + 1:n], '') as suffix
  from parts)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(body) as restored_sha256
from texts
"""
