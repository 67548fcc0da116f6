"""SentencePiece encoding and decoding through a distinct-chunk table.

Method: no piece of the model has a whitespace marker after another character
(checked when the model is loaded), so a text falls into chunks of one run of
markers and the characters up to the next marker, and the ids of a text are
the ids of its chunks in order. Each task keeps a table of the distinct chunks
it has met: a chunk is segmented once, and the ids are put back by position
through the chunk's row in the table. Texts come in steps of ``STEP_CHARS`` and
the table is bounded by bytes (``TABLE_BYTES``); when it is full it starts anew
with the step's own chunks, which changes the work and not the result.
A table per task needs no shuffle and is rebuilt with the task when an
executor is lost; a table over the whole corpus would shuffle every word twice.

Special cases: a null text counts as empty and has only the end id; repeated
rows each get their own result; an empty table gives an empty result; input
columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_text

MARK = "▁"
#: Text that one step segments, at most (a single longer text is a step alone).
STEP_CHARS = 1_000_000
#: Memory of a task's table, about: keys, ids, decoded bytes and ``ROW_BYTES`` an entry.
TABLE_BYTES = 32_000_000
ROW_BYTES = 320
#: Chunks longer than this are segmented each time and not kept.
KEPT_CHARS = 200

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def load_model(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(sp.get_piece_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a whitespace marker: chunks can't be segmented alone")
    probe = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)]))
    if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError("the model changes characters before it segments them: chunks can't be cut first")
    return sp


def piece_bytes(sp) -> list[bytes]:
    """What each id decodes to: a piece's characters, a byte, or nothing for control ids."""
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i):
            out.append(b"")
        else:
            out.append((" \u2047 " if sp.is_unknown(i) else piece.replace(MARK, " ")).encode())
    return out


def chunks_of(text: str) -> list[str]:
    """The marked words of a text; the model puts one marker before the text."""
    if not text:
        return []
    marked = (MARK + text).replace(" ", MARK)
    if MARK + MARK not in marked and marked[-1] != MARK:
        return [MARK + w for w in marked[1:].split(MARK)]
    return _CHUNK.findall(marked)


class ChunkTable:
    """Distinct chunk -> (its ids as 32-bit integers, the bytes they decode to)."""

    def __init__(self, sp, size: int = TABLE_BYTES):
        self.sp, self.size, self.rows, self.held = sp, size, {}, 0
        self.mark, self.bytes = sp.piece_to_id(MARK), piece_bytes(sp)

    def segment(self, chunks: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Segment chunks that are not in the table, in one call."""
        # the library puts the first marker itself, and none before an empty text
        got = self.sp.encode([c[1:] for c in chunks], num_threads=1)
        chars = self.bytes
        out = {c: (array("i", ids).tobytes(), b"".join([chars[i] for i in ids])) for c, ids in zip(chunks, got)}
        if MARK in out:
            out[MARK] = (array("i", [self.mark]).tobytes(), chars[self.mark])
        return out

    def look_up(self, texts: list[list[str]]) -> dict[str, tuple[bytes, bytes]]:
        """Puts the texts' chunks into the table; returns those that are too long for it."""
        needed = set().union(*texts)
        new = [c for c in needed if c not in self.rows]
        if not new:
            return {}
        found = self.segment(new)
        long = {c: found.pop(c) for c in new if len(c) > KEPT_CHARS}
        size = _held(found)
        if self.held + size > self.size:
            self.rows = {c: self.rows[c] for c in needed if c in self.rows}
            self.held = _held(self.rows)
        self.rows.update(found)
        self.held += size
        return long


def _held(rows: dict[str, tuple[bytes, bytes]]) -> int:
    return sum(len(c) + len(ids) + len(text) + ROW_BYTES for c, (ids, text) in rows.items())


def encode_documents(df: DataFrame, model_path: str, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """Per row: the ``keep`` columns, ``ids`` (array of int, the end id last)
    and ``decoded`` (the library's decode of those ids)."""

    def make():
        sp = load_model(model_path)
        table, end = ChunkTable(sp), array("i", [sp.eos_id()]).tobytes()

        def of(texts):
            chunked = [chunks_of(t or "") for t in texts]
            long = table.look_up(chunked)
            rows = table.rows
            flat, offsets, decoded = [], [0], []
            for chunks in chunked:
                got = [rows.get(c) or long[c] for c in chunks]
                ids = b"".join([r[0] for r in got])
                flat.append(ids)
                flat.append(end)
                offsets.append(offsets[-1] + len(ids) // 4 + 1)
                whole = b"".join([r[1] for r in got])
                # the library strips the space of the marker that it put before the text
                decoded.append((whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace"))
            values = pa.array(np.frombuffer(b"".join(flat), np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            return {"ids": ids, "decoded": pa.array(decoded, pa.string())}

        return of

    return by_text(df, make, "ids array<int>, decoded string", list(keep), text, STEP_CHARS)


def digest_columns() -> list:
    """n_tokens, ids_sha256 and decoded_sha256 of ``encode_documents``'s columns."""
    return [F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
            F.sha2(F.col("decoded"), 256).alias("decoded_sha256")]


def token_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encode_documents``'s result."""
    return encoded.select("doc_id", *digest_columns())
