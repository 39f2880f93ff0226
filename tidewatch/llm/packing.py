"""Sum-of-squares online packing of documents into windows of at most ``WINDOW`` tokens.

A document's ids (byte-level BPE of the whole text, then id 0) are cut into whole windows and a remainder. A whole window is
a sequence of its own. Remainders go online into partially filled windows: each to the fill level, or a new window, that
makes the sum of squared counts of windows by level smallest, a fit that fills the window counting as one less. The
counts by level are the whole state.

Pieces are spread over lanes by a hash, about ``LANE`` pieces each, and a lane is packed in the order of another hash, so a
lost task packs the same way again. A lane ends with some hundred open windows, whatever its length, so lanes are long (a
few seconds of one task); there are as many as the input needs. Memory follows the open windows and the level array. Texts are read once, and ids never leave
the task that made them: a piece is its place, length and checksum.

Null text counts as empty: its only id is 0. A null id keeps its row, repeated rows are packed each. Strings that look like
special tokens are ordinary text. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.llm.text import blocks
from tidewatch.session import materialise

WINDOW, LANE = 1024, 1 << 17


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file of the tokenizers library, special tokens left out.

    Such files write a byte as a printable character: the printable Latin-1 ones as themselves, the others from U+0100 on.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"] for t in made.get("added_tokens", ())}
    return {bytes(byte[c] for c in token): k for token, k in made["model"]["vocab"].items() if token not in special}


def encoder(path: str, pattern: str):
    """A function from text to the ids that the tokenizers library gives for this file.

    Ids of this vocabulary follow the order of its merges, so the merges can be run by rank with tiktoken, four times as fast.
    """
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=byte_ranks(path), special_tokens={}).encode_ordinary


def pieces(docs: DataFrame, path: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``: whole windows and the remainder of every document."""
    def run(batches):
        encode = encoder(path, pattern)
        for b in blocks(batches):
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = encode(text or "")
                ids.append(0)
                data = np.array(ids, "<u4")
                for at in range(0, len(data), window):
                    one = data[at : at + window]
                    row.append(i)
                    start.append(at)
                    length.append(len(one))
                    crc.append(zlib.crc32(one.tobytes()))
                    total.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


class Lane:
    """Open windows by fill level, and the choice between them."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window's number and the piece's offset in it."""
        w, n = self.window, self.count
        if size >= w:
            self.made += 1
            return self.made - 1, 0
        # putting the piece on level h turns one window of level h into one of level h + size
        change = 2 * (n[size + 1 : w] - n[1 : w - size]) + 2
        change = np.append(change, 1 - 2 * n[w - size])
        change[n[1 : w - size + 1] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else -1
        if best < 0 or change[best] > 2 * n[size] + 1:
            number, level = self.made, 0
            self.made += 1
        else:
            level = best + 1
            number = self.open[level].pop()
            n[level] -= 1
        if level + size < w:
            self.open[level + size].append(number)
            n[level + size] += 1
        return number, level


def pack(parts: DataFrame, window: int = WINDOW, lane: int = LANE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    parts = materialise(parts, "pieces")
    lanes = max(1, -(-parts.count() // lane))
    key = F.xxhash64("doc_id", "start", "ids_crc32")
    rows = parts.withColumn("lane", F.pmod(key, F.lit(lanes))).withColumn("turn", F.xxhash64(F.lit(17), "doc_id", "start"))
    rows = rows.repartition(lanes, "lane").sortWithinPartitions("lane", "turn", "doc_id", "start", "ids_crc32")

    def run(batches):
        now, state = None, None
        for b in batches:
            number, offset = [], []
            for k, size in zip(b.column("lane").to_pylist(), b.column("length").to_pylist(), strict=True):
                if k != now:
                    now, state = k, Lane(window)
                n, at = state.place(size)
                number.append((k << 32) | n)
                offset.append(at)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:5]), pa.array(number, pa.int64()), pa.array(offset, pa.int64())], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = parts.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, window: int = WINDOW, lane: int = LANE) -> DataFrame:
    """Tokenise and pack; ``path`` is the vocabulary file on every executor, ``pattern`` how it splits text into pieces."""
    import public_tokenizers

    ready(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(pieces(docs, str(path), pattern or public_tokenizers.PATTERN, window), window, lane)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
