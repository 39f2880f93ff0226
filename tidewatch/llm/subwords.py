"""SentencePiece merge models: exact encoding by backtracking, and decoding.

Merging keeps a token sequence exactly when every two neighbours, merged anew on their own, stay these two tokens; so a text's
encoding is the only sequence of tokens all of whose neighbours are compatible. It is found from the left: an Aho-Corasick
automaton gives the pieces that match at each place, the longest compatible one is taken (then the next longest piece that begins it, from a table made once), a place from which nothing compatible
goes on is marked in a bit field, and the token before it gives way to a shorter one. A sequence that reaches a place is the
encoding of the text before it, so a failed place stays failed and each is given up once. Compatibility is decided by merging the two
tokens' characters again in the model's order (score, then from the left) and remembered per pair. A character without a piece is a token of its own
and becomes its UTF-8 bytes.

Merges never cross a place between two characters that stand beside each other in no piece, so texts are cut there: first
before the space marks that begin a word (checked when the model is read; otherwise a text is one chunk), and words met for the first
time at every such place. What was met before is looked up. The tables of words, of parts and of pairs are emptied at ``HELD`` entries.

Null text counts as empty: no ids, empty text. Equal and repeated rows are encoded each; ids of any type, other columns are
ignored. Models other than merge models with byte fallback are refused. ``path`` is a file every executor has.
"""

from __future__ import annotations

import array
import functools
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.llm.text import blocks

HELD, LONG = 1 << 19, 48
MARK = "▁"


class Table(dict):
    """What ``make`` gives for a text, made once; emptied when it is full, and long texts are not held."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, text: str) -> bytes:
        made = self.make(text)
        if len(text) <= LONG:
            if len(self) >= HELD:
                self.clear()
            self[text] = made
        return made


class Model:
    """A merge model's pieces, with ``encode`` from text to ids."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.byte, ids = {}, {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids[piece], self.score[piece] = i, sp.get_score(i)
        if len(self.byte) != 256:
            raise ValueError("only models with byte fallback are supported")
        self.ids = ids
        self.name = {i: piece for piece, i in ids.items()}
        # by number: all ids, and after them the characters without a piece that were met
        self.last_id = sp.get_piece_size() - 1
        self.size = [len(self.name.get(i, "")) for i in range(self.last_id + 1)]
        self.bares: dict[str, int] = {}
        # the next longest piece that begins a piece; after the last one a first character that is none itself
        self.shorter = [-1] * len(self.size)
        for piece, i in ids.items():
            prefix = next((ids[piece[:j]] for j in range(len(piece) - 1, 0, -1) if piece[:j] in ids), None)
            self.shorter[i] = prefix if prefix is not None else (self.bare(piece[0]) if len(piece) > 1 else -1)
        self.beside = {piece[i : i + 2] for piece in ids for i in range(len(piece) - 1)}
        self.find = ahocorasick.Automaton()
        for piece, i in ids.items():
            self.find.add_word(piece, (i, len(piece) - 1))
        self.find.make_automaton()
        self.apart = not any(b[1] == MARK != b[0] for b in self.beside)
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.pairs: dict[int, bool] = {}
        self.words = Table(lambda word: self.chunk_ids(MARK + word))
        self.parts = Table(self.packed)

    def merge(self, text: str) -> list[str]:
        """The tokens left after merging the characters of a short text in the model's order."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens beside each other stay as they are; ``left`` -1 asks for ``right`` alone."""
        parts = [self.name[right]] if left < 0 else [self.name[left], self.name[right]]
        if len(self.pairs) >= HELD:
            self.pairs.clear()
        said = self.pairs[(left << 32) + right] = self.merge("".join(parts)) == parts
        return said

    def bare(self, letter: str) -> int:
        """The number, behind all ids, of a character without a piece; -1 for one that has a piece."""
        if letter in self.ids:
            return -1
        if (number := self.bares.get(letter)) is None:
            number = self.bares[letter] = len(self.size)
            self.name[number] = letter
            self.size.append(1)
            self.shorter.append(-1)
        return number

    def tokens(self, chunk: str) -> list[int]:
        """The chunk's tokens, by backtracking."""
        n, size, pairs, shorter = len(chunk), self.size, self.pairs, self.shorter
        longest = [-1] * n
        for end, (i, more) in self.find.iter(chunk):  # of the pieces that begin at a place the longest comes last
            longest[end - more] = i
        failed = None
        out, last, at, token = [], -1, 0, longest[0]
        if token < 0:
            token = self.bare(chunk[0])
        while True:
            while token >= 0:
                end = at + size[token]
                if failed is None or not failed[end >> 3] & (1 << (end & 7)):
                    said = pairs.get((last << 32) + token)
                    if said or (said is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
                if token < 0:
                    token = self.bare(chunk[end])
            else:
                failed = bytearray(n // 8 + 1) if failed is None else failed
                failed[at >> 3] |= 1 << (at & 7)
                gone = out.pop()
                at -= size[gone]
                last, token = (out[-1] if out else -1), shorter[gone]

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a chunk, as 32-bit numbers behind each other."""
        plain = len(chunk) <= LONG and chunk[1:].isalpha()  # letters alone are seldom worth cutting
        cuts = [] if plain else [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.beside]
        if not cuts:
            return self.packed(chunk)
        parts = self.parts
        return b"".join([parts[chunk[i:j]] for i, j in zip([0, *cuts], [*cuts, len(chunk)], strict=True)])

    def packed(self, part: str) -> bytes:
        found = self.tokens(part)
        if max(found) > self.last_id:
            spelled = ((t,) if t <= self.last_id else map(self.byte.__getitem__, self.name[t].encode()) for t in found)
            found = itertools.chain.from_iterable(spelled)
        return array.array("i", found).tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids, as 32-bit numbers behind each other."""
        text, words = self.library.normalize(text), self.words
        if not self.apart:
            return self.chunk_ids(text) if text else b""
        if text[:1] == MARK and text[-1:] != MARK and MARK + MARK not in text:
            return b"".join(map(words.__getitem__, text[1:].split(MARK)))
        out = []
        for chunk in self.cut(text):
            plain = chunk[0] == MARK and chunk[1:2] not in (MARK, "")
            out.append(words[chunk[1:]] if plain else self.chunk_ids(chunk))
        return b"".join(out)

    def ids_of(self, text: str) -> list[int]:
        return np.frombuffer(self.encode(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One per worker process."""
    return Model(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the whole text's tokens without begin or end."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        held = model(path)
        for b in blocks(batches):
            made = [held.encode(t or "") for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(m) // 4 for m in made)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``text``, what the ids stand for; null ids count as none."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held = model(path)
        for b in batches:
            ids = b.column("ids")
            flat, ends = ids.flatten().to_numpy(), np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_pylist()])
            said = [held.decode(flat[i:j].tolist()) if j > i else "" for i, j in zip(ends[:-1], ends[1:], strict=True)]
            said = pa.array(said, pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), said], ["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def op12_subwords(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    tokens = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
