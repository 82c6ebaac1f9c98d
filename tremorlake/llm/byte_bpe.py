"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is one valid encoding, and so one valid
last token.  The table of last tokens is filled from left to right: a token that
ends at a place is the valid one if it fits the last token of the prefix before
it.  Two tokens fit if merging the bytes of both gives these two again; an
encoding is valid if all its neighbours fit.  Walking back from the end reads off the
ids.  Appending bytes continues the table and gives exactly the ids of the whole
text; after an edit only the table from the edit on is made anew.

A text is first split into pieces by the public pattern; pieces are encoded
separately, without special tokens.  Python runs inside mapInArrow with caches
of bounded size; the vocabulary, a file of fixed size, is broadcast.

Defined results: null texts count as empty; empty texts have no ids.  Rows that
are repeated give repeated rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import ready, whole_text

#: Bytes that a worker keeps of encoded chunks, and as many of pieces; beyond, the cache starts anew.
CACHE_BYTES = 96 << 20
#: Pairs of tokens that are known to fit or not, two numbers each.
KNOWN_PAIRS = 600_000
#: A dictionary's own share of an entry, and the characters up to which a text is kept.
ENTRY_BYTES, CACHED_CHARS = 100, 256
#: Bytes of text in a result batch.
BATCH_BYTES = 1 << 22
#: White space as the splitting pattern sees it.  No match of the pattern spans the place between other characters and it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


class Vocabulary:
    """Ranks with what the prefix table needs: the tokens that end at each place, and which pairs of tokens fit."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        #: Finds (place of the last byte, (id, bytes)) of every token in a string of bytes, longest first.
        self.tokens_in = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.tokens_in.add_word(t.decode("latin-1"), (i, len(t)))
        self.tokens_in.make_automaton()
        #: Right token -> left token -> whether they fit.
        self._fits: dict[int, dict[int, bool]] = {i: {} for i in self.token}
        self._known = 0

    def merged(self, data: bytes) -> list[bytes]:
        """Encoding by merging, lowest rank first; for short strings only."""
        get, none = self.ranks.get, 1 << 60
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [get(data[i:i + 2], none) for i in range(len(data) - 1)]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stand next to each other in some encoding; left -1: whether the right one stands at all."""
        parts = ([self.token[left]] if left >= 0 else []) + [self.token[right]]
        known = self.merged(b"".join(parts)) == parts
        if self._known >= KNOWN_PAIRS:
            self._fits, self._known = {i: {} for i in self.token}, 0
        self._fits[right][left] = known
        self._known += 1
        return known

    def extend(self, data: bytes, last: list[int]) -> None:
        """Fill ``last`` (last[i]: last token of the first i bytes; last[0] is -1) up to the end of ``data``."""
        done = len(last) - 1
        last += [-1] * (len(data) - done)
        fits, filled = self._fits, done
        for end, (t, n) in self.tokens_in.iter(data.decode("latin-1"), max(0, done + 1 - self.longest)):
            if end < filled:  # the place has its token, or had it before
                continue
            left = last[end + 1 - n]
            ok = fits[t].get(left)
            if ok or ok is None and self.fits(left, t):
                last[end + 1] = t
                filled = end + 1
            fits = self._fits
        if filled < len(data):
            raise ValueError(f"the vocabulary can't encode byte {data[filled]}")

    def walk_back(self, last: list[int]) -> list[int]:
        ids, at = [], len(last) - 1
        while at > 0:
            ids.append(last[at])
            at -= len(self.token[last[at]])
        return ids[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token is that token; else the prefix table decides."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last = [-1]
        self.extend(data, last)
        return self.walk_back(last)

    def encode(self, text: str) -> list[int]:
        return [i for m in self.pattern.findall(text) for i in self.encode_piece(m.encode())]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Editor:
    """A text whose ids stay exact under appends and edits, with work near the change only.

    Pieces depend on little before them: matching starts anew two pieces before
    a change and stops where old piece borders are met again.  Within a piece
    that only grew, the prefix table goes on where it ended.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, ""
        self.starts: list[int] = []
        self.tables: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in place of the characters from start to stop."""
        old_starts, old_tables, old_text = self.starts, self.tables, self.text
        self.text = old_text[:start] + new + old_text[stop:]
        shift = len(new) - (stop - start)
        first = max(0, int(np.searchsorted(old_starts, start, side="left")) - 2) if old_starts else 0
        at = old_starts[first] if old_starts else 0
        # A match may end before the change only because of what it saw just behind itself.
        tail = {s + shift: k for k, s in enumerate(old_starts) if s >= stop}
        starts, tables, kept = old_starts[:first], old_tables[:first], None
        for m in self.vocabulary.pattern.finditer(self.text, at):
            if m.start() >= start + len(new) and m.start() in tail:
                kept = tail[m.start()]
                break
            data, reuse = m.group().encode(), [-1]
            k = len(starts)
            if k < len(old_starts) and old_starts[k] == m.start():
                end = old_starts[k + 1] if k + 1 < len(old_starts) else len(old_text)
                before = old_text[old_starts[k]:end].encode()
                same = next((i for i, (a, b) in enumerate(zip(before, data, strict=False)) if a != b), min(len(before), len(data)))
                reuse = old_tables[k][:same + 1]
            self.vocabulary.extend(data, reuse)
            starts.append(m.start())
            tables.append(reuse)
        if kept is not None:
            starts += [s + shift for s in old_starts[kept:]]
            tables += old_tables[kept:]
        self.starts, self.tables = starts, tables

    def ids(self) -> list[int]:
        out = []
        for k, table in enumerate(self.tables):
            end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text)
            whole = self.vocabulary.ranks.get(self.text[self.starts[k]:end].encode())
            out += [whole] if whole is not None else self.vocabulary.walk_back(table)
        return out


class _Bounded(dict):
    """A cache of texts' packed ids that is emptied before it holds more than CACHE_BYTES; long texts are not kept."""

    def __init__(self):
        super().__init__()
        self.held = 0

    def keep(self, text: str, packed: bytes) -> bytes:
        if len(text) <= CACHED_CHARS:
            size = sys.getsizeof(text) + sys.getsizeof(packed) + ENTRY_BYTES
            if self.held + size > CACHE_BYTES:
                self.clear()
                self.held = 0
            self.held += size
            self[text] = packed
        return packed


class _PackedPieces(_Bounded):
    """Piece of text -> its ids as packed little-endian 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        ids = self.vocabulary.encode_piece(piece.encode())
        return self.keep(piece, struct.pack(f"<{len(ids)}I", *ids))


class _Packed(_Bounded):
    """Chunk of text, of one or more pieces -> its packed ids."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.pieces = vocabulary, _PackedPieces(vocabulary)

    def __missing__(self, chunk: str) -> bytes:
        return self.keep(chunk, b"".join(map(self.pieces.__getitem__, self.vocabulary.pattern.findall(chunk))))


_packed: dict[int, _Packed] = {}


def _worker_cache(key: int, ranks: bytes, pattern: str) -> _Packed:
    """One vocabulary and cache for each Python worker, kept between tasks."""
    if key not in _packed:
        _packed.clear()
        _packed[key] = _Packed(Vocabulary(read_ranks(ranks), pattern))
    return _packed[key]


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, path: str, pattern: str, verified: bool = False) -> DataFrame:
    """(doc_id, ids, decoded): ids packed as little-endian unsigned 32-bit integers; the bytes that they decode to.

    ``path`` names a rank file that the driver can read; its bytes are broadcast.
    ``verified`` stops at a document whose ids do not decode to its whole text,
    as those of a pattern that leaves characters out do.
    """
    data = vocabulary_bytes(path)
    shared, key = ready(docs.sparkSession).sparkContext.broadcast(data), hash((data, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = _worker_cache(key, shared.value, pattern)
        token = packed.vocabulary.token

        def made(ids, ids_out, decoded):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ids_out, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

        for batch in batches:
            doc_ids, ids_out, decoded, held = [], [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                ids = b"".join(map(packed.__getitem__, _CHUNK.findall(text)))
                doc_ids.append(doc_id.as_py())
                ids_out.append(ids)
                decoded.append(b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist())))
                if verified and decoded[-1] != text.encode():
                    raise ValueError(f"the ids of document {doc_ids[-1]} do not decode to its text")
                held += 3 * len(text) + len(ids)
                if held > BATCH_BYTES:
                    yield made(doc_ids, ids_out, decoded)
                    doc_ids, ids_out, decoded, held = [], [], [], 0
            if doc_ids:
                yield made(doc_ids, ids_out, decoded)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")
