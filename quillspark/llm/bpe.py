"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into halves until a leaf is small, leaves are encoded, and neighbours are joined.
A join keeps all tokens outside a window around the seam and encodes the window afresh.  Two
facts make "outside" provable:

* Text level.  No match of the splitting pattern spans a *sync point* (see ``SYNC``): a place
  between a letter, digit or sign and a white-space character, after a run of letters, after a run
  of digits, or before a digit that follows a sign.  Matching looks only forward, so the matches
  on either side of a sync point do not depend on the other side.  A join therefore encodes only
  what lies between the last sync point of the left half and the first one of the right half,
  and the window grows until it reaches both.
* Inside one match.  A sequence of tokens is the BPE encoding of its bytes exactly when each
  neighbouring pair is the encoding of its own bytes.  Very long matches are halved too; the
  window at the seam doubles until the pairs at its two edges pass that test.

Decoding concatenates the bytes of leaves up the same kind of tree.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillspark.llm.common import encoding

#: Positions where a match of the pattern always ends, whatever stands further off.
SYNC = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}])(?=\p{N})")


class TreeCodec:
    """Encoder and decoder for one rank file.

    leaf_chars: texts up to this length are encoded directly.
    leaf_bytes: the same for a single match of the pattern.
    """

    def __init__(self, path: str, pattern: str, leaf_chars: int = 2048, leaf_bytes: int = 4096):
        self.core = encoding(path, pattern)
        self.pattern = regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self._leaf(text)
        mid = len(text) // 2
        return self.join(text[:mid], self.encode(text[:mid]), text[mid:], self.encode(text[mid:]))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The encoding of ``left + right``, given the encodings of both."""
        if not left or not right:
            return left_ids or right_ids
        tail, head = self._tail(left), self._head(right)
        inner = self._leaf(left[tail:] + right[:head])
        keep = len(left_ids) - len(self._leaf(left[tail:]))
        skip = len(self._leaf(right[:head]))
        return left_ids[:keep] + inner + right_ids[skip:]

    def _tail(self, text: str) -> int:
        """Where the last sync point of ``text`` lies; 0 if it has none."""
        span = 32
        while True:
            at = max(0, len(text) - span)
            found = [m.start() for m in SYNC.finditer(text, at)]
            if found:
                return found[-1]
            if at == 0:
                return 0
            span *= 2

    def _head(self, text: str) -> int:
        """Where the first sync point of ``text`` lies; its length if it has none."""
        found = SYNC.search(text)
        return found.start() if found else len(text)

    def _leaf(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self.core.encode_ordinary(text)
        out: list[int] = []
        for m in self.pattern.finditer(text):
            out += self.encode_piece(m[0].encode())
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        if len(data) <= self.leaf_bytes:
            return self.core._encode_single_piece(data)
        mid = len(data) // 2
        return self._join_piece(self.encode_piece(data[:mid]), self.encode_piece(data[mid:]))

    def _join_piece(self, left: list[int], right: list[int]) -> list[int]:
        n = 8
        while True:
            a, b = max(0, len(left) - n), min(len(right), n)
            inner = self.core._encode_single_piece(self.core.decode_bytes(left[a:] + right[:b]))
            if (a == 0 or self._stable(left[a - 1], inner[0])) and (b == len(right) or self._stable(inner[-1], right[b])):
                return left[:a] + inner + right[b:]
            n *= 2

    @functools.lru_cache(maxsize=1 << 16)  # noqa: B019  one codec lives as long as its worker
    def _stable(self, a: int, b: int) -> bool:
        return self.core._encode_single_piece(self.core.decode_bytes([a, b])) == [a, b]

    def decode(self, ids: list[int], leaf: int = 8192) -> bytes:
        if len(ids) <= leaf:
            return self.core.decode_bytes(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf) + self.decode(ids[mid:], leaf)


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> TreeCodec:
    return TreeCodec(path, pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with a column of token ids (array of int). A null text counts as empty and has no ids.

    Rows are independent, so repeated rows and ties need no rule; other columns pass unchanged
    (a column already named like ``ids`` is replaced). No shuffle.
    """
    schema = df.drop(ids).withColumn(ids, _empty_ids()).schema
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            col = pa.array([c.encode(x or "") for x in b.column(text).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([col if n == ids else b.column(n) for n in names], names=names)

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of a column of ids; a null list gives null."""
    from pyspark.sql import functions as F

    schema = df.drop(out).withColumn(out, F.lit(b"")).schema
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            col = pa.array([None if x is None else c.decode(x) for x in b.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([col if n == out else b.column(n) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _empty_ids():
    from pyspark.sql import functions as F

    return F.array().cast("array<int>")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, SHA-256 of the decimal ids joined by one space, and of the decoded bytes.

    Null texts count as empty, rows that repeat others have a result each, an empty table none;
    doc_id is of any type, other columns don't matter. The ids stay inside the task, so only the
    digests leave it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            n, i, d = [], [], []
            for x in b.column("text"):
                ids = c.encode(x.as_py() or "")
                n.append(len(ids))
                i.append(hashlib.sha256(str(ids)[1:-1].replace(",", "").encode()).hexdigest())
                d.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
