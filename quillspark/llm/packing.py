"""Bounded-space online packing of token ids into fixed windows.

Each partition keeps at most ``open_windows`` windows. A document's full windows leave at once;
its remainder goes to the open window that it fits best. When none fits, the fullest window takes
what it has room for and is emitted full, and the rest of the document is placed again. What is
open at the end of a partition is merged over groups of ``fan_in`` partitions, level by level,
until one partial window is left. Every emitted window but that one is full.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import materialise

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, unit long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "unit"]
#: Digits of a sequence_id: level, unit (partition or group) and a counter within it.
LEVEL, UNIT = 1 << 58, 1 << 30


@functools.lru_cache(maxsize=2)
def tokenizer_core(path: str, pattern: str):
    """Encoder for the vocabulary of a ``tokenizers`` JSON file, and the ids of the tokens the file adds.

    In a byte-level BPE file the order of ids is the order of merges, so the vocabulary is its own
    table of ranks; characters stand for bytes by the usual printable mapping. The encoder knows
    none of the added tokens (special ones): to it their strings are ordinary text.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    added = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
    if any(t[k] for t in doc.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take in white space, need word bounds or are normalised")
    table = {bytes(byte_of[c] for c in t): i for t, i in doc["model"]["vocab"].items() if t not in added}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=table, special_tokens={}), added


def encoder(path: str, pattern: str, added_tokens: bool):
    """Function from a text to its ids. added_tokens: strings of added tokens in a text are these tokens, as
    ``tokenizers`` has it by default; else they are ordinary text, as with its ``encode_special_tokens``."""
    core, added = tokenizer_core(path, pattern)
    plain = lambda t: np.frombuffer(core._core_bpe.encode_to_tiktoken_buffer(t, set()), np.uint32)
    if not added_tokens or not added:
        return plain
    # of two that start at one place the longer one counts
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def encode(text: str) -> np.ndarray:
        parts = split(text)
        return plain(text) if len(parts) == 1 else np.concatenate([np.array([added[x]], np.uint32) if i % 2 else plain(x) for i, x in enumerate(parts)])

    return encode


class Packer:
    """Open windows of one partition or group. ``done`` gets the pieces of emitted windows."""

    def __init__(self, size: int, open_windows: int, base: int):
        self.size, self.most, self.next_id = size, open_windows, base
        self.open: list[list] = []  # [fill, pieces]
        self.done: list[tuple] = []

    def emit(self, pieces: list[tuple], keep_ids: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            data = ids.tobytes()
            self.done.append((doc, start, len(ids), zlib.crc32(data), total, self.next_id, at, data if keep_ids else None))
            at += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.size:
            self.emit([(doc, start, ids[: self.size], total)])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            fits = [w for w in self.open if w[0] + len(ids) <= self.size]
            if fits:
                best = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(best := [0, []])
            else:
                best = max(self.open, key=lambda w: w[0])
            n = min(len(ids), self.size - best[0])
            best[1].append((doc, start, ids[:n], total))
            best[0] += n
            if best[0] == self.size:
                self.open = [w for w in self.open if w is not best]
                self.emit(best[1])
            start, ids = start + n, ids[n:]

    def batch(self, unit: int) -> pa.RecordBatch:
        cols = list(zip(*self.done, strict=True)) or [()] * 8
        types = [pa.int64()] * 7 + [pa.binary()]
        self.done, n = [], len(self.done)
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types, strict=True)), pa.array([unit] * n, pa.int64())], names=NAMES)


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = 1, size: int = 2048, open_windows: int = 32, fan_in: int = 64, added_tokens: bool = False) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is a document of ``end_id`` alone. Repeated rows are packed as documents
    of their own, a null doc_id stays null; doc_id is a long. Of windows that a piece fits equally
    well, and of those equally full, the one opened first takes it. Other columns of ``docs`` don't
    matter, whatever their names. An empty table gives no rows. added_tokens: as in
    ``encoder``; the query and the pipeline set it. Memory: ``open_windows``
    windows a task; a merging task reads what ``fan_in`` tasks left open.
    """
    first = docs.select("doc_id", "text").mapInArrow(functools.partial(_pack_partition, path=path, pattern=pattern, end_id=end_id, size=size, most=open_windows, fan_in=fan_in, added_tokens=added_tokens), SCHEMA)
    pieces = materialise(first, "pack")
    out, left = pieces.where("ids is null").drop("ids", "unit"), pieces.where("ids is not null")
    groups = (left.agg(F.max("unit")).first()[0] or 0) + 1
    levels = 1
    while groups > 1:
        groups, levels = -(-groups // fan_in), levels + 1
    for level in range(1, levels + 1):
        merged = left.groupBy("unit").applyInArrow(_merger(level, level == levels, size, fan_in), SCHEMA)
        if level < levels:
            merged = materialise(merged, "pack")
        out = out.unionByName(merged.where("ids is null").drop("ids", "unit"))
        left = merged.where("ids is not null")
    return out


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int, size: int, most: int, fan_in: int, added_tokens: bool = False) -> Iterator[pa.RecordBatch]:
    encode = encoder(path, pattern, added_tokens)
    unit = TaskContext.get().partitionId()
    p = Packer(size, most, unit * UNIT)
    for b in batches:
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
            ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
            p.add(doc, 0, ids, len(ids))
        if p.done:
            yield p.batch(-1)
    for _, pieces in p.open:
        p.emit(pieces, keep_ids=True)
    yield p.batch(unit // fan_in)


def _merger(level: int, last: bool, size: int, fan_in: int):
    def run(table: pa.Table) -> pa.Table:
        return _merge_group(table, level, last, size, fan_in)

    return run


def _merge_group(table: pa.Table, level: int, last: bool, size: int, fan_in: int) -> pa.Table:
    """Windows left open by one group of tasks, filled one after another; the partial last one goes up a level."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
    unit = rows[0]["unit"]
    p = Packer(size, 1, level * LEVEL + unit * UNIT)
    for r in rows:
        p.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
    for _, pieces in p.open:
        p.emit(pieces, keep_ids=not last)
    return pa.Table.from_batches([p.batch(unit // fan_in)])
