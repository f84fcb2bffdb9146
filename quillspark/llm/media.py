"""Telephony audio columns: companded bytes, ADPCM blocks, resampled PCM.

Mu-law and A-law samples expand by 256-entry lookup tables built from the G.711 rules. IMA ADPCM
blocks are decoded with numpy across blocks: the loop runs over the sample positions in a block,
each step handles every block of the batch at once. A stored form is a RIFF/WAVE file.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: WAVE format tags (fixed values).
PCM, ALAW, MULAW = 1, 6, 7
BLOCK = 64
RATE, OUT_RATE = 8000, 16000


@functools.lru_cache(maxsize=1)
def mulaw_table() -> np.ndarray:
    """16-bit samples of the mu-law codes: sign, 3 bits of exponent, 4 of mantissa, all inverted, bias 132."""
    u = ~np.arange(256) & 0xFF
    mag = (((u & 15) << 3) + 132 << (u >> 4 & 7)) - 132
    return np.where(u & 128, -mag, mag).astype("<i2")


@functools.lru_cache(maxsize=1)
def alaw_table() -> np.ndarray:
    """16-bit samples of the A-law codes: even bits inverted, linear below exponent 1."""
    a = np.arange(256) ^ 0x55
    e, m = a >> 4 & 7, (a & 15) << 4
    mag = np.where(e == 0, m + 8, (m + 264) << np.maximum(e - 1, 0))
    return np.where(a & 128, mag, -mag).astype("<i2")


@functools.lru_cache(maxsize=1)
def adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """For state ``index * 16 + nibble``: the signed difference, and the next index times 16.

    The 89 steps of IMA ADPCM follow no exact rule, so they are stated as fixed values.
    """
    steps = np.array(
        [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767]
    )
    moves = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2)
    n = np.arange(16)
    s = steps[:, None]
    diff = (s >> 3) + np.where(n & 1, s >> 2, 0) + np.where(n & 2, s >> 1, 0) + np.where(n & 4, s, 0)
    diff = np.where(n & 8, -diff, diff)
    nxt = np.clip(np.arange(89)[:, None] + moves, 0, 88) * 16
    return diff.ravel().astype(np.int32), nxt.ravel().astype(np.int32)


def adpcm_decode(blocks: np.ndarray) -> np.ndarray:
    """PCM of IMA ADPCM blocks, an array of n x size bytes: n x (2 * (size - 4) + 1) samples.

    A block starts with its first sample (16 bits, little-endian), the step index (held to 0..88)
    and an unused byte; the low nibble of a byte comes first.
    """
    diff, nxt = adpcm_tables()
    n, size = blocks.shape
    out = np.empty((2 * (size - 4) + 1, n), "<i2")
    pred = (blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8).astype(np.int16).astype(np.int32)
    state = np.minimum(blocks[:, 2], 88).astype(np.int32) * 16
    out[0] = pred
    body = np.ascontiguousarray(blocks[:, 4:].T)
    for i in range(size - 4):
        for j, nib in enumerate((body[i] & 15, body[i] >> 4)):
            k = state + nib
            pred += diff[k]
            np.clip(pred, -32768, 32767, out=pred)
            state = nxt[k]
            out[2 * i + j + 1] = pred
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray, up: int = OUT_RATE // RATE) -> np.ndarray:
    """Linear interpolation to ``up`` times the rate; the last sample is held. Integer arithmetic, floor."""
    if not len(pcm):
        return pcm
    x = pcm.astype(np.int32)
    d = np.append(np.diff(x), 0)
    return ((x[:, None] * up + d[:, None] * np.arange(up)) // up).astype("<i2").ravel()


def wav(data: bytes, tag: int, bits: int, rate: int) -> bytes:
    """A mono WAVE file around ``data``; chunks are padded to even length."""
    align = bits // 8
    fmt = struct.pack("<HHIIHH", tag, 1, rate, rate * align, align, bits)
    chunks = [(b"fmt ", fmt if tag == PCM else fmt + b"\0\0")]
    if tag != PCM:
        chunks.append((b"fact", struct.pack("<I", len(data) // align)))
    chunks.append((b"data", data))
    body = b"WAVE" + b"".join(k + struct.pack("<I", len(v)) + v + b"\0" * (len(v) % 2) for k, v in chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, int, bytes]:
    """(format tag, rate, sample bytes) of a WAVE file; raises ValueError if it isn't one."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, tag, rate = 12, 0, 0
    while at + 8 <= len(media):
        kind, n = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if kind == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif kind == b"data":
            return tag, rate, media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


def expand(tag: int, data: bytes) -> np.ndarray:
    """16-bit samples of stored bytes, by format tag."""
    if tag == PCM:
        return np.frombuffer(data, "<i2")
    return (mulaw_table() if tag == MULAW else alaw_table())[np.frombuffer(data, np.uint8)]


def pad(data: bytes, unit: int = BLOCK) -> bytes:
    """``data`` with bytes 0 up to a positive multiple of ``unit``."""
    return data + b"\0" * (-len(data) % unit or (0 if data else unit))


def stored(text: str | None) -> bytes:
    """The stored form of a text: a mu-law WAVE file whose samples are its padded UTF-8 bytes; a null counts as empty."""
    return wav(pad((text or "").encode()), MULAW, 8, RATE)


def resampled(media: bytes) -> bytes:
    """A stored form's samples, expanded and resampled, as a 16-bit PCM WAVE file."""
    tag, _, data = read_wav(media)
    return wav(resample(expand(tag, data)).tobytes(), PCM, 16, OUT_RATE)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about a megabyte of text, one row at least: what is made of a slice is several times its size."""
    sizes = np.cumsum([len(x.as_py() or "") for x in batch.column(text)])
    at = 0
    while at < batch.num_rows:
        rows = max(1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (1 << 20), "right")) - at)
        yield batch.slice(at, rows)
        at += rows


def store_audio(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``media`` (mu-law WAVE holding the text's padded bytes) and ``pcm`` (resampled 16-bit WAVE).

    A null text counts as empty: one block of bytes 0. Rows are independent, repeated ones too; an
    empty table gives none. Other columns pass, columns of the two names are replaced.
    """
    from pyspark.sql import functions as F

    keep = df.drop("media", "pcm")
    schema = keep.withColumns({"media": F.lit(b""), "pcm": F.lit(b"")}).schema
    names = [f.name for f in keep.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, text):
                media = [stored(x.as_py()) for x in b.column(text)]
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(media, pa.binary()), pa.array(map(resampled, media), pa.binary())], names=[*names, "media", "pcm"])

    return keep.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: sizes and digests of what ``store_audio`` stores of its text, and features read back from it.

    Both forms are made by the functions that make its columns, in the task that takes their
    digests, so they don't travel. Null, empty and repeated rows as there; doc_id is of any type.
    ADPCM blocks of all texts in a slice of the batch are decoded together, then cut apart again.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, "text"):
                yield _digest_slice(b.column("doc_id"), [x.as_py() for x in b.column("text")])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def _digest_slice(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    media = [stored(x) for x in texts]
    back = [read_wav(m) for m in media]
    joined = np.frombuffer(b"".join(p for _, _, p in back), np.uint8).reshape(-1, BLOCK)
    adpcm = np.concatenate([adpcm_decode(joined[i : i + 4096]) for i in range(0, len(joined), 4096)])
    sha = lambda x: hashlib.sha256(x).hexdigest()
    feature, block = [], 0
    for m, (tag, _, payload) in zip(media, back, strict=True):
        pcm = expand(tag, payload)
        wide = pcm.astype(np.int64)
        n = len(payload) // BLOCK
        turns = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
        feature.append(
            f"peak={int(max(abs(int(pcm.max())), abs(int(pcm.min()))))};rms={math.isqrt(int(wide @ wide) // len(pcm))};turns={turns};pcm16k={zlib.crc32(read_wav(resampled(m))[2]):08x};"
            f"alaw={zlib.crc32(expand(ALAW, payload)):08x};adpcm={zlib.crc32(adpcm[block : block + n]):08x}"
        )
        block += n
    cols = [
        ids, pa.array((len((x or "").encode()) for x in texts), pa.int64()), pa.array((len(p) for _, _, p in back), pa.int64()), pa.array((sha(p) for _, _, p in back), pa.string()),
        pa.array((zlib.crc32(p[-BLOCK:]) for _, _, p in back), pa.int64()), pa.array(map(len, media), pa.int64()), pa.array(map(sha, media), pa.string()), pa.array(feature, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
