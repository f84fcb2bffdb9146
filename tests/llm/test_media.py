import hashlib
import zlib

import numpy as np
from edges import empty, odd

from quillspark.llm import media, queries


def slow_adpcm(block):
    """One block, one sample at a time."""
    diff, nxt = media.adpcm_tables()
    pred, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [pred]
    for b in block[4:]:
        for nib in (b & 15, b >> 4):
            pred = max(-32768, min(32767, pred + int(diff[index * 16 + nib])))
            index = int(nxt[index * 16 + nib]) // 16
            out.append(pred)
    return out


def test_tables():
    mu, a = media.mulaw_table(), media.alaw_table()
    assert (mu[0], mu[0x7F], mu[0x80], mu[0xFF]) == (-32124, 0, 32124, 0) and (a[0x55], a[0xD5], a[0x2A], a[0xAA]) == (-8, 8, -32256, 32256)
    assert len(set(mu.tolist())) == 255 and len(set(a.tolist())) == 256
    diff, nxt = media.adpcm_tables()
    assert diff[0] == 0 and diff[4] == 7 and diff[12] == -7 and diff[88 * 16 + 7] == 32767 + 16383 + 8191 + 4095 and nxt[0] == 0 and nxt[7] == 8 * 16


def test_adpcm_across_blocks():
    blocks = np.random.default_rng(1).integers(0, 256, (17, 64), dtype=np.uint8)
    assert media.adpcm_decode(blocks).tolist() == [slow_adpcm(bytes(b)) for b in blocks]
    assert media.adpcm_decode(np.empty((0, 64), np.uint8)).shape == (0, 121)


def test_resample_and_wav():
    assert media.resample(np.array([0, 10, -11], "<i2")).tolist() == [0, 5, 10, -1, -11, -11]
    for data in (b"", b"abc", bytes(range(256))):
        assert media.read_wav(media.wav(data, media.MULAW, 8, 8000)) == (media.MULAW, 8000, data)


def test_query(spark, sf):
    text = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_telephony(spark, sf).collect():
        p = media.pad(text[r["doc_id"]])
        assert len(p) % 64 == 0 and len(p) > 0 and p.rstrip(b"\0") == text[r["doc_id"]].rstrip(b"\0")
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len(text[r["doc_id"]]), len(p), zlib.crc32(p[-64:]))
        assert r["payload_sha256"] == hashlib.sha256(p).hexdigest() and r["media_sha256"] == hashlib.sha256(media.wav(p, media.MULAW, 8, 8000)).hexdigest()
        assert f"adpcm={zlib.crc32(media.adpcm_decode(np.frombuffer(p, np.uint8).reshape(-1, 64))):08x}" in r["feature"]


def test_odd_rows(spark):
    got = media.store_audio(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    for r in got:
        assert media.read_wav(bytes(r["media"]))[2] == media.pad((r["text"] or "").encode()) and media.read_wav(bytes(r["pcm"]))[1] == 16000
    d = media.digests(odd(spark)).collect()
    assert len({tuple(r)[1:] for r in d if r["n_bytes"] == 0}) == 1 and media.digests(empty(spark)).count() == 0 and media.store_audio(empty(spark)).count() == 0
