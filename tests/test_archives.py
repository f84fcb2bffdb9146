import io
import zipfile

from quillspark.sources import archives


def packed(*entries, method=zipfile.ZIP_DEFLATED, comment=b""):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", method) as z:
        for name, data in entries:
            z.writestr(name, data)
        z.comment = comment
    return bytearray(b.getvalue())


def test_entries_and_refusals(spark, tmp_path):
    flipped = packed(("a", "hello hello hello"), method=zipfile.ZIP_STORED)
    flipped[flipped.index(b"hello")] ^= 1
    header = packed(("a", "x"), ("b", "y"))
    header[header.index(b"PK\x03\x04", 5)] ^= 1
    cut = packed(("a", "x"), ("b", "y"))
    cut[cut.rindex(b"PK\x01\x02")] ^= 1
    short = packed(("a", "x" * 50), method=zipfile.ZIP_STORED)
    at = short.index(b"PK\x01\x02")
    short[at + 24 : at + 28] = (40).to_bytes(4, "little")
    wide = packed(("a", "x"))
    end = wide.rindex(b"PK\x05\x06")
    wide[end + 16 : end + 20] = b"\xff" * 4
    made = {
        "good": packed(("a/b.xml", "<x/>"), ("a/", ""), ("..name", "ok"), ("ü", "u"), comment=b"c" * 60_000), "odd": packed(("../up", "x"), ("/abs", "y"), ("C:x", "z"), ("d\\..\\e", "w")),
        "lzma": packed(("c", "x" * 99), method=zipfile.ZIP_LZMA), "none": bytearray(b"no zip"), "empty": packed(), "nothing": bytearray(), "flipped": flipped, "header": header, "cut": cut, "short": short, "wide": wide,
    }
    (tmp_path / "sub").mkdir()
    for i, (name, data) in enumerate(made.items()):
        (tmp_path / ("sub" if i % 2 else ".") / f"{name}.zip").write_bytes(data)
    (tmp_path / "other.txt").write_text("x")
    for most in (1 << 20, 20):
        got = {(r.archive.rpartition("/")[2][:-4], r.name): (r.data and bytes(r.data), r.error) for r in archives.read_archives(spark, str(tmp_path), most).collect()}
        assert got == {
            ("good", "a/b.xml"): (b"<x/>", None), ("good", "..name"): (b"ok", None), ("good", "ü"): (b"u", None), ("odd", "../up"): (None, "escapes its folder"), ("odd", "/abs"): (None, "escapes its folder"), ("odd", "C:x"): (None, "escapes its folder"), ("odd", "d\\..\\e"): (None, "escapes its folder"),
            ("lzma", "c"): (None, "method 14 isn't read"), ("none", None): (None, "no end record"), ("nothing", None): (None, "no end record"), ("flipped", "a"): (None, "bad checksum"),
            ("header", "a"): (b"x", None), ("header", "b"): (None, "bad local header"), ("cut", "a"): (b"x", None), ("cut", None): (None, "bad directory record 1"), ("short", "a"): (None, "size mismatch"), ("wide", None): (None, "zip64 isn't read"),
        }, most


def test_many_tasks_read_one_archive(spark, tmp_path):
    files = [(f"d/{i}.txt", bytearray(f"text {i} ".encode() * i)) for i in range(200)]
    root = str(tmp_path / "z")
    told = archives.write_archives(spark.createDataFrame(files, "path string, content binary").repartition(2), root).collect()
    assert sum(r.entries for r in told) == 200 and len(told) == 2
    df = archives.read_archives(spark, root, 2000)
    assert df.rdd.getNumPartitions() > 8
    assert {r.name: bytes(r.data) for r in df.collect()} == {n: bytes(d) for n, d in files} and df.where("error is not null").count() == 0
