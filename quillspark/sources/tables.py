"""Table, text and archive sources."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and content of every file below ``path``; reading only paths doesn't open the files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Sorted-able relative paths only; the content column is pruned from the scan."""
    return files(spark, path, glob).select("path", "length")


def verified(archives: DataFrame, checksums: DataFrame) -> DataFrame:
    """``archives`` (name, content) with their SHA-256 and whether it is the one of ``checksums`` (name, sha256); null where none is stated."""
    a = archives.withColumn("actual", F.sha2("content", 256))
    return a.join(checksums, "name", "left").withColumn("ok", F.col("actual") == F.lower("sha256"))


def stale(archives: DataFrame, extracted: DataFrame) -> DataFrame:
    """Archives whose digest no marker in ``extracted`` (sha256) records: what is left to extract."""
    return archives.join(extracted.select(F.col("sha256").alias("actual")), "actual", "left_anti")


def unsafe_entry(name: Column) -> Column:
    """Whether an archive entry would leave its folder: absolute, or climbing by a ``..`` segment."""
    return name.rlike(r"^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)")


ENTRY = "path string, name string, data binary, method int, error string"


def unzip(archives: DataFrame) -> DataFrame:
    """Entries of zip archives (path, content): name, data, method, error.

    Stored and deflated entries only. A row with an error stands for an entry or archive that is
    refused: zip64, other methods, wrong size or checksum, bad header, escaping name. Directory
    entries are skipped. Archives are independent, one at a time is in memory.
    """

    def entries(path: str, content: bytes) -> Iterator[tuple]:
        try:
            z = zipfile.ZipFile(io.BytesIO(content))
        except zipfile.BadZipFile as e:
            yield path, None, None, None, f"bad header: {e}"
            return
        for info in z.infolist():
            if info.is_dir():
                continue
            if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                yield path, info.filename, None, info.compress_type, f"method {info.compress_type} isn't read"
            elif info.file_size >= 0xFFFFFFFF or info.extract_version >= 45:
                yield path, info.filename, None, info.compress_type, "zip64 entries aren't read"
            else:
                try:
                    data = z.read(info)
                    wrong = "size mismatch" if len(data) != info.file_size else None
                    yield path, info.filename, None if wrong else data, info.compress_type, wrong
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, EOFError) as e:
                    yield path, info.filename, None, info.compress_type, f"bad entry: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                rows = list(entries(path, bytes(content)))
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "name", "data", "method", "error"])

    out = archives.select("path", "content").mapInPandas(run, ENTRY)
    return out.withColumn("error", F.when(unsafe_entry(F.col("name")), "escapes its folder").otherwise(F.col("error"))).withColumn("data", F.when(F.col("error").isNull(), F.col("data")))


def markdown(files: DataFrame) -> DataFrame:
    """Front matter and body of Markdown documents (path, content): path, keys (map), sources, defined_terms, h1, body.

    The reader shares no code with the emitter; it takes ``key: value`` lines, a flow list of
    sources and a block list of terms.
    """
    from quillspark.functions.yamlish import unquote

    head = F.regexp_extract("content", r"(?s)\A---\n(.*?)\n---\n", 1)
    rest = F.regexp_replace("content", r"(?s)\A---\n.*?\n---\n+", "")
    lines = F.split(head, "\n")
    plain = F.filter(lines, lambda x: x.rlike(r"^[a-z_]+: "))
    keys = F.map_from_entries(F.transform(plain, lambda x: F.struct(F.substring_index(x, ": ", 1), unquote(F.regexp_replace(x, "^[a-z_]+: ", "")))))
    return files.select(
        "path", keys.alias("keys"),
        F.transform(F.regexp_extract_all(F.regexp_extract(head, r"(?m)^sources: \[(.*)\]$", 1), F.lit(r'"(?:[^"\\]|\\.)*+"|[^,\s"][^,]*'), F.lit(0)), unquote).alias("sources"),
        F.transform(F.filter(lines, lambda x: x.startswith("  - ")), lambda x: unquote(F.substring(x, 5, F.length(x)))).alias("defined_terms"),
        F.regexp_extract(rest, r"\A# ([^\n]*)", 1).alias("h1"),
        F.trim(F.regexp_replace(rest, r"\A# [^\n]*\n*", ""), F.lit("\n")).alias("body"), "content",
    )


def links(pages: DataFrame, prefix: str | None = None) -> DataFrame:
    """Distinct canonical link targets of each page (page_id, html), those below ``prefix`` if given."""
    from quillspark.functions.urls import canonical

    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    targets = F.array_distinct(F.filter(F.transform(found, canonical), lambda u: (u != "") & (u.startswith(prefix) if prefix else F.lit(True))))
    return pages.select("page_id", F.explode(targets).alias("link"))


def images(listing: DataFrame) -> DataFrame:
    """Files of a package's image folder (doc, path): doc, name, state; the folder's name in any case, several ⇒ ambiguous, none ⇒ absent."""
    found = listing.withColumn("folder", F.regexp_extract("path", r"(?i)(?:^|/)(images)/[^/]+$", 1))
    by = found.groupBy("doc").agg(F.size(F.collect_set(F.when(F.col("folder") != "", F.col("folder")))).alias("n"))
    named = found.where("folder <> ''").select("doc", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    return by.join(named, "doc", "left").select("doc", "name", F.when(F.col("n") == 0, "absent").when(F.col("n") > 1, "ambiguous").otherwise("listed").alias("state"))


def json_or_null(text: Column, schema: str) -> Column:
    """A JSON value, null where it is missing or corrupt."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def redact(text: Column, keys: str = "key|token|secret|password|authorization") -> Column:
    """A JSON text with the string values of secret-looking keys replaced, at any depth."""
    return F.regexp_replace(text, rf'(?i)("[^"]*(?:{keys})[^"]*"\s*:\s*)"(?:[^"\\]|\\.)*+"', '$1"[redacted]"')


def probed(urls: DataFrame, statuses: DataFrame, most_errors: int = 5) -> tuple[DataFrame, DataFrame]:
    """URLs with the state of their last probe (url, attempt, status): present, missing or error; and the violation
    that stops a run: ``most_errors`` URLs or more gave neither 200 nor 404. A URL without a probe is an error."""
    from quillspark.functions.urls import head_state
    from quillspark.operators.guards import violation

    last = statuses.groupBy("url").agg(F.max_by("status", "attempt").alias("status"))
    states = urls.select("url").distinct().join(last, "url", "left").withColumn("state", head_state(F.coalesce("status", F.lit(0))))
    errors = states.where("state = 'error'").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first")).where(F.col("n") >= most_errors)
    return states, violation(errors, "probe", "first", "concat(n, ' without answer')")


def upload_plan(figures: DataFrame, states: DataFrame) -> DataFrame:
    """What is to be sent (url, path, content type): figures (url, path) that the probe finds missing. A name without known type is a violation (null)."""
    from quillspark.functions.urls import content_type

    return figures.join(states.where("state = 'missing'").select("url"), "url", "left_semi").select("url", "path", content_type(F.col("path")).alias("content_type")).distinct()
