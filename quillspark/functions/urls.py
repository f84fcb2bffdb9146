"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_component(x: Column) -> Column:
    """Percent-encoding as encodeURIComponent does it."""
    out = F.url_encode(x)
    for code, char in (("+", "%20"), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def file_url(prefix: Column, name: Column) -> Column:
    """A file's URL; parentheses are encoded too, since Markdown ends links with them."""
    return F.concat(prefix, F.lit("/"), F.replace(F.replace(encode_component(name), F.lit("("), F.lit("%28")), F.lit(")"), F.lit("%29")))


def with_fragment(url: Column, id: Column) -> Column:
    return F.when(F.coalesce(id, F.lit("")) == "", url).otherwise(F.concat(url, F.lit("#"), encode_component(id)))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def depth(path: Column) -> Column:
    return F.size(segments(path))


def canonical(url: Column) -> Column:
    """A link without fragment, query and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(url, "[#?].*$", ""), "/+$", "")


def rewrite_prefix(body: Column, prefix: Column, target: Column) -> Column:
    return F.replace(body, F.concat(prefix, F.lit("/")), F.concat(target, F.lit("/")))


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))


#: Content types by extension, and those that pages show inline (fixed values).
CONTENT_TYPES = {"svg": "image/svg+xml", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "avif": "image/avif", "pdf": "application/pdf"}
INLINE = ("svg", "png", "jpg", "jpeg", "gif", "webp", "avif")


def content_type(name: Column) -> Column:
    """The content type of a file name; null where the extension isn't known (a violation)."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in CONTENT_TYPES.items() for x in kv)), extension(name))


def inline_mark(name: Column) -> Column:
    return F.when(extension(name).isin(*INLINE), "!").otherwise("")


def retry_delay_ms(attempt: Column, retry_after_s: Column, base: int = 500, cap: int = 60_000) -> Column:
    """Milliseconds to wait: what the server asks for, up to the cap, else exponential."""
    asked = retry_after_s.try_cast("double") * 1000
    return F.least(F.coalesce(asked, F.lit(base) * F.pow(F.lit(2.0), attempt)), F.lit(float(cap))).cast("long")


def should_retry(method: Column, status: Column, attempt: Column, most: int = 4) -> Column:
    return (F.upper(method) == "GET") & (attempt < most) & (status.isin(408, 429) | (status >= 500))


def head_state(status: Column) -> Column:
    return F.when(status == 200, "present").when(status == 404, "missing").otherwise("error")


def figure_parts(url: Column, host: str) -> Column:
    """year, key, file and problem of an image URL: https, the host, no query or fragment, five decodable segments."""
    path = F.regexp_replace(url, "^https://[^/]+/", "")
    seg = F.split(path, "/")
    name = F.try_url_decode(F.get(seg, F.lit(4)))
    problem = (
        F.when(~url.startswith(f"https://{host}/"), "another host").when(url.rlike("[?#]"), "query or fragment").when(F.size(seg) != 5, "not five segments")
        .when(name.isNull(), "does not decode").when(name.rlike(r"^[.]{1,2}$|/"), "not a file name")
    )
    return F.struct(F.get(seg, F.lit(2)).alias("year"), F.get(seg, F.lit(3)).alias("key"), name.alias("file"), problem.alias("problem"))
