"""Token counts by section: offset-mapped attribution of a whole document's tokens.

A document is encoded as a whole, never section by section, so tokens are those of the text as it
stands. The byte lengths of the tokens sum up to byte spans, code-point bounds of the sections are
mapped to bytes, and the two sorted lists of spans are joined by overlap inside the task that has
the text: no token leaves it.

A token that crosses a bound belongs to the section that holds most of its bytes, the earlier one
on a tie. A token that touches no section is counted in a row of its own, so the counts of a
document always sum up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.bpe import codec
from quillspark.llm.common import ranks

NAMES = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]


def line_sections(text: str) -> list[tuple[int, int]]:
    """Each line with the line feed that ends it, as code-point spans; an empty text has one empty line."""
    out, at = [], 0
    for x in text.split("\n"):
        out.append((at, min(at + len(x) + 1, len(text))))
        at += len(x) + 1
    return out


def attributed(widths: np.ndarray, data: bytes, sections: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens and crossing tokens of each section, and the tokens outside all of them.

    widths: bytes of each token of ``data``. sections: code-point spans that don't overlap, in any order.
    """
    counts, crossing = np.zeros(len(sections), np.int64), np.zeros(len(sections), np.int64)
    place = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
    spans = np.array(sections, np.int64).reshape(-1, 2)
    if (spans[:, 0] > spans[:, 1]).any() or (spans < 0).any() or (spans >= len(place)).any():
        raise ValueError("a section lies outside its text")
    spans = place[spans]
    full = np.flatnonzero(spans[:, 0] < spans[:, 1])
    full = full[np.argsort(spans[full, 0], kind="stable")]
    s, e = spans[full, 0], spans[full, 1]
    if (s[1:] < e[:-1]).any():
        raise ValueError("sections overlap")
    right = np.cumsum(widths)
    left = right - widths
    first, last = np.searchsorted(e, left, "right"), np.searchsorted(s, right, "left") - 1
    touches = first <= last
    chosen = first.copy()
    for i in np.flatnonzero(first < last):
        k = np.arange(first[i], last[i] + 1)
        chosen[i] = k[np.argmax(np.minimum(e[k], right[i]) - np.maximum(s[k], left[i]))]
    chosen = chosen[touches]
    counts[full] = np.bincount(chosen, minlength=len(full))
    over = (left[touches] < s[chosen]) | (right[touches] > e[chosen])
    crossing[full] = np.bincount(chosen[over], minlength=len(full))
    return counts, crossing, int((~touches).sum())


def count_tokens(docs: DataFrame, path: str, pattern: str, sections: str | None = None) -> DataFrame:
    """Per row and section: doc_id, section, start, end, n_tokens, n_crossing, doc_tokens.

    sections: a column of arrays of (start, end), code points, end exclusive; they may leave gaps
    but not overlap. Without it the sections are the lines, each with the line feed that ends it.
    section is the place in the array; the tokens outside all sections have a row with null
    section, start and end, if there are any. n_crossing: tokens of n_tokens that reach beyond the
    section. A null text counts as empty, a null array has no sections. Repeated rows are
    documents of their own; a null doc_id stays null. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, table = codec(path, pattern), ranks(path)
        width = np.zeros(max(table.values()) + 1, np.int64)
        width[list(table.values())] = [len(t) for t in table]
        for b in batches:
            row, out = [], [[] for _ in NAMES[1:]]
            given = [None] * b.num_rows if sections is None else b.column("__sections").to_pylist()
            for i, (x, own) in enumerate(zip(b.column("text"), given, strict=True)):
                text = x.as_py() or ""
                spans = line_sections(text) if sections is None else [tuple(o.values()) for o in own or []]
                widths = width[np.array(c.encode(text), np.int64)]
                n, crossing, outside = attributed(widths, text.encode(), spans)
                found = [(k, *span, int(n[k]), int(crossing[k]), len(widths)) for k, span in enumerate(spans)]
                if outside:
                    found.append((None, None, None, outside, 0, len(widths)))
                row += [i] * len(found)
                for col, values in zip(out, zip(*found, strict=True), strict=False):
                    col += values
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(v, pa.int64()) for v in out)], names=NAMES)

    taken = docs.select("doc_id", "text") if sections is None else docs.selectExpr("doc_id", "text", f"`{sections}` as __sections")
    return taken.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in NAMES[1:]))
