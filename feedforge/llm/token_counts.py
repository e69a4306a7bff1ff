"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole. The byte lengths of its tokens give
their spans; the spans are interval-joined to the sections of the text by binary
search on the section bounds. Sections are paragraphs: a section ends after a run
of line breaks, which belongs to it.

Rule for a token that crosses a boundary: it counts for the section that holds
most of its bytes, at a tie for the first of these. So the counts of the sections
add up to the tokens of the whole text.

Defined results: a null or empty text has one section 0 of no characters and no
tokens. Repeated rows are counted each; a null id stays null. Characters are
Unicode code points; a token inside of a character spans the whole character.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    sizes = np.zeros(max(table.values()) + 1, dtype=np.int64)
    for token, i in table.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={}), sizes


def section_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets where sections begin: 0, and after every run of line breaks."""
    brk = raw == 10
    return np.concatenate([[0], np.flatnonzero(brk[:-1] & ~brk[1:]) + 1]) if len(raw) else np.array([0])


def attribute(ends: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token, and whether it crosses a boundary.

    ``ends`` are the end offsets of consecutive tokens from 0, ``starts`` the
    begins of the sections; ``size`` is the length of the text.
    """
    begins = np.concatenate([[0], ends])[:len(ends)]
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, np.maximum(ends - 1, begins), side="right") - 1
    section, bounds = first.copy(), np.append(starts, size)
    for t in np.flatnonzero(last > first):
        held = [min(ends[t], bounds[s + 1]) - max(begins[t], bounds[s]) for s in range(first[t], last[t] + 1)]
        section[t] = first[t] + int(np.argmax(held))
    return section, last > first


def token_counts(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, section, start_char, end_char, n_tokens, n_crossing, document_tokens).

    ``n_crossing`` are the tokens of the section that reach into another one.
    """
    ship(documents.sparkSession)
    ranks = open(ranks_path, "rb").read()

    def run(batch: pa.RecordBatch):
        encoding, sizes = _encoding(ranks, pattern)
        ids, out = [], [[] for _ in range(6)]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            starts = section_starts(raw)
            ends = np.cumsum(sizes[np.array(encoding.encode_ordinary(text), dtype=np.int64)])
            section, crossing = attribute(ends, starts, len(raw))
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            n = len(starts)
            ids.extend([doc_id] * n)
            for column, values in zip(out, (
                    np.arange(n), chars[starts], chars[np.append(starts[1:], len(raw))],
                    np.bincount(section, minlength=n), np.bincount(section[crossing], minlength=n),
                    np.full(n, len(ends)))):
                column.append(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(np.concatenate(c).astype(np.int64)) for c in out)],
            ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "document_tokens"])

    def parts(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 500):
            yield from run(batch.slice(at, 500))

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(chosen, parts, "doc_id long, section long, start_char long, end_char long, "
                                      "n_tokens long, n_crossing long, document_tokens long")
