"""Token counts per section from one encoding of the whole document.

A document is encoded once, as a whole.  The tokenizer is byte level, so the
byte lengths of its ids add up to the document's bytes and their running sum is
an exact offset map.  Sections (lines, or named fields joined by line feeds) are
intervals on the same axis; tokens meet them in an interval join of two sorted
lists.  A token that crosses a boundary goes to the section holding most of its
bytes, and in a tie to the earlier one, so a document's section counts always add
up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of

COUNTS = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"
#: Split of GPT-2 style vocabularies (fixed value of the vocabulary file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_encoder(ranks_path: str):
    """``(encoding, byte length of each id)`` from a file of base64 tokens and ranks."""
    import base64

    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def attribute(token_bytes: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section.

    ``token_bytes``: byte lengths of the tokens in order; ``section_ends``: byte
    ends of the sections, ascending, the last one the document's length.  Each
    token goes to the section with most of its bytes, ties to the earlier.
    """
    n = len(section_ends)
    end = np.cumsum(token_bytes)
    start = end - token_bytes
    first = np.searchsorted(section_ends, start, side="right")
    last = np.searchsorted(section_ends, end, side="left")
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    for t in crossing:  # a handful: only tokens that hold a boundary
        sections = np.arange(first[t], last[t] + 1)
        lo = np.maximum(start[t], np.concatenate(([0], section_ends))[sections])
        share = np.minimum(end[t], section_ends[sections]) - lo
        owner[t] = sections[int(np.argmax(share))]
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def section_token_counts(docs: DataFrame, ranks_path: str, fields: list[str] | None = None) -> DataFrame:
    """One row per section with its characters' span and its tokens.

    Without ``fields`` the sections are the lines of ``text`` (a line keeps its
    line feed).  With ``fields`` the document is those columns joined by line
    feeds and each column is a section.  ``start``/``end`` are character offsets,
    ``n_crossing`` counts the section's tokens that reach over its boundary,
    ``doc_tokens`` all tokens of the document.  A null or empty text is one
    section of no characters and no tokens; a null field an empty section;
    repeated rows are counted each by itself.
    """
    if fields:
        parts = F.array(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), parts.alias("parts"))
    else:
        source = documents_of(docs)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, sizes = load_encoder(ranks_path)
        for batch in batches:
            ids, numbers, starts, ends, tokens, crossings, totals = [], [], [], [], [], [], []
            for doc_id, body in zip(batch["doc_id"], batch[batch.columns[1]], strict=True):
                if isinstance(body, str):
                    sections = body.split("\n")
                else:
                    sections = list(body)
                text = "\n".join(sections)
                m = len(sections)
                chars = np.fromiter(map(len, sections), np.int64, m)
                chars[:-1] += 1
                if text.isascii():
                    size = chars
                else:
                    size = np.fromiter((len(s.encode("utf-8")) for s in sections), np.int64, m)
                    size[:-1] += 1
                token_bytes = sizes[np.asarray(encoding.encode_ordinary(text), dtype=np.int64)]
                if len(token_bytes):
                    own, crossing = attribute(token_bytes, np.cumsum(size))
                else:
                    own = crossing = np.zeros(m, dtype=np.int64)
                stop = np.cumsum(chars)
                ids += [None if pd.isna(doc_id) else int(doc_id)] * m
                numbers.append(np.arange(m))
                starts.append(stop - chars)
                ends.append(stop)
                tokens.append(own)
                crossings.append(crossing)
                totals.append(np.full(m, len(token_bytes)))
            if ids:
                flat = [np.concatenate(x) for x in (numbers, starts, ends, tokens, crossings, totals)]
                yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "section": flat[0].astype(np.int32),
                                    "start": flat[1], "end": flat[2], "n_tokens": flat[3], "n_crossing": flat[4],
                                    "doc_tokens": flat[5]})

    return source.mapInPandas(count, COUNTS)
