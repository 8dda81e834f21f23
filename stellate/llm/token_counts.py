"""Operator 6: token counts of sections by offset-mapped attribution.

A document is encoded once, whole. The byte lengths of its tokens add up to
their spans; spans in characters follow from the UTF-8 lead bytes. Fields or
sections are spans of the same text, and an interval join (both sides sorted,
so a binary search) gives each token to the spans it overlaps. A token that
crosses a boundary goes to one span by a rule: ``largest`` (most of its
bytes, ties to the earlier span), ``first`` or ``last``.

Lines (with their line break) are the default sections: their counts add up
to the document's tokens. Other spans may leave gaps, whose tokens count
nowhere. Spans may come in any order and their counts keep it; bounds beyond
the text are cut to it; where spans overlap the common part is the one's that
starts first (then: ends first, comes first).

Defined cases: a NULL array has no spans; a NULL span, one with a NULL bound
or one that is empty or backward gets 0 tokens; NULL and empty texts have no tokens and no sections; repeated
rows and NULL ids give one result row each; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that the vocabulary's merges expect.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("largest", "first", "last")


class Encoder:
    """A byte-level BPE and the byte length of each of its tokens."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def token_ends(self, text: str) -> np.ndarray:
        """Ends in bytes of the text's tokens; each begins where the one before ends."""
        return np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), np.int64)])


def byte_offsets(text: str, at: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets."""
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    return np.append(np.flatnonzero(lead), len(lead))[at]


def attribute(ends: np.ndarray, starts_of: np.ndarray, ends_of: np.ndarray, rule: str = "largest") -> tuple[np.ndarray, int]:
    """(tokens per span, tokens over a boundary). ``ends``: ends of tokens;
    spans: sorted, disjoint, in the same unit."""
    out = np.zeros(len(starts_of), np.int64)
    if not len(ends) or not len(out):
        return out, 0
    begins = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(ends_of, begins, "right")  # the first span that ends after the token begins
    last = np.searchsorted(starts_of, ends, "left") - 1  # the last span that starts before it ends
    whole = first == last
    np.add.at(out, first[whole], 1)
    inside = whole & (begins >= starts_of[np.minimum(first, len(out) - 1)]) & (ends <= ends_of[np.minimum(first, len(out) - 1)])
    crossing = int(((first <= last) & ~inside).sum())
    for k in np.flatnonzero(first < last):
        spans = np.arange(first[k], last[k] + 1)
        if rule == "first":
            out[spans[0]] += 1
        elif rule == "last":
            out[spans[-1]] += 1
        else:
            share = np.minimum(ends[k], ends_of[spans]) - np.maximum(begins[k], starts_of[spans])
            out[spans[int(share.argmax())]] += 1
    return out, crossing


def ordered_spans(spans: list, chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, starts, ends) of the spans that hold something, in order and disjoint."""
    found, covered = [], 0
    known = [(s["start"], s["end"], k) for k, s in enumerate(spans) if s and s["start"] is not None and s["end"] is not None]
    for a, b, k in sorted((max(0, a), min(chars, b), k) for a, b, k in known):
        a = max(a, covered)
        if a < b:
            found.append((k, a, b))
            covered = b
    return tuple(np.array([f[i] for f in found], np.int64) for i in range(3))


def line_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    ends = breaks if len(breaks) and breaks[-1] == len(data) else np.append(breaks, len(data))
    return np.concatenate(([0], ends[:-1])), ends


def token_counts(docs: DataFrame, spans: str | None = None, rule: str = "largest", vocabulary: str = VOCABULARY,
                 pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, n_sections, n_crossing, section_tokens) per row.
    ``spans`` names a column of character spans
    (array<struct<start, end>>); by default sections are the lines."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as f:  # about a megabyte, read once
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches):
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            tokens, crossing, sections = [], [], []
            given = batch.column("spans").to_pylist() if spans else None
            for i, text in enumerate(batch.column("text").to_pylist()):
                ends = encoder.token_ends(text) if text else np.zeros(0, np.int64)
                if given is not None:
                    places, a, b = ordered_spans(given[i] or [], len(text or ""))
                    found = np.zeros(len(given[i] or []), np.int64)
                    found[places], over = attribute(ends, byte_offsets(text or "", a), byte_offsets(text or "", b), rule)
                else:
                    a, b = line_spans(text.encode()) if text else (ends, ends)
                    found, over = attribute(ends, a, b, rule)
                tokens.append(len(ends))
                crossing.append(over)
                sections.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array([len(s) for s in sections], pa.int64()),
                 pa.array(crossing, pa.int64()), pa.array([s.tolist() for s in sections], pa.list_(pa.int64()))],
                names=["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])

    cols = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
    if spans:
        cols.append(F.transform(spans, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))).alias("spans"))
    return docs.select(*cols).mapInArrow(
        count, "doc_id bigint, n_tokens bigint, n_sections bigint, n_crossing bigint, section_tokens array<bigint>")
