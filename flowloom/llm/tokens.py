"""Encoding of whole texts with a public byte-level BPE vocabulary.

Forced boundaries: a pair of bytes that stands in no vocabulary token can never be merged, so a text may be
cut there. The cut must also be one of the pre-tokenizer's: between a visible ASCII character and ASCII white
space its pattern always ends a match, whatever stands around. Where both hold, fragments are encoded
independently and their ids concatenated; each distinct fragment is encoded once and remembered.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Distinct fragments that a worker remembers (a bound on memory, not on results).
REMEMBERED = 400_000
#: Fragments longer than this many characters are encoded but not remembered.
SHORT = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


def forced_pairs(tokens) -> np.ndarray:
    """256 x 256: True where the byte pair stands in no token."""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        if len(t) > 1:
            a = np.frombuffer(t, np.uint8)
            inside[a[:-1], a[1:]] = True
    return ~inside


def cut_pattern(forced: np.ndarray) -> regex.Pattern:
    """Matches fragments: cuts lie at forced pairs of a visible ASCII character and ASCII white space."""
    spaces = [9, 10, 13, 32]
    visible = [b for b in range(33, 127) if all(forced[b, s] for s in spaces)]
    left = "".join(regex.escape(chr(b), literal_spaces=True) for b in visible)
    return regex.compile(rf"(?<=[{left}])(?=[\t\n\r ])")


class Encoder:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = cut_pattern(forced_pairs(ranks))
        self.known: dict[str, list[int]] = {}

    def fragments(self, text: str) -> list[str]:
        return self.cut.split(text)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, encode = self.known, self.encoding.encode_ordinary
        for f in self.fragments(text):
            ids = known.get(f)
            if ids is None:
                ids = encode(f)
                if len(f) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[f] = ids
            out += ids
        return out


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path, pattern)


def encoded(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """id_col and ids (array<int>) of each document, without special tokens; strings of special tokens are text.

    Null and empty texts give the empty list, blank texts are encoded as they stand. Rows are neither dropped
    nor merged. No shuffle. vocabulary: a rank file that every worker can read.
    """
    path, pat = vocabulary or default_vocabulary(), pattern or default_pattern()
    id_type = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pat)
        for b in batches:
            # slices keep a batch of very long texts from being held encoded all at once
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                lists = [np.asarray(e.encode(t), np.int32) if t else np.zeros(0, np.int32) for t in part[1].to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part[0], ids], [id_col, "ids"])

    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")
