"""Cut points in the tokens of an existing tokenizer.

The rank file is loaded once per Python worker; texts are encoded in Arrow
batches, and only the offsets of their tokens come back, as arrays of code
points. All that follows are column expressions over these arrays. Without a
rank file every byte is a token, which needs no vocabulary.

Defined results: null for null; a token that begins within a character begins
where the character does; a text without tokens is an error for a cut point.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.cutpoints import sampled_index

#: A tiktoken rank file; empty: bytes.
TOKENIZER = os.environ.get("QUERN_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: The split pattern that goes with the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, tuple] = {}


def _load(path: str) -> tuple:
    """The encoder and the number of bytes of each token."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _LOADED[path] = (tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sizes)
    return _LOADED[path]


def offsets(text: str, path: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one code points of each token of one text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    if not path:
        first = last = np.arange(len(raw))
    else:
        encode, sizes = _load(path)
        stops = np.cumsum(sizes[encode(text)])
        first, last = np.concatenate([[0], stops[:-1]]).astype(np.int64)[: len(stops)], stops - 1
    return char[first].astype(np.int32), (char[last] + 1).astype(np.int32)


_SPANS = T.StructType([T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.IntegerType()))])


def token_spans(text: Column, path: str = TOKENIZER) -> Column:
    """``starts`` and ``ends`` of a text's tokens; null arrays for null."""

    def run(s: pd.Series) -> pd.DataFrame:
        got = [(None, None) if t is None else offsets(t, path) for t in s]
        return pd.DataFrame({"starts": [g[0] for g in got], "ends": [g[1] for g in got]})

    return F.pandas_udf(run, _SPANS)(text)


def _some(spans: Column) -> Column:
    """The number of tokens; an error if there are none."""
    n = F.size(spans["starts"])
    return F.when(n > 0, n).otherwise(F.raise_error(F.lit("text without tokens")).cast("int"))


def cut_point(text: Column, spans: Column, limit: int) -> Column:
    """Where token number ``limit`` (from 0) begins; the length of the text if it has no more tokens."""
    return F.when(_some(spans) <= limit, F.length(text)).otherwise(F.get(spans["starts"], F.lit(limit)))


def truncated(text: Column, spans: Column, limit: int) -> tuple[Column, Column]:
    """The text up to ``limit`` tokens, and the number kept."""
    n = F.size(spans["starts"])
    return F.when(n <= limit, text).otherwise(F.substring(text, F.lit(1), F.get(spans["starts"], F.lit(limit)))), F.least(n, F.lit(limit))


def sampled_cut(spans: Column, u: Column, limit: int) -> tuple[Column, Column]:
    """Start and index of a token drawn by ``u`` from the first ``limit``."""
    at = sampled_index(F.least(_some(spans), F.lit(limit)), u)
    return F.get(spans["starts"], at), at


def end_slot(spans: Column, limit: int) -> tuple[Column, Column]:
    """End of the last of at most ``limit`` tokens, and their number."""
    kept = F.least(_some(spans), F.lit(limit))
    return F.get(spans["ends"], kept - 1), kept


def token_index(spans: Column, offset: Column) -> Column:
    """The token that begins at an offset or holds it; the number of tokens for an offset past the last one's start."""
    starts = spans["starts"]
    before = F.size(F.filter(starts, lambda s: s < offset))
    n = F.size(starts)
    return F.when(before >= n, n).when(F.get(starts, before) == offset, before).otherwise(F.greatest(before - 1, F.lit(0)))
