"""Token budget per source and language.

Problem 7. An existing tokenizer is loaded once per Python worker (its path is a
parameter) and encodes whole texts in Arrow batches; the exact counts, not the
texts, are what is shuffled. Totals are a cube over corpus, language (from the
label, cleaned) and topic.

Defined results: a null text has no row, an empty one has 0 tokens; strings
that look like special tokens are ordinary text; the versions and deliveries of
an item count once, with its first known language and topic; an unknown
language is ``und``; nulls of a cube's own dimensions stay apart from its totals
by ``level``.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tiktoken rank file or a sentencepiece model.
TOKENIZER = os.environ.get("QUERN_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: The split pattern that goes with the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts longer than this are encoded in pieces cut before white space, so memory stays bounded; counts stay exact.
PIECE = 1_000_000

_LOADED: dict[str, object] = {}


def _counter(path: str):
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            _LOADED[path] = lambda texts: [sum(len(encode(p)) for p in _pieces(t)) for t in texts]
    return _LOADED[path]


def _cuts_at(text: str, i: int) -> bool:
    """Whether the split pattern always cuts before place ``i``: at a space between letters, and where letters or digits end and what follows is no space."""
    a, b = text[i - 1], text[i]
    if b == " ":
        return a.isalpha() and text[i + 1 : i + 2].isalpha()
    return a.isalpha() and not b.isspace() and not b.isalpha()


def _pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut where the split pattern cuts as well."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut > at and not _cuts_at(text, cut):
            cut -= 1
        if cut == at:  # one run of letters: it goes whole
            cut = at + PIECE
            while cut < len(text) and not _cuts_at(text, cut):
                cut += 1
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def count_tokens(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Exact token counts of a text column; null for null."""

    def run(s: pd.Series) -> pd.Series:
        texts = list(dict.fromkeys(t for t in s if t is not None))  # versions in one batch are encoded once
        counts = dict(zip(texts, _counter(tokenizer)(texts)))
        return pd.Series([None if t is None else counts[t] for t in s], dtype="Int64")

    return F.pandas_udf(run, T.LongType())(text)


#: ISO 639 codes and English and own names of the languages.
SPELLINGS = {
    "en": "en eng english",
    "deu": "de deu ger german deutsch",
    "fra": "fr fra fre french français francais",
    "ita": "it ita italian italiano",
    "spa": "es spa spanish español espanol castellano",
    "rus": "ru rus russian русский",
    "cmn": "zh zho chi cmn chinese mandarin 中文 汉语",
    "jpn": "ja jpn jp japanese 日本語",
}


def clean_language(label: Column) -> Column:
    """One of the eight codes, or null: the part before a region or script, in any case."""
    head = F.regexp_replace(F.lower(F.trim(F.regexp_replace(label, r"\s+", " "))), r"[-_ (.].*$", "")
    known = F.create_map(*[x for code, names in SPELLINGS.items() for n in names.split() for x in (F.lit(n), F.lit(code))])
    return F.try_element_at(known, head)


def item_tokens(items: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """item_id, corpus, lang, topic and n_tokens: one row per item."""
    counted = items.where("item_id is not null and text is not null").select("item_id", "iteration", "corpus", clean_language(F.col("subset")).alias("lang"), "topic", count_tokens(F.col("text"), tokenizer).alias("n_tokens"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.coalesce("iteration", F.lit(2**31 - 1)))).alias(c)
    return counted.groupBy("item_id").agg(first("corpus"), first("lang"), first("topic"), F.max("n_tokens").alias("n_tokens")).fillna("und", ["lang"])


def token_cube(tokens: DataFrame) -> DataFrame:
    """Items and tokens for each combination of corpus, lang and topic and for all their totals."""
    dims = ("corpus", "lang", "topic")
    return tokens.cube(*dims).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n_items"), F.sum("n_tokens").alias("n_tokens"))
