import base64
from collections import Counter, defaultdict

import tiktoken
from pyspark.sql import functions as F

from quern.llm import tokens


def _encode():
    with open(tokens.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_counts_equal_the_tokenizer_and_bear_anything(spark):
    texts = ["", None, "plain words", "<|endoftext|>", "ß 中文 🙂", "a " * 3000, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.n for r in df.select("i", tokens.count_tokens(F.col("text")).alias("n")).collect()}
    encode = _encode()
    assert got == {i: None if t is None else len(encode(t)) for i, t in enumerate(texts)}


def test_long_texts_in_pieces_count_the_same(monkeypatch):
    text = "Some words here, and 12 numbers; more words follow them\n\nnow and then " * 50
    encode = _encode()
    monkeypatch.setattr(tokens, "PIECE", 97)
    assert sum(len(encode(p)) for p in tokens._pieces(text)) == len(encode(text))
    assert list(tokens._pieces("x" * 500)) == ["x" * 500]


def test_spellings(spark):
    rows = ["en", "EN", "en-GB", "eng_Latn", "English", "de-AT", "ger", "RUS", "cmn_Hani", "zh-CN", "ja", " fr ", "und", "N/A", "", "-", "null", "xx", None]
    df = spark.createDataFrame([(x,) for x in rows], "s string")
    got = [r.l for r in df.select(tokens.clean_language(F.col("s")).alias("l")).collect()]
    assert got == ["en"] * 5 + ["deu", "deu", "rus", "cmn", "cmn", "jpn", "fra"] + [None] * 7


def test_cube_equals_brute_force(spark, tables):
    per = tokens.item_tokens(tables("items"))
    rows = per.collect()
    encode = _encode()
    texts = {r.item_id: r.text for r in tables("items").collect()}
    assert {r.item_id: r.n_tokens for r in rows} == {i: len(encode(t)) for i, t in texts.items()}
    want = defaultdict(Counter)
    for r in rows:
        for level in range(8):
            key = tuple(None if level >> (2 - k) & 1 else v for k, v in enumerate((r.corpus, r.lang, r.topic)))
            want[(*key, level)].update(n=1, t=r.n_tokens)
    got = {(r.corpus, r.lang, r.topic, r.level): (r.n_items, r.n_tokens) for r in tokens.token_cube(per).collect()}
    assert got == {k: (v["n"], v["t"]) for k, v in want.items()}
    assert tokens.item_tokens(tables("items").limit(0)).collect() == []


def test_long_texts_without_spaces_are_cut_where_the_pattern_cuts(monkeypatch):
    from quern.llm import tokens

    texts = ["日本語の文です。次の文、" * 40, "abc123DEF/+x" * 60, "plain words go on and on " * 30, "a" * 900, "x's don't we're " * 40, "12 34,5 6\n\n7  8 " * 30]
    whole = tokens._counter(tokens.TOKENIZER)(texts)
    monkeypatch.setattr(tokens, "PIECE", 50)
    assert tokens._counter(tokens.TOKENIZER)(texts) == whole
    assert max(map(len, tokens._pieces(texts[0]))) <= 50 and "".join(tokens._pieces(texts[4])) == texts[4]
