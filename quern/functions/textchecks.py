"""Small checks and transforms of generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys of the answer object that must not show up inside its text, bare or quoted.
BARE_KEYS = ("reflection_1p",)
QUOTED_KEYS = ("analysis", "reflection_1p")
LEAK = rf'(?<![A-Za-z0-9_])(?:{"|".join(BARE_KEYS)})(?![A-Za-z0-9_])|"(?:{"|".join(QUOTED_KEYS)})"'

#: Common function words by which ``detect_language`` tells the languages of the Latin alphabet apart.
STOP_WORDS = {
    "en": "the of and to in that is with for this was on it as by at from their who which his her not but be are so had were every our they some while because although",
    "deu": "der die das und den dem mit im nicht von zu des auf für ist ein eine einen einem eines an aus als auch es sich wird bei nach vor über unter weil dass wenn am zum zur aber",
    "fra": "le la les des du et une dans pour avec de un que qui sur ne pas par au aux ce cette sa son ses est se plus mais comme il elle sans sous parce si avant chez",
    "ita": "il di che la una per con del della nel lo gli le dello dei degli delle e in un uno su non da dal dalla al alla nella sul si è come ma più anche se perché",
    "spa": "el la los de una por con del que en las y un para no se su sus al lo como más pero es sin sobre si ha porque aunque cuando fue entre este esta bajo",
}


def leaks_key(text: Column) -> Column:
    """Whether a key stands in the text: any in quotes, or an unmistakable one bare between non-identifier characters."""
    return F.coalesce(text.rlike(LEAK), F.lit(False))


def script_of(text: Column) -> Column:
    """``CJK``, ``cyrillic``, ``latin`` or ``?``: the first that occurs."""
    return F.when(text.rlike("[぀-ヿ一-鿿]"), "CJK").when(text.rlike("[Ѐ-ӿ]"), "cyrillic").when(text.rlike("[A-Za-z]"), "latin").otherwise("?")


def looks_truncated(text: Column, below: int = 800) -> Column:
    """Short, with more opening than closing braces."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return F.coalesce((F.length(text) < below) & (count("{") > count("}")), F.lit(False))


def after_thinking(text: Column) -> Column:
    """What follows the last closing think tag; null where one opens early and never closes."""
    closed = F.contains(text, F.lit("</think>"))
    early = F.contains(F.substring(text, 1, 200), F.lit("<think>"))
    return F.when(closed, F.trim(F.substring_index(text, "</think>", -1))).when(early, F.lit(None).cast("string")).otherwise(text)


def first_word(text: Column) -> Column:
    return F.get(F.split(F.trim(text), r"\s+"), F.lit(0))


def opener(text: Column, words: int = 5) -> Column:
    return F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, words), " ")


def closing(text: Column, width: int = 80) -> Column:
    """The last sentence by full stops, cut to ``width``."""
    bare = F.regexp_replace(F.rtrim(text), r"\.+$", "")
    return F.substring(F.trim(F.substring_index(bare, ".", -1)), 1, width)


def detect_language(text: Column) -> Column:
    """A language by script and function words, in plain expressions; null below ten characters."""
    clean = F.lower(F.regexp_replace(text, r"\[[^\]]*\]|`[^`]*`", " "))
    words = F.regexp_extract_all(clean, F.lit(r"(\p{L}+)"), F.lit(1))
    names = F.array(*map(F.lit, STOP_WORDS))
    count = lambda ws: F.array(*[F.size(F.array_intersect(ws, F.array(*map(F.lit, s.split())))) for s in STOP_WORDS.values()])
    # an array of one value, transformed, binds the value: words and counts are worked out once
    first = lambda hits: F.when(F.array_max(hits) > 0, F.get(names, (F.array_position(hits, F.array_max(hits)) - 1).cast("int")))
    latin = F.get(F.transform(F.transform(F.array(F.array_distinct(words)), count), first), F.lit(0))
    return (
        F.when(F.length(F.trim(clean)) < 10, F.lit(None).cast("string"))
        .when(clean.rlike("[぀-ヿ]"), "jpn")
        .when(clean.rlike("[一-鿿]"), "cmn")
        .when(clean.rlike("[Ѐ-ӿ]"), "rus")
        .otherwise(latin)
    )


def in_language(source: Column, detected: Column) -> Column:
    """Whether an answer kept to English or to another language than English, as its source; null if either is unknown."""
    known = (F.length(source) > 0) & (source != "—") & (F.length(detected) > 0)
    return F.when(known, (source == "en") == (detected == "en"))


def usage_tokens(*shapes: Column) -> Column:
    """The first usage figure that is neither null nor zero; else 0."""
    return F.coalesce(*[F.nullif(s, F.lit(0)) for s in shapes], F.lit(0))


def assemble(system: str, text: Column, point: Column, directive: Column) -> Column:
    """One prompt: instructions, the text up to its point, a marker, and a directive if there is one."""
    return F.concat(F.lit(system), F.lit("\n\n"), F.substring(text, F.lit(1), point), F.lit(" [...] "), F.coalesce(F.concat(F.lit("\n"), directive), F.lit("")))
