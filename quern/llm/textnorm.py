"""Folding of texts: what is left when case, accents, spacing, encoding and markup are set aside."""

from __future__ import annotations

import html
import re
import unicodedata

#: Scripts written without spaces: Han, kana, half-width kana are NFKC-folded before.
CJK = "ぁ-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0002fa1f"
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_CTRL = re.compile(r"\\[nrt]")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_MARKS = re.compile("[̀-゙゚ͯ]")
_TOKEN = re.compile(f"[{CJK}]|[^\\W_{CJK}]+")
_ASCII_TOKEN = re.compile(r"[A-Za-z0-9]+")
#: Letters of other alphabets that look like Latin ones, after case folding.
LOOKALIKES = str.maketrans("аеіјкмнорсухѕԁвтһαειкνορτυχς", "aeijkmhopcyxsdbthaeiknoptuxc")
_MOJIBAKE = re.compile("[Â-ô][\u0080-¿Œ-ƒ–-™€]")


def _unescape(m: re.Match) -> str:
    return chr(int(m.group(1), 16))


def repair(text: str) -> str:
    """Undo escapes, entities and doubly encoded UTF-8."""
    if "\\" in text:
        if "\\u" in text:
            text = _ESCAPE.sub(_unescape, text)
            if any("\ud800" <= c <= "\udfff" for c in text):
                text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        text = _CTRL.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii() and len(_MOJIBAKE.findall(text)) > 2:
        for codec in ("cp1252", "latin-1"):
            try:
                text = text.encode(codec).decode("utf-8")
                break
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
    return text


def fold_tokens(text: str) -> list[str]:
    """Folded words (look-alike letters as one); in scripts without spaces, characters."""
    text = repair(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.isascii():
        return _ASCII_TOKEN.findall(text.lower())
    text = _MARKS.sub("", unicodedata.normalize("NFKD", _HIDDEN.sub("", text))).casefold()
    # look-alikes fold alike on both sides, so Cyrillic texts still match each other
    return _TOKEN.findall(text.translate(LOOKALIKES))
