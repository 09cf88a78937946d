"""Per-document text quality statistics and the kind of text they point to.

Problem 5. A text is cut into rows of cells and segments (sentences, entries).
Layout tells how each stands: vertical delimiter alignment (lines in a row that
agree in the number and, for spaces, the places of their cells), indentation
periodicity (how often a line's indent and marker are those of one, two or three
lines before), and the autocorrelation of line lengths, by which wrapped prose
is told from entries. With word, symbol and punctuation ratios these make the
vector of a segment; a softmax with fitted weights gives its class (sentence,
list, table, junk), and if less than half of a text is sentences the largest
other class names its kind.

The weights are fitted at run time to the sentences of all texts, each text once:
they are dealt out in turn to prose, lists, tables and damaged text in many
layouts, so labels are known by construction and no sentence is left over. The
texts are fitted in groups of about ``GROUP`` characters, by hash, and the weights
of the groups averaged. Whether words look like words is told by letter trigrams
of all sentences (``RARE``), not by a list of the table's words; part of the prose
is shown to the fit as if its language were unknown, so that prose on other
subjects or in other languages stays prose.

``common_share`` counts function words and the words in at least ``COMMON`` of
all texts; it is a figure and has no part in the kind.

Defined results: null and blank texts are left out; an item's versions and
deliveries count once; whole texts are read; without any usable sentence the fit
rests on built-in ones; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.textnorm import CJK, LOOKALIKES
from quern.llm.words import FUNCTION_WORDS, is_function
from quern.session import materialize, spread

#: Share of all texts that have a common word.
COMMON = 0.002
#: Least share of all sentences in which a letter trigram stands that counts as known.
RARE = 1 / 5000
#: Characters of text (about) and most sentences whose layouts are fitted together, and least layouts of all groups.
GROUP, GROUP_SENTENCES, LAYOUTS = 1_000_000, 16_000, 3000
#: Texts of ``sample_texts``.
SAMPLE = 400
#: Text of fewer characters is too short to be of a kind.
SHORT = 40
HALF = 0.5
#: Most words (characters, in scripts without spaces) of an entry that is merely repeated.
ENTRY = 15
KINDS = ("sentence", "list", "table", "junk")

_WORD = re.compile(f"[{CJK}]|[^\\W\\d_{CJK}]+(?:['’][^\\W\\d_{CJK}]+)*")
_CELL = re.compile(r"</t[dh]>\s*<t[dh]\b[^<>]*>", re.I)
_ROW = re.compile(r"</?(?:tr|table|tbody|thead)\b[^<>]*>", re.I)
_ITEM = re.compile(r"<li\b[^<>]*>|<br\s*/?>|</p>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_MARK = re.compile(r"^[ \t]*(?:[-*•–—+·▪◦]|\(?\d{1,3}[.)]|\(?[a-zа-я][.)]|[ivxIVX]{1,4}[.)]|\[[ xX]?\]|[①-⑳])\s+|^[ \t]*(?:[•▪◦①-⑳]|\[[ xX]?\])")
_END = re.compile(r"[.!?。！？…:][\"”»』」)\]*_]{0,9}\s*$")
_STOP = re.compile(r"[.!?…]+[\"”»)\]]*(?=\s|$)|[。！？]")
_SENT = re.compile(r"(?<=[.!?…])[\"”»)\]]*\s+|(?<=[。！？])[\"”»』」)\]]*")
_SEP = re.compile(r"[;,、，；/|·•]|\s[-–—»]\s|\t")
_UNIT = "\x1f"
_CELLS = {_UNIT: re.compile(_UNIT), "|": re.compile(r"\s*\|\s*"), "\t": re.compile(r"\t"), ";": re.compile(r";"), ",": re.compile(r","), "  ": re.compile(r"\s{2,}")}
_CJK1 = re.compile(f"[{CJK}]")
_ALPHA = re.compile(r"[^\W\d_]+")
#: Latin and Cyrillic words, whose letters the trigrams judge.
_JUDGED = re.compile(r"[a-zà-öø-ÿœšžŀ-ž'’]+|[а-яё]+")
_CYRILLIC, _LATIN = re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-z]")
#: Marks of damage: stops or capitals within a word, stops before one; characters of wrong decodings.
_TORN = re.compile(r"[^\W\d_][.,;:!?]+[^\W\d_]|(?<!\S)[.,;:!?]+\w|[a-zà-öø-ÿа-яё][A-ZÀ-ÖØ-ÞА-ЯЁ]")
_BROKEN = re.compile("[\x00-\x08\x0e-\x1e\x7f-\x9f\ufffd]|[Â-ô][\u0080-¿Œ-ƒ–-™€]")
_SYMBOL = re.compile(r"[^\w\s]|_")
_DIGIT = re.compile(r"\d")
_ODD = re.compile(r"\w*\d\w*[^\W\d_]\w*|\w*[^\W\d_]\w*\d\w*|\w{8,}\d+")


def _size(s: str) -> int:
    return len(s) - s.count(" ") - s.count("\t") - s.count(_UNIT)


def autocorrelation(xs: list[int]) -> float:
    """Lag-one autocorrelation of line lengths; 0 for fewer than three lines, 1 for equal ones."""
    n = len(xs)
    if n < 3:
        return 0.0
    mean = sum(xs) / n
    var = sum((x - mean) ** 2 for x in xs)
    return sum((a - mean) * (b - mean) for a, b in zip(xs, xs[1:])) / var if var else 1.0


def periodicity(shapes: list[str]) -> float:
    """Share of lines whose indent and marker are those of the line one, two or three before, by the best of these periods."""
    n = len(shapes)
    return max((sum(a == b for a, b in zip(shapes, shapes[k:])) / (n - k) for k in (1, 2, 3) if n > k + 1), default=0.0)


def alignment(lines: list[str]) -> tuple[dict[int, float], float]:
    """Lines that are rows of cells with the share of rows that agree with them, and the best delimiter's share of all lines."""
    best: dict[int, float] = {}
    share = 0.0
    for name, cut in _CELLS.items():
        if len(lines) < 3 and name != _UNIT or not any(name in x for x in lines):
            continue
        least = 2 if name == _UNIT else 3
        counts: dict[int, int] = {}
        edges: dict[int, set[int]] = {}
        for i, line in enumerate(lines):
            s = line.strip().strip("|").strip() if name == "|" else line.strip()
            cells = cut.split(s)
            if len(cells) >= least and 3 * len(_SYMBOL.findall(s)) <= 2 * _size(s):
                words = sum(len(c.split()) for c in cells)
                if name in (_UNIT, "|", "\t") or words <= 7 * len(cells):
                    counts[i] = len(cells)
                    if name == "  ":
                        edges[i] = {m.end() for m in cut.finditer(line)} | {m.start() for m in cut.finditer(line)}
        if len(counts) < (1 if name == _UNIT else 3):
            continue
        if name == "," and any(line.count(", ") * 2 > line.count(",") for line in (lines[i] for i in counts)):
            continue
        width, k = Counter(counts.values()).most_common(1)[0]
        if name == "," and width < 4:
            continue
        rows = {}
        order = list(counts)
        for at, i in enumerate(order):
            near = order[max(0, at - 2) : at + 3]
            agree = sum(abs(counts[j] - counts[i]) <= (name not in (";", ",")) for j in near) / len(near)
            if edges:  # columns that begin or end at the same places
                agree = (agree + sum(bool(edges[i] & edges[j]) for j in near) / len(near)) / 2
            rows[i] = agree if abs(counts[i] - width) <= 1 else agree / 2
        if sum(rows.values()) > sum(best.values()):
            best, share = rows, k / len(lines)
    return best, share


def _unwrap(lines: list[str]) -> list[str]:
    """Joins the lines of prose that was wrapped at a fixed width."""
    out: list[str] = []
    block: list[str] = []

    def flush() -> None:
        if len(block) < 2:
            out.extend(block)
            block.clear()
            return
        most = max(map(len, block))
        widths = [len(x) for x in block]
        open_ = [(w, max(widths[max(0, i - 2) : i + 3])) for i, (w, x) in enumerate(zip(widths, block[:-1])) if _END.search(x[-12:]) is None]
        stops = len(_STOP.findall(" ".join(block)))
        wrapped = open_ and 30 <= most <= 130 and sum(w >= 0.65 * near for w, near in open_) >= 0.7 * len(open_) and stops * 6 >= len(block) and sum(_MARK.match(x) is not None for x in block) * 3 <= len(block)
        out.extend([" ".join(block)] if wrapped else block)
        block.clear()

    for line in lines:
        if line.strip():
            block.append(line)
        else:
            flush()
    flush()
    return out


def word_trigrams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


#: Bits that each figure of a word, and their sums over a segment, take up.
_BITS = 32
_LOW = (1 << _BITS) - 1


class Grams(dict):
    """A set of letter trigrams; as a mapping it tells of a word, and keeps, how many of its trigrams are in the set, how many it has, whether it is a function word, and its length: in one number, so that sums of words are one sum."""

    def __init__(self, grams: frozenset[str]) -> None:
        super().__init__()
        self.grams = grams

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        g = word_trigrams(word) if len(word) > 1 and _JUDGED.fullmatch(word) else []
        figures = (sum(map(self.grams.__contains__, g)), len(g), int(is_function(word)), len(word))
        got = self[word] = sum(x << _BITS * k for k, x in enumerate(figures))
        return got

    def total(self, words: list[str]) -> tuple[int, int, int, int]:
        """The sums of the four figures."""
        n = sum(map(self.__getitem__, words))
        return n & _LOW, n >> _BITS & _LOW, n >> 2 * _BITS & _LOW, n >> 3 * _BITS


class Layout:
    """The segments of one text with their feature vectors, and its figures."""

    __slots__ = ("_broken", "_damaged", "_letters", "_odd", "_pieces", "_torn", "stops", "alignment", "autocorrelation", "dense", "entries", "full", "function", "marker_share", "periodicity", "segments", "vectors", "words")

    def __init__(self, text: str, grams: Grams, known: bool = True) -> None:
        body = text
        if "<" in body:
            body = _ROW.sub("\n", _CELL.sub(_UNIT, body))
            body = _TAG.sub(" ", _ITEM.sub("\n- ", body))
        if not body.isascii() and (found := _CYRILLIC.findall(body)) and len(_LATIN.findall(body)) > 2 * len(found):
            body = body.translate(LOOKALIKES)  # look-alike letters in Latin words are no damage
        self._damaged = _BROKEN.search(body) is not None
        raw = body.split("\n")
        full = self.full = [x for x in raw if x.strip()]
        self.words: list[str] = []
        self.function = 0
        self.dense = "".join(text.split())
        rows, self.alignment = alignment(full)
        marks = [m.group().strip() if (m := _MARK.match(x)) else "" for x in full]
        shapes = [f"{len(x) - len(x.lstrip())}{'d' if m[:1].isalnum() or m[1:2].isalnum() and m[:1] == '(' else m[:1]}" for x, m in zip(full, marks)]
        self.marker_share = sum(map(bool, marks)) / len(full) if full else 0.0
        self.periodicity = periodicity(shapes)
        self.autocorrelation = autocorrelation([len(x) for x in full])
        lines = min(1.0, len(full) / 8)
        self.stops = min(1.0, 25 * len(_STOP.findall(body)) / (len(body) + 1) ** 0.9)
        self.segments: list[tuple[int, str]] = []
        self.vectors: list[list[float]] = []
        self.entries: list[str] = []
        self._odd = self._letters = self._torn = self._pieces = self._broken = 0
        rest = []
        k = 0
        for x in raw:  # what is no row, with the blank lines kept
            if x.strip():
                if k in rows:
                    self._add(x, rows[k], False, lines, grams, known)
                else:
                    rest.append(x)
                k += 1
            else:
                rest.append(x)
        for line in _unwrap(rest):
            mark = _MARK.match(line)
            inner = line[mark.end() :] if mark else line
            for seg in _SENT.split(inner):
                if seg.strip():
                    self._add(seg, 0.0, bool(mark), lines, grams, known)
        # damage shows in the whole text better than in one sentence
        odd, torn = self._odd / max(self._letters, 20), self._torn / max(self._pieces, 4)
        n = len(self.words)
        singles = sum(map((1).__eq__, map(len, self.words))) / n if n and not _CJK1.search(body) else 0.0  # letters set apart
        symbols = len(_SYMBOL.findall(body)) / (len(self.dense) or 1)
        for v in self.vectors:
            v += [singles, min(1.0, 4 * max(0.0, singles - 0.15)), symbols, min(1.0, 4 * max(0.0, symbols - 0.1)), odd, torn, min(1.0, 20 * odd * torn), float(odd > 0.15 and torn > 0.03), min(1.0, 5 * self._broken / (len(self.dense) or 1))]

    def _add(self, seg: str, aligned: float, marked: bool, lines: float, grams, known: bool) -> None:
        size = _size(seg)
        if not size:
            return
        toks = _WORD.findall(seg.lower())
        self.words += toks
        m = len(toks)
        wide = m > 0 and _CJK1.search(seg) is not None and sum(t[0] > "\u2e80" for t in toks) * 2 > m
        long = m / 2.2 if wide else m
        ended = _END.search(seg[-12:]) is not None
        parts = _SEP.split(seg) if _SEP.search(seg) else [seg]
        if len(parts) > 1:
            parts = [p for p in parts if p.strip()]
        per = long / max(len(parts), 1)
        seen, total, function, alpha = grams.total(toks)
        self.function += function
        function = function / m if m and known else 0.0
        odd = 1 - (seen + 2) / (total + 2) if total else 0.0
        alnum = size - len(_SYMBOL.findall(seg))
        pieces = seg.split()
        digits, codes = 0, sum(len(p) > 40 for p in pieces) if size > 40 else 0
        if _DIGIT.search(seg):
            digits = sum(map(str.isdigit, seg))
            codes += sum(1 for p in pieces if len(p) <= 40 and not p.isalpha() and _ODD.fullmatch(p.strip(".,;:()[]")))
        codes /= len(pieces)
        torn = len(_TORN.findall(seg.strip(" .!?…,;:"))) if odd > 0.03 else 0
        self._odd, self._letters, self._torn, self._pieces = self._odd + total - seen, self._letters + total, self._torn + torn, self._pieces + len(pieces)
        torn = min(1.0, torn / len(pieces))
        broken = sum(map(len, _BROKEN.findall(seg))) if self._damaged else 0
        self._broken += broken
        spread_out = max(0.0, 3 - alpha / m) if m and not wide else 0.0
        length = min(long, 30) / 10
        written = alnum >= 0.4 * size  # symbols make no entries
        listed = written * min(len(parts), 10) / 10 * (per <= 6)
        short = written * max(0.0, 1 - long / 9)
        self.segments.append((size, seg))
        self.vectors.append(
            [
                1.0,
                aligned,
                marked * self.periodicity,
                written * lines * self.periodicity * (not ended),
                lines * (1 - abs(self.autocorrelation)) * short,
                length,
                float(ended),
                ended * length,
                self.stops * (not ended),
                self.stops * (not ended) * length,
                short * (not ended),
                short * lines,
                short * marked,
                listed,
                listed * (not ended),
                written * max(0.0, 1 - per / 6) * (len(parts) > 4),
                function,
                function * length,
                1 - alnum / size,
                digits / size,
                codes,
                min(1.0, odd * 2),
                odd * (total > 30),
                float(not m),
                torn,
                torn * odd,
                min(1.0, 3 * broken / size),
                spread_out,
                spread_out * (len(pieces) > 12),
                float(odd > 0.2 and total > 30),
                min(1.0, max(0.0, alpha / m - 9) / 10) if m and not wide else 0.0,
            ]
        )
        if not aligned:
            self.entries += [p.strip().lower() for p in parts] if len(parts) >= 5 else [seg.strip(" .;,").lower()]


class Kinds:
    """Known letter trigrams and the weights of the softmax."""

    def __init__(self, grams: frozenset[str], weights: np.ndarray) -> None:
        self.grams, self.weights = Grams(grams), weights

    def sizes(self, lay: Layout) -> dict[str, int]:
        """Characters of each class."""
        out = dict.fromkeys(KINDS, 0)
        if lay.vectors:
            best = (np.array(lay.vectors) @ self.weights).argmax(1)
            for (size, _), k in zip(lay.segments, best):
                out[KINDS[k]] += size
        return out


def _repeated(lay: Layout, sizes: dict[str, int]) -> bool:
    """Whether the text is one entry merely repeated: a few word triples, or a few entries, make it up."""
    n = len(lay.words)
    if n >= 15:
        triples = Counter(zip(lay.words, lay.words[1:], lay.words[2:]))
        if len(triples) <= ENTRY + 0.2 * n:
            top = [k for _, k in triples.most_common(ENTRY)]
            if top[0] >= 5 and sum(top) >= 0.8 * (n - 2):
                return True
    return len(lay.entries) >= 6 and len(set(lay.entries)) <= max(1, 0.2 * len(lay.entries)) and sizes["list"] * 2 > sum(sizes.values())


def text_kind(lay: Layout, model: Kinds) -> tuple[str | None, float]:
    """The kind of a text, None for prose, and the share of it that is sentences."""
    sizes = model.sizes(lay)
    total = sum(sizes.values()) or 1
    if _repeated(lay, sizes):
        return ("junk" if len(lay.dense) >= SHORT else None), 0.0
    kind = None
    if len(lay.dense) >= SHORT and sizes["sentence"] < HALF * total:
        kind = max(KINDS[1:], key=sizes.get)
    return kind, sizes["sentence"] / total


# --- the fit -----------------------------------------------------------------------------------------------------

#: Sentences for the fit where the texts have none; from general knowledge of each language.
BUILT_IN = (
    "The old letter lay on the table for a week before anyone dared to open it.", "Nobody in the town could say who had paid for the new bridge, or why.",
    "Der alte Brief lag eine Woche auf dem Tisch, bevor ihn jemand öffnete.", "Niemand in der Stadt wusste, wer die neue Brücke bezahlt hatte.",
    "La vieille lettre est restée une semaine sur la table avant que l'on ose l'ouvrir.", "La vecchia lettera rimase sul tavolo per una settimana prima che qualcuno la aprisse.",
    "La vieja carta estuvo una semana sobre la mesa antes de que alguien se atreviera a abrirla.", "Старое письмо лежало на столе неделю, прежде чем кто-то его открыл.",
    "那封旧信在桌子上放了一个星期，才有人敢打开它。", "その古い手紙は、誰かが開けるまで一週間も机の上に置かれていた。",
)


class _Function(dict):
    """Tells of a word, and keeps, whether it is a function word."""

    def __missing__(self, word: str) -> bool:
        if len(self) > 200_000:
            self.clear()
        got = self[word] = is_function(word)
        return got


_FUNCTION = _Function()


def text_sentences(text: str) -> list[str]:
    """Sentences of a text that look like such: a stop at the end, function words within."""
    out = []
    for s in _SENT.split(" ".join(text.split())):
        toks = _WORD.findall(s.lower())
        if 6 <= len(toks) <= 80 and _STOP.search(s) and sum(map(_FUNCTION.__getitem__, toks)) >= 0.12 * len(toks):
            out.append(s.strip())
    return out


def _sentences(texts: list[str]) -> list[str]:
    return [s for t in texts for s in text_sentences(t)] or list(BUILT_IN)


class Deal:
    """Sentences dealt in turn, so that each is used; once all are (``left`` is 0), on from a random place."""

    def __init__(self, rng: random.Random, sents: list[str]) -> None:
        self.rng, self.sents, self.at, self.left = rng, sents, 0, len(sents)

    def next(self) -> str:
        if self.at == len(self.sents):
            self.at = self.rng.randrange(len(self.sents))
        self.at, self.left = self.at + 1, self.left - 1
        return self.sents[self.at - 1]


def _one(rng: random.Random, sents: list[str] | Deal) -> str:
    return sents.next() if isinstance(sents, Deal) else rng.choice(sents)


def _phrase(rng: random.Random, sentence: str) -> str:
    if _CJK1.search(sentence):
        s = re.sub(r"[。！？，、「」.!?\s]", "", sentence)
        i, k = rng.randrange(max(1, len(s) - 8)), rng.randint(2, 9)
        return s[i : i + k] or s
    ws = re.sub(r"[.!?,;:\"…]", "", sentence).split()
    i, k = rng.randrange(max(1, len(ws) - 6)), rng.randint(1, 6)
    return " ".join(ws[i : i + k]) or sentence


def _cell(rng: random.Random, sents: list[str] | Deal) -> str:
    kind = rng.randrange(5)
    if kind == 0:
        return str(rng.randrange(10 ** rng.randint(1, 5)))
    if kind == 1:
        return f"{rng.randrange(1000)}{rng.choice('.,')}{rng.randrange(100):02d}{rng.choice(['', '%'])}"
    if kind == 2:
        return rng.choice(["{d:02d}.{m:02d}.{y}", "{y}-{m:02d}-{d:02d}"]).format(d=rng.randint(1, 28), m=rng.randint(1, 12), y=rng.randint(1980, 2025))
    return _phrase(rng, _one(rng, sents))


def _said(rng: random.Random, sentence: str) -> str:
    """The first words of a sentence as a sentence of their own."""
    if _CJK1.search(sentence):
        return sentence[: rng.randint(6, 14)].rstrip("，、。") + rng.choice("。？！")
    ws = sentence.rstrip(".!?").split()
    return " ".join(ws[: rng.randint(4, 9)]).rstrip(",;:") + rng.choice(["?", ".", ".", "!", "..."])


def _prose(rng: random.Random, sents: list[str] | Deal) -> str:
    some = [_one(rng, sents) for _ in range(rng.randint(1, 9))]
    style = rng.randrange(8)
    gap = "" if _CJK1.search(some[0]) else " "
    if style > 5:  # written carelessly
        lower = rng.random() < 0.6
        some = [s.rstrip(".!?。") + rng.choice(["", "", "!!", "...", s[-1:], s[-1:] + "...", ";"]) for s in some]
        some = [s.lower() for s in some] if lower else some
    if style == 0:  # speech by turns, often in short sentences
        turn = rng.choice([["— "], ["- "], ["A: ", "B: "], ["„"], [""]])
        return "\n".join(turn[k % len(turn)] + (_said(rng, s) if rng.random() < 0.6 else s) for k, s in enumerate(some))
    if style == 1 and gap:
        width, text = rng.randint(45, 100), " ".join(some)
        out, line = [], ""
        for w in text.split():
            if len(line) + len(w) > width:
                out.append(line.strip())
                line = ""
            line += w + " "
        return "\n".join([*out, line.strip()])
    if style == 2:
        some = [s + (f" ({_phrase(rng, _one(rng, sents))})" if rng.random() < 0.2 else "") for s in some]
        return rng.choice(["\n\n", gap]).join(some)
    if style == 3:
        return "\n".join(some)
    return gap.join(some)


def _list(rng: random.Random, sents: list[str] | Deal) -> str:
    n = rng.randint(5, 24)
    names = rng.random() < 0.25
    entries = [(f"{_phrase(rng, _one(rng, sents)).split(' ')[0]}: " if names else "") + _phrase(rng, _one(rng, sents)) for _ in range(n)]
    if rng.random() < 0.3:
        entries = [e[:1].upper() + e[1:] for e in entries]
    head = _phrase(rng, _one(rng, sents)) + rng.choice(["", ":", "\n----", "\n"]) + "\n" if rng.random() < 1 / 3 else ""
    if rng.random() < 0.3:
        return head + rng.choice([", ", "; ", " / ", " | ", " • ", ","]).join(entries) + rng.choice(["", "."])
    mark = rng.choice(["", "", "", "- ", "* ", "• ", "{}. ", "{}) ", "a) ", "[ ] ", "[x] ", "  - ", "({}) "])
    end = rng.choice(["", "", "", ";", ".", ","])
    return head + "\n".join(mark.format(k) + e + end for k, e in enumerate(entries, 1))


def _table(rng: random.Random, sents: list[str] | Deal) -> str:
    n, k = rng.randint(4, 16), rng.randint(3, 7)
    rows = [[_cell(rng, sents) for _ in range(k)] for _ in range(n)]
    style = rng.randrange(6)
    if style == 0:
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    if style == 1:
        widths = [max(len(r[j]) for r in rows) + 2 for j in range(k)]
        return "\n".join("".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in rows)
    if style == 2:
        return "\n".join("   ".join(r) for r in rows)
    sep = rng.choice(["\t", ";", " | "])
    return "\n".join(("| " if sep == " | " and style == 3 else "") + sep.join(r) for r in rows)


def _junk(rng: random.Random, sents: list[str] | Deal) -> str:
    style = rng.choice((0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10))
    some = " ".join(_one(rng, sents) for _ in range(rng.randint(1, 4))) if 5 <= style <= 9 else ""
    if style == 0:
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", rng.randint(12, 26)))
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 14))) for _ in range(rng.randint(15, 60)))
    if style == 1:
        return "".join(rng.choice("!@#$%^&*()_+=~<>{}|/\\?-.\n ") * rng.randint(1, 5) for _ in range(rng.randint(30, 120)))
    if style == 2:
        return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(rng.randint(80, 500)))
    if style == 3:
        return "\n".join(f"{i * 16:08x}  " + " ".join(f"{rng.randrange(256):02x}" for _ in range(16)) for i in range(rng.randint(3, 12)))
    if style == 4:
        return " ".join(rng.choice(["0x", "x", "ID", "--", "", "#", "k="]) + str(rng.randrange(10**9)) for _ in range(rng.randint(12, 50)))
    if style == 5:  # letters out of order, as in a damaged scan
        out = []
        for w in some.split():
            cs = list(w)
            rng.shuffle(cs)
            out.append("".join(cs))
        return " ".join(out)
    if style == 6:
        damaged = some
        for _ in range(rng.randint(1, 3)):
            damaged = damaged.encode("utf-8", "replace").decode(rng.choice(["cp1252", "latin-1"]), "replace")
        return damaged if len(_BROKEN.findall(damaged)) * 8 > len(damaged) else "�".join(some)
    if style == 7:
        return "".join(c if rng.random() < 0.5 else rng.choice("�#?*□¤~^") for c in some)
    if style == 8:  # letters set apart or lost, with specks between
        apart, lost = rng.uniform(0.2, 0.6), rng.uniform(0.0, 0.25)
        return "".join((rng.choice("~`'|;_1l") if rng.random() < lost else c) + (rng.choice("    ~`'|;_1l ") * rng.randint(1, 2) if rng.random() < apart else "") for c in some)
    if style == 9:  # letters out of order within and across words
        cs = [c for c in some if c != " "]
        sizes, out = [len(w) for w in some.split()], []
        for k in sizes:
            part = cs[:k]
            del cs[:k]
            rng.shuffle(part)
            out.append("".join(part))
        return " ".join(out)
    return " ".join(f"{rng.choice('ABCDEFXYZ')}{rng.randrange(1000)}-{rng.choice('abcdefgh')}{rng.randrange(100)}:{rng.randrange(10**6)}" for _ in range(rng.randint(10, 40)))


def gram_counts(sents: list[str]) -> Counter:
    """How often a letter trigram stands in the words of a sentence, each word of it once."""
    words = Counter(w for s in sents for w in set(_JUDGED.findall(s.lower())))
    out: Counter = Counter()
    for w, n in words.items():
        for g in word_trigrams(w):
            out[g] += n
    return out


def known_grams(counts: tuple[Counter, Counter], totals: tuple[int, int]) -> tuple[frozenset[str], tuple[frozenset[str], frozenset[str]], frozenset[str]]:
    """The known trigrams of two halves of all sentences; those that judge each half, which are of the other, as other texts will be; and
    the frequent ones, which judge prose as if its language were unknown."""
    base: Counter = Counter()
    for w in {w for s in BUILT_IN for w in _JUDGED.findall(s.lower())} | {w for words in FUNCTION_WORDS.values() for w in words}:
        base.update(word_trigrams(w))

    if not all(totals):  # a single sentence
        counts, totals = (counts[0] + counts[1],) * 2, (sum(totals),) * 2

    def known(count: Counter, total: int) -> Counter:
        return base + Counter({g: n for g, n in count.items() if n >= RARE * total})

    both = known(counts[0] + counts[1], sum(totals))
    often = sorted(both, key=lambda g: (-both[g], g))[: len(both) // 4]
    return frozenset(both), (frozenset(known(counts[1], totals[1])), frozenset(known(counts[0], totals[0]))), frozenset(often)


def fit_layouts(halves: list[list[str]], judges: list[Grams], few: Grams, seed: int = 11, rounds: int = 200, docs: int = LAYOUTS) -> tuple[np.ndarray, int]:
    """Softmax weights fitted to layouts into which all sentences of both halves are dealt, ``docs`` of them at least, and their number."""
    rng = random.Random(seed)
    deals = [Deal(rng, half) for half in halves]
    xs, ys, sizes = [], [], []
    makers = (_prose, _prose, _list, _table, _junk)
    d = half = 0
    while d < docs or d % len(makers) or any(x.left > 0 for x in deals):
        make = makers[d % len(makers)]
        if not d % len(makers):
            half = int(not deals[0].sents or bool(deals[1].sents) and deals[1].left > deals[0].left)
        # no function words, as if the language of a sentence were unknown
        unknown = make is _prose and rng.random() < 0.2
        lay = Layout(make(rng, deals[half]), few if unknown else judges[half], not unknown)
        total = sum(s for s, _ in lay.segments) or 1
        y = KINDS.index({_prose: "sentence", _list: "list", _table: "table", _junk: "junk"}[make])
        if lay.vectors:
            xs.append(np.array(lay.vectors))
            ys += [y] * len(lay.vectors)
            sizes += [size / total for size, _ in lay.segments]
        d += 1
    x, w = np.concatenate(xs), np.array(sizes)
    gold = np.eye(len(KINDS))[ys]
    weights = np.zeros((x.shape[1], len(KINDS)))
    m1, m2 = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):  # full-batch Adam
        z = x @ weights
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        grad = x.T @ ((p - gold) * w[:, None]) / w.sum() + 1e-4 * weights
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        weights -= 0.3 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return weights, d


def fit_kinds(texts: list[str], seed: int = 11, rounds: int = 200, docs: int = LAYOUTS) -> Kinds:
    """The fit to a list of texts, as one group."""
    sents = _sentences(texts)
    halves = [sents[0::2], sents[1::2] or sents]
    known, judges, few = known_grams((gram_counts(halves[0]), gram_counts(halves[1])), (len(halves[0]), len(halves[1])))
    return Kinds(known, fit_layouts(halves, [Grams(g) for g in judges], Grams(few), seed, rounds, docs)[0])


#: White space as ``str.strip`` knows it.
_BLANK = r"[^\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def distinct_texts(items: DataFrame) -> DataFrame:
    """Every different text that is not blank, once, written with its hash (``key``)."""
    texts = items.where("item_id is not null and text is not null").where(F.col("text").rlike(_BLANK)).select("text").distinct()
    return materialize(texts.select(F.md5("text").alias("key"), "text"), "texts")


#: Parts of one by which weights are summed as whole numbers.
_PARTS = 10**6


def fit_texts(texts: DataFrame) -> Kinds:
    """The fit to all of ``distinct_texts``: trigrams are counted over all sentences, weights fitted in groups of texts and averaged by
    layouts. The groups are of hashes and the sums of whole numbers, so partitions have no say."""
    spark = texts.sparkSession
    groups = -(-(texts.agg(F.sum(F.length("text"))).first()[0] or 0) // GROUP)
    if not groups:
        return fit_kinds([])

    columns = ["half", "key", "sents", "gram", "n"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, totals = (Counter(), Counter()), [0, 0]
        for pdf in batches:
            rows: tuple[list, list] = ([], [])
            for key, text in zip(pdf["key"], pdf["text"]):
                sents = text_sentences(text)
                for half, some in enumerate((sents[0::2], sents[1::2]), int(key[-1], 16)):
                    if some:
                        rows[half % 2].append((key, some))
            for half, found in enumerate(rows):
                sents = [s for _, some in found for s in some]
                counts[half].update(gram_counts(sents))
                totals[half] += len(sents)
                yield pd.DataFrame([(half, k, x, None, len(x)) for k, x in found], columns=columns, dtype=object)
        for half, count in enumerate(counts):
            yield pd.DataFrame([(half, None, None, g, n) for g, n in [("", totals[half]), *count.items()]], columns=columns, dtype=object)

    found = materialize(spread(texts).mapInPandas(read, "half int, key string, sents array<string>, gram string, n long"), "sentences")
    by_half = [F.coalesce(F.sum(F.when(F.col("half") == h, F.col("n"))), F.lit(0)).alias(f"n{h}") for h in (0, 1)]
    totals = tuple(found.where("gram = ''").agg(*by_half).first())
    if not sum(totals):
        return fit_kinds([])
    counted = found.where("gram <> ''").groupBy("gram").agg(*by_half)
    enough = (F.col("n0") >= max(1, RARE * totals[0])) | (F.col("n1") >= max(1, RARE * totals[1]))  # else too rare in both together, too
    rows = counted.where(enough).collect()
    known, judges, few = known_grams((Counter({r["gram"]: r["n0"] for r in rows}), Counter({r["gram"]: r["n1"] for r in rows})), totals)
    sent = spark.sparkContext.broadcast((judges, few))
    least = -(-LAYOUTS // groups)

    kept: list[Grams] = []  # what a task has found out about words serves all its groups

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        if not kept:
            kept.extend(Grams(g) for g in (*sent.value[0], sent.value[1]))
        *judges, few = kept
        pdf = pdf.sort_values("key")
        halves = [[s for x in pdf["sents"][pdf["half"] == h] for s in x] for h in (0, 1)]
        parts = -(-sum(map(len, halves)) // GROUP_SENTENCES)
        out = 0
        n = 0
        for k in range(parts):
            some = [x[len(x) * k // parts : len(x) * (k + 1) // parts] for x in halves]
            weights, docs = fit_layouts(some, judges, few, docs=-(-least // parts))
            out, n = out + np.rint(weights.ravel() * _PARTS).astype("int64") * docs, n + docs
        return pd.DataFrame({"place": range(len(out)), "v": out, "n": n})

    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")
    fitted = found.where("key is not null").select(group, "half", "key", "sents").groupBy("group").applyInPandas(fit, "place int, v long, n long")
    sums = fitted.groupBy("place").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("place").collect()
    return Kinds(known, np.array([r["v"] / (_PARTS * r["n"]) for r in sums]).reshape(-1, len(KINDS)))


def sample_texts(items: DataFrame) -> list[str]:
    """At most ``SAMPLE`` texts, chosen by hash, for trials on the driver; the queries fit to all texts (``fit_texts``)."""
    rows = items.where("item_id is not null and text is not null").select("item_id", "text", F.xxhash64("text").alias("_h")).orderBy("_h", "item_id").limit(4 * SAMPLE).collect()
    return list(dict.fromkeys(r["text"] for r in rows))[:SAMPLE]


def statistics(text: str | None, model: Kinds, common: frozenset[str] | set[str] = frozenset()) -> dict | None:
    """The figures of one text; None for a blank one."""
    if not text or not text.strip():
        return None
    lay = Layout(text, model.grams)
    kind, sentences = text_kind(lay, model)
    n = len(lay.words)
    return {
        "n_words": n,
        "mean_word_length": sum(map(len, lay.words)) / n if n else 0.0,
        "symbol_share": 1 - sum(map(str.isalnum, lay.dense)) / len(lay.dense),
        "ending_share": sum(_END.search(x[-12:]) is not None for x in lay.full) / len(lay.full),
        "common_share": (sum(w in common or is_function(w) for w in lay.words) if common else lay.function) / n if n else 0.0,
        "alignment": lay.alignment,
        "marker_share": lay.marker_share,
        "periodicity": lay.periodicity,
        "line_autocorrelation": lay.autocorrelation,
        "sentence_share": sentences,
        "text_kind": kind,
    }


FIELDS = [
    T.StructField("n_words", T.LongType()),
    *[T.StructField(f, T.DoubleType()) for f in ("mean_word_length", "symbol_share", "ending_share", "common_share", "alignment", "marker_share", "periodicity", "line_autocorrelation", "sentence_share")],
    T.StructField("text_kind", T.StringType()),
]

def common_words(items: DataFrame) -> DataFrame:
    """The words in at least ``COMMON`` of all texts (``w``), counted once per item and version."""
    texts = items.where("text is not null")
    lower = F.lower("text")
    latin = F.array_distinct(F.regexp_extract_all(lower, F.lit(r"([\p{L}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+(?:['’]\p{L}+)*)"), F.lit(1)))
    cjk = F.array_distinct(F.regexp_extract_all(lower, F.lit(r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}])"), F.lit(1)))
    counts = texts.select(F.explode(F.concat(latin, cjk)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= max(2.0, COMMON * texts.count())).select("w")


def text_statistics(items: DataFrame, model: Kinds | None = None, common: list[str] | None = None) -> DataFrame:
    """item_id and the statistics of each item's text.

    Each different text is read once, whatever the number of its items and
    versions; the figures are then joined to the items by the text's hash. Of an
    item with differing texts the one of the first version counts.
    """
    spark = items.sparkSession
    texts = distinct_texts(items)
    model = model or fit_texts(texts)
    sent = spark.sparkContext.broadcast((model.grams.grams, model.weights, frozenset(common or ())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, weights, words = sent.value
        mine = Kinds(grams, weights)
        for pdf in batches:
            rows = [(k, *statistics(t, mine, words).values()) for k, t in zip(pdf["key"], pdf["text"])]
            yield pd.DataFrame(rows, columns=["key", *[f.name for f in FIELDS]])

    place = F.format_string("%011d%020d", F.coalesce("iteration", F.lit(0)), F.xxhash64("text")) if "iteration" in items.columns else F.xxhash64("text").cast("string")
    rows = items.where("item_id is not null and text is not null").where(F.col("text").rlike(_BLANK)).select("item_id", place.alias("_at"), F.md5("text").alias("key"))
    first = rows.groupBy("item_id").agg(F.min_by("key", "_at").alias("key"))
    got = spread(texts).mapInPandas(run, T.StructType([T.StructField("key", T.StringType()), *FIELDS]))
    return first.join(got, "key").select("item_id", *[f.name for f in FIELDS])


def common_list(items: DataFrame) -> list[str]:
    """``common_words`` on the driver: a word in 0.2 % of all texts is one of at most 500 times the words of a text."""
    return [r["w"] for r in common_words(items).collect()]
