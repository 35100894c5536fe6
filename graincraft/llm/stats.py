"""Per-document statistics that tell prose from lists, tables and junk."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from operator import contains

import numpy as np
from pyspark.sql import DataFrame

from graincraft.llm.counts import frequent_words
from graincraft.llm.fold import code_points, level, level_all
from graincraft.llm.repetition import said_before

_HAN = "㐀-䶿一-鿿豈-﫿"
_RINGS = "①-⓿❶-➓㈠-㉃"
_RING = re.compile(f"([{_RINGS}])")
_WORD = re.compile(f"[{_HAN}]|[^\\W_{_HAN}{_RINGS}]+")
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*>")
_CELL_END = re.compile(r"</t[dh]>\s*<t[dh][^<>]*>", re.I)
_ROW_END = re.compile(r"</tr>|<br\s*/?>|</p>|</li>|</div>", re.I)
_ITEM = re.compile(r"<li[^<>]*>", re.I)
_ESCAPE = re.compile(r"&(?:amp;)?[A-Za-z]+;|&#\w+;|\\u[0-9a-fA-F]{4}|%[0-9A-F]{2}")
#: Marks that close a line, and what may stand after them.
_MARKS = frozenset(".!?…。！？")
_AFTER = "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "\"'”’»」』)]*_"
_STOP = re.compile(rf"""[.!?…。！？]["'”’»」』)\]]*(?=\s|$|[{_HAN}])""")
_BULLET = re.compile(r"^\s*(?:[-*•▪◦‣·+–—]\s|\[[ xX]?\]|\(?\d{1,3}[.):、．]|[①-⑳㈠-㈩❶-❿]|\(?[a-zA-Z][.)]\s|[一二三四五六七八九十]+、|#\s)")
_SEPARATOR = re.compile(r"\t|\||;|,(?!\s)|，| {4,}")
_COMMA = re.compile(r",\s")
_AGAIN = re.compile(r"\b(\w+)(?:[\W_]+\1\b){2,}|(\w{2,16}?)\2{3,}", re.I)
_HEX = re.compile(r"^[0-9a-f]{2}$")
_NUMBER = re.compile(r"(?<![\w.])\d+(?:\.\d+)?(?![\w])")
_VOWEL = re.compile("[aeiouyàáâãäåæèéêëìíîïòóôõöœùúûüýÿаеёиоуыэюя]", re.I)
NAMES = (
    "words", "word_length", "symbols", "digits", "lines", "closed_lines", "common", "bullets", "line_words",
    "same_cells", "separators", "sentence_share", "no_vowels", "replaced", "mojibake", "longest_word", "mixed_words",
    "hex_pairs", "number_cells", "escapes", "sentence_words", "short_lines", "common_pairs", "small_items",
    "wrapped",
)


def lay_out(text: str) -> str:
    """Markup as layout: table cells become tabs, rows and items lines; other tags go."""
    if "<" not in text:
        return text
    text = _ITEM.sub("\n- ", _ROW_END.sub("\n", _CELL_END.sub("\t", text)))
    return _TAG.sub(" ", text)


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def leveled_words(text: str) -> list[str]:
    return words(level(text))


def terms(text: str) -> set[str]:
    """The distinct words and pairs of neighbours (with a blank between) of a text, without numbers."""
    own = words(level(text))
    out = {w for w in own if not w.isdigit()}
    out.update(map(" ".join, zip(own, own[1:])))
    return out


_NONE: frozenset = frozenset()


class Common:
    """Words (single Chinese characters) and pairs of neighbours in at least ``share`` of some texts."""

    def __init__(self, texts: list[str], share: float = 0.001):
        uses = Counter(w for t in texts for w in terms(t))
        self._hold(w for w, n in uses.items() if n >= max(3, share * len(texts)))

    @classmethod
    def of_table(cls, texts: DataFrame, share: float = 0.001) -> "Common":
        """Those of all rows of ``texts``, a column ``t`` without nulls."""
        out = cls([])
        out._hold(frequent_words(texts, words_of, share, 3))
        return out

    def _hold(self, kept) -> None:
        kept = [tuple(w.split(" ")) for w in kept]
        self.words = frozenset(w for w, *more in kept if not more)
        self.pairs = frozenset(w for w in kept if len(w) == 2)
        self._after: dict[str, set[str]] | None = None
        self._marked: _Marked | None = None

    def __getstate__(self):
        return {"words": self.words, "pairs": self.pairs, "_after": None, "_marked": None}

    @property
    def after(self) -> dict[str, set[str]]:
        """For each word the words that follow it in the common pairs."""
        if self._after is None:
            self._after = {}
            for a, b in self.pairs:
                self._after.setdefault(a, set()).add(b)
        return self._after

    @property
    def marked(self) -> "_Marked":
        """What is counted of the words met."""
        if self._marked is None:
            self._marked = _Marked(self)
        return self._marked

    def near(self, own: list[str]) -> Iterator[bool]:
        """For each word of a list but the last whether it makes a common pair with the next."""
        return map(contains, map(self.after.get, own, repeat(_NONE)), own[1:])


def statistics(text: str, common: Common) -> list[float]:
    """The values of ``NAMES``, of the whole text; all 0 for an empty text."""
    return measures(text, common)[0]


def measures(text: str, common: Common) -> tuple[list[float], list[float]]:
    """The values of ``NAMES`` of the whole text, and with text said many times in a row counted once."""
    whole, once = measures_of([text], common)[0].tolist()
    return whole, once


def measures_of(texts: list[str], common: Common) -> np.ndarray:
    """``measures`` of each text: an array of texts, two forms and ``NAMES``. Texts are taken in blocks of bounded size."""
    out = np.zeros((len(texts), 2, len(NAMES)))
    marked = common.marked
    for at, stop in _blocks(texts):
        marked.start()
        _measure(texts[at:stop], marked, out[at:stop])
    return out


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of blocks of at most 1 024 texts and, but for one longer text, 200 000 characters."""
    at = chars = 0
    for k, t in enumerate(texts):
        if k > at and (k - at == 1024 or chars + len(t) > 200_000):
            yield at, k
            at, chars = k, 0
        chars += len(t)
    if at < len(texts):
        yield at, len(texts)


def _measure(texts: list[str], marked: "_Marked", out: np.ndarray) -> None:
    """Fill in the measures of one block of texts."""
    held = [k for k, t in enumerate(texts) if t and not t.isspace()]
    laid, damage = [], []
    for k in held:
        text = texts[k]
        escapes = sum(map(len, _ESCAPE.findall(text))) if "&" in text or "\\" in text or "%" in text else 0
        replaced = 0 if text.isascii() else text.count("\ufffd") + text.count("□")
        visible = sum(map(len, text.split())) if escapes or replaced else 1
        laid.append(lay_out(_ESCAPE.sub(" ", text) if escapes else text))
        damage.append((escapes / visible, replaced / visible))
    shown = [t if t.isascii() else _RING.sub(r"\1 ", t) for t in level_all(laid)]
    block = _Block(shown, marked)
    mixed = [_mixed(t) if longest >= 13 else 0 for t, longest in zip(laid, block.longest.tolist())]
    whole = _values(block, damage, mixed)
    once = {i: block.once(i) for i in np.flatnonzero(block.again).tolist()}
    fewer = [i for i, t in once.items() if t != shown[i]]
    out[held] = whole[:, None]
    if fewer:
        del block
        own = _Block([once[i] for i in fewer], marked)
        out[[held[i] for i in fewer], 1] = _values(own, [damage[i] for i in fewer], [mixed[i] for i in fewer])


def _mixed(text: str) -> int:
    """Characters in runs of 13 and more letters and digits (which are all in one word) that have both."""
    return sum(len(w) for w in _LONG.findall(text) if any(map(str.isdigit, w)) and any(map(str.islower, w)))


class _Marked(dict):
    """For each word met a number, and by number what is counted of the word."""

    KNOWN, NUMBER, VOWELLESS, NO_LETTERS, HEX = 1, 2, 4, 8, 16

    def __init__(self, common: Common):
        self.common = common
        self.sides = {w: k for k, w in enumerate({w for pair in common.pairs for w in pair})}
        self.pairs = np.sort(np.array([self._pair(self.sides[a], self.sides[b]) for a, b in common.pairs], dtype=np.int64))
        self._marks, self._side = array("b"), array("q")

    def _pair(self, a, b):
        return a * len(self.sides) + b

    def start(self) -> None:
        """Forget the words met once they are many."""
        if len(self) > 200_000:
            self.clear()
            self._marks, self._side = array("b"), array("q")

    def __missing__(self, w: str) -> int:
        mark, size = self.NUMBER if w.isdigit() else 0, len(w)
        if w in self.common.words:
            mark |= self.KNOWN
        elif size > 2:  # letters are those of words of three or more; unknown ones count if they are of an alphabet
            if w[0] < "㐀" and w.isalpha():
                if len(_VOWEL.findall(w)) * 5 < size:
                    mark |= self.VOWELLESS
            else:
                mark |= self.NO_LETTERS
        elif size == 2 and _HEX.match(w):
            mark |= self.HEX
        self[w] = len(self._marks)
        self._marks.append(mark)
        self._side.append(self.sides.get(w, -1))
        return self[w]

    def of(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word its number, its marks, and whether it makes a common pair with the next."""
        ids = np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found))
        side = np.array(self._side, dtype=np.int64)[ids]
        pair = np.where((side[:-1] >= 0) & (side[1:] >= 0), self._pair(side[:-1], side[1:]), -1)
        near = np.zeros(len(ids), dtype=bool)
        if len(self.pairs):
            near[:-1] = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        return ids, np.array(self._marks, dtype=np.int8)[ids], near


@lru_cache(maxsize=1)
def _char_kinds() -> np.ndarray:
    """For each code point what ``_char_kind`` says, filled as characters are met."""
    return np.full(0x110000, 255, dtype=np.uint8)


_BLANK, _PART, _SINGLE, _DECIMAL = 1, 2, 4, 8


def _char_kind(ch: str) -> int:
    """Whether a character is a blank, part of a word, a word by itself, a decimal digit."""
    part = _WORD.match(ch) is not None
    return _BLANK * ch.isspace() + _PART * part + _SINGLE * (_HAN_CHAR.match(ch) is not None) + _DECIMAL * ch.isdecimal()


def _kinds(codes: np.ndarray) -> np.ndarray:
    table = _char_kinds()
    out = table[codes]
    if (new := np.unique(codes[out == 255])).size:
        table[new] = [_char_kind(chr(c)) for c in new.tolist()]
        out = table[codes]
    return out


def _word_bounds(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, by the kinds of its characters."""
    part, single = np.append(kinds & _PART > 0, False), np.append(kinds & _SINGLE > 0, False)
    run = part & ~single
    starts, ends = part.copy(), part.copy()
    starts[1:] &= ~run[:-1] | single[1:]
    ends[:-1] &= ~run[1:] | single[:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of all ``texts`` in level form, one after the other, and how many each text has."""
    found, sizes = [], []
    for at, stop in _blocks(texts):
        block = _Split(level_all(texts[at:stop]))
        found += block.found
        sizes.append(np.diff(block.first))
    return found, np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)


def _parts(codes: np.ndarray, kinds: np.ndarray) -> list[str]:
    """The words themselves."""
    apart = np.where(kinds & _PART, codes, 32)
    if (single := np.flatnonzero(kinds & _SINGLE)).size:
        apart = np.insert(apart, np.concatenate([single, single + 1]), 32)
    return apart.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").split()


class _Split:
    """Texts side by side and their words."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        codes, _ = code_points(["\n".join(texts)])
        self.kinds = _kinds(codes)
        self.at = np.append(0, np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1))
        self.starts, self.ends = _word_bounds(self.kinds)
        self.first = np.searchsorted(self.starts, self.at)
        self.found = _parts(codes, self.kinds)


def _running(values: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(values, dtype=np.int64))


class _Block(_Split):
    """Split texts with sums over their words, taken for any stretch of words by two lookups."""

    def __init__(self, texts: list[str], marked: _Marked):
        super().__init__(texts)
        self.common = marked.common
        ids, marks, near = marked.of(self.found)
        first, sizes = self.first, self.ends - self.starts
        count = np.diff(first)
        text = np.repeat(np.arange(len(texts)), count)
        near[:-1] &= text[1:] == text[:-1]

        def by_text(values: np.ndarray) -> np.ndarray:
            return np.diff(_running(values)[first])

        def marked_chars(mark: int) -> np.ndarray:
            return by_text(np.where(marks & mark, sizes, 0))

        known = marks & marked.KNOWN > 0
        self.hits, self.nears = _running(known).tolist(), _running(near).tolist()
        self.numbers = _running(marks & marked.NUMBER > 0).tolist()
        self.count, self.chars, self.near = count, by_text(sizes), by_text(near)
        self.known, self.vowelless, self.hexes = marked_chars(marked.KNOWN), marked_chars(marked.VOWELLESS), marked_chars(marked.HEX)
        self.letters = by_text(np.where((sizes > 2) & (marks & marked.NO_LETTERS == 0), sizes, 0))
        places = np.minimum(self.at, len(self.kinds))
        self.digits = np.diff(_running(self.kinds & _DECIMAL > 0)[places])
        self.solid = np.diff(_running(self.kinds & _BLANK == 0)[places])  # the breaks between texts are blanks
        self.longest = np.where(count, np.maximum.reduceat(np.append(sizes, 0), first[:-1]), 0) if texts else count
        top = int(ids.max(initial=0)) + 1
        uses = np.sort(text * top + ids)
        new = np.append(True, uses[1:] != uses[:-1])[: len(uses)]
        self.distinct = np.bincount(uses[new] // top, minlength=len(texts))
        thrice = (ids[2:] == ids[1:-1]) & (ids[1:-1] == ids[:-2]) & (text[2:] == text[:-2])
        self.again = (2 * self.distinct <= count) | (np.bincount(text[:-2][thrice], minlength=len(texts)) > 0)
        self.at, self.starts, self.ends, self.first = self.at.tolist(), self.starts.tolist(), self.ends.tolist(), first.tolist()

    def once(self, i: int) -> str:
        """Text ``i`` without stretches said before, where these are a large part of it."""
        text, n = self.texts[i], self.count[i]
        shorter = _AGAIN.sub(lambda m: m.group(1) or m.group(2), text)
        if 2 * self.distinct[i] > n or n < 24:
            return shorter
        at_words = [m.span() for m in _WORD.finditer(shorter)]
        out, at = [], 0
        for (start, stop), again in zip(at_words, said_before([shorter[a:b] for a, b in at_words])):
            if again:
                out.append(shorter[at:start])
                at = stop
        out.append(shorter[at:])
        return _EMPTY.sub("", "".join(out)) if len(out) > 1 else shorter

    def lines(self, i: int) -> tuple[list[str], list[int], list[int]]:
        """The lines of text ``i`` that are no blanks or rules, where they begin, and the first word of each and of what follows."""
        text, first, stop = self.texts[i], self.first[i], self.first[i + 1]
        body, at, word = [], [], []
        place = self.at[i]
        own = text.splitlines()
        for ln, whole in zip(own, text.splitlines(True) if len(own) > 1 else own):
            if ln and not ln.isspace() and ln.strip(_RULE):
                body.append(ln)
                at.append(place)
                word.append(bisect_left(self.starts, place, word[-1], stop) if word else first)
            place += len(whole)
        word.append(stop)
        return body, at, word


def _values(block: _Block, damage: list[tuple[float, float]], mixed: list[int]) -> np.ndarray:
    """The values of ``NAMES`` for each text of a block."""
    out = np.zeros((len(block.texts), len(NAMES)))
    if not len(out):
        return out
    seen = np.array([_counted(block, i) for i in range(len(out))]).T
    lines, closed, bullets, cells, marks, sentences, sentence_words, sentence_chars, strange, numbers, short, tiny, parts, wrapped, breaks = seen
    least = lambda values: np.maximum(1, values)
    n, chars, solid = least(block.count), least(block.chars), least(block.solid)
    escapes, replaced = np.array(damage).T
    log = lambda values: list(map(math.log1p, np.asarray(values).tolist()))
    values = (
        log(n),
        chars / n,
        np.maximum(0.0, 1 - chars / solid),
        block.digits / solid,
        log(lines),
        closed / lines,
        block.known / chars,
        bullets / lines,
        block.count / lines,
        cells / lines,
        marks / n,
        sentence_chars / solid,
        block.vowelless / least(block.letters),
        replaced,
        strange / solid,
        log(block.longest),
        np.array(mixed) / chars,
        block.hexes / chars,
        numbers / n,
        escapes,
        sentence_words / least(sentences),
        short / lines,
        block.near / n,
        tiny / least(parts),
        wrapped / least(breaks),
    )
    for k, column in enumerate(values):
        out[:, k] = column
    return out


def _counted(block: _Block, i: int) -> tuple[int, ...]:
    """What is counted by lines, sentences and parts of lines of one text."""
    shown, found, digits = block.texts[i], block.found, block.digits[i] > 0
    body, at, first = block.lines(i)
    plain = shown.isascii()
    apart = "," in shown or any(map(shown.__contains__, _APART))  # else no line has cells, and no part is an enumeration
    marks = [_separators(ln.strip(" |")) for ln in body] if apart else [0] * len(body)
    bullets = [_BULLET.match(ln) is not None for ln in body]
    closed = [ln.rstrip(_AFTER)[-1:] in _MARKS for ln in body]
    cells = [c for c in marks if c >= 2]
    goes_on = [block.nears[k] > block.nears[k - 1] and _wraps(found, a, k, b) for a, k, b in zip(first, first[1:], first[2:])]
    sentences = sentence_chars = sentence_words = 0
    for part, start, stop in _sentences(block, body, at, first, marks, bullets, closed, goes_on):
        k = stop - start
        numbers = block.numbers[stop] - block.numbers[start] if digits else 0
        if k - numbers < 4:
            continue
        if numbers:
            own = [w for w in found[start:stop] if not w.isdigit()]
            k, opening = len(own), own[0]
            hits, near = sum(map(block.common.words.__contains__, own)), sum(block.common.near(own))
        else:
            opening = found[start]
            hits, near = block.hits[stop] - block.hits[start], block.nears[stop - 1] - block.nears[start]
        if (k >= 8 or opening < "㐀") and hits >= 0.5 * k and near > 0.5 * (k - 1):
            if not apart or not _enumeration(part, k) and _separators(part) <= 0.2 * k:
                sentences += 1
                sentence_words += k
                sentence_chars += len("".join(part.split()))
    parts = [p for ln in body for p in _PARTS.split(ln) if p and not p.isspace()] if apart else body
    if plain:
        tiny = sum([len(p) < 40 and p.count(" ") < 6 for p in parts])
    else:
        tiny = sum([len(p) < 40 and (len(p) <= 16 if _HAN_CHAR.search(p) else p.count(" ") < 6) for p in parts])
    breaks = [on for on, c in zip(goes_on, closed) if not c]
    return (
        len(body) or 1,
        sum(closed),
        sum(bullets),
        max(Counter(cells).values()) if cells else 0,
        sum(marks),
        sentences,
        sentence_words,
        sentence_chars,
        0 if plain else len(_STRANGE.findall(shown)),
        len(_NUMBER.findall(shown)) if digits else 0,
        sum([b - a <= 8 for a, b in zip(first, first[1:])]) if body else 1,
        tiny,
        len(parts),
        sum(breaks),
        len(breaks),
    )


_LONG = re.compile(r"[A-Za-z0-9]{13,}")
_RULE = "|-: +="


_EMPTY = re.compile(r"^(?:[\d_]|[^\w\n])*$\n?", re.M)
_STRANGE = re.compile("[\x80-\xa6\xa8\xa9\xac-\xaf\xb1-\xb6\xb8\xb9\xbc-\xbe\ue000-\uf8ffˆ˜šžÿ‚„†‡‰‹›€™œƒ]")
_PARTS = re.compile(r"[,;，、；/|·•\t]\s*")
_CUTS = ",;，、；/|·•\t"
_APART = (*_CUTS[1:], "    ")
_HAN_CHAR = re.compile(f"[{_HAN}]")


def _enumeration(part: str, size: int) -> bool:
    """Whether ``part``, of ``size`` words, is four or more short items in a row."""
    if sum(map(part.count, _CUTS)) < 3:
        return False
    items = [p for p in _PARTS.split(part) if p]
    return len(items) >= 4 and size <= len(items) * (9 if _HAN_CHAR.search(part) else 4)


def _separators(text: str) -> int:
    """Number of separators of cells."""
    if "    " in text:
        return len(_SEPARATOR.findall(text))
    return sum(map(text.count, "\t|;，,")) - (len(_COMMA.findall(text)) if "," in text else 0)


def _wraps(found: list[str], start: int, stop: int, end: int) -> bool:
    """Whether a sentence may go on from a line of words to the next: short Chinese lines are not wrapped."""
    return start < stop < end and not (found[stop - 1] >= "㐀" and stop - start < 10)


def _sentences(block: _Block, body, at, first, marks, bullets, closed, goes_on) -> list[tuple[str, int, int]]:
    """Sentences and the bounds of their words, with wrapped lines joined: a line goes on in the next if the words at the break are common neighbours."""
    out: list[tuple[str, int, int]] = []
    start = 0
    for k, last in enumerate(closed, 1):
        if last or k == len(body) or bullets[k] or marks[k] >= 2 or not goes_on[k - 1]:
            text = body[start] if k - start == 1 else " ".join(body[start:k])
            _part(out, block, text, at[start] if k - start == 1 else None, first[start], first[k])
            start = k
    return out


def _part(out: list, block: _Block, text: str, place: int | None, start: int, last: int) -> None:
    """Add the sentences of ``text``, which begins at ``place``; joined lines have none, so that their words are counted again."""
    done = 0
    for m in _STOP.finditer(text):
        a, b = m.span()
        if not done and not text[b:].strip():
            out.append((text[:a], start, last))  # one sentence: its words are those of its lines
            return
        if a > done:
            stop = start + len(words(text[done:a])) if place is None else bisect_left(block.starts, place + a, start, last)
            out.append((text[done:a], start, stop))
            start = stop
        done = b
    if done < len(text):
        out.append((text[done:] if done else text, start, last))
