"""One consistent form for text that looks the same.

The mapping is derived from the Unicode character database by rule; only the list of
letters of other scripts with the same shape as a Latin letter is stated here.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

# Letters of the Cyrillic and Greek scripts drawn like a Latin letter.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ν": "v", "ο": "o", "ρ": "p", "ι": "i", "α": "a",
}
# Decompositions of forms that look like what they decompose to.
SAME_LOOK = {
    "<wide>", "<narrow>", "<compat>", "<font>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>",
    "<vertical>", "<small>",
}
INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10)}


def fold_char(ch: str) -> str:
    """What ``ch`` looks like: '' for invisible characters, a space for any kind of blank."""
    if ord(ch) < 128:
        return ch
    if unicodedata.category(ch) == "Cf" or ord(ch) in INVISIBLE:
        return ""
    if unicodedata.category(ch) == "Zs":
        return " "
    form = unicodedata.decomposition(ch)
    if form.partition(" ")[0] in SAME_LOOK:
        ch = unicodedata.normalize("NFKC", ch)
    plain = "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFD", ch))
    return unicodedata.normalize("NFC", plain)


class _Lazy(dict):
    """A table for ``str.translate`` that is filled as characters are met."""

    def __init__(self, rule):
        super().__init__()
        self.rule = rule

    def __missing__(self, code: int) -> str:
        value = self[code] = self.rule(chr(code))
        return value


_LOOK = _Lazy(fold_char)


def same_look(text: str) -> str:
    """The consistent form of ``text``; letter case, punctuation, accents and the number of blanks stay."""
    return text if text.isascii() else unicodedata.normalize("NFC", text.translate(_LOOK))


# Small letters join the capital's class where the capital is drawn like a Latin one, so that a
# difference of case cannot separate texts that a difference of script does not.
_SMALL = {k.casefold(): v.casefold() for k, v in LOOKALIKES.items() if "\u0400" <= k < "\u0530"}


def _level_char(ch: str) -> str:
    form = unicodedata.normalize("NFD", ch)
    if not "\u0400" <= form[0] < "\u0530":
        form = unicodedata.normalize("NFD", fold_char(ch))
    return "".join(_SMALL.get(c, c) for c in unicodedata.normalize("NFD", form.casefold()))


def _bare_char(ch: str) -> str:
    out = _level_char(ch)
    return "".join(c for c in out if not (c.isspace() or c in _ASCII_MARKS or unicodedata.category(c)[0] in "PZC"))


_ASCII_MARKS = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_BARE = _Lazy(_bare_char)


_LEVEL = _Lazy(_level_char)


def level(text: str) -> str:
    """``same_look`` in small letters, where neither case nor script tells letters of one shape apart."""
    return text.casefold() if text.isascii() else unicodedata.normalize("NFC", text.translate(_LEVEL))


_UNMET, _SEVERAL, _NOTHING = 0x7FFFFFF0, 0x7FFFFFF1, 0x7FFFFFF2


@lru_cache(maxsize=1)
def _level_codes() -> np.ndarray:
    """For each code point that of its level form, filled as characters are met."""
    return np.full(0x110000, _UNMET, dtype=np.uint32)


def _level_code(code: int) -> int:
    form = unicodedata.normalize("NFC", _LEVEL[code])
    return ord(form) if len(form) == 1 else _SEVERAL if form else _NOTHING


def level_all(texts: list[str]) -> list[str]:
    """``level`` of each text, by one lookup of all their characters."""
    out = [t.casefold() if t.isascii() else None for t in texts]
    wide = [k for k, t in enumerate(out) if t is None]
    if not wide:
        return out
    table = _level_codes()
    codes, offsets = code_points([texts[k] for k in wide])
    met = table[codes]
    if (new := np.unique(codes[met == _UNMET])).size:
        table[new] = [_level_code(c) for c in new.tolist()]
        met = table[codes]
    several = np.append(0, np.cumsum(met == _SEVERAL))[offsets]
    met[met == _SEVERAL] = 32
    if (gone := met == _NOTHING).any():
        offsets = offsets - np.append(0, np.cumsum(gone))[offsets]
        met = met[~gone]
    joined, at = met.tobytes().decode("utf-32-le", "surrogatepass"), offsets.tolist()
    for k, a, b, more in zip(wide, at, at[1:], np.diff(several).tolist()):
        out[k] = level(texts[k]) if more else unicodedata.normalize("NFC", joined[a:b])
    return out


def bare(text: str) -> str:
    """``same_look`` without letter case, white space and punctuation."""
    return unicodedata.normalize("NFC", text.translate(_BARE))


def alnum_count(text: str) -> int:
    """Number of letters and digits."""
    return sum(map(str.isalnum, text))


@lru_cache(maxsize=1)
def bare_weights() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, the summed weights and the number of the characters it leaves in ``bare``.

    Summed over a text they give a hash of its letter histogram and its stripped length, both
    independent of order, case, punctuation, blanks and presentation forms.
    """
    top = 0x30000
    codes = np.arange(top, dtype=np.uint64)
    weight = mix(codes + np.uint64(1))
    count = np.ones(top, dtype=np.int32)
    plain = [range(0x3400, 0x4DC0), range(0x4E00, 0xA000), range(0xAC00, 0xD7A4), range(0x20000, 0x2F800)]
    skip = np.zeros(top, dtype=bool)
    for r in plain:
        skip[r.start : r.stop] = True
    with np.errstate(over="ignore"):
        for code in np.flatnonzero(skip):
            if unicodedata.category(chr(code)) == "Cn":
                weight[code] = count[code] = 0
        for code in np.flatnonzero(~skip):
            if 0xD800 <= code < 0xE000:
                weight[code] = count[code] = 0
                continue
            out = unicodedata.normalize("NFD", _BARE[int(code)])
            if out != chr(code):
                weight[code] = sum((int(mix(np.uint64(ord(c) + 1))) for c in out), 0) & 0xFFFFFFFFFFFFFFFF
                count[code] = len(out)
    # a Hangul syllable equals its letters
    for code in range(0xAC00, 0xD7A4):
        out = unicodedata.normalize("NFD", chr(code))
        weight[code] = sum(int(weight[ord(c)]) for c in out) & 0xFFFFFFFFFFFFFFFF
        count[code] = len(out)
    return weight, count


def mix(x):
    """A 64-bit finaliser (splitmix64) for scalars or arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and the offsets of each text (one more than texts)."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), offsets
