"""Functions that stand for external models and services, each with a deterministic default.

The defaults are substitutes, not equals, of large models; callers pass their own.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable

import numpy as np

#: text -> (language, probability)
Detector = Callable[[str], tuple[str, float]]
#: text -> words
Segmenter = Callable[[str], list[str]]
#: texts -> matrix with a row for each
Encoder = Callable[[list[str]], np.ndarray]
#: texts -> texts
Translator = Callable[[list[str]], list[str]]
#: url -> content, or None if it cannot be had
Fetcher = Callable[[str], bytes | None]

# Frequent words by language.
STOP_WORDS = {
    "en": "the of and to in is that for with as are this be on by or",
    "de": "der die und das den von zu mit ist des auf für eine nicht auch",
    "fr": "le la les de des et est une que pour dans par sur au pas",
    "es": "el la los las de que y en un una por con para su al",
    "pt": "o os as de que e em um uma por com para do da não",
    "ru": "и в не на что с как для по из это от к",
}
_STOP = {lang: frozenset(words.split()) for lang, words in STOP_WORDS.items()}


def stop_word_detector(text: str) -> tuple[str, float]:
    """Chinese by script, else the language with most frequent words; ('und', 0.0) if there is none."""
    han = sum("一" <= c <= "龥" for c in text)
    if han * 2 > len("".join(text.split())):
        return "zh", 1.0
    words = Counter(text.lower().replace("\n", " ").split())
    hits = {lang: sum(words[w] for w in own) for lang, own in _STOP.items()}
    best = max(sorted(hits), key=hits.get)
    total = sum(hits.values())
    return (best, hits[best] / total) if total else ("und", 0.0)


def character_segmenter(text: str) -> list[str]:
    """Single Chinese characters and runs of other letters or digits."""
    out: list[str] = []
    held = ""
    for c in text:
        if "一" <= c <= "龥" or not c.isalnum():
            if held:
                out.append(held)
                held = ""
            if c.isalnum():
                out.append(c)
        else:
            held += c
    return out + [held] if held else out


def hashing_encoder(dimensions: int = 64) -> Encoder:
    """Signed hashed words, of length 1."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions))
        for row, text in zip(out, texts):
            for w in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                row[h % dimensions] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return encode


def identity_translator(texts: list[str]) -> list[str]:
    return list(texts)


def looks_like_image(content: bytes) -> bool:
    """Whether the first bytes are those of a common image format."""
    return content[:8] == b"\x89PNG\r\n\x1a\n" or content[:3] == b"\xff\xd8\xff" or content[:4] in (b"GIF8", b"RIFF") or content[:2] == b"BM"
