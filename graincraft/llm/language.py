"""Problem 7: missing or wrong language labels, by rank-order profiles.

A text is cut into segments (sentences). A segment's script decides between Chinese, Russian and the
languages of the Latin script; among these, the ranks of its most frequent n-grams are compared to each
language's profile by out-of-place distance. Profiles are fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.llm.fold import LOOKALIKES, _Lazy, fold_char
from graincraft.session import bounded_sample

#: Languages told apart within the Latin script.
LATIN = ("de", "en", "es", "fr", "pt")
LANGUAGES = ("de", "en", "es", "fr", "pt", "ru", "zh")
# Names of the languages' labels; regions and letter case are dropped before.
LABELS = {
    "de": "de", "deu": "de", "ger": "de", "german": "de", "deutsch": "de",
    "en": "en", "eng": "en", "english": "en",
    "es": "es", "spa": "es", "spanish": "es", "español": "es", "castilian": "es",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr", "français": "fr",
    "pt": "pt", "por": "pt", "portuguese": "pt", "português": "pt",
    "ru": "ru", "rus": "ru", "russian": "ru", "русский": "ru",
    "zh": "zh", "zho": "zh", "chi": "zh", "cmn": "zh", "chinese": "zh", "mandarin": "zh", "中文": "zh",
}


def label_code(label: str | None) -> str | None:
    """The language a label names, or None if it names none of ``LANGUAGES``."""
    if label is None or label != label:
        return None
    word = re.split(r"[-_ (,;/]", label.strip().casefold())[0]
    return LABELS.get(word)


# ---------------------------------------------------------------- segments and scripts

_HAN = "㐀-䶿一-鿿豈-﫿"
_END = r"""(?<=[.!?…])["'”’»)\]]*\s+|(?<=[。！？])["'”’»」』)\]]*"""
_CUT = re.compile(rf"""{_END}|[\r\n]\s*[\r\n]\s*|(?<=[.?!])\s*(?=[{_HAN}])|(?<=[{_HAN}]{{6}})\s*[\r\n]+\s*""")
_TAGS = re.compile(r"</?[A-Za-z][^<>]*>|https?://\S+|[^\s@]{1,64}@[^\s@]{1,255}")
_ESCAPES = re.compile(r"&(?:amp;)?[A-Za-z]+;|&#\w+;|\\u[0-9a-fA-F]{4}|%[0-9A-F]{2}")
_WORD = re.compile(rf"[{_HAN}]+|[^\W_{_HAN}]+")
_RINGS = re.compile("[①-⓿❶-➓㈠-㉃]")
_LATIN_LETTER = re.compile("[A-Za-z]")
_OWN_CYRILLIC = re.compile(f"[{''.join(chr(c) for c in range(0x400, 0x500) if chr(c) not in LOOKALIKES)}]")
_PLAIN = _Lazy(lambda c: c if c in LOOKALIKES else fold_char(c) if unicodedata.normalize("NFD", c)[0] not in LOOKALIKES else c)
_TO_LATIN = str.maketrans(LOOKALIKES)


def presentation_free(text: str) -> str:
    """``text`` with presentation forms and kinds of blanks mapped; letters of every script stay."""
    return text if text.isascii() else unicodedata.normalize("NFC", text.translate(_PLAIN))


def segments(text: str) -> list[str]:
    """Sentences of ``text`` without markup, in presentation-free form.

    A line break ends a sentence only at a blank line or after a closing mark, so that wrapped lines,
    lists and tables stay together.
    """
    if "<" in text or "@" in text or "http" in text:
        text = _TAGS.sub(" ", text)
    if "&" in text or "\\" in text or "%" in text:
        text = _ESCAPES.sub(" ", text)
    if not text.isascii():
        text = presentation_free(_RINGS.sub(" ", text))
    return [s for s in _CUT.split(text) if s and not s.isspace()]


def visible(text: str) -> int:
    """Characters of ``text`` without blanks and markup."""
    return len("".join((_TAGS.sub(" ", text) if "<" in text else text).split()))


def scripts(segment: str) -> tuple[int, int, int, str, int]:
    """Letters in Chinese, Cyrillic and Latin script, the Latin words joined by blanks in lower case, and
    the length of all text in words of three letters or more, a Chinese character counting as three.

    A word of look-alike letters is Latin if it holds a Latin letter. Words with digits and repeated words
    count nowhere.
    """
    han = cyr = 0
    words = []
    found = _WORD.findall(segment)
    long = 0
    for w in found:
        if w[0] >= "㐀":
            long += 3 * len(w)
        elif len(w) > 2 and w.isalpha():
            long += len(w)
    for w in dict.fromkeys(found):
        if "㐀" <= w[0] <= "﫿":
            han += len(w)
        elif w.isascii():
            if w.isalpha():
                words.append(w)
        elif any(c.isdigit() for c in w):
            continue
        elif _OWN_CYRILLIC.search(w):
            cyr += len(w)
        else:
            plain = w.translate(_TO_LATIN)
            if plain == w or _LATIN_LETTER.search(w) or not cyr:
                words.append(plain)
    return han, cyr, sum(map(len, words)), " ".join(words).casefold(), long


# ---------------------------------------------------------------- rank-order profiles

_ALPHABET = " abcdefghijklmnopqrstuvwxyzßàáâãäæçèéêëìíîïñòóôõöùúûüœ"
_IDS = np.full(0x3000, 63, dtype=np.int64)
for _i, _c in enumerate(_ALPHABET):
    _IDS[ord(_c)] = _i
_GRAMS = (1 << 18) + (1 << 12)
#: N-grams kept in a profile; also the out-of-place distance of one that is missing.
DEPTH = 1500
#: Words of fewer sampled segments (mostly names) are left out of the profiles.
LEAST_USES = 3
_CAP = 16


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bigrams and trigrams of each text: text number, gram and count."""
    codes = np.frombuffer(("".join(f"  {t} " for t in texts) + "  ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ids = _IDS[np.minimum(codes, len(_IDS) - 1)]
    sizes = np.fromiter((len(t) + 3 for t in texts), dtype=np.int64, count=len(texts))
    owner = np.concatenate([np.repeat(np.arange(len(texts)), sizes), [len(texts)] * 2])
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    two = (a << 6) | b
    keep2 = ((a != 0) | (b != 0)) & (owner[:-2] == owner[1:-1])
    keep3 = keep2 & ((b != 0) | (c != 0)) & (owner[:-2] == owner[2:])
    keys = np.concatenate(
        [(owner[:-2][keep3] << 19) | (two[keep3] << 6) | c[keep3], (owner[:-2][keep2] << 19) | (1 << 18) | two[keep2]]
    )
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys >> 19, keys & ((1 << 19) - 1), counts


def _ranks(owner: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Rank of each gram by its count within its text; equal counts share their mean rank."""
    level = np.minimum(counts, _CAP - 1)
    have = np.bincount(owner * _CAP + level, minlength=n * _CAP).reshape(n, _CAP)
    above = have[:, ::-1].cumsum(axis=1)[:, ::-1] - have
    return above[owner, level] + (have[owner, level] - 1) / 2


@dataclass
class Profiles:
    """For each language of the Latin script the rank of each gram, ``DEPTH`` if it is not among the first.

    ``words`` are the words the profiles come from; others (mostly names) are left out of a text's own
    ranks as long as it has any of these. ``owner`` names the language of words that only one has.
    """

    ranks: np.ndarray = field(default_factory=lambda: np.full((len(LATIN), 1 << 19), DEPTH, dtype=np.float32))
    words: frozenset = frozenset()
    owner: dict = field(default_factory=dict)

    @classmethod
    def fit(cls, texts: list[str], labels: list[str]) -> "Profiles":
        out = cls()
        kept: set[str] = set()
        for i, lang in enumerate(LATIN):
            own = [t for t, l in zip(texts, labels) if l == lang]
            if own:
                uses = Counter(w for t in own for w in set(t.split()))
                words = {w for w, n in uses.items() if n >= LEAST_USES}
                _, gram, count = _grams([" ".join(w for t in own for w in t.split() if w in words)])
                order = np.argsort(-count, kind="stable")[:DEPTH]
                out.ranks[i, gram[order]] = np.arange(len(order))
                for w in words:
                    out.owner[w] = lang if w not in kept else None
                kept |= words
        out.words = frozenset(kept)
        out.owner = {w: lang for w, lang in out.owner.items() if lang}
        return out

    def reduced(self, text: str) -> str:
        """``text`` in its known words, or whole if it has none."""
        return " ".join([w for w in text.split() if w in self.words]) or text

    def distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distance of each text to each language, as a share of the largest possible,
        and the share of its grams that some profile knows."""
        n = len(texts)
        owner, gram, count = _grams(texts)
        rank = _ranks(owner, count, n)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        out = np.empty((n, len(LATIN)))
        known = np.zeros(len(gram), dtype=bool)
        for i in range(len(LATIN)):
            at = self.ranks[i][gram]
            hit = at < DEPTH
            known |= hit
            far = np.where(hit, np.minimum(np.abs(at - rank), DEPTH), DEPTH)
            out[:, i] = np.bincount(owner, weights=far, minlength=n) / total / DEPTH
        return out, np.bincount(owner, weights=known, minlength=n) / total

    def packed(self) -> tuple:
        """The grams and ranks of each language, at most ``DEPTH`` entries each, and the words."""
        return [(g := np.flatnonzero(r < DEPTH), r[g]) for r in self.ranks], self.words, self.owner

    @classmethod
    def unpacked(cls, packed) -> "Profiles":
        out = cls(words=packed[1], owner=packed[2])
        for row, (g, r) in zip(out.ranks, packed[0]):
            row[g] = r
        return out


def fit_profiles(df: DataFrame, text_col: str, label_col: str, order_col: str, fit_rows: int = 8000) -> Profiles:
    """Profiles from a bounded sample: the ``fit_rows`` labelled rows with the smallest hash of ``order_col``.

    Labels are noisy, so the profiles are fitted twice, the second time on the segments whose language by
    the first profiles agrees with their label.
    """
    labelled = df.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    rows = bounded_sample(labelled.select(F.col(text_col).alias("t"), F.col(label_col).alias("l"), F.col(order_col).alias("o")), "o", fit_rows)
    texts, labels = [], []
    for row in rows:
        code = label_code(row["l"])
        if code in LATIN:
            for s in segments(row["t"]):
                han, cyr, lat, words, _ = scripts(s)
                if lat >= 12 and lat > 4 * (han + cyr):
                    texts.append(words)
                    labels.append(code)
    fitted = Profiles.fit(texts, labels)
    if texts:
        best = fitted.distances(texts)[0].argmin(axis=1)
        same = [i for i, l in enumerate(labels) if LATIN[best[i]] == l]
        fitted = Profiles.fit([texts[i] for i in same], [labels[i] for i in same])
    return fitted


# ---------------------------------------------------------------- documents

#: Below this share of known grams a Latin segment is in no language.
KNOWN = 0.8
#: Below this share of its visible characters in words of a language a text is in no language.
WORDY = 0.3
#: A segment counts as a sentence of its own from so many Latin or Cyrillic letters, or Chinese characters.
LEAST_LETTERS, LEAST_HAN = 18, 6
#: Lead of the best language, as a share of the distance to the second, that gives full confidence.
LEAD = 0.2


def classify(profiles: Profiles, texts: list[str | None]) -> list[list[tuple[str, str | None, float, int, int]]]:
    """For each text its segments as ``(segment, language or None, confidence, letters, length in words)``.

    ``letters`` leaves out repeated words.
    """
    where, latin, out = [], [], []
    for t in texts:
        own = []
        for s in segments(t) if t else ():
            han, cyr, lat, words, long = scripts(s)
            total = 3 * han + cyr + lat
            if not total:
                continue
            if 3 * han > cyr + lat:
                own.append((s, "zh", 3 * han / total, han, long))
            elif cyr > lat:
                own.append((s, "ru", cyr / total, cyr, long))
            else:
                where.append((len(out), len(own)))
                latin.append(profiles.reduced(words))
                own.append((s, None, 0.0, lat, long))
        out.append(own)
    if latin:
        dist, known = profiles.distances(latin)
        order = np.sort(dist, axis=1)
        lead = (order[:, 1] - order[:, 0]) / np.maximum(order[:, 1], 1e-9)
        for (i, j), d, k, gap in zip(where, dist, known, lead):
            s, _, _, n, long = out[i][j]
            out[i][j] = (s, LATIN[int(d.argmin())] if k >= KNOWN else None, float(min(1.0, gap / LEAD) * k), n, long)
    return out


def languages(own: list[tuple[str, str | None, float, int, int]], visible_chars: int) -> dict[str, float]:
    """The languages of a text with their confidence, from its segments.

    The main language has most letters. Another one is present if it has a whole sentence with a clear lead.
    Text most of whose characters stand in no language's words has none.
    """
    weight: dict[str, float] = {}
    sure: dict[str, float] = {}
    in_words = 0
    for _, lang, conf, n, long in own:
        if lang:
            in_words += long
            weight[lang] = weight.get(lang, 0.0) + (3 * n if lang == "zh" else n) * max(conf, 0.05)
            if conf >= 0.5 and n >= (LEAST_HAN if lang == "zh" else LEAST_LETTERS):
                sure[lang] = max(sure.get(lang, 0.0), conf)
    if not weight or in_words < WORDY * visible_chars:
        return {}
    main = max(weight, key=weight.get)
    sure.setdefault(main, weight[main] / max(1e-9, sum(3 * n if g == "zh" else n for _, g, _, n, _ in own)))
    return sure


def detect(df: DataFrame, id_col: str, text_col: str, profiles: Profiles, label_col: str | None = None, min_alnum: int = 12) -> DataFrame:
    """``(id, languages, segments)`` for each row.

    ``languages`` is a map from language to confidence, empty for texts without a language, null texts and
    texts with fewer than ``min_alnum`` letters and digits. ``segments`` lists the stretches of one language
    of a text of several, as ``(segment, language, confidence)``; it is empty for other texts.
    With ``label_col`` the column ``case`` tells how the label is defective: ``missing``, ``wrong`` or
    ``mixed``, else null.
    """
    packed = profiles.packed()
    schema = "id long, languages map<string,double>, segments array<struct<segment:string,language:string,confidence:double>>, case string"

    def run(batches):
        own = Profiles.unpacked(packed)
        for pdf in batches:
            texts = [t if t and sum(map(str.isalnum, t)) >= min_alnum else None for t in pdf["text"]]
            rows = []
            for i, label, t, parts in zip(pdf["id"], pdf["label"], texts, classify(own, texts)):
                langs = languages(parts, visible(t)) if parts else {}
                code = label_code(label)
                case = None
                if langs:
                    case = "missing" if code is None else "wrong" if code not in langs else "mixed" if len(langs) > 1 else None
                rows.append((i, langs, _stretches(parts, langs) if len(langs) > 1 else [], case))
            yield pd.DataFrame(rows, columns=["id", "languages", "segments", "case"])

    label = F.col(label_col) if label_col else F.lit(None)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), label.cast("string").alias("label"))
    out = src.mapInPandas(run, schema)
    return out if label_col else out.drop("case")


def _stretches(parts, langs) -> list[dict]:
    """Neighbouring segments of one language joined; a segment of no or an unsure language joins the one before."""
    out: list[list] = []
    for s, lang, conf, _, _ in parts:
        lang = lang if lang in langs and (conf >= 0.5 or not out) else None
        if out and lang in (None, out[-1][1]):
            out[-1][0] += " " + s
            out[-1][2] = max(out[-1][2], conf)
        else:
            out.append([s, lang or next(iter(langs)), conf])
    return [{"segment": s, "language": l, "confidence": c} for s, l, c in out]


def label_cases(df: DataFrame, id_col: str, text_col: str, label_col: str, profiles: Profiles) -> DataFrame:
    """``(id, lang, confidence)``: for each row with a defective label one row for each language really in the text."""
    found = detect(df.where(F.col(text_col).isNotNull()), id_col, text_col, profiles, label_col).where("case is not null")
    return found.select("id", F.explode("languages").alias("lang", "confidence"))
