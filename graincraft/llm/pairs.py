"""Problem 3: broken prompt and response pairs.

Each pair is tested for five defects, at most one of which is reported, in the order of ``DEFECTS``:
a response without content, one that only gives back the prompt (greedy string tiling), one that declines
(refusal grammars), one in a language that is neither in the prompt nor asked for (script and profile
checks), and one that stops before its end (a pushdown parser over fences, brackets, quotations, lists and
markup, with a test of how the last line closes).
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.llm import language
from graincraft.llm.counts import frequent_terms
from graincraft.llm.fold import level, same_look
from graincraft.llm.language import LANGUAGES, Profiles

DEFECTS = ("empty", "copy", "refusal", "language", "truncated")

_HAN = "㐀-䶿一-鿿豈-﫿"
_WORD = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->|&(?:amp;)?[A-Za-z]+;|&#\w+;", re.S)
_FENCE = re.compile(r"^\s*(```|~~~)", re.M)

# ---------------------------------------------------------------- empty

# What stands where an answer is missing, and answers nothing.
PLACEHOLDERS = {
    "n/a", "na", "n.a.", "null", "nil", "nan", "undefined", "empty", "tbd", "todo", "missing", "no answer", "not available",
    "blank", "placeholder", "lorem ipsum", "暂无", "无答案", "нет ответа", "keine angabe", "sin respuesta", "sem resposta", "sans réponse",
}
# Words that stand for a missing answer too, but answer a question for a number or for whether there is any.
REPLIES = {
    "none", "unknown", "nothing", "无", "空", "没有", "нет", "keine", "aucun", "aucune", "ninguno", "ninguna", "nenhum", "nenhuma",
}
# How such questions are asked.
_COUNTING = re.compile(
    r"(?:how (?:many|much)|\b(?:is|are|was|were) there\b|\bany(?:thing|one|body)?\b|\bwho(?:m|se)?\b|\bremain|\bleft\b|wie ?viele?|gibt es|\bwer\b"
    r"|combien|y a-t-il|\bqui\b|cuánt|\bhay\b|\bquién|quant[oa]s|\bhá\b|\bquem\b|сколько|есть ли|\bкто\b|多少|几[个本种人]|有没有|有.{0,12}吗|谁|是否)[^.!?。！？\n]*[?？]"
)
#: More letters and digits than any placeholder has; the four left out are letters that show nothing.
_LETTERS = re.compile("(?:[\\W_\u115f\u1160\u3164\uffa0]*[^\\W_\u115f\u1160\u3164\uffa0]){24}")


def is_empty(answer: str | None, question: str | None = None) -> bool:
    """Null, nothing visible, only markup, or only a placeholder.

    "None" and its like are answers where ``question`` asks how many there are, who, or whether there is any.
    """
    if answer is None:
        return True
    if "<" not in answer and "&" not in answer and _LETTERS.match(answer):
        return False
    shown = same_look(_TAG.sub(" ", answer)).strip()
    if not any(map(str.isalnum, shown)):
        return not _emoji(shown)
    shown = " ".join(shown.split())
    if len(shown) >= 24:
        return False
    word = shown.casefold().strip(" \t\n.[](){}<>*_-\"'。")
    return word in PLACEHOLDERS or word in REPLIES and not (question and _COUNTING.search(question.casefold()))


def _emoji(text: str) -> bool:
    return any(ord(c) >= 0x1F300 for c in text)


# ---------------------------------------------------------------- copy


def tile(answer: list[str], question: list[str], least: int) -> tuple[bytearray, bytearray]:
    """Greedy string tiling: marks the tokens of both sides that lie in common tiles of ``least`` or more.

    The longest common stretch of unmarked tokens of ``answer`` is taken first, of equal ones the first. A stretch of
    the question may be used again, so that an answer that gives it back several times is covered too. The stretches
    come from a suffix automaton of the question, so that texts of any length are tiled.
    """
    got_a, got_q = bytearray(len(answer)), bytearray(len(question))
    steps, link, size, last = _automaton(question[::-1])
    reach, state = [0] * len(answer), [0] * len(answer)
    at = have = 0
    for i in range(len(answer) - 1, -1, -1):  # both are read backwards: a stretch is known by where it starts
        while at and answer[i] not in steps[at]:
            at = link[at]
            have = size[at]
        if answer[i] in steps[at]:
            at = steps[at][answer[i]]
            have += 1
        reach[i], state[i] = have, at
    heap = [(-n, i) for i, n in enumerate(reach) if n >= least]
    heapq.heapify(heap)
    while heap:
        n, i = heapq.heappop(heap)
        n = -n
        free = got_a.find(1, i, i + n)
        free = n if free < 0 else free - i
        if free < n:
            if free >= least:
                heapq.heappush(heap, (-free, i))
            continue
        at = state[i]
        while size[link[at]] >= n:
            at = link[at]
        j = len(question) - 1 - last[at]
        got_a[i : i + n] = b"\x01" * n
        got_q[j : j + n] = b"\x01" * n
    return got_a, got_q


def _automaton(tokens: list[str]) -> tuple[list[dict], list[int], list[int], list[int]]:
    """The suffix automaton of ``tokens``: steps, suffix links, greatest length and last end of each state."""
    steps: list[dict] = [{}]
    link, size, last = [0], [0], [-1]
    end = 0
    for k, t in enumerate(tokens):
        new = len(size)
        steps.append({})
        link.append(0)
        size.append(size[end] + 1)
        last.append(k)
        at = end
        while t not in steps[at]:
            steps[at][t] = new
            if not at:
                at = -1
                break
            at = link[at]
        if at >= 0:
            to = steps[at][t]
            if size[to] == size[at] + 1:
                link[new] = to
            else:
                copy = len(size)
                steps.append(dict(steps[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                last.append(last[to])
                link[to] = link[new] = copy
                while steps[at].get(t) == to:
                    steps[at][t] = copy
                    if not at:
                        break
                    at = link[at]
        end = new
    for at in sorted(range(1, len(size)), key=size.__getitem__, reverse=True):
        last[link[at]] = max(last[link[at]], last[at])
    return steps, link, size, last


def common(text: list[str], other: list[str], least: int) -> bytearray:
    """Marks the tokens of ``text`` in stretches of ``least`` or more that ``other`` has too: all that tiles can cover."""
    known = {tuple(other[j : j + least]) for j in range(len(other) - least + 1)}
    out = bytearray(len(text))
    for i in range(len(text) - least + 1):
        if tuple(text[i : i + least]) in known:
            out[i : i + least] = b"\x01" * least
    return out


def is_copy(question: str | None, answer: str, mark: int = 3, share: float = 0.95) -> bool:
    """Whether ``answer`` only gives back ``question``: it covers it, and at most ``mark`` words before it are new."""
    if not question or len(answer) < 0.6 * len("".join(question.split())):
        return False
    q, a = _WORD.findall(level(question)), _WORD.findall(level(_TAG.sub(" ", answer)))
    if not q or not a or len(a) < share * len(q):
        return False
    known = set(q)
    fresh = [i for i, w in enumerate(a) if w not in known]
    if len(fresh) > mark or fresh and fresh[-1] > mark:
        return False
    least = min(3, len(q))
    got_a, got_q = common(a, q, least), common(q, a, least)
    if sum(got_q) >= share * len(q):
        got_a, got_q = tile(a, q, least)
    rest = [i for i, hit in enumerate(got_a) if not hit]
    return sum(got_q) >= share * len(q) and len(rest) <= mark and (not rest or rest[-1] <= mark)


# ---------------------------------------------------------------- refusal

# A clause declines if it denies being able, allowed or willing to do what answering takes ("I cannot" + "help"), or if it
# is one of the set phrases. Fixed values, by language: denials, acts of answering, set phrases.
GRAMMAR = {
    "en": (
        r"can ?not|can't|could not|couldn't|won't|will not|would not|wouldn't|not able to|unable to|not allowed to|not permitted to|(?:would|'d) rather not"
        r"|prefer not to|not possible|impossible|must decline|have to decline|no permission|not comfortable|allowed to",
        r"answer\w*|help|assist\w*|discuss\w*|talk|speak|respond|reply|provide|do (?:that|this|it|so)|go into|get into|cover|continue|share|comment|handle"
        r"|say|tell|give|offer|address|engage|comply|fulfil\w*|process|advise|support|proceed",
        r"(?:is|lies|falls|that's) (?:outside|beyond) (?:of )?(?:what i|my)|against (?:my|our|the) (?:guideline|polic|rule)\w*|leave (?:\w+ )?unanswered"
        r"|\bi (?:must|have to|will) (?:decline|refuse)|\bi decline|(?:would not|wouldn't|not) be appropriate|is not appropriate|not something i (?:can|will|may)"
        r"|(?:can't|cannot|won't) be able to do",
    ),
    "de": (
        r"\bnicht\b|\bnichts\b|\bkeine?\b|lieber nicht|\bunmöglich",
        r"helfen|sagen|beantworten|antworten|auskunft|besprechen|sprechen|äußern|eingehen|übernehmen|\btun\b|machen|liefern|angaben|weiterhelfen|behandeln",
        r"(?:muss|möchte|werde|will)\b.{0,60}(?:ablehnen|auslassen|verzichten)|(?:nicht|kein\w*) (?:möglich|erlaubt|gestattet|in der lage)|gegen (?:die|meine) (?:regeln|richtlinien)"
        r"|\blehne\b.{0,30}\bab\b|untersagt|verboten",
    ),
    "fr": (
        r"ne (?:peux|suis|saurais|pourrai|veux|dois|puis)\b(?: pas)?|impossible|(?:dois|préfère\w*|préférerais) (?:ne pas|refuser|décliner)|pas (?:autorisée?|le droit|en mesure)",
        r"répondre|aider|parler|traiter|faire|fournir|discuter|aborder|dire|donner|commenter|continuer|satisfaire",
        r"je refuse|je dois (?:refuser|décliner)|contre (?:les|mes) règles|m'est (?:impossible|interdit)|est hors de",
    ),
    "es": (
        r"no (?:puedo|podré|me es posible|estoy en condiciones|estoy autorizad\w|tengo permiso|me está permitido|quiero|debo)|prefiero no|debo (?:negarme|rechazar|declinar)|me niego",
        r"responder|contestar|ayudar\w*|hablar|tratar|hacerlo|hacer|dar|ofrecer|proporcionar|comentar|discutir|atender|decir",
        r"va contra (?:las|mis) (?:normas|reglas)|me niego|debo (?:negarme|rechazar|declinar)|fuera de (?:lo que|mi)",
    ),
    "pt": (
        r"não (?:posso|consigo|tenho como|tenho permissão|estou autorizad\w|poderei|me é possível|devo|quero)|prefiro não|(?:devo|preciso|tenho que|tenho de) (?:recusar|negar|declinar)|recuso",
        r"responder|ajudar|falar|tratar|fazer|dar|oferecer|fornecer|comentar|discutir|atender|dizer|assunto|pedido",
        r"contra as (?:regras|normas)|me recuso|(?:devo|preciso|tenho que|tenho de) (?:recusar|negar|declinar)|fora d[oa] que",
    ),
    "ru": (
        r"не (?:могу|смогу|в состоянии|имею права|вправе|готов\w*|буду|стану|хочу)|вынужден\w* отказ\w+|предпочт?у?\w* не|запрещено|невозможно",
        r"помочь|ответ\w+|отвеча\w+|говорить|обсужда\w+|сделать|делать|дать|предостав\w+|сказать|коммент\w+|продолж\w+|выполн\w+|рассказ\w+",
        r"вынужден\w* отказ\w+|отказываюсь|против правил|вне моих",
    ),
    "zh": (
        r"无法|不能|没有办法|没办法|不便|不方便|无权|恕难|只能|不予|难以|不可以",
        r"回答|帮助|讨论|提供|完成|继续|略过|谈论|协助|处理|透露|答复|评论|满足|从命|办到",
        r"帮不了|超出了?我|不符合规范|拒绝|无可奉告|违反.{0,6}(?:规定|准则|规范)",
    ),
}
# Clauses that give a reason, and those that may stand beside a refusal without answering anything.
REASONS = (
    r"^(?:since|because|as (?:it|this|that|an?)\b|for safety|da\b|weil\b|denn\b|als\b|car\b|parce|puisque|en tant que|porque|ya que|puesto que|como (?:un )?model|pois\b|já que"
    r"|так как|потому|поскольку|как языковая|因为|由于|作为)"
)
COURTESIES = (
    r"let me know|anything else|please (?:ask|consult|contact|try|see|talk)|ask a|consult|thank you|thanks|sorry|apologi[sz]e|qualified|professional|expert|for asking"
    r"|bitte (?:frage|wende|wenden|kontaktiere)|fachkraft|danke|entschuldig|tut mir leid|leider"
    r"|adressez|consultez|spécialiste|professionnel|merci|désolé|pardon|pour la question|regrette"
    r"|consulta\b|consulte|experto|especialista|gracias|lo siento|perdón|por preguntar|lamento|procure|obrigad|desculpe|sinto muito|pela pergunta|infelizmente"
    r"|обратитесь|специалист|спасибо|извините|простите|к сожалению|за вопрос"
    r"|换个问题|咨询|谅解|抱歉|对不起|遗憾|感谢|谢谢|理解"
)
_DECLINE = {k: re.compile(f"(?:{no})(?:.{{0,60}}?)(?:{act})|(?:{act}).{{0,24}}(?:{no})|{whole}" if k in ("de", "zh") else f"(?:{no}).{{0,60}}?\\b(?:{act})|{whole}") for k, (no, act, whole) in GRAMMAR.items()}
_REFUSE = {k: _DECLINE[k] for k in ("ru", "zh")}
_REFUSE["latin"] = re.compile("|".join(f"(?:{_DECLINE[k].pattern})" for k in ("en", "de", "fr", "es", "pt")))
# What a declining clause of the Latin script has in it, whichever of the patterns it fits.
HINTS = (
    "not", "n't", "unable", "impossib", "declin", "no ", "allowed", "outside", "beyond", "against", "unanswered", "refus", "nich", "kein",
    "unmög", "ablehn", "auslass", "verzicht", "gegen", "lehne", "untersagt", "verboten", "ne ", "pas ", "déclin", "contre", "interdit",
    "hors de", "nieg", "nega", "rechaz", "contra", "fuera", "não ", "recus", "fora ",
)
_CYRILLIC = re.compile("[а-я]")
_HAN_CHAR = re.compile(f"[{_HAN}]")
_REASON, _COURTESY = re.compile(REASONS), re.compile(COURTESIES)
_SENTENCE = re.compile(r"[^.!?…。！？\n]+(?:[.!?…](?!\s)[^.!?…。！？\n]*)*[.!?…。！？\n]*")
_CLAUSE = re.compile(r"[,;:，；：、]|\s[–—-]\s|\b(but|however|yet|still|aber|jedoch|doch|mais|cependant|pero|sin embargo|mas|porém|но|однако)\b|(但是|但|不过|然而)")
#: A clause of so many words (Chinese characters) or fewer says nothing of its own, unless it stands against a refusal.
_FRAGMENT, _HAN_FRAGMENT = 5, 10


def is_refusal(answer: str) -> bool:
    """Whether the answer declines and answers nothing.

    Sentences are cut into clauses. One has to decline; the others may give a reason, be a courtesy, a mere
    fragment or what a declining clause goes on to (an infinitive). Any other clause is taken for an answer.
    """
    declines = False
    for m in _SENTENCE.finditer(language.presentation_free(_TAG.sub(" ", answer)).casefold().replace("’", "'")):
        s = m.group()
        if not any(map(str.isalnum, s)):
            continue
        script = "latin" if s.isascii() else "zh" if _HAN_CHAR.search(s) else "ru" if _CYRILLIC.search(s) else "latin"
        whole = _REFUSE[script].search(s) if script != "latin" or any(map(s.__contains__, HINTS)) else None
        if not whole and not _COURTESY.search(s):
            return False
        parts = _CLAUSE.split(s)
        said = against = False
        for clause, latin, han in zip(parts[::3], [None, *parts[1::3]], [None, *parts[2::3]]):
            against = against or bool(latin or han)
            clause = clause.strip(" .!?…。！？\n\"'»”)")
            size = len(_HAN_CHAR.findall(clause)) if script == "zh" else len(clause.split())
            if not size:
                continue
            if _REFUSE[script].search(clause):
                said, against = True, False
            elif _REASON.match(clause) or _COURTESY.search(clause):
                continue
            elif said and against:  # "..., but here is a start"
                return False
            elif size > (_HAN_FRAGMENT if script == "zh" else _FRAGMENT) and not re.search(r"\bzu \w+n$", clause) and not (whole and not said):
                return False
        declines = declines or bool(whole)
    return declines


# ---------------------------------------------------------------- truncation

_OPEN = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "「": "」", "『": "』", "《": "》", "“": "”", "„": "“”", "«": "»", '"': '"'}
_CLOSERS = {c: o for o, cs in _OPEN.items() for c in cs if c != o}
_BLOCK = re.compile(r"<(/?)(table|tr|td|th|ul|ol|li|pre|code|div|span|p|b|i|em|strong|a|h[1-6])\b[^<>]*?(/?)>", re.I)
_STRUCTURE = re.compile(f"[<`~{re.escape(''.join(_OPEN))}]|^\\s*(?:[-*•▪◦+–—]|\\(?\\d{{1,3}}[.):、])", re.M)
_ITEM = re.compile(r"^\s*(?:[-*•▪◦+–—]|\(?\d{1,3}[.):、]|[①-⑳]|\[[ xX]?\])(?=\s|[^\d\s]|$)\s*")
_SYMBOL = re.compile(f"{_BLOCK.pattern}|[{re.escape(''.join(_OPEN) + ''.join(_CLOSERS))}]|\n", re.I)
# Faces drawn with brackets, which open nothing; numbers of items end with a bracket too.
_FACE = re.compile(r"(?<![^\s.,!?])[:;=8][-'o^]?[()\[\]{}|]+(?!\w)|(?m:^\s*\(?\w{1,3}[)\]])")
# Words that cannot end a text.
LINKS = {
    "a", "an", "the", "and", "or", "but", "of", "to", "in", "on", "for", "with", "by", "from", "that", "because", "which",
    "und", "oder", "aber", "der", "die", "das", "ein", "eine", "mit", "von", "für", "zu", "weil", "dass", "im", "in",
    "et", "ou", "mais", "le", "la", "les", "un", "une", "de", "des", "du", "avec", "pour", "par", "parce", "que", "qui",
    "y", "o", "pero", "el", "los", "las", "del", "con", "para", "por", "porque", "una", "e", "mas", "os", "as", "da", "do",
    "com", "um", "uma", "em", "no", "na", "и", "или", "но", "в", "на", "с", "для", "по", "что", "который", "потому", "из", "к",
}
HAN_LINKS = ("并且", "以及", "因为", "其中的", "而且", "或者", "但是", "如果", "所以", "和", "与", "的", "把", "在", "由", "被")


def open_structures(text: str) -> list[str]:
    """What a pushdown parser finds open at the end: fences, brackets, quotations, markup, and a list whose last
    item has not been closed though the items before it were."""
    stack: list[str] = []
    last = 0
    for m in _FENCE.finditer(text):
        if stack and stack[-1] == m.group(1):
            stack.pop()
        elif not stack or stack[-1] not in ("```", "~~~"):
            _plain(text[last : m.start()], stack)
            stack.append(m.group(1))
        last = m.end()
    if not stack or stack[-1] not in ("```", "~~~"):
        _plain(text[last:], stack)
    return stack


def _plain(text: str, stack: list[str]) -> None:
    """Text outside fences: symbols one by one, and the frames of its lists."""
    text = _FACE.sub(lambda m: " " * len(m.group()), text)
    for m in _SYMBOL.finditer(text):
        token = m.group()
        if token == "\n":
            # a straight quotation ends with its line at the latest: it does not tell opening from closing
            if '"' in stack and text[m.end() :].strip():
                stack.remove('"')
        elif token[0] == "<" and len(token) > 1:
            name = "<" + m.group(2).lower()
            if m.group(1):
                if name in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(name) :]
            elif not m.group(3) and name not in ("<p", "<li", "<td", "<th", "<tr"):
                stack.append(name)
        elif token == '"':
            if '"' in stack:
                del stack[stack.index('"') :]
            elif not text[m.start() - 1 : m.start()].isalnum() and text[m.end() : m.end() + 1].strip():
                stack.append('"')
        elif token in _CLOSERS and any(token in _OPEN.get(s, "") for s in stack):
            while token not in _OPEN.get(stack.pop(), ""):
                pass
        elif token in _OPEN:
            stack.append(token)
    _lists(text, stack)


def _lists(text: str, stack: list[str]) -> None:
    """Pushes a frame for each list that is still open at the end of ``text`` with an unfinished item.

    A frame holds the indent of its items and whether each one so far ended with a closing mark. An item of a
    smaller indent, or a line that is neither an item nor indented below one, closes the frames above it.
    """
    frames: list[tuple[int, list[bool]]] = []
    for line in text.split("\n"):
        body = line.strip()
        if not body:
            continue
        indent = len(line) - len(line.lstrip())
        ended = body[-1] in ".!?…。！？"
        if _ITEM.match(line):
            while frames and frames[-1][0] > indent:
                frames.pop()
            if frames and frames[-1][0] == indent:
                frames[-1][1].append(ended)
            else:
                frames.append((indent, [ended]))
        elif frames and indent > frames[-1][0]:
            frames[-1][1][-1] = ended
        else:
            frames.clear()
    stack.extend("list" for _, ends in frames if len(ends) > 2 and all(ends[:-1]) and not ends[-1])


class Vocabulary:
    """Words in use, to tell a word cut short from a whole one."""

    def __init__(self, texts: list[str], uses: int = 5):
        self._hold(w for w, n in Counter(w for t in texts for w in _answer_words(t)).items() if n >= uses)

    @classmethod
    def of_table(cls, texts: DataFrame, share: float = 1 / 1600, floor: int = 5) -> "Vocabulary":
        """The words in at least ``share`` of all rows of ``texts``, a column ``t`` without nulls, and in ``floor`` of them."""
        out = cls([])
        out._hold(frequent_terms(texts, _answer_words, share, floor))
        return out

    def _hold(self, words) -> None:
        self.words = sorted(words)
        self.known = frozenset(self.words)

    def cut_short(self, word: str) -> bool:
        """Whether ``word`` is no known word but the beginning of one."""
        if len(word) < 2 or word in self.known:
            return False
        at = bisect.bisect_left(self.words, word)
        return at < len(self.words) and self.words[at].startswith(word)


def _answer_words(text: str) -> set[str]:
    return {w for w in _WORD.findall(level(text)) if len(w) > 3 and w.isalpha()}


def is_truncated(answer: str, vocabulary: Vocabulary | None = None) -> bool:
    """Whether the answer stops inside a word, a sentence, a list or a code block."""
    text = language.presentation_free(answer).rstrip()
    if _STRUCTURE.search(text) and open_structures(text):
        return True
    if _FENCE.match(text.rpartition("\n")[2]):
        return False
    text = _TAG.sub(" ", text).rstrip()
    if not text:
        return False
    line = text.rpartition("\n")[2]
    item = _ITEM.match(line)
    body = (line[item.end() :] if item else line).strip(" *_`")
    if not body:
        return bool(item)
    end = body[-1]
    if end in ",;:、，；：-–—/&+=":
        return True
    if not end.isalnum():
        return False
    own = _WORD.findall(level(body))
    if own[-1] in _LEVEL_LINKS and (len(own) > 1 or item) or body.endswith(HAN_LINKS) and (item or len(body) > 4):
        return True
    if item or "|" in body or "\t" in body:
        return bool(vocabulary and own[-1].isalpha() and own[-1] < "㐀" and vocabulary.cut_short(own[-1]))
    han = sum("㐀" <= w <= "﫿" for w in own)
    if han * 2 > len(own):
        return han >= 9 or "\n" in text and _closed_before(text)
    last = re.split(r"(?<=[.!?…])\s+", body)
    own = _WORD.findall(level(last[-1]))
    return len(own) >= 5 or len(last) > 1 or _closed_before(text) or bool(
        vocabulary and len(own) > 1 and own[-1].isalpha() and vocabulary.cut_short(own[-1])
    )


_LEVEL_LINKS = frozenset(level(w) for w in LINKS)


def _closed_before(text: str) -> bool:
    """Whether the lines before the last are running text."""
    lines = [ln for ln in text.split("\n")[:-1] if ln.strip()]
    return bool(lines) and lines[-1].rstrip()[-1:] in ".!?…。！？"


# ---------------------------------------------------------------- language

# Names of languages, as word beginnings in small letters.
ASKED = {
    "en": r"english|englisch|inglés|inglês|anglais|английск|英文|英语",
    "zh": r"chinese|chinesisch|chino|chinês|chinois|китайск|中文|汉语",
    "de": r"german|deutsch|alemán|alemão|allemand|немецк|德文|德语",
    "fr": r"french|französisch|francés|francês|français|французск|法文|法语",
    "es": r"spanish|spanisch|español|espanhol|espagnol|испанск|西班牙",
    "pt": r"portugu|португальск|葡萄牙",
    "ru": r"russian|russisch|ruso|russo|russe|русск|俄文|俄语",
}
_ASKED = {k: re.compile(p) for k, p in ASKED.items()}
_NOT = re.compile(r"(?:\bnot?\b|n't|nicht|kein\w*|\bpas\b|\bsans\b|\bno\b|\bsin\b|não|sem|не|без|不要|别|不用|勿)[^.!?。！？]{0,24}$")
# Words of very short prompts, by language.
SHORT = {
    "en": "continue hello hi thanks thank yes please why ok go on what how no more next sure",
    "de": "hallo warum weiter danke ja bitte wie was nein mehr gut",
    "es": "sigue hola sí claro gracias por qué cómo más no bueno continúa",
    "fr": "bonjour pourquoi oui vas y merci comment continue salut plus non",
    "pt": "olá obrigado obrigada sim pode ser por quê como continue mais não oi",
}
_SHORT = {k: frozenset(v.split()) for k, v in SHORT.items()}


def asked_languages(question: str) -> set[str]:
    """Languages that the question names, unless it says not to use them."""
    low = question.casefold()
    found = set()
    for lang, pattern in _ASKED.items():
        if any(not _NOT.search(low[: m.start()]) for m in pattern.finditer(low)):
            found.add(lang)
    return found


def question_languages(question: str, parts, label: str | None) -> set[str]:
    """Languages of a question; empty for null, empty and junk ones."""
    langs = set(language.languages(parts, language.visible(question))) if parts else set()
    letters = sum(map(str.isalnum, question))
    if letters >= 24 or "zh" in langs or "ru" in langs:
        return langs
    words = set(re.findall(r"[^\W\d_]+", question.casefold()))
    short = {k for k, own in _SHORT.items() if words and len(words & own) * 2 >= len(words)}
    named = language.label_code(label)
    if not langs and not short and letters >= 12:
        return set()
    return langs | short | ({named} if named and (langs or short) else set())


def is_foreign(answer_parts, answer: str, allowed: set[str]) -> bool:
    """Whether the whole answer is in a language that is not ``allowed``."""
    sure = {lang for _, lang, conf, n, _ in answer_parts if lang and (conf >= 0.8 and n >= 12 or lang == "zh" and n >= 3 or lang == "ru" and n >= 5)}
    every = {lang for _, lang, _, _, _ in answer_parts if lang}
    return bool(sure) and not every & allowed


# ---------------------------------------------------------------- operator


class Judge:
    """Everything needed to judge a pair: language profiles and a vocabulary of answers."""

    def __init__(self, profiles: Profiles, vocabulary: Vocabulary):
        self.profiles, self.vocabulary = profiles, vocabulary

    def same_language(self, question: str, answer: str) -> bool:
        """Whether both are plainly in one language, by script and by words that only one language has.

        Pairs of which this is not plain are classified sentence by sentence.
        """
        q, a = self._plain_language(question), self._plain_language(answer)
        return q is not None and q == a

    def _plain_language(self, text: str) -> str | None:
        if not text.isascii():
            n = len(text)
            if len(_HAN_CHAR.findall(text)) * 2 > n:
                return "zh"
            if len(_CYRILLIC.findall(text)) * 2 > n:
                return "ru"
        votes = Counter(map(self.profiles.owner.get, text.casefold().split()))
        del votes[None]
        (top, n), *rest = votes.most_common(2) or [(None, 0)]
        return top if n >= 4 and (not rest or n >= 3 * rest[0][1]) else None

    def defects(self, questions, answers, labels) -> list[str | None]:
        out: list[str | None] = []
        open_rows = []
        for q, a in zip(questions, answers):
            found = "empty" if is_empty(a, q) else "copy" if is_copy(q, a) else "refusal" if is_refusal(a) else None
            if found is None:
                open_rows.append(len(out))
            out.append(found)
        spoken = {i: _spoken(answers[i]) for i in open_rows if questions[i]}
        doubt = [i for i, a in spoken.items() if not self.same_language(questions[i], a)]
        parts = language.classify(self.profiles, [spoken[i] for i in doubt] + [questions[i] for i in doubt])
        for k, i in enumerate(doubt):
            langs = question_languages(questions[i], parts[len(doubt) + k], labels[i])
            if langs and is_foreign(parts[k], answers[i], langs | asked_languages(questions[i])):
                out[i] = "language"
        for i in open_rows:
            if out[i] is None and is_truncated(answers[i], self.vocabulary):
                out[i] = "truncated"
        return out


def _spoken(answer: str) -> str:
    """The answer without code blocks."""
    return re.sub(r"(?s)(```|~~~).*?(\1|$)", " ", answer) if "```" in answer or "~~~" in answer else answer


def fit_judge(df: DataFrame, question_col: str, answer_col: str, label_col: str, order_col: str, fit_rows: int = 8000) -> Judge:
    """Profiles from a sample of ``fit_rows`` labelled questions, and the vocabulary of all answers."""
    profiles = language.fit_profiles(df, question_col, label_col, order_col, fit_rows)
    return Judge(profiles, Vocabulary.of_table(df.where(F.col(answer_col).isNotNull()).select(F.col(answer_col).alias("t"))))


def broken_pairs(df: DataFrame, id_col: str, question_col: str, answer_col: str, judge: Judge, label_col: str | None = None) -> DataFrame:
    """``(id, defect)`` for each row whose answer is defective, ``defect`` being one of ``DEFECTS``.

    A null or empty answer is ``empty`` whatever the question. With a null or empty question only the
    answer's own defects are judged. ``label_col`` names a language label that helps with questions too
    short to tell. Columns of ``df`` beyond those named are ignored.
    """
    profiles, vocabulary = judge.profiles.packed(), judge.vocabulary

    def run(batches):
        own = Judge(Profiles.unpacked(profiles), vocabulary)
        for pdf in batches:
            q, a, l = ([None if v is None or v != v else v for v in pdf[c]] for c in ("q", "a", "l"))
            out = pd.DataFrame({"id": pdf["id"], "defect": own.defects(q, a, l)})
            yield out[out["defect"].notna()]

    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(question_col).alias("q"), F.col(answer_col).alias("a"), label.alias("l"))
    return src.mapInPandas(run, "id long, defect string")


__all__ = ["DEFECTS", "LANGUAGES", "Judge", "Vocabulary", "broken_pairs", "fit_judge", "is_copy", "is_empty", "is_refusal", "is_truncated"]
