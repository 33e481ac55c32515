"""Sentence boundaries across languages and scripts.

Document-centred disambiguation.  What a full stop after a token means is read first from
unambiguous occurrences elsewhere in the same document: a stop before a small letter or a
digit, before a word that the document also writes small (so its capital opens a sentence)
or never writes small (a proper name), at the end of a block, and the token without a
stop.  Then from the same counts over the whole corpus.  Only for a token that neither
knows a short list of common abbreviations serves as prior.  Terminators are those of the
script at hand: ``. ! ? …``, ``。！？``, ``।``, ``؟``, and the space between Thai letters.

Two passes over the corpus: one counts (combined before the shuffle), one cuts.  Only
tokens that the counts judge to be abbreviations, titles or references are kept, however
rare the corpus makes them.  Up to ``MAX_TYPES`` of them are broadcast; more are joined to
the tokens of each document, with the same result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, release, spread

MAX_TYPES = 100_000
#: Occurrences before which the corpus or a document decides nothing.
CORPUS_LEAST, OWN_LEAST = 5, 3
#: Occurrences from which a token can be taken never to end a sentence though only names follow it, or it is written small.
SURE = 20

# Common abbreviations, in lower case, without the final stop.  A prior only.
#: before a name or a quoted work: a stop after them never ends a sentence
TITLES = frozenset(
    "dr prof doç yrd av arş gör öğr uzm sn alb bkz bk krş örn hz "  # tr
    "mr mrs ms st rev gen capt lt col sgt hon cf viz "  # en
    "hr fr vgl bzw ca evtl ggf sog dipl ing bspw geb gest "  # de
    "د أ م "  # ar
    "डॉ प्रो श्री पं कु सुश्री".split()  # hi
)
#: before a number: a stop after them ends nothing if a digit follows
REFERENCES = frozenset("no nr nos vol p pp s ss sf c cilt bd kap abb fig art sec ch md mah sok sk cad cd blv apt kat ص ج पृ सं".split())
#: may stand inside or at the end of a sentence
ENDERS = frozenset("vb vs vd etc usw usf ltd inc co corp jr sr şti yy yky approx dept est tel".split())
#: with inner stops, never at the end
NEVER = frozenset("i.e e.g z.b d.h u.a s.o m.ö m.s i.ö m.e vb.g พ.ศ ค.ศ".split())
_LISTED = TITLES | REFERENCES | ENDERS | NEVER
#: words that carry on a quotation
REPORTING = frozenset("diye dedi der demiş sordu said asked cried replied wrote whispered rief sagte fragte schrieb meinte قال قالت يقول سأل صاح".split())
#: words before an ordinal where nouns are written with a capital
ORDINAL_BEFORE = frozenset("im am vom zum zur beim der die das dem den des ab bis seit".split())
#: words that go on after dots of hesitation where the script has no capitals
GO_ON = frozenset("ثم و لكن بل أو और फिर पर लेकिन मगर तो तब".split())

_STRONG = "!?。！？｡।॥؟۔"
_CJK_END = "。！？｡"
_TERM = r"[.!?…。！？｡।॥؟۔]+"
_PAIRS = {"“": "”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", "【": "】", "《": "》", "„": "“", "‘": "’", "‚": "‘"}
_CLOSERS = set("”»›」』)]）】》’\"'")
_PLAIN = r"(?P<t>" + _TERM + r")|(?P<q>[“”«»‹›「」『』()\[\]（）【】《》„‘’‚\"])"
_EVENT = re.compile(_PLAIN)
_THAI = re.compile("[ก-๎]")
_EVENT_THAI = re.compile(_PLAIN + r"|(?P<th>(?<=[ก-ฺเ-๎])\s+(?=[ก-ฺเ-๎]))")
_EMPTY = re.compile(r"(?:\r?\n|\u2029)[^\S\n]*(?:(?:\r?\n|\u2029)[^\S\n]*)+|\u2029")
_MARK = re.compile(r"[^\S\n]*(?:(?P<b>[-–—•*·‣▪◦●])[^\S\n]+|[(]?(?P<n>\d{1,3}|[a-zA-Zçğıöşü])(?P<c>[.)])[^\S\n]+)(?=\S)")
_NUMBER = re.compile(r"[(]?[\d٠-٩०-९]+(?:[.,:/–-][\d٠-٩०-९]+)*$")
_LEFT = set(" \t\n\r\xa0　([{“„«‹「『（\"‘*•")
_WORD = re.compile(r"[^\W\d_]+")
#: letters with the vowel signs and marks that scripts put on them
_LETTER = (
    "[A-Za-zªµºÀ-ÖØ-öø-\u0605\u0610-\u061a\u0620-\u065f\u066e-\u06d3\u06d5-\u06ef\u06fa-\u0963\u0971-\u0e3a\u0e40-\u0e4e"
    "\u0e80-\u1fff\u2c00-\u2dff\u3005-\u3007\u3031-\u3035\u3041-\u3096\u3099-\u30fa\u30fc-\u9fff\uac00-\ud7af\uf900-\ufaff\ufe70-\ufefc\U00010000-\U0001ffff]"
)
_FORM = re.compile(_LETTER + r"++\.?")
_TOKEN = re.compile(rf"(?<![.\w])({_LETTER}++(?:\.{_LETTER}++)*+)\.(?![.\w])")
_STOP = re.compile(_TOKEN.pattern + r"([^\S\n]*\n?[^\S\n]*)(\S?)")
_STARTS = re.compile(r"[^.\W\d]{3}[.!?]\s+([^\W\d_])")
_ASIDE = re.compile(r"[(“„«「][^)”“»」]*[)”“»」]")
#: what is counted of a token: stop before a small letter or comma, a digit, a proper name, a capital that
#: opens a sentence, a letter without case; at the end of a block; without stop; itself with a capital
_COUNTED = ("mid", "num", "name", "up", "other", "last", "bare", "cap")


def _kind(ch: str) -> str:
    """u(pper), l(ower), d(igit), o(ther letter), p(unctuation)."""
    if ch.isupper() or ch.istitle():
        return "u"
    if ch.islower():
        return "l"
    if ch.isdigit():
        return "d"
    return "o" if ch.isalpha() else "p"


def _run(text: str, low: int, i: int) -> str:
    """The run before position ``i``, back to white space or an opening mark."""
    j = i
    while j > low and text[j - 1] not in _LEFT and not text[j - 1].isspace():
        j -= 1
    return text[j:i]


def _pairs(text: str, a: int, b: int, marks: list[re.Match]) -> list[tuple[int, int]]:
    """Outermost matched quotes and brackets of a segment as ``(open, close)``; ``marks`` are its events."""
    stack: list[tuple[str, int]] = []
    out: list[tuple[int, int]] = []
    straight = text.count('"', a, b) // 2 * 2
    for m in marks:
        ch = m["q"]
        at = m.start()
        if ch == '"':
            if straight <= 0:
                continue
            straight -= 1
        closes = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == ch or (stack[k][0] == "“" and ch == "”")), None)
        if ch == "’" and (closes is None or (at + 1 < b and text[at + 1].isalnum())):
            continue
        if closes is not None and not (ch == "“" and stack[closes][0] != "“"):
            o = stack[closes][1]
            del stack[closes:]
            while out and out[-1][0] > o:
                out.pop()
            out.append((o, at))
        elif ch in _PAIRS or ch == '"':
            if ch == "‘" and at > a and text[at - 1].isalnum():
                continue
            stack.append((_PAIRS.get(ch, '"'), at))
    # an unmatched opener hides nothing; keep outermost pairs only
    out.sort()
    top: list[tuple[int, int]] = []
    for o, c in out:
        if not top or o > top[-1][1]:
            top.append((o, c))
    return top


def small_form(w: str) -> str:
    return w.lower().replace("i̇", "i")


def evidence(text: str) -> tuple[dict[str, list[int]], set[str]]:
    """The counts ``_COUNTED`` of each token before a full stop, and the words written small."""
    forms = Counter(_FORM.findall(text))
    small = {x for x in forms if x.islower()}
    out: dict[str, list[int]] = {}
    # what a quotation or bracket says of its own stops is left out
    free = _ASIDE.sub(lambda m: " " * len(m.group()), text)
    for m in _STOP.finditer(free):
        w, ws, n = m.groups()
        low = small_form(w)
        if n and not ws and n not in ",;":
            continue
        c = out.get(low)
        if c is None:
            c = out[low] = [0] * 8
            for x in {low, w, w.capitalize()}:
                c[6] += forms.get(x, 0)
        if w[0].isupper() and (len(w) == 1 or not w.isupper()):
            c[7] += 1
        if not n:
            c[5] += 1
        elif n.islower() or n in ",;":
            c[0] += 1
        elif n.isdigit():
            c[1] += 1
        elif n.isupper() or n.istitle():
            nxt = _WORD.match(free, m.start(3)).group()
            x = nxt.lower()
            c[3 if x in small or x + "." in small else 2] += 1
        elif n.isalpha():
            c[4] += 1
    return out, small


def judge(c: list[int], least: int) -> str | None:
    """What the counts say of a token: ``title`` (a stop after it ends nothing), ``ref`` (nothing before a
    digit), ``abbr`` (it may end a sentence), ``word`` (an ordinary word) or nothing."""
    mid, num, name, up, other, last, bare, cap = c
    n = mid + num + name + up + other
    ends = up + last
    if n < least:
        return None
    if num >= 0.8 * n and ends <= 0.1 * n:
        return "ref"
    if bare > 0.25 * n:
        return "word"
    if ends <= 0.02 * n and (n >= SURE or mid + num and cap >= 0.9 * n) and (mid + num >= 0.95 * n or mid + num + name >= 0.98 * n and cap >= 0.9 * n):
        return "title"
    if mid >= 0.3 * n:
        return "abbr"
    return None


def judge_caseless(w: str, c: list[int]) -> str | None:
    """Short tokens of scripts without case that always carry a stop and never end a block."""
    mid, num, name, up, other, last, bare, _ = c
    n = mid + num + name + up + other
    if n >= CORPUS_LEAST and len(w) <= 4 and other + num >= 0.9 * n and last <= 0.02 * n and bare <= 0.02 * n:
        return "title"
    return None


class Splitter:
    """Cuts one text after another; ``corpus`` maps a token to what the corpus says of it."""

    def __init__(self, corpus: dict[str, str] | None = None):
        self.corpus = corpus or {}

    def units(self, text: str) -> list[tuple[int, int]]:
        """``(start, end)`` of each unit in code points, in order."""
        if not text or text.isspace():
            return []
        self.own, self.own_bare, self._small_words = {}, set(), None
        stopped = Counter(small_form(w) for w in _TOKEN.findall(text))
        # a document that has no token often enough, and none that others know, has nothing to say
        if stopped and (max(stopped.values()) >= OWN_LEAST or not _LISTED.isdisjoint(stopped) or not self.corpus.keys().isdisjoint(stopped)):
            seen, self._small_words = evidence(text)
            self.own = {w: j for w, c in seen.items() if (j := judge(c, OWN_LEAST))}
            self.own_bare = {w for w, c in seen.items() if c[6] >= 2 and not c[0] and not c[1]}
        self._text = text
        self.event = _EVENT_THAI if _THAI.search(text) else _EVENT
        starts = _STARTS.findall(text)
        cased = [c for c in starts if c.isupper() or c.islower()]
        self.small = len(cased) >= 3 and sum(c.isupper() for c in cased) < 0.1 * len(cased)
        out: list[tuple[int, int]] = []
        at = 0
        for m in _EMPTY.finditer(text):
            self._block(text, at, m.start(), out)
            at = m.end()
        self._block(text, at, len(text), out)
        return out

    @property
    def doc_small(self) -> set[str]:
        """Words that the document writes small."""
        if self._small_words is None:
            self._small_words = {x for x in _FORM.findall(self._text) if x.islower()}
        return self._small_words

    def _block(self, text: str, a: int, b: int, out: list) -> None:
        if a >= b or text[a:b].isspace():
            return
        lines, s = [], a
        while True:
            e = text.find("\n", s, b)
            lines.append((s, b if e < 0 else e))
            if e < 0:
                break
            s = e + 1
        marks = [_MARK.match(text, s, e) for s, e in lines]
        item = [False] * len(lines)
        number = None
        for k, m in enumerate(marks):
            if not m:
                number = number if k and item[k - 1] and not text[lines[k][0] : lines[k][1]].strip() else None
                continue
            if m.group("b"):
                # a dash after an unfinished line can be a dash of the sentence
                item[k] = m.group("b") not in "-–—" or k == 0 or item[k - 1] or self._ended(text, a, lines[k - 1][1]) or self._next_is_item(marks, k)
                number = None
                continue
            v = m.group("n")
            n = int(v) if v.isdigit() else ord(v.lower()) - 96
            lone = not v.isdigit() and m.group("c") == "."
            follows = number is not None and n == number + 1
            begins = n == 1 and not lone and (k == 0 or self._ended(text, a, lines[k - 1][1]) or self._next_number(marks, k) == 2)
            more = v.isdigit() and self._next_number(marks, k) == n + 1 and (k == 0 or self._ended(text, a, lines[k - 1][1]))
            single = k == 0 and len(lines) == 1 and v.isdigit() and m.group("c") == ")"
            if follows or begins or more or single:
                item[k], number = True, n
            else:
                number = None
        k = 0
        while k < len(lines):
            if item[k]:
                self._segment(text, lines[k][0], lines[k][1], marks[k].end(), out)
                k += 1
                continue
            j = k
            while j + 1 < len(lines) and not item[j + 1]:
                j += 1
            self._segment(text, lines[k][0], lines[j][1], lines[k][0], out)
            k = j + 1

    @staticmethod
    def _ended(text: str, a: int, e: int) -> bool:
        t = text[a:e].rstrip()
        while t and t[-1] in _CLOSERS | {"“"}:
            t = t[:-1]
        return not t or t[-1] in ".…:" + _STRONG

    @staticmethod
    def _next_is_item(marks: list, k: int) -> bool:
        return k + 1 < len(marks) and marks[k + 1] is not None and marks[k + 1].group("b") is not None

    @staticmethod
    def _next_number(marks: list, k: int) -> int | None:
        m = marks[k + 1] if k + 1 < len(marks) else None
        return int(m.group("n")) if m and m.group("n") and m.group("n").isdigit() else None

    def _segment(self, text: str, a: int, b: int, body: int, out: list) -> None:
        events = list(self.event.finditer(text, body, b))
        marks = [m for m in events if m.lastgroup == "q"]
        pairs = _pairs(text, body, b, marks) if marks else []
        p = 0
        start = a
        for m in events:
            i, j = m.span()
            if i < start or m.lastgroup == "q":
                continue
            while p < len(pairs) and pairs[p][1] < i:
                p += 1
            inside = pairs[p] if p < len(pairs) and pairs[p][0] < i < pairs[p][1] else None
            if m.lastgroup == "th":
                if inside is None:
                    self._put(text, start, i, out)
                    start = j
                continue
            if inside:
                if j != inside[1]:
                    # other closers may stand between, as in .’”
                    if text[j : inside[1]].strip("”»›」』)]）’\"'"):
                        continue
                end = inside[1] + 1
                # a terminator right after the closing mark decides by itself
                if end < b and text[end] in "." + _STRONG + "…":
                    continue
                while end < b and text[end] in _CLOSERS and not (text[end] in "\"'" and end + 1 < b and text[end + 1].isalnum()):
                    end += 1
                if self._after_quote(text, start, inside[0], end, b, m.group()):
                    self._put(text, start, end, out)
                    start = end
                continue
            end = j
            while end < b and text[end] in _CLOSERS and not any(o == end for o, _ in pairs[p : p + 2]) and not (text[end] in "\"'’" and end + 1 < b and text[end + 1].isalnum()):
                end += 1
            if self._ends(text, start, i, end, b, m.group()):
                self._put(text, start, end, out)
                start = end
        self._put(text, start, b, out)

    @staticmethod
    def _put(text: str, s: int, e: int, out: list) -> None:
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if e > s:
            out.append((s, e))

    @staticmethod
    def _next(text: str, k: int, b: int) -> tuple[int, str, bool]:
        """Position and kind of what follows, and whether an opening mark comes first."""
        n = k
        while n < b and text[n].isspace():
            n += 1
        f = n
        while f < b and (text[f] in _PAIRS or text[f] in "\"'¿¡"):
            f += 1
        return n, (_kind(text[f]) if f < b else "e"), f > n

    def _after_quote(self, text: str, start: int, o: int, end: int, b: int, term: str) -> bool:
        """Does the unit end after a closed quotation or bracket whose last mark is a terminator?"""
        n, kind, opens = self._next(text, end, b)
        if n >= b:
            return True
        head = text[start:o].strip()
        alone = not head
        nxt = text[n]
        if nxt in ",;:،、，；：—–-" or (kind == "l" and not self.small and not opens):
            return False
        word = _WORD.match(text, n)
        w = word.group().lower() if word else ""
        if w in REPORTING:
            return False
        if kind == "o":
            if not alone:
                return False
            if nxt in "とっ":
                return False
            rest = re.split(r"[。！？।.!?؟\n]", text[n : n + 60], maxsplit=1)[0]
            if re.match(r"[^，、]{1,8}(?:说|道|问|喊|叫|答)(?:$|[：:，])", rest) or re.search(r"(?:कहा|बोला|बोली|पूछा)\s*$", rest) or re.match(r"(?:قال|قالت|يقول|سأل|صاح)\b", rest):
                return False
            return True
        if kind == "u":
            if alone:
                return True
            # all capitals say nothing about a new sentence
            letters = [c for c in text[start:o] if c.isupper() or c.islower()]
            return not (letters and all(c.isupper() for c in letters))
        if kind == "d":
            return alone
        return alone or "\n" in text[end:n]

    def _class(self, token: str) -> str | None:
        """What is known of a token before a full stop: by its form, the document, the corpus, the lists."""
        t = small_form(token)
        if len(t) == 1 and t.isalpha():
            return "title"
        known = self.own.get(t)
        if known is None and t not in self.own_bare:
            # a word that this document also uses without a stop is no abbreviation here
            known = self.corpus.get(t)
        if known is None and t not in self.own_bare:
            known = "title" if t in TITLES or t in NEVER else "abbr" if t in ENDERS else None
        if known is None and t in REFERENCES:
            known = "ref"
        if known and known != "word":
            return known
        return "dotted" if "." in t else None

    def _ends(self, text: str, start: int, i: int, end: int, b: int, term: str) -> bool:
        n, kind, opens = self._next(text, end, b)
        if n >= b:
            return True
        ws = text[end:n]
        gap, line = bool(ws), "\n" in ws
        nxt = text[n]
        if nxt in ",;،、，；" or (nxt in ")]”»" and not gap):
            return False
        if any(c in _CJK_END for c in term):
            return True
        if any(c in _STRONG for c in term):
            if opens:
                return True
            if kind == "l":
                return self.small and gap
            if not gap:
                return kind in "uo"
            return True
        if len(term) > 1 or term == "…":
            if opens and gap:
                return True
            if kind == "u":
                return True
            if kind == "o":
                if not gap:
                    return False
                w = re.match(r"\S+", text[n:b]).group()
                return w not in GO_ON
            if kind == "l":
                return self.small and gap and line
            return gap and (line or kind == "p")
        # a single full stop
        token = _run(text, start, i)
        prev = text[i - 1] if i > start else " "
        if not gap:
            if kind == "u" and end + 1 < b and not opens:
                bare = token.rsplit(")", 1)[-1]
                if not bare.isalpha() or len(bare) < 2 or self._class(bare):
                    return False
                if bare.islower() or (bare[1:].islower() and len(bare) > 2):
                    return text[end + 1].islower() or not text[end + 1].isalnum()
                return bare.isupper() and len(bare) > 3 and text[end + 1].isupper()
            if kind == "o":
                return token.isalpha() and len(token) > 2 and "฀" > prev and not self._class(token)
            return opens and kind != "e" and token.isalpha() and len(token) > 1 and not self._class(token)
        if "ก" <= prev <= "๎":
            return line and kind != "d"
        core = token.strip("([{“„«\"'‘")
        if _NUMBER.match(core):
            return self._after_number(text, start, i - len(token), core, kind, line, opens)
        cls = self._class(core)
        if cls == "title":
            return False
        if cls == "ref":
            return kind in "uo" and len(core) > 1 and not opens
        if cls == "dotted":
            return (kind == "u" and core.islower()) or (opens and core.islower())
        if cls == "abbr":
            if kind == "u" and text[start:n].isupper() and len(core) > 1:
                # all capitals: only a stop that is known to end sentences as well does so
                w = _WORD.match(text, n, b)
                return not (w and w.group().replace("I", "ı").replace("İ", "i").lower() in self.doc_small)
            return kind in "uop" or opens
        if kind == "l":
            return self.small
        return True

    @staticmethod
    def _after_number(text: str, start: int, at: int, core: str, kind: str, line: bool, opens: bool) -> bool:
        before = text[start:at].split()
        if opens:
            return bool(before)
        if kind == "l":
            return False
        if kind == "d":
            return line and bool(before)
        if len(before) <= 1 and core.isdigit() and (not before or before[0].isalpha()):
            return False  # a label such as "Part 5."
        if kind == "u" and core.isdigit() and len(core) <= 2 and before and before[-1].lower() in ORDINAL_BEFORE:
            return False
        return True


def corpus_judgements(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(w, j)``: tokens that the corpus shows to be abbreviations, titles or references, as ``judge`` does."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: dict[str, list[int]] = {}
            for t in b.column(0).to_pylist():
                for w, c in evidence(t)[0].items():
                    had = total.get(w)
                    total[w] = c if had is None else [x + y for x, y in zip(had, c)]
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total)), *(pa.array(x, pa.int64()) for x in zip(*total.values()))], ["w", *_COUNTED])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ws, js = [], []
            for w, *c in zip(*(x.to_pylist() for x in b.columns)):
                j = judge(c, CORPUS_LEAST) or judge_caseless(w, c)
                if j and j != "word":
                    ws.append(w)
                    js.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(ws, pa.string()), pa.array(js, pa.string())], ["w", "j"])

    src = docs.select(F.col(text).alias("t")).where(F.length("t") > 0)
    parts = spread(src).mapInArrow(count, "w string, " + ", ".join(f"{x} bigint" for x in _COUNTED))
    total = parts.groupBy("w").agg(*[F.sum(x).alias(x) for x in _COUNTED])
    # ordinary words are most of the tokens and are left in the JVM
    n = F.col("mid") + F.col("num") + F.col("name") + F.col("up") + F.col("other")
    known = total.where((n >= CORPUS_LEAST) & ((F.col("bare") <= 0.25 * n) | (F.col("num") >= 0.8 * n)))
    return materialize(known.mapInArrow(decide, "w string, j string"), "stops")


def _stopped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(row, w)``: each token of a text that stands before a full stop, as ``Splitter`` looks it up."""
    for b in batches:
        rows, ws = [], []
        for r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = {small_form(x) for x in _TOKEN.findall(t)}
            rows += [r] * len(own)
            ws += own
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ws, pa.string())], ["row", "w"])


def sentence_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start_char, end_char, unit_no)``: the sentence units of every document.

    A unit is a sentence, a heading or a list item, without outer white space; offsets are
    code points, the end is exclusive.  Null, empty and blank texts give no row; repeated
    documents are cut under each key; whole texts are read, however long.
    """
    judged = corpus_judgements(docs, text)
    src = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("t")).where(F.length("t") > 0)
    known = judged.limit(MAX_TYPES + 1).collect()
    many = len(known) > MAX_TYPES
    corpus = docs.sparkSession.sparkContext.broadcast({} if many else {r["w"]: r["j"] for r in known})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Splitter(corpus.value)
        for b in batches:
            ids, a, e, no = [], [], [], []
            own = b.column(2).to_pylist() if many else None
            for i, (d, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if many:
                    s.corpus = dict(own[i] or ())
                for k, (x, y) in enumerate(s.units(t)):
                    ids.append(d)
                    a.append(x)
                    e.append(y)
                    no.append(k)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.int32()), pa.array(e, pa.int32()), pa.array(no, pa.int32())], ["doc_id", "start_char", "end_char", "unit_no"])

    if many:
        # rows, not documents, are what is joined: keys repeat
        src = materialize(src.withColumn("row", F.monotonically_increasing_id()), "texts")
        own = spread(src.select("row", "t")).mapInArrow(_stopped, "row bigint, w string").join(judged, "w")
        own = own.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "j"))).alias("own"))
        src = src.join(own, "row", "left").select("doc_id", "t", "own")
    else:
        release(judged)
        src = spread(src)
    return src.mapInArrow(cut, "doc_id bigint, start_char int, end_char int, unit_no int").withColumnRenamed("doc_id", key)
