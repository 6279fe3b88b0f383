"""Repairing text that was taken from scanned pages.

Word counts of the whole corpus are the lexicon. Each paragraph that holds anything suspicious is decoded
as one stream of characters: a shortest path over joint segmentations, in which a word may have lost or gained a space, hold
misread characters or a speck, or be hyphenated at a line's end, and whole lines may be page furniture (running heads,
feet, page numbers) to be passed over, each at a cost against the words' frequencies. A page is noisy if the edits
of its cheapest paths gain enough over the text as it stands. The lines are then joined into paragraphs by
dynamic programming over their boundaries.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import ship_package

#: A word is in the lexicon if at least this share of the pages has it; so the lexicon has at most the mean
#: number of different words of a page divided by it, whatever the number of pages.
SHARE = 5e-5
#: Words of that share of the pages are never suspicious.
COMMON = 0.005

# Misread -> meant.
MISREAD = tuple(p.split(">") for p in "0>o 1>l 1>i 5>s 6>b 8>b 9>g (>c |>l |>i !>l !>i rn>m li>h ii>u cl>d vv>w f>t c>e e>c l>i i>l l>t h>b n>u u>n q>g o>c c>o 3>з 0>о 6>б".split())
BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _seen, _meant in MISREAD:
    BY_FIRST.setdefault(_seen[0], []).append((_seen, _meant))
CODE_COST, LETTER_COST, HYPHEN_COST, SPACE_COST, SPECK_COST = 3.5, 4.5, 0.0, 5.5, 4.0
#: A lost space; what a word costs that isn't in the lexicon, at least and a letter; a hyphen of the kinds no text has at a line's end.
LOST_COST, UNKNOWN_COST, UNKNOWN_LETTER_COST, SOFT_COST = 3.5, 18.0, 2.0, 8.0
#: What a lone speck between two words of a line of prose costs if it stays.
KEPT_SPECK = 4.0
#: By how much the edits together must beat what stands there to make the page a noisy one; and lost and gained spaces alone.
SURE, SURE_SPACES = 1.5, 10.0
#: Edits of a word besides hyphens: so many, or one for so many letters.
EDITS, LETTERS_AN_EDIT = 2, 4
HYPHENS = "-\xad¬"

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\s,;:?“”«»<>/=\[\]{}]+")
#: For ASCII texts the same by a table, which is faster: letters in lower case, or the characters of a token; all else a blank.
_ASCII_WORDS = str.maketrans({c: chr(c).lower() if chr(c).isalpha() else " " for c in range(128)})
_ASCII_TOKENS = str.maketrans({c: " " for c in b",;:?<>/=[]{}"})
_SHAPE = re.compile(r"[^\W_]*[(|!]?[^\W_]*")
_CAMEL = re.compile(r"[^\W\d_A-ZА-Я][A-ZА-Я]")
_CODE = re.compile(r"(?<=[^\W\d_])[0-9(|!](?=[^\W\d_])")
_NUMBER = re.compile(r"(?:-|–|—)\s?(\d{1,4})\s?(?:-|–|—)|\[(\d{1,4})\]|[Pp]age (\d{1,4})|[Ss]eite (\d{1,4})|(\d{1,4})")
_HEAD_NUMBER = re.compile(r"(\S.*?\S)(?: {3,}|\t+| \| )(\d{1,4})|(\d{1,4})(?: {3,}|\t+| \| )(\S.*\S)")
_CANDIDATE = re.compile(r"(?m)^[ \t\f]*(?:[-–—\[]?\s?\d{1,4}\s?[-–—\]]?[ \t\f]*$|(?:[Pp]age|[Ss]eite) \d|\d{1,4}(?: {3}|\t| \| ))|(?:   |\t| \| )\d{1,4}[ \t\f]*$")
_HYPHEN_END = re.compile(r"[-\xad¬][ \t]*\n[ \t]*(?=[^\W\d_]|[-–—\[(\d])")
_SOFT_END = re.compile(r"[\xad¬][ \t]*\n")
_SPECK_BETWEEN = re.compile(r"(?<=[^\W\d_]) +[|'~.^`¸] +(?=[^\W\d_])")
_BLANK = re.compile(r"\n[ \t\f]*\n\s*")
_WORD_BEFORE = re.compile(r"([^\W\d_]+)[ \n]\Z")
_WORD_AFTER = re.compile(r"[ \n]([^\W\d_]+)")
_LINE_END_HYPHEN = re.compile(r"(?<=[^\W\d_])[-\xad¬][ \t]*\n")
# A sign around a word on both sides is a quote or an emphasis and no speck.
_SPECK = re.compile(r"(?<=[^\W\d_]) +(?:([|'~.\"^*·`¸])(?!\w+\1) +|(?<![,;] )([|'~.^*·`¸])(?!\w+\2))(?=[^\W\d_])|(?<=[^\W\d_])([|~^*])(?!\w+\3)(?=[^\W\d_])")
_SPECK_SIGNS = (*(f" {x}" for x in "|'~.\"^*·`¸"), *"|~^*")  # one of them is in every match, and looked for faster
_LONE = re.compile(r" *([|'~.\"^*·`¸])(?!\w+\1) *(?=[^\W\d_])")
_VERBATIM = re.compile(r"[ \t]{2,}\S|[-*•o]\s|\d{1,3}[.)]\s|.*[{};|]\s*$|[=\-~_*]{3,}\s*$|.*\S {2,}\S|set [A-Z]+=|for \(|if \(|hr = ")
_ENDS = re.compile(r"[.!?。！？:…][\"'”’»)\]]*\s*$")


def words_in(text: str) -> set[str]:
    """The different words of a text in lower case."""
    return set(text.translate(_ASCII_WORDS).split() if text.isascii() else _WORD.findall(text.lower()))


def tokens_in(text: str) -> set[str]:
    return set(text.translate(_ASCII_TOKENS).split() if text.isascii() else _TOKEN.findall(text))


#: Bytes that a word of the lexicon takes in a worker, about: a string of some ten letters, its place in a list and its number.
WORD_BYTES = 75


class Lexicon:
    """Words, sorted, with the number of pages that have them; beginnings are looked up in the same list."""

    def __init__(self, counts: dict[str, int] | tuple[list[str], list[int]], pages: int):
        words, numbers = (list(counts), list(counts.values())) if isinstance(counts, dict) else counts
        if any(a > b for a, b in zip(words, words[1:])):
            order = sorted(range(len(words)), key=words.__getitem__)
            words, numbers = [words[k] for k in order], [numbers[k] for k in order]
        self.words, self.numbers, self.pages = words, array("q", numbers), pages
        self.total = max(1, sum(self.numbers))
        least = max(3, COMMON * pages)
        self.usual = {w: n for w, n in zip(words, self.numbers) if n >= least}  # at most the mean number of different words of a page / COMMON
        self.longest = max(map(len, self.usual), default=0)
        self.begun: dict[str, bool] = {}
        self.memo: dict[str, bool] = {}
        self.fine: set[str] = set()

    def count(self, word: str) -> int:
        n = self.usual.get(word)
        if n is None:
            k = bisect_left(self.words, word)
            n = self.numbers[k] if k < len(self.words) and self.words[k] == word else 0
        return n

    def begins(self, part: str) -> bool:
        """Whether any word begins so."""
        known = self.begun.get(part)
        if known is None:
            if len(self.begun) > 300_000:
                self.begun.clear()
            k = bisect_left(self.words, part)
            known = self.begun[part] = k < len(self.words) and self.words[k].startswith(part)
        return known

    def cost(self, word: str) -> float | None:
        n = self.count(word)
        return math.log(self.total / n) if n else None

    def stands(self, word: str) -> float:
        """What a word costs as it stands."""
        own = self.cost(word.lower())
        return max(UNKNOWN_COST, UNKNOWN_LETTER_COST * len(word)) if own is None else own

    def common(self, word: str) -> bool:
        return word in self.usual

    def suspicious(self, raw: str) -> bool:
        """Whether a token as it stands in the text should be decoded; those that need not are remembered."""
        token = raw.strip(".'\"()*&–—-·’")
        low = token.lower()
        if len(token) > 1 and not self.common(low) and not low.isdigit():
            if "-" in low:
                if any(len(x) > 3 and not self.common(x) and _SHAPE.fullmatch(x) and not x.isdigit() and self.misread(x) for x in low.split("-")):
                    return True  # a part of a compound
            elif not _SHAPE.fullmatch(low):
                pass
            elif not (_CAMEL.search(token) and token[0].isupper()):
                if self.misread(low) or self.run_together(token) or raw[0] == "(" and ")" not in raw and self.misread("(" + low):
                    return True
            elif _CODE.search(low) and any(self.count(w) > 2 + 3 * self.count(low) for w, _ in self.variants(low, 1)):
                return True  # a name, misread as a sign or a digit within it
        if not low.isalpha() or self.common(low) or token != low:  # a rare word may be part of one
            if len(self.fine) > 500_000:
                self.fine.clear()
            self.fine.add(raw)
        return False

    def misread(self, token: str) -> bool:
        """Whether one or two misread characters away there is a word far more usual than the token.

        One page with the token is no sign that it is in use; the ratio is to those beyond it, whatever the number of pages.
        In tokens of two or three characters, of which many are names or cut words, only signs and digits count, for words that are the more usual.
        """
        known = self.memo.get(token)
        if known is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            known = self.memo[token] = self._misread(token)
        return known

    def _misread(self, token: str) -> bool:
        n = max(1, self.count(token))
        if len(token) < 4 and token.isalpha():
            return False
        short = 10.0 ** max(0, 4 - len(token))
        few = max(2.0, 0.002 * short * self.pages, 50 * short * (n - 1))
        more = max(4.0, 0.01 * short * self.pages, 200 * short * (n - 1))
        if few > self.pages:
            return False
        return any(self.count(word) >= (few if edits == 1 else more) for word, edits in self.variants(token, max(EDITS, len(token) // LETTERS_AN_EDIT)))

    def run_together(self, token: str) -> bool:
        """Whether a rare token in small letters begins with a common word and goes on with words."""
        if not token[1:].islower() or len(token) < 5 or self.count(token.lower()) > 1:
            return False
        low, ends, todo = token.lower(), {0}, [0]
        while todo:  # from the ends of common words to those of the next
            at = todo.pop()
            for k in range(at + 2, min(len(low), at + self.longest) + 1):
                if k not in ends and k != len(low) - 1 and self.common(low[at:k]):
                    if k == len(low):
                        return True
                    ends.add(k)
                    todo.append(k)
        return False

    def variants(self, token: str, most: int) -> Iterator[tuple[str, int]]:
        """(word or beginning of one, edits) that the token can be a misreading of; only beginnings of known words are followed."""
        todo = [(0, "", 0)]
        while todo:
            at, made, done = todo.pop()
            if at == len(token):
                if done:
                    yield made, done
                continue
            if self.begins(made + token[at]):
                todo.append((at + 1, made + token[at], done))
            if done < most:
                for seen, meant in BY_FIRST.get(token[at], ()):
                    if token.startswith(seen, at) and self.begins(made + meant):
                        todo.append((at + len(seen), made + meant, done + 1))


def count_words(df: DataFrame, text_col: str) -> DataFrame:
    """(word, pages): in how many texts each word occurs, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: Counter = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    own.update(words_in(text))
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], ["word", "pages"])

    return df.select(text_col).mapInArrow(run, "word string, pages long").groupBy("word").agg(F.sum("pages").alias("pages"))


@dataclass
class Edits:
    hyphens: int = 0
    misread: int = 0
    codes: int = 0
    spaces: int = 0
    specks: int = 0
    furniture: int = 0

    def add(self, other: tuple[int, ...]) -> None:
        for k, v in zip(vars(self), other):
            setattr(self, k, getattr(self, k) + v)

    def __bool__(self) -> bool:
        return any(vars(self).values())


NONE = (0, 0, 0, 0, 0, 0)
Skips = dict[int, tuple[int, float, int]]  # where page furniture begins -> where it ends, what keeping it costs, its lines


def words_at(s: str, i: int, lex: Lexicon, skips: Skips) -> list[tuple[int, str, float, tuple[int, ...]]]:
    """All words that the stream can mean from position i on: (end, word, cost, edits).

    A common word may also end before a small letter, where a space was lost; one broken by a hyphen goes on behind page furniture.
    """
    out = []
    todo = [(i, "", 0.0, NONE)]
    n = len(s)
    most = i
    while most < n and not s[most].isspace():
        most += 1
    most = max(EDITS, (most - i) // LETTERS_AN_EDIT)
    while todo:
        j, made, cost, e = todo.pop()
        if made and (j == n or not s[j].isalpha()):
            own = lex.cost(made)
            if own is not None:
                out.append((j, made, own + cost, e))
        elif len(made) > 1 and s[j].islower() and s[j - 1].isalnum() and lex.common(made):
            out.append((j, made, lex.cost(made) + cost + LOST_COST, (*e[:3], e[3] + 1, *e[4:])))
        if j >= n:
            continue
        ch = s[j].lower()
        if lex.begins(made + ch):
            todo.append((j + 1, made + ch, cost, e))
        edits = e[1] + e[2] + e[3] + e[4]
        if edits < most:
            for seen, meant in BY_FIRST.get(ch, ()):
                if (len(seen) == 1 or s[j + 1 : j + 2].lower() == seen[1]) and lex.begins(made + meant):
                    code = not seen[0].isalpha()
                    todo.append((j + len(seen), made + meant, cost + (CODE_COST if code else LETTER_COST), (e[0], e[1] + (not code), e[2] + code, *e[3:])))
        if not made:
            continue
        if s[j] in HYPHENS and e[0] == 0 and (m := _HYPHEN_END.match(s, j)):
            k, _, lines = skips.get(m.end(), (m.end(), 0.0, 0))
            todo.append((k, made, cost + HYPHEN_COST, (1, *e[1:5], e[5] + lines)))
        elif edits < most and e[4] == 0 and (m := _LONE.match(s, j)):
            todo.append((m.end(), made, cost + SPECK_COST, (*e[:4], 1, e[5])))
        elif edits < most and e[3] == 0 and s[j] in " \n" and j + 1 < n and s[j + 1].isalpha():
            todo.append((j + 1, made, cost + SPACE_COST, (*e[:3], 1, *e[4:])))
    return out


@dataclass
class Reading:
    """The cheapest reading of a stream, its edits, and what they gained over the stream as it stands."""

    text: str
    edits: Edits
    gain: float = 0.0
    spaces: dict[str, float] = field(default_factory=dict)


def beside(a: int, b: int, skips: Skips) -> list[tuple[int, int]]:
    """A part of the stream without the page furniture in it."""
    out = []
    for k in sorted(k for k in skips if a < k < b):
        out.append((a, k))
        a = skips[k][0]
    return [*out, (a, b)]


def plain_cost(s: str, a: int, b: int, lex: Lexicon, skips: Skips, kept: dict[int, float]) -> float:
    """What a part of the stream costs as it stands."""
    cost = sum(lex.stands(m[0]) for m in _WORD.finditer(s, a, b))
    cost += sum(SOFT_COST for m in _SOFT_END.finditer(s, a, b))
    return cost + sum(c for k, c in kept.items() if a <= k < b) + sum(c for k, (_, c, _) in skips.items() if a <= k < b)


def decode(s: str, lex: Lexicon, skips: Skips | None = None, look: list[tuple[int, int]] | None = None) -> Reading:
    """Read a stream the cheapest way.

    Only words that begin within the spans of ``look`` (all, if it isn't given) can mean others than they are: elsewhere
    every word is usual and followed by usual ones, so that it is cheapest as it stands.
    """
    n = len(s)
    skips = skips or {}
    kept = lone_specks(s)
    costs: list[float | None] = [None] * (n + 1)
    costs[0] = 0.0
    back: list[tuple[int, str, tuple[int, ...]]] = [(0, "", NONE)] * (n + 1)
    spans = iter([*(look if look is not None else [(0, n)]), (n + 1, n + 1)])
    x, y = next(spans)

    def reach(i: int, j: int, cost: float, text: str, e: tuple[int, ...]) -> None:
        if costs[j] is None or cost < costs[j] - 1e-9:
            costs[j] = cost
            back[j] = (i, text, e)

    inside = 0  # page furniture is passed over or kept as it is
    for i in range(n):
        if i in skips:
            inside = skips[i][0]
        here = costs[i]
        if here is None:
            continue
        while i >= y:
            x, y = next(spans)
        ch = s[i]
        if i in skips:
            after, keep, lines = skips[i]
            reach(i, after, here + plain_cost(s, i, after, lex, {}, {}), "", (0, 0, 0, 0, 0, lines))
            here += keep
        letter = ch.isalpha()
        if not letter:
            reach(i, i + 1, here + kept.get(i, 0.0) + (SOFT_COST if ch in "\xad¬" and _SOFT_END.match(s, i) else 0.0), ch, NONE)
            if i >= inside and i in kept and (m := _SPECK_BETWEEN.match(s, i)):
                reach(i, m.end(), here + 1.0, "" if i and s[i - 1] == " " else " ", (0, 0, 0, 0, 1, 0))
        lost = i > 0 and s[i - 1].isalnum() and back[i][1].endswith(" ")
        end = _WORD.match(s, i).end() if letter else i
        if i >= max(x, inside) and (letter or ch.isdigit() or ch in "(|!") and (i == 0 or not s[i - 1].isalnum() or lost) and not (letter and settled(s, i, end, lex)):
            for j, word, cost, e in words_at(s, i, lex, skips):
                if e == NONE:
                    continue  # the arc below
                text = s[i:j]
                if e[5]:
                    text = "".join(s[a:b] for a, b in beside(i, j, skips))
                if not (e[1] or e[2]):
                    text = "".join(filter(str.isalpha, text))
                elif len(text) == len(word):
                    text = "".join(o if o.lower() == w else w.upper() if o.isupper() or text.isupper() else w for o, w in zip(text, word))
                else:
                    text = word.upper() if text.isupper() and len(text) > 1 else word.capitalize() if text[0].isupper() else word
                reach(i, j, here + cost, text + " " * (j < n and s[j].isalpha() and s[j - 1].isalnum()), e)
        if letter:
            j = end
            reach(i, j, here + lex.stands(s[i:j]), s[i:j], NONE)
            if i >= max(x, inside) and j < n and s[j] in HYPHENS and (m := _HYPHEN_END.match(s, j)):
                after, _, lines = skips.get(m.end(), (m.end(), 0.0, 0))
                # A word that is nowhere else is one if neither half is a word.
                if (w := _WORD.match(s, after)) and w[0].islower() and (s[j] != "-" or j - i > 1 and not lex.count(s[i:j].lower()) and not lex.count(w[0])):
                    whole = s[i:j] + w[0]
                    reach(i, w.end(), here + lex.stands(whole) + HYPHEN_COST, whole, (1, 0, 0, 0, 0, lines))
    parts, found, at = [], Reading("", Edits()), n
    end, own = n, NONE  # of words that were run together
    while at > 0:
        before, text, e = back[at]
        parts.append(text)
        own = tuple(map(sum, zip(own, e))) if e != NONE else own
        if before == 0 or not (s[before - 1].isalnum() and s[before].isalpha()):
            if own != NONE:
                found.edits.add(own)
                gain = plain_cost(s, before, end, lex, skips, kept) - (costs[end] - costs[before])
                if own[0] or own[1] or own[2] or own[4] or own[5]:
                    found.gain += gain
                else:
                    found.spaces[s[before:end]] = gain
            end, own = before, NONE
        at = before
    found.text = "".join(reversed(parts))
    return found


def settled(s: str, i: int, j: int, lex: Lexicon) -> bool:
    """Whether a word is usual, whole, and followed by no speck, no hyphen and no rare word, so that it can only be what it is."""
    if not lex.common(s[i:j].lower()):
        return False
    if j == len(s):
        return True
    if s[j].isalnum() or s[j] in HYPHENS or s[j] in "|~^*(!'`" or _LONE.match(s, j):
        return False
    after = _WORD_AFTER.match(s, j)
    return after is None or lex.common(after[1].lower())


def lone_specks(s: str) -> dict[int, float]:
    """Where specks stand alone between two words of a line of prose that has no other such sign: what keeping each costs."""
    out: dict[int, float] = {}
    end, alone = -1, frozenset()
    for m in _SPECK_BETWEEN.finditer(s):
        if m.start() > end:
            end = e if (e := s.find("\n", m.end())) >= 0 else len(s)
            line = s[s.rfind("\n", 0, m.start()) + 1 : end]
            alone = frozenset(ch for ch in "|'~.^`¸" if line.count(" ") > 4 and line.count(f" {ch} ") == 1)
        sign = m[0].strip()
        if sign in alone and (s[m.end()].islower() or s[m.start() - 1].islower() and sign in ".~^`"):
            out[m.start()] = KEPT_SPECK
    return out


def furniture(lines: list[str], title: str | None) -> list[tuple[int, int, float]]:
    """(first line, last line, what keeping them costs) of the running heads, feet and page numbers.

    Candidates are lone numbers and lines with a number beside a heading. One counts if a heading like the
    title, or one repeated with other numbers, stands with it, if a form feed ends it, or if it interrupts a sentence or stands between two lines of prose
    and is marked as a page number or follows the count of another one.
    """
    found: dict[int, tuple[int, str, str, list[int]]] = {}  # line -> number, format, heading, its lines
    plain = lambda x: re.sub(r"[\W_]+", "", x).casefold()
    name = plain(title or "")
    heads = Counter()
    for i, raw in enumerate(lines):
        line = raw.strip(" \t\r\f")
        if not line or not (line[-1].isdigit() or line[0].isdigit() or line[-1] in "]-–—"):
            continue
        m = _NUMBER.fullmatch(line)
        if m:
            k = m.lastindex or 0
            head, own = "", [i]
            for j in (i + 1, i - 1):
                if 0 <= j < len(lines):
                    other = lines[j].strip(" \t\r\f")
                    if 3 < len(other) and not _ENDS.search(other) and len(plain(other)) > 3 and (like(plain(other), name) or "\f" in lines[j] or j > i):
                        head, own = plain(other), sorted((i, j))
                        break
            found[i] = (int(m[k]), f"n{k}", head, own)
        elif m := _HEAD_NUMBER.fullmatch(line):
            head = plain(m[1] or m[4])
            if len(head) > 3:
                found[i] = (int(m[2] or m[3]), "h1" if m[1] else "h2", head, [i])
        if i in found and found[i][2]:
            heads[found[i][2]] += 1
    out: list[tuple[int, int, float]] = []
    numbers: dict[str, set[int]] = defaultdict(set)
    for n, kind, _, _ in found.values():
        numbers[kind].add(n)
    for i, (n, kind, head, own) in found.items():
        series = n + 1 in numbers[kind] or n - 1 in numbers[kind]
        titled = bool(head) and bool(name) and like(head, name)
        again = bool(head) and heads[head] > 1 and series
        marked = kind in ("n1", "n3", "n4")
        alone = [i] if len(own) > 1 else own
        if len(own) > 1 and not titled and not again and not any("\f" in lines[j] for j in own if j != i):
            cut = interrupts(lines, i, i)
            if cut or not (marked and interrupts(lines, own[0], own[-1])):
                own = alone  # the line beside it is text
        feed = any("\f" in lines[j] for j in own) or own[0] and lines[own[0] - 1].endswith("\f")
        if own[-1] + 1 < len(lines) and "\f" in lines[own[-1] + 1] and not lines[own[-1] + 1].strip():
            feed, own = True, [*own, own[-1] + 1]  # a line of nothing but the feed
        score = 2 * feed + 2 * titled + 2 * again + interrupts(lines, own[0], own[-1]) + series * (kind != "n5") + marked + (kind == "n2") * 0.5
        if score < 2 and (kind != "n5" or series) and kind[0] == "n" and in_prose(lines, own[0], own[-1]):
            score += 1 + (kind == "n5")
        if score >= 2:
            out.append((min(own), max(own), 2.0 * score - 1.5))
    merged: list[tuple[int, int, float]] = []
    for first, last, cost in sorted(out):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]), max(cost, merged[-1][2]))
        else:
            merged.append((first, last, cost))
    return merged


def like(a: str, b: str) -> bool:
    """Whether two headings are the same but for a few misread characters."""
    if not a or not b:
        return False
    if a == b or len(b) > 6 and (a in b or b in a) and min(len(a), len(b)) > 0.6 * max(len(a), len(b)):
        return True
    if abs(len(a) - len(b)) > 3 or len(b) < 6:
        return False
    pairs = lambda x: Counter(x[k : k + 2] for k in range(len(x) - 1))
    x, y = pairs(a), pairs(b)
    return 2 * sum((x & y).values()) >= 0.7 * (len(a) + len(b) - 2)


def in_prose(lines: list[str], first: int, last: int) -> bool:
    """Whether the lines before and after, blank ones aside, have four words or more."""
    for part in (reversed(lines[:first]), lines[last + 1 :]):
        near = next((x for x in part if x.strip()), "")
        if len(near.split()) < 4:
            return False
    return True


def interrupts(lines: list[str], first: int, last: int) -> int:
    """Whether a sentence runs on from the line before to the line after: 2 if both are long, 1 if the one before is."""
    if first == 0 or last + 1 >= len(lines):
        return 0
    before, after = lines[first - 1].strip(), lines[last + 1].strip()
    if len(before) <= 24 or not after or _ENDS.search(before) or _VERBATIM.match(lines[first - 1]) or not after[0].isalpha():
        return 0
    if not after[0].islower() and before[-1] not in HYPHENS + ",;":
        return 0
    return 2 if len(after) > 24 else 1


def paragraphs(lines: list[str]) -> list[str]:
    """Join lines into paragraphs; the boundaries are those of least total cost.

    Each line is verbatim (code, lists, tables), begins a paragraph or goes on with one; the costs come from blank
    lines, sentence ends, capitals and the lines' lengths against the usual one.
    """
    rows = [(x.rstrip(), k > 0 and not lines[k - 1].strip()) for k, x in enumerate(lines) if x.strip()]
    if not rows:
        return []
    width = sorted(len(x) for x, _ in rows)[int(0.8 * (len(rows) - 1))]
    verbatim, begin, go_on = 0, 1, 2
    cost = [[0.0] * 3 for _ in rows]
    back = [[0] * 3 for _ in rows]
    ends = [bool(_ENDS.search(x)) for x, _ in rows]
    for k, (x, blank) in enumerate(rows):
        looks, begins = bool(_VERBATIM.match(x)), x.lstrip()[:1]
        short = len(x) < 0.5 * width
        own = [0.0 if looks else 2.5 - short, 3.0 * looks + 0.3, 3.0 * looks]
        for state in (verbatim, begin, go_on):
            choices = []
            for was in (verbatim, begin, go_on):
                if k == 0:
                    choices.append(own[state] + (99.0 if state == go_on else 0.0))
                    continue
                before, ended = len(rows[k - 1][0]), ends[k - 1]
                join = (6.0 * blank + 1.6 * ended * (0.5 + (before < 0.75 * width)) + 1.2 * (before < 0.6 * width) + 0.8 * begins.isupper() * ended + 99.0 * (was == verbatim)) if state == go_on else 0.0
                part = 2.2 * (not blank) * (begins.islower() + (not ended)) if state == begin and was != verbatim else 0.0
                choices.append(cost[k - 1][was] + own[state] + join + part)
            back[k][state] = min(range(3), key=choices.__getitem__)
            cost[k][state] = min(choices)
    states = [min(range(3), key=cost[-1].__getitem__)]
    for k in range(len(rows) - 1, 0, -1):
        states.append(back[k][states[-1]])
    states.reverse()
    out: list[list[str]] = []
    for (x, blank), state in zip(rows, states):
        if state == go_on:
            out[-1].append(x.strip())
        elif state == verbatim and out and not blank and out[-1][0] == "":
            out[-1].append(x)
        else:
            out.append(["", x] if state == verbatim else [x.strip()])
    return ["\n".join(p[1:]) if p[0] == "" else " ".join(p) for p in out]


@dataclass
class Found:
    edits: Edits
    repaired: list[str] | None = None
    gain: float = 0.0  # what the edits gained together, but for those of spaces alone
    spaces: dict[str, float] = field(default_factory=dict)

    @property
    def noisy(self) -> bool:
        return self.gain > SURE or sum(self.spaces.values()) > SURE_SPACES


def examine(text: str, title: str | None, lex: Lexicon, repair: bool = True) -> Found:
    """What scanning left in one text, and the text without it."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    skips: Skips = {}
    if _CANDIDATE.search(text):
        lines = text.split("\n")
        if blocks := furniture(lines, title):
            starts = [0, *accumulate(len(x) + 1 for x in lines)]
            skips = {starts[a]: (min(len(text), starts[b + 1]), cost, b - a + 1) for a, b, cost in blocks}
    spans = [(max(0, a - 1), end) for a, (end, _, _) in skips.items()]
    spans += [m.span() for m in _LINE_END_HYPHEN.finditer(text)]
    if (fresh := tokens_in(text) - lex.fine) and (odd := {t for t in fresh if lex.suspicious(t)} | parted(text, fresh - lex.fine, lex)):
        spans += [m.span() for m in _TOKEN.finditer(text) if m[0] in odd]
    if any(x in text for x in _SPECK_SIGNS):
        spans += [m.span() for m in _SPECK.finditer(text)]
    found = Found(Edits())
    if spans:
        spans.sort()
        out, at = [], 0
        for a, b, look in regions(text, spans, skips):
            read = decode(text[a:b], lex, {k - a: (end - a, cost, n) for k, (end, cost, n) in skips.items() if a <= k < b}, look)
            if read.edits:
                found.edits.add(tuple(vars(read.edits).values()))
                found.gain += read.gain
                found.spaces |= read.spaces
                out += (text[at:a], read.text)
                at = b
        if repair and found.noisy:
            found.repaired = paragraphs(("".join(out) + text[at:]).replace("\f", "").split("\n"))
    return found


def parted(text: str, rare: set[str], lex: Lexicon) -> set[str]:
    """Of some rare tokens those that make a word with the token before or after them."""
    out = set()
    for t in rare:
        low = t.strip(".'\"()*").lower()
        if not low.isalpha() or lex.common(low):
            continue
        at = text.find(low)
        while at >= 0:
            end = at + len(low)
            if (at == 0 or not text[at - 1].isalpha()) and (end == len(text) or not text[end].isalpha()):
                before, after = _WORD_BEFORE.search(text, max(0, at - 40), at), _WORD_AFTER.match(text, end)
                if before and lex.count(before[1].lower() + low) or after and lex.begins(low) and lex.count(low + after[1].lower()):
                    out.add(t)
                    break
            at = text.find(low, end)
    return out


def regions(s: str, spans: list[tuple[int, int]], skips: Skips) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, spans within it in which words may be others) of the paragraphs that hold any of the spans.

    The paragraphs before and after page furniture are one stream.
    """
    look = [(x, y) for _, x, y in stretches(s, spans)]
    bounds = [m.span() for m in _BLANK.finditer(s) if not any(x <= m.end() and m.start() <= skips[x][0] for x in skips)]
    k, at = 0, 0
    for a, b in [*bounds, (len(s), len(s))]:
        own = []
        while k < len(look) and look[k][0] < a:
            own.append((max(0, look[k][0] - at), min(a, look[k][1]) - at))
            k += 1
        if own:
            yield at, a, own
        at = b


def stretches(s: str, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start of the first span, start, end) of the widened spans; those that touch are one."""
    k = 0
    while k < len(spans):
        a, b = spans[k]
        x, y = widened(s, a, b)
        while k + 1 < len(spans) and spans[k + 1][0] < y:
            k += 1
            b = max(b, spans[k][1])
            y = widened(s, a, b)[1]
        k += 1
        yield a, x, max(y, b)


def widened(s: str, a: int, b: int) -> tuple[int, int]:
    """A span with the word before and the word after it, on the same lines."""
    x = a
    while x > 0 and s[x - 1] not in " \n":
        x -= 1
    if x > 0 and s[x - 1] == " " and a - x < 30:
        x -= 1
        while x > 0 and s[x - 1] not in " \n":
            x -= 1
    y = b
    while y < len(s) and s[y] not in " \n":
        y += 1
    if y < len(s) and s[y] == " ":
        y += 1
        while y < len(s) and s[y] not in " \n" and y - b < 40:
            y += 1
    return x, y


def lexicon_of(df: DataFrame, text_col: str) -> tuple[pa.Table, int]:
    """The lexicon of a corpus: (word, pages) over all texts, of which the rarest are left out by a share of the texts, and the number of texts."""
    pages = df.where(F.col(text_col).isNotNull()).count()
    rows = count_words(df, text_col).where(F.col("pages") >= max(2, math.ceil(SHARE * pages)))
    return rows.toArrow(), pages  # bounded by SHARE: see lexicon_bound


def lexicon_bound(words_a_page: float) -> float:
    """MB that the lexicon takes in a worker at most, for pages with so many different words in the mean, however many pages there are."""
    return words_a_page / SHARE * WORD_BYTES / 1e6


def scan_noise(df: DataFrame, id_col: str, text_col: str, title_col: str | None = None, repair: bool = True) -> DataFrame:
    """(id, n_breaks, n_misread, n_specks, n_furniture, repaired): a row for each text with noise from scanning.

    ``repaired`` is the text in continuous paragraphs with an empty line between them (null if ``repair`` is off). Null and empty texts and
    those without noise give no row; repeated rows are judged each by itself; an empty table gives no rows.
    """
    spark = df.sparkSession
    ship_package(spark)
    words, pages = lexicon_of(df, text_col)
    held = spark.sparkContext.broadcast((words, pages))  # bounded by SHARE
    kind = df.schema[id_col].dataType
    numbers = ("n_breaks", "n_misread", "n_specks", "n_furniture")
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.IntegerType()) for c in numbers), T.StructField("repaired", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pages = held.value
        words = words.sort_by("word")
        own = Lexicon((words["word"].to_pylist(), words["pages"].to_pylist()), pages)
        for batch in batches:
            at, rows = [], []
            titles = batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text and (f := examine(text, titles[i], own, repair)).noisy:
                    at.append(i)
                    rows.append((f.edits.hyphens, f.edits.misread + f.edits.codes, f.edits.specks, f.edits.furniture, None if f.repaired is None else "\n\n".join(f.repaired)))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int32()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], schema.names)

    title = F.col(title_col) if title_col else F.lit(None).cast("string")
    return df.select(id_col, F.col(text_col).alias("text"), title.alias("title")).mapInArrow(run, schema)
