"""Finding and undoing text that was read in a wrong character encoding.

A chain says which encoding the bytes had, in which they were read, and how often that happened. A
multinomial naive Bayes classifier over hashed byte bigrams (of each token's UTF-8 bytes) is trained on all tokens of
the corpus, as they stand for the class "right" and garbled on purpose by each chain for the
other classes. A token is garbled if a chain beats "right" clearly and inverts the token strictly: every
character must be one the wrong encoding can give, and the bytes must decode without an error in the true
one. Since the classifier knows only the languages of the corpus, the text before must also be the better formed one:
no right word mixes alphabets, turns to capitals in its middle or holds signs of drawings, in whatever language.
Tokens with U+FFFD have lost their bytes and are garbled without a chain.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.llm.lookalike import PROTOTYPE
from leafmill.session import drop_table, materialise, ship_package

#: Counts over more rows are divided as if of so many: the smoothing, the weight of SEED and the margins are meant for that, however large the corpus.
SCALED_ROWS = 8_000
#: Different tokens that a task counts before it passes them on.
HELD_TOKENS = 200_000
BUCKETS = 1 << 15
PAIR_BUCKETS = 1 << 18
#: Characters of a window: longer tokens are learnt in pieces of it and classified in windows that overlap by half.
LOOK = 60
#: By how much a chain's log-likelihood must beat that of "right" for a token; and for a chain that loses bytes.
MARGIN = 4.0
MARGIN_LOST = 12.0
#: By how much the text before must be likelier than the token, both as letter pairs of right text without case.
LIKELIER = 3.0
#: And by how much where any bytes are fit for the true encoding and the word before is not one of the corpus.
LIKELIER_UNKNOWN = 14.0
#: And where it is as well formed a word as the text before, in another alphabet.
LIKELIER_FORMED = 20.0
#: And where only a part of a token is given back.
LIKELIER_PART = 8.0
#: Whole UTF-8 sequences in a token that are proof, even if it is well formed as it stands.
PROOF_SEQUENCES = 3
#: Different words, none of them garbled for certain, that together show a field to be garbled by one chain.
WEAK_WORDS = 3
#: How many times as often the sign before must stand alone in all rows as the sign it is taken to have become.
LONE_RATIO = 100

# Wrong reader <- true encodings of the chains.
CHAINS = {
    "cp1252": "utf-8 cp1251 koi8-r cp866 cp1250 iso8859-2 cp852 mac_roman cp437 cp850 cp932 euc_jp",
    "latin-1": "utf-8 cp1251 koi8-r cp866 cp1250 iso8859-2 cp932 euc_jp",
    "cp437": "utf-8 cp1252 cp1250 cp1251 koi8-r cp866 mac_roman",
    "cp850": "utf-8 cp1252 cp1250 cp1251",
    "cp852": "utf-8 cp1250 cp1252 iso8859-2",
    "mac_roman": "utf-8 cp1252 cp1250 cp1251 koi8-r cp932 euc_jp",
    "cp1250": "utf-8 cp1252 iso8859-2 cp852 cp1251",
    "iso8859-2": "utf-8 cp1252 cp1250",
    "cp1251": "utf-8 cp1252 koi8-r cp866 cp1250",
    "koi8-r": "utf-8 cp1252 cp1251 cp866",
    "cp866": "utf-8 cp1252 cp1251 koi8-r",
}
#: Readers that make letters of the bytes that begin a UTF-8 sequence.
LETTERS_FIRST = ("cp1251", "koi8-r", "cp866")
TWICE = (("cp1252", "utf-8"), ("latin-1", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"))
# A few words of the commoner languages, so that a corpus too small to learn from has some; they count once.
SEED = """für über können größer Änderung Übersicht Straße müssen während gemäß schließt nächsten Gerät ändern Höhe Zähler
été après très déjà où même élève garçon français là être côté fenêtre caractère clé mémoire réseau à ça l’écran d’accès
señal año también más según código página está español información número opción después así él tamaño menú
że się nie być może są właśnie źródło książka pamięć ścieżka został każdy żądanie długość główne łącze wątek
для что это как при после перед система файл память указатель значение ключ данных объект очередь поток ошибка сообщение
これは の に を は が です ます ファイル 画面 最後 登録 必要 同期 文字 自動的 キー 一覧 メッセージ
não são ação você também informação já até è perché più così può città
příliš žluťoučký kůň že být není může který různé č ř ž ů
– — ’ “ ” „ … € £ © ® ™ ° ± µ × « » · • → “quoted” „zitiert“ «cité» it’s don’t Café® naïve façade 100 °C ½ ¼ § ¶"""

_RUN = re.compile("[^ \t\r\n\f\v]+")
_ENTITY = re.compile(r"&(?:[A-Za-z]{2,8}[0-9]{0,2}|#[0-9]{2,5}|#x[0-9A-Fa-f]{2,5});")
_BAD = re.compile("[\x00-\x08\x0e-\x1f\x80-\x9f\ufffd\uffff]")


def _tables(codec: str) -> tuple[dict[int, str], dict[int, str]]:
    """Byte -> character for str.translate, undefined bytes as C1 controls, and its inverse."""
    table = []
    for b in range(256):
        try:
            table.append(bytes((b,)).decode(codec))
        except UnicodeDecodeError:
            table.append(chr(b))
    # Readers of the Windows encodings often leave bytes 80 to 9F as they are, defined or not.
    back = {c: chr(c) if c < 0xA0 and codec.startswith("cp125") else "\uffff" for c in range(0x80, 0x100)}
    back |= {ord(ch): chr(b) for b, ch in enumerate(table) if b >= 0x80}
    return dict(enumerate(table)), back


SINGLE = {c: _tables(c) for c in CHAINS}


def read_wrongly(data: bytes, codec: str) -> str:
    return data.decode("latin-1").translate(SINGLE[codec][0])


def bytes_of(text: str, codec: str) -> bytes | None:
    """The bytes a wrong reader saw, or nothing if it cannot have given this text."""
    try:
        return text.translate(SINGLE[codec][1]).encode("latin-1")
    except UnicodeEncodeError:
        return None


@dataclass(frozen=True)
class Chain:
    name: str
    steps: tuple[tuple[str, str], ...]  # (wrong reader, true encoding), the first one done first

    @property
    def strict(self) -> bool:
        return self.steps[-1][1] == "utf-8"

    def garble(self, text: str) -> str | None:
        for wrong, true in self.steps:
            try:
                text = read_wrongly(text.encode(true), wrong)
            except UnicodeEncodeError:
                return None
        return text

    def invert(self, text: str) -> str | None:
        """The text before; nothing unless every step is strictly possible and the result is fit for a text."""
        for wrong, true in reversed(self.steps):
            data = bytes_of(text, wrong)
            if data is None:
                return None
            try:
                text = data.decode(true)
            except UnicodeDecodeError:
                return None
        return None if _BAD.search(text) else text


def chains() -> list[Chain]:
    out = [Chain(f"{true}>{wrong}", ((wrong, true),)) for wrong, trues in CHAINS.items() for true in trues.split()]
    out += [Chain(f"{true}>{wrong} twice", ((wrong, true),) * 2) for wrong, true in TWICE]
    return out + [Chain(f"{true}>{wrong} thrice", ((wrong, true),) * 3) for wrong, true in TWICE[:2]]


ALL = chains()
#: Chains by which a part of a token can be told alone.
PARTLY = [c for c, x in enumerate(ALL) if x.strict]


def features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte bigrams of all tokens one after the other, and where each token's begin."""
    data = [b"\x02" + t.encode("utf-8", "surrogatepass") + b"\x03" for t in tokens]
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(d) for d in data])
    pair = (flat[:-1] << np.uint32(8) | flat[1:]) if len(flat) > 1 else flat[:0]
    keep = np.ones(len(pair), bool)
    keep[ends[:-1] - 1] = False
    hashed = (pair * np.uint32(2_654_435_761)) >> np.uint32(32 - 15)
    lengths = np.array([len(d) - 1 for d in data])
    return hashed[keep].astype(np.int64), np.cumsum(lengths) - lengths


def joined(texts: list[str]) -> np.ndarray:
    """The characters of all texts, each between two that stand for its ends."""
    return np.frombuffer("".join([f"\x02{t}\x03" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def letter_pairs(*tokens: str) -> np.ndarray:
    """Hashed pairs of characters without case; the ends count as characters. Between tokens there is one more."""
    flat = joined([t.lower() for t in tokens])
    return (((flat[:-1] * np.uint64(1_000_003) + flat[1:]) * np.uint64(2_654_435_761) & np.uint64(0xFFFFFFFF)) >> np.uint64(14)).astype(np.int64)


#: Signs that stand within words and beside letters in right text.
_JOINING = frozenset("\xad’‘ʼ·•–—‐‑…“”„«»‹›¡¿ªº°©®™§¶\xa0\u3000、。・「」（）：；！？，％～")
_DRAWN = re.compile(r"[\u2500-\u259f]+[^\W\d_]")
_KIND: dict[str, tuple[str, str]] = {}


def kind_of(ch: str) -> tuple[str, str]:
    """(class, alphabet) of a character: U(pper), l(ower) or o(ther) letter, m(ark), d(igit), n(umber or letter above the line), b(ox), j(oining), s(ign), or x for controls."""
    found = _KIND.get(ch)
    if found is None:
        c = unicodedata.category(ch)
        if c == "Lm" and unicodedata.decomposition(ch).startswith("<super>"):
            found = ("n", "")
        elif c[0] == "L":
            name = unicodedata.name(ch, "?").replace("-", " ").partition(" ")[0]
            name = {"MICRO": "GREEK", "HIRAGANA": "CJK", "KATAKANA": "CJK", "HANGUL": "CJK", "IDEOGRAPHIC": "CJK", "HALFWIDTH": "CJK", "FULLWIDTH": "CJK", "FEMININE": "LATIN", "MASCULINE": "LATIN"}.get(name, name)
            found = ("U" if ch.isupper() else "l" if ch.islower() else "o", name)
        elif c[0] == "M":
            found = ("m", "")
        elif c[0] == "N":
            found = ("d" if c == "Nd" else "n", "")
        elif "\u2500" <= ch <= "\u259f":
            found = ("b", "")
        else:
            found = ("j" if ch < "\x7f" or ch in _JOINING else "x" if c[0] == "C" else "s", "")
        if len(_KIND) < 200_000:
            _KIND[ch] = found
    return found


@lru_cache(100_000)
def looks_plain(token: str) -> bool:
    """Whether all that isn't ASCII in a token are blanks, soft hyphens and letters that look like ASCII ones: then it was written so, if it needn't be garbled."""
    return all(ch < "\x80" or unicodedata.category(ch) == "Zs" or ch == "\xad" or PROTOTYPE.get(ch, "é").isascii() for ch in token)


@lru_cache(100_000)
def oddness(token: str) -> int:
    """How many things in a token no right word has, in whatever language.

    Neighbouring letters of two alphabets, capitals after small letters and small ones after several capitals (unless both are ASCII),
    signs between or beside letters, frames of boxes beside letters or signs, controls.
    """
    n = 0
    a, alphabet, before = "j", "", " "
    start = 0  # of the run of letters
    for i, ch in enumerate(token):
        k, own = kind_of(ch)
        if k in "Ulo":
            wide = ch > "\x7f" or before > "\x7f"
            if a in "Ulo":
                if own != alphabet:
                    # Japanese has Latin words, and measures and formulas begin with one Greek letter.
                    n += not ("CJK" in (own, alphabet) and (ch if own != "CJK" else before) < "\x7f" or alphabet == "GREEK" and i == start + 1 and len(token) < i + 4)
                elif wide and (a == "l" and k == "U" or a == "U" and k == "l" and i > start + 1):
                    n += 1
            else:
                start = i
                n += a == "s" and before > "\x7f" and (ch > "\x7f" or i > 1) or a == "b" and ch > "\x7f"
            alphabet = own
        elif k == "x":
            n += 1
        elif k == "b":
            n += a == "s" or a in "Ulo" and (before > "\x7f" or bool(_DRAWN.match(token, i)))
        elif k == "n":
            n += a in "Ulo" and token[i + 1 : i + 2].isalpha()
        elif k == "s":
            n += a == "b" or a in "Ulo" and before > "\x7f" or a in "Ulo" and token[i + 1 : i + 2].isalpha()
        if k != "m":
            a, before = k, ch
    return n


def windows(token: str) -> list[str]:
    """A token in windows of LOOK characters that overlap by half, so that no character is outside all of them."""
    return [token] if len(token) <= LOOK else [token[k : k + LOOK] for k in range(0, len(token) - LOOK // 2, LOOK // 2)]


def pieces_of(token: str) -> list[str]:
    return [token[k : k + LOOK] for k in range(0, len(token), LOOK)]


def other_alphabet(token: str, before: str) -> bool:
    """Whether two readings are in different alphabets, or both in Cyrillic, of which several encodings hold the letters in another order."""
    own = [{k[1] for ch in t if (k := kind_of(ch))[1] and ch > "\x7f"} for t in (token, before)]
    return len(own[1]) == 1 and (own[0] != own[1] or own[1] == {"CYRILLIC"})


def bare(token: str) -> str:
    """A token without the punctuation around it, in lower case."""
    return token.lower().strip(".,;:!?()[]{}\"'“”„«»’‘…–—·/&-")


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


class Words:
    """A set of words by their sorted 64-bit hashes: 8 bytes a word, and a wrong answer with a chance of 1e-12 where there are ten million."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes

    def __contains__(self, word: str) -> bool:
        h = np.uint64(word_hash(word))
        k = self.hashes.searchsorted(h)
        return k < len(self.hashes) and self.hashes[k] == h


@dataclass
class Model:
    """Log-probabilities of the buckets for "right" (column 0) and for each chain; and of letter pairs in right text."""

    table: np.ndarray
    letters: np.ndarray
    words: frozenset[str] | Words
    lone: dict[str, int]
    memo: dict[str, tuple[int, float, str | None]] = field(default_factory=dict)
    known: dict[tuple[str, int], str | None] = field(default_factory=dict)
    last: tuple[str, float] = ("", 0.0)

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Log-likelihood of each class over that of "right", in the window where it is most."""
        cut = [windows(t) for t in tokens]
        flat = [w for own in cut for w in own]
        parts = []
        for k in range(0, len(flat), 2000):
            at, starts = features(flat[k : k + 2000])
            rows = self.table[at]
            own = np.stack([rows[i:j].sum(axis=0) for i, j in zip(starts, [*starts[1:], len(rows)])])  # several times as fast as reduceat
            parts.append(own - own[:, :1])
        lengths = np.array([len(own) for own in cut])
        return np.maximum.reduceat(np.concatenate(parts), np.cumsum(lengths) - lengths, axis=0)

    def likelihood(self, token: str) -> float:
        return float(self.letters[letter_pairs(token)].sum())

    def gain(self, before: str, token: str) -> float:
        """By how much the text before is likelier than the token, which is mostly the one asked for last."""
        if self.last[0] != token:
            self.last = (token, self.likelihood(token))
        return self.likelihood(before) - self.last[1]

    def likelier(self, before: str, token: str, chain: Chain, parts: bool = False) -> float | None:
        """By how much the text before is the better one, or nothing if that isn't plain; strict UTF-8 counts as evidence.

        It must not be odder than the token (see :func:`oddness`). A token that is well formed as it stands may be right in a language
        that the corpus lacks: then the text before has to be a word of the corpus, or much likelier and of another alphabet.
        """
        gain = self.gain(before, token)
        if gain <= 0:
            return None
        was, now = oddness(token), oddness(before)
        if now > was:
            return None
        word = bare(before)
        known = gain > LIKELIER and word in self.words or before in self.lone
        if chain.strict:
            if parts and looks_plain(token) and not known:
                return None
            proof = now < was or known or gain > LIKELIER_UNKNOWN or not parts and sum(ch > "\x7f" for ch in before) >= PROOF_SEQUENCES
            return gain if proof else None
        if known and (len(word) > 3 or now < was and not looks_plain(token)):
            return gain
        if not any(ch.isalpha() for ch in token) or gain <= LIKELIER_UNKNOWN or looks_plain(token):
            return None
        if now < was or gain > LIKELIER_FORMED and len(word) > 3 and other_alphabet(token, before):
            return gain
        return None

    def judge(self, tokens: list[str]) -> None:
        """Fill the memo with (chain or -1, margin, the text before) for tokens not yet known."""
        new = [t for t in dict.fromkeys(tokens) if t not in self.memo]
        if len(self.memo) + len(new) > 300_000:
            self.memo.clear()
            self.known.clear()
            new = list(dict.fromkeys(tokens))
        for k in range(0, len(new), 2000):
            part = new[k : k + 2000]
            for t, row in zip(part, self.scores(part)):
                self.memo[t] = self._best(t, row)

    def _best(self, token: str, row: np.ndarray) -> tuple[int, float, str | None]:
        if "\ufffd" in token:
            return -2, 99.0, None
        if len(token) == 1:
            return self._lone(token)
        likely = np.flatnonzero(row[1:] >= MARGIN)
        fit, weak = [], None
        for c in map(int, likely):
            before = ALL[c].invert(token)
            if before is not None and before != token:
                gain = self.likelier(before, token, ALL[c])
                if gain is not None:
                    fit.append(self.rank(c, row, gain, before))
                elif weak is None or row[c + 1] > row[weak + 1]:
                    weak = c if self.weak(before, token) else weak
        # A reading that is still odd and not of UTF-8 is held against those of runs, since UTF-8 that has lost a byte inverts by runs only.
        sure = bool(fit) and (max(fit)[0] or max(fit)[1] == 0)
        runs = list(fit)
        for c in map(int, () if sure else likely):
            if fit and not ALL[c].strict:
                continue
            before = in_runs(token, ALL[c])
            gain = before is not None and self.likelier(before, token, ALL[c], True)
            if gain:
                runs.append(self.rank(c, row, gain, before))
        if runs:
            *_, c, before = max(runs)
            return -c, float(row[1 - c]), before
        if len(likely):
            c = int(likely[np.argmax(row[1:][likely])])
            if row[c + 1] >= MARGIN_LOST and _BAD.search(token):
                return -2, float(row[c + 1]), None
        part = self._part(token)
        return part if part[0] != -1 or weak is None else (-3 - weak, 0.0, None)

    def rank(self, c: int, row: np.ndarray, gain: float, before: str) -> tuple:
        """How good a reading is: the classifier's log-likelihood and that of the letters together."""
        return ALL[c].strict, -oddness(before), bare(before) in self.words, float(row[c + 1]) + gain, -c, before

    def weak(self, before: str, token: str) -> bool:
        """Whether a word of another alphabet is likelier than the token, but not for certain."""
        if looks_plain(token) or all(ch < "\x80" or kind_of(ch)[0] == "b" for ch in token):
            return False
        return other_alphabet(token, before) and self.gain(before, token) > LIKELIER and oddness(before) <= oddness(token)

    def _part(self, token: str) -> tuple[int, float, str | None]:
        """A token that is right but for whole UTF-8 sequences in it: the classifier is asked of each run of wrong characters by itself."""
        best, was = (-1, 0.0, None), oddness(token)
        for c in PARTLY:
            before = in_runs(token, ALL[c])
            if before is None or _BAD.search(before) or (now := oddness(before)) > was:
                continue
            gain = self.gain(before, token)
            if gain <= max(best[1], LIKELIER_PART):
                continue
            wrong = ALL[c].steps[-1][0]
            runs = [m[0] for m in MADE[wrong].finditer(token) if in_runs(m[0], ALL[c]) is not None]
            if (now < was and not looks_plain(token) or wrong not in LETTERS_FIRST) and self.scores(runs)[:, c + 1].max() >= MARGIN:
                best = (c, gain, before)
        return best

    def _lone(self, token: str) -> tuple[int, float, str | None]:
        """A letter or piece of a frame that stands alone is garbled only if that is rare against the sign it was, the commonest possible."""
        best = (-1, 0.0, None)
        if kind_of(token)[0] not in "Ulob":
            return best
        most = LONE_RATIO * max(1, self.lone.get(token, 0))
        for c, chain in enumerate(ALL):
            before = chain.invert(token)
            if before and len(before) == 1 and before != token and not before.isalpha() and self.lone.get(before, 0) >= most + (best[2] is not None):
                best, most = (c, MARGIN, before), self.lone[before]
        return best

    def by(self, token: str, chain: int) -> str | None:
        """The token inverted by a chain that its text came through, if that makes it likelier at all."""
        key = (token, chain)
        if key not in self.known:
            before = ALL[chain].invert(token)
            ok = before is not None and before != token and self.gain(before, token) > 0 and oddness(before) <= oddness(token)
            self.known[key] = before if ok else None
        return self.known[key]


#: For each wrong reader the runs of characters that it can have made of bytes from 80 on.
MADE = {c: re.compile("[" + "".join(re.escape(chr(k)) for k, v in back.items() if v != "\uffff") + "]{2,}") for c, (_, back) in SINGLE.items()}


def in_runs(token: str, chain: Chain) -> str | None:
    """The token with those of its runs inverted that can be; nothing if none can.

    A chain of one step over UTF-8 also gives back single whole sequences within a run.
    """
    wrong, true = chain.steps[-1]
    done = False

    def one(m: re.Match) -> str:
        nonlocal done
        before = chain.invert(m[0])
        if before is None and len(chain.steps) == 1 and true == "utf-8":
            before = sequences(m[0], bytes_of(m[0], wrong))
        if before is None or before == m[0]:
            return m[0]
        done = True
        return before

    out = MADE[wrong].sub(one, token)
    return out if done else None


_SEQUENCE = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")


def sequences(run: str, data: bytes) -> str | None:
    """A run with its whole UTF-8 sequences decoded, the other characters as they stand."""
    out, at, done = [], 0, False
    for m in _SEQUENCE.finditer(data):
        try:
            ch = m[0].decode("utf-8")
        except UnicodeDecodeError:
            continue
        if not _BAD.search(ch):
            out += (run[at : m.start()], ch)
            at, done = m.end(), True
    return "".join(out) + run[at:] if done else None


def tokens_of(text: str) -> list[str]:
    """The runs without blanks that aren't ASCII, in a time that grows with the text only."""
    for blank in "\t\r\n\f\v":
        text = text.replace(blank, " ")
    return [t for t in text.split(" ") if not t.isascii()]


_IMAGES: list[dict[str, bytes | None]] = [{} for _ in range(len(ALL) + 1)]


def image(c: int, ch: str) -> bytes | None:
    """The UTF-8 bytes that a class makes of a character, each by itself in all encodings of the chains; nothing if it can't."""
    known = _IMAGES[c]
    if ch not in known:
        made = ch if c == 0 else ALL[c - 1].garble(ch)
        known[ch] = None if made is None else made.encode("utf-8", "surrogatepass")
    return known[ch]


def sums_of(words: list[str], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted counts of the byte bigrams of words by class (rows), and of their letter pairs.

    A class counts the words that its chain can garble and changes. As a chain garbles character by character, pairs of characters are counted once for
    all classes, apart by the classes that count their words, and only the different ones are taken to bytes.
    """
    tables, letters = np.zeros((len(ALL) + 1, BUCKETS)), np.zeros(PAIR_BUCKETS)
    if not words:
        return tables, letters

    def within(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many characters the texts have with their ends, and which pairs are of one text."""
        lengths = np.array([len(t) + 2 for t in texts])
        own = np.ones(lengths.sum() - 1, bool)
        own[np.cumsum(lengths)[:-1] - 1] = False
        return lengths, own

    lengths, own = within([t.lower() for t in words])
    letters += np.bincount(letter_pairs(*words)[own], np.repeat(weight, lengths)[:-1][own], PAIR_BUCKETS)

    flat, (lengths, inside) = joined(words), within(words)
    chars, at = np.unique(flat, return_inverse=True)
    images = [[image(c, chr(x)) for x in chars] for c in range(len(ALL) + 1)]
    unfit = np.packbits([[i is None for i in own] for own in images], axis=0).T
    changed = np.packbits([[c == 0 or i != o for i, o in zip(own, images[0])] for c, own in enumerate(images)], axis=0).T
    starts = np.cumsum(lengths) - lengths
    counted = np.bitwise_or.reduceat(changed[at], starts, axis=0) & ~np.bitwise_or.reduceat(unfit[at], starts, axis=0)
    kinds, kind = np.unique(counted, axis=0, return_inverse=True)
    kinds = np.unpackbits(kinds, axis=1, count=len(ALL) + 1).astype(bool)
    n = len(chars)
    key = (np.repeat(kind.reshape(-1), lengths)[:-1] * n + at[:-1]) * n + at[1:]
    keys, at_key = np.unique(key[inside], return_inverse=True)
    total = np.bincount(at_key, np.repeat(weight, lengths)[:-1][inside])
    of, first, second = keys // (n * n), keys // n % n, keys % n
    for c, own in enumerate(images):
        own = [i or b"?" for i in own]
        chosen = kinds[of, c]
        w = total[chosen]
        ends = np.frombuffer(bytes(i[-1] for i in own), np.uint8).astype(np.uint32)[first[chosen]] << np.uint32(8)
        ends |= np.frombuffer(bytes(i[0] for i in own), np.uint8)[second[chosen]]
        inner = [(k, i[j] << 8 | i[j + 1]) for k, i in enumerate(own) for j in range(len(i) - 1)]
        by_char = np.bincount(second[chosen], w, n)
        k, pairs = np.array(inner, np.int64).reshape(-1, 2).T
        every = np.concatenate([ends, pairs.astype(np.uint32)])
        tables[c] = np.bincount(((every * np.uint32(2_654_435_761)) >> np.uint32(32 - 15)).astype(np.int64), np.concatenate([w, by_char[k]]), BUCKETS)
    return tables, letters


@lru_cache(1)
def seed_words() -> tuple[list[str], tuple[np.ndarray, np.ndarray]]:
    words = sorted({t for t in SEED.split() if not t.isascii()})
    return words, sums_of(words, np.ones(len(words)))


def model_of(tables: np.ndarray, letters: np.ndarray, words: frozenset[str] | Words, lone: dict[str, int]) -> Model:
    """The model of counts without the seed's, scaled."""
    more = seed_words()[1]
    table = np.ascontiguousarray((tables + more[0]).T) + 0.02
    letters = letters + more[1] + 0.01
    # Classes that few tokens can come to must not win by their smoothing: none has less than a part of the total of "right".
    total = table.sum(axis=0)
    return Model((np.log(table) - np.log(np.maximum(total, total[0] * 0.25))).astype(np.float32), np.log(letters / letters.sum()).astype(np.float32), words, lone)


def garbled_of(words: list[str], model: Model) -> list[bool]:
    """Which tokens an earlier round takes for garbled: they are left out of the next."""
    model.judge(words)
    return [model.memo[t][0] != -1 and model.memo[t][0] >= -2 for t in words]


def train(counts: Counter, rounds: int = 2, lone: dict[str, int] | None = None) -> Model:
    """Fit the classifier on tokens and how often they occur; ``lone`` has the characters alone.

    The tokens are not labelled: those that a first round takes for garbled, and their like, are left out of the second.
    """
    clean = Counter()
    for t, n in counts.items():
        for piece in pieces_of(t):
            clean[piece] += n
    if lone is None:
        lone = {t: n for t, n in counts.items() if len(t) == 1}
    words, weight = list(clean), np.array(list(clean.values()), float)
    tables, letters = sums_of(words, weight)
    out, model = [False] * len(words), None
    for _ in range(rounds):
        less = (0.0, 0.0)
        if model is not None:
            out = garbled_of(words, model)
            less = sums_of([t for t, o in zip(words, out) if o], weight[out])
        vocabulary = frozenset(w for t in [*(t for t, o in zip(words, out) if not o), *seed_words()[0]] if len(w := bare(t)) > 1)
        model = model_of(tables - less[0], letters - less[1], vocabulary, lone)
    return model


def token_counts(df: DataFrame, fields: list[str], parts: int | None = None) -> DataFrame:
    """(token, n): how often each non-ASCII token occurs in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], ["token", "n"])
        for batch in batches:
            for col in batch.columns:
                for text in col.to_pylist():
                    if text and not text.isascii():
                        own.update(tokens_of(text))
            if len(own) > HELD_TOKENS:
                yield out()
                own.clear()
        yield out()

    counted = df.select(*fields).mapInArrow(run, "token string, n long")
    return (counted.repartition(parts, "token") if parts else counted).groupBy("token").agg(F.sum("n").alias("n"))


def lone_of(counts: DataFrame) -> dict[str, int]:
    """How often each non-ASCII character stands alone; there are at most as many as characters."""
    return {r["token"]: r["n"] for r in counts.where(F.char_length("token") == 1).collect()}


def lone_counts(df: DataFrame, fields: list[str]) -> dict[str, int]:
    return lone_of(token_counts(df, fields))


def learnt(counts: DataFrame, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and words (as sorted hashes) of all counted tokens; with a model, the sums of those that it takes for garbled and the words of the others.

    Each task adds up its tokens; parts of these sums (a class, the letter pairs, a 64th of the hashes) are added up side by side. The driver gets the totals.
    """
    spark = counts.sparkSession
    held = None if model is None else spark.sparkContext.broadcast((model.table, model.letters, model.words, model.lone))
    schema, n_classes = "part int, at binary, n binary", len(ALL) + 1
    none = np.empty(0, np.uint64)

    def row(part: int, at: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at.tobytes()], pa.binary()), pa.array([b"" if n is None else n.tobytes()], pa.binary())], ["part", "at", "n"])

    def sparse(part: int, sums: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(sums)
        return row(part, at.astype(np.int32), sums[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if held is None else Model(*held.value)
        tables, letters, words = np.zeros((n_classes, BUCKETS)), np.zeros(PAIR_BUCKETS), [none]
        for batch in batches:
            clean: Counter = Counter()
            for t, n in zip(*(c.to_pylist() for c in batch.columns)):
                for piece in pieces_of(t):
                    if not piece.isascii():
                        clean[piece] += n
            pieces, weight = list(clean), np.array(list(clean.values()), float)
            out = np.zeros(len(pieces), bool) if own is None else np.array(garbled_of(pieces, own), bool)
            right = {word_hash(w) for t, o in zip(pieces, out) if not o and len(w := bare(t)) > 1}
            words.append(np.fromiter(right, np.uint64, len(right)))
            summed = ~out if own is None else out
            more = sums_of([t for t, s in zip(pieces, summed) if s], weight[summed])
            tables += more[0]
            letters += more[1]
        for c in range(n_classes):
            yield sparse(c, tables[c])
        yield sparse(n_classes, letters)
        for k, part in enumerate(slices(np.unique(np.concatenate(words)))):
            if len(part):
                yield row(n_classes + 1 + k, part)

    def slices(hashes: np.ndarray) -> list[np.ndarray]:
        return np.split(hashes, hashes.searchsorted(np.arange(1, 64, dtype=np.uint64) << np.uint64(58)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        hashes: dict[int, list[np.ndarray]] = defaultdict(list)
        for batch in batches:
            for part, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                if part > n_classes:
                    hashes[part].append(np.frombuffer(at, np.uint64))
                else:
                    sums.setdefault(part, np.zeros(BUCKETS if part < n_classes else PAIR_BUCKETS))[np.frombuffer(at, np.int32)] += np.frombuffer(n)
        for part, total in sums.items():
            yield sparse(part, total)
        for part, some in hashes.items():
            yield row(part, np.unique(np.concatenate(some)))

    tables, letters, hashes = np.zeros((n_classes, BUCKETS)), np.zeros(PAIR_BUCKETS), {}
    for part, at, n in counts.select("token", "n").mapInArrow(run, schema).repartition("part").mapInArrow(add, schema).collect():
        if part > n_classes:
            hashes[part] = np.frombuffer(at, np.uint64)
        else:
            (tables[part] if part < n_classes else letters)[np.frombuffer(at, np.int32)] = np.frombuffer(n)
    return tables, letters, np.concatenate([none, *(hashes[k] for k in sorted(hashes))])


def fitted(df: DataFrame, fields: list[str], rounds: int = 2) -> Model:
    """:func:`train` on the tokens of all rows, without any of them on the driver but their hashes; the counts are scaled to SCALED_ROWS rows."""
    ship_package(df.sparkSession)
    rows = df.count()
    scale = min(1.0, SCALED_ROWS / max(1, rows))
    counts = materialise(token_counts(df, fields, max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // 50_000)), "token-counts")
    lone = lone_of(counts)
    tables, letters, words = learnt(counts, None)
    seeds = np.array(sorted({word_hash(w) for t in seed_words()[0] if len(w := bare(t)) > 1}), np.uint64)
    model = model_of(tables * scale, letters * scale, Words(np.union1d(words, seeds)), lone)
    for _ in range(rounds - 1):
        *less, words = learnt(counts, model)
        model = model_of((tables - less[0]) * scale, (letters - less[1]) * scale, Words(np.union1d(words, seeds)), lone)
    drop_table(counts)
    return model


@dataclass
class Verdict:
    chain: str
    restored: str
    n_garbled: int
    n_lost: int


def examine(text: str, model: Model) -> Verdict | None:
    """What is garbled in one text, or nothing."""
    source, entities = text, False
    if "&" in text:
        source = _ENTITY.sub(lambda m: u if len(u := html.unescape(m[0])) == 1 and u > "\x7f" else m[0], text)
        entities = source != text
    if source.isascii():
        return None
    tokens = tokens_of(source)
    model.judge(tokens)
    memo = model.memo
    by_chain: dict[int, float] = defaultdict(float)
    sure = False
    for t in tokens:
        c, margin, _ = memo[t]
        if c > -1 or c == -2:
            by_chain[c] += margin
            sure |= len(t) > 1 or c == -2
    if by_chain and not sure and any(memo[t][0] == -1 for t in tokens):
        return None  # signs alone prove nothing beside others that are right
    if not by_chain:
        weak = Counter(-3 - memo[t][0] for t in set(tokens) if memo[t][0] < -2)
        if not weak:
            return None
        c, n = min(weak.items(), key=lambda x: (-x[1], x[0]))
        if n < max(WEAK_WORDS, 0.5 * len(set(tokens))):
            return None
        by_chain[c] = 0.0
    best = max(by_chain, key=lambda c: (by_chain[c], -c))
    lettered = best >= 0 and (ALL[best].strict or any(memo[t][0] == best and any(map(str.isalpha, t)) for t in tokens))
    garbled = lost = 0

    def restore(m: re.Match) -> str:
        nonlocal garbled, lost
        if m[0].isascii():
            return m[0]
        c, _, before = memo[m[0]]
        if lettered and c != best and (own := model.by(m[0], best)) is not None:
            if before is None or model.likelihood(own) >= model.likelihood(before) - LIKELIER and oddness(own) <= oddness(before):
                c, before = best, own  # the chain of the text, where it fits as well as the token's own
        if c == -1 or c < -2:
            return m[0]
        garbled += 1
        lost += before is None
        return m[0] if before is None else before

    restored = _RUN.sub(restore, source)
    name = "lost" if best < 0 else ALL[best].name
    return Verdict(name + (" in entities" if entities else ""), restored, garbled, lost)


def restored_fields(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id, field_name, chain, restored, n_garbled, n_lost): a row for each field with text read in a wrong encoding.

    ``chain`` names the true encoding and the wrong reader that most of the garbled tokens came through, "lost" if their
    bytes are gone; ``restored`` has every token given back whose bytes still decode strictly, the others as
    they stand; n_lost counts those. Null, empty and plain ASCII fields give no row; repeated rows are judged each by itself.
    """
    spark = df.sparkSession
    ship_package(spark)
    model = fitted(df, fields)
    held = spark.sparkContext.broadcast((model.table, model.letters, model.words, model.lone))  # buckets by chains, and 8 bytes a different word
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.StringType()) for c in ("field_name", "chain", "restored")), T.StructField("n_garbled", T.IntegerType()), T.StructField("n_lost", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            at, rows = [], []
            for k, name in enumerate(fields):
                for i, text in enumerate(batch.column(k + 1).to_pylist()):
                    if text and (found := examine(text, own)) is not None:
                        at.append(i)
                        rows.append((name, found.chain, found.restored, found.n_garbled, found.n_lost))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.string()] * 3 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], schema.names)

    return df.select(id_col, *fields).mapInArrow(run, schema)
