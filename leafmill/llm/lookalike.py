"""One consistent form for texts that look the same.

Steps: width and style variants are resolved, invisible characters go, blanks and hyphens become one kind,
and every letter that has a twin in another alphabet is taken to the twin's prototype. Each token then
keeps the set of scripts in which all of its letters can be spelled (the intersection of the letters' own
sets); a token is mixed if its letters come from more than one script, and confusable as a whole if it
could be spelled in another one. The spelling chosen is the one script left, or, among several, that of
the nearest token before (else after) which has only one, or Latin. All of it depends on the prototypes
only, so texts have equal forms if and only if they look the same.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.session import materialise, ship_package

# Letters that look like the letter (first of each pair) in another alphabet or form.
TWINS = {
    "Cyrillic": "AА BВ EЕ SЅ IІ JЈ KК MМ HН OО PР CС TТ YУ YҮ XХ VѴ GԌ QԚ WԜ IӀ aа eе oо pр cс yу xх sѕ iі jј hһ dԁ qԛ wԝ lӏ vѵ əә ƏӘ ÆӔ æӕ",
    "Greek": "AΑ BΒ EΕ ZΖ HΗ IΙ KΚ MΜ NΝ OΟ PΡ TΤ YΥ XΧ oο pρ vν cϲ jϳ µμ ГΓ ПΠ ФΦ",
    "Armenian": "oօ OՕ uս UՍ nո hհ gց qզ SՏ",
    "Cherokee": "AᎪ BᏴ CᏟ DᎠ EᎬ GᏀ HᎻ JᎫ KᏦ LᏞ MᎷ PᏢ SᏚ TᎢ VᏙ WᎳ ZᏃ",
    "Lisu": "AꓮBꓐCꓚDꓓEꓰFꓝGꓖHꓧIꓲJꓙKꓗLꓡMꓟNꓠOꓳPꓑRꓣSꓢTꓔUꓴVꓦWꓪXꓫYꓬZꓜ",
    "Latin": "gɡ aɑ cᴄ oᴏ sꜱ vᴠ wᴡ yʏ zᴢ e℮ ĐÐ ĐƉ əǝ",
    "Katakana": "へヘ",
}
# Decomposition kinds that differ in width or style only, and ranges whose compatibility form looks the same.
STYLES = ("<wide>", "<narrow>", "<font>", "<small>", "<initial>", "<medial>", "<final>", "<isolated>")
LIGATURES = ((0x2160, 0x217F), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x0132, 0x0133), (0xFB00, 0xFB17))
HYPHENS = "‐‑﹣－"
#: Characters of no width besides those of category Cf.
UNSEEN = ((0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x2065, 0x2065), (0x3164, 0x3164), (0xFFA0, 0xFFA0), (0xFE00, 0xFE0F), (0xE0100, 0xE01EF))
#: Of category Cf, but seen (number signs), or part of what is seen (flags' tags; joiners are handled by their place).
SEEN = ((0x0600, 0x0605), (0x06DD, 0x06DD), (0x070F, 0x070F), (0x0890, 0x0891), (0x08E2, 0x08E2), (0x110BD, 0x110BD), (0x200C, 0x200D), (0xE0020, 0xE007F))
PREFERRED = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Lisu", "Katakana", "Hiragana")

_in = lambda c, ranges: any(a <= c <= b for a, b in ranges)


def _first_map() -> dict[str, str]:
    out: dict[int, str] = {}
    for c in (*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800), *range(0x1EE00, 0x1EF00), *range(0x1FBF0, 0x1FBFA), *range(0xE0000, 0xE0200), *range(0x110B0, 0x110D0)):
        ch = chr(c)
        kind = unicodedata.decomposition(ch).partition(" ")[0]
        if kind in STYLES or kind == "<compat>" and _in(c, LIGATURES):
            out[c] = unicodedata.normalize("NFKD", ch)
        elif unicodedata.category(ch) == "Zs" or c == 0x2800:
            out[c] = " "
        elif c in (0x85, 0x2028, 0x2029):
            out[c] = "\n"
        elif _in(c, UNSEEN) or unicodedata.category(ch) in ("Cf", "Cc") and not _in(c, SEEN):
            out[c] = ""
    out |= {c: "" for c in (*range(0x20), 0x7F) if chr(c) not in "\t\n\v\f\r"}
    out |= {ord(h): "-" for h in HYPHENS}
    return {chr(c): t for c, t in out.items()}


FIRST = _first_map()
PROTOTYPE: dict[str, str] = {}
SPELLINGS: dict[str, dict[str, str]] = {}
for _script, _pairs in TWINS.items():
    _letters = _pairs.replace(" ", "")
    for _p, _t in zip(_letters[::2], _letters[1::2]):
        PROTOTYPE[_t] = _p
        SPELLINGS.setdefault(_p, {}).setdefault(_script, _t)
for _p, _own in SPELLINGS.items():
    _own[unicodedata.name(_p).partition(" ")[0].capitalize() if _p != "µ" else "Latin"] = _p

for _c in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):  # letters with marks whose base has a twin
    _base, _marks = unicodedata.normalize("NFD", chr(_c))[:1], unicodedata.normalize("NFD", chr(_c))[1:]
    if _marks and _base in PROTOTYPE:
        PROTOTYPE[chr(_c)] = unicodedata.normalize("NFC", PROTOTYPE[_base] + _marks)

_CONTROLS = re.compile("[\x00-\x08\x0e-\x1f\x7f]")
_ODD_LINES = re.compile("\r")
#: Letters of the alphabets that have twins; ASCII apart.
_TWIN_SCRIPTS = re.compile("[\u0370-\u058f\u13a0-\u13ff\ua4d0-\ua4ff\u3040-\u30ff]")
_TOKEN = re.compile(r"[^\W\d_]+")
_JOINER = re.compile("(?<![؀-෿‍️\U0001f000-\U0001faff☀-➿])[‌‍]+|[‌‍]+(?=[\\s]|$)")
_SEEN_AT_ALL = re.compile(r"\S")


def script_of(letter: str) -> str:
    """The script by the first word of the character's name; ideographs and unnamed ones give it as well."""
    return unicodedata.name(letter, "?").replace("-", " ").partition(" ")[0].capitalize()


class Forms:
    """Forms of texts; tokens once resolved are kept up to a bound."""

    def __init__(self, kept: int = 200_000):
        self.kept = kept
        self.tokens: dict[str, frozenset[str]] = {}

    def scripts(self, token: str) -> frozenset[str]:
        """The scripts in which every letter of a token of prototypes can be spelled."""
        found = self.tokens.get(token)
        if found is None:
            sets = []
            for ch in set(token):
                base = unicodedata.normalize("NFD", ch)[0]
                own = SPELLINGS.get(ch) or SPELLINGS.get(base)
                sets.append(frozenset(own) if own else frozenset((script_of(base),)))
            found = frozenset.intersection(*sets) if sets else frozenset()
            if len(self.tokens) >= self.kept:
                self.tokens.clear()
            self.tokens[token] = found
        return found

    @staticmethod
    def spell(token: str, script: str) -> str:
        if script == "Latin":
            return token
        return unicodedata.normalize("NFC", "".join(SPELLINGS.get(ch, {}).get(script, ch) for ch in unicodedata.normalize("NFD", token)))

    @staticmethod
    def skeleton(text: str) -> str:
        """The text in prototypes, before a script is chosen."""
        if _ODD_LINES.search(text):
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        if text.isascii():
            return _CONTROLS.sub("", text)
        seen = set(text)
        for ch in seen & FIRST.keys():
            text = text.replace(ch, FIRST[ch])
        if "\u200c" in seen or "\u200d" in seen:
            text = _JOINER.sub("", text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if twins := set(text) & PROTOTYPE.keys():
            for ch in twins:
                text = text.replace(ch, PROTOTYPE[ch])
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
        return text

    def form(self, text: str) -> str:
        """The one form of everything that looks like ``text``."""
        text = self.skeleton(text)
        if text.isascii() or not _TWIN_SCRIPTS.search(text):
            return text
        spans = [(m.start(), m.end(), self.scripts(m[0])) for m in _TOKEN.finditer(text)]
        chosen: list[str] = []
        for _, _, own in spans:  # the one script left, or what the token before has
            if len(own) == 1:
                chosen.append(next(iter(own)))
            else:
                chosen.append(chosen[-1] if chosen and chosen[-1] in own else "")
        after = ""
        for i in range(len(spans) - 1, -1, -1):
            own = spans[i][2]
            if not chosen[i]:
                chosen[i] = after if after in own else next((s for s in PREFERRED if s in own), "Latin")
            elif len(own) == 1:
                after = chosen[i]
        out, at = [], 0
        for (a, b, _), script in zip(spans, chosen):
            if script != "Latin":
                out += (text[at:a], self.spell(text[a:b], script))
                at = b
        return "".join(out) + text[at:]

    def kinds(self, text: str) -> tuple[int, int]:
        """How many tokens mix scripts, and how many are in one script that looks like Latin throughout."""
        mixed = whole = 0
        if not text.isascii():
            for m in _TOKEN.finditer(unicodedata.normalize("NFC", text)):
                if m[0].isascii():
                    continue
                own = {script_of(unicodedata.normalize("NFD", ch)[0]) for ch in m[0]} - {"Fullwidth", "Halfwidth", "Mathematical", "Ideographic"}
                if len(own) > 1 and not own <= {"Hiragana", "Katakana", "Cjk"}:
                    mixed += 1
                elif own and own < set(TWINS) - {"Latin", "Katakana"} and "Latin" in self.scripts(self.skeleton(m[0])):
                    whole += 1
        return mixed, whole


def forms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, form, n_mixed, n_whole): the consistent form of each text, and how many tokens of either kind it had.

    Null stays null with zero counts, an empty text stays empty, repeated rows stay repeated. No shuffle.
    """
    ship_package(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("form", T.StringType()), T.StructField("n_mixed", T.IntegerType()), T.StructField("n_whole", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Forms()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            kinds = [own.kinds(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else own.form(t) for t in texts], pa.string()), pa.array([k[0] for k in kinds], pa.int32()), pa.array([k[1] for k in kinds], pa.int32())], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship_package(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("look", T.BinaryType()), T.StructField("own", T.BinaryType())])

    def digest(text: str) -> bytes:
        return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Forms()
        for batch in batches:
            at, looks, texts = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                form = own.form(text) if text else ""
                if _SEEN_AT_ALL.search(form):
                    at.append(i)
                    texts.append(d := digest(text))
                    looks.append(d if form == text else digest(form))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(looks, pa.binary()), pa.array(texts, pa.binary())], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def lookalike_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_a, id_b), the smaller first: rows whose texts differ but have one form.

    Texts without a visible character, null ones included, are in no pair; rows with equal texts aren't a
    pair of their own. Only digests of 128 bits are shuffled; groups of one text are dropped before the join.
    """
    texts = materialise(_digests(df, id_col, text_col), "looks")
    several = texts.groupBy("look").agg(F.min("own").alias("least"), F.max("own").alias("most")).where("least <> most").select("look")
    kept = texts.join(several, "look", "left_semi")
    # Pairs of different texts first, then their rows: copies of one text never meet each other.
    distinct = kept.select("look", "own").distinct()
    pairs = distinct.withColumnRenamed("own", "own_a").join(distinct.withColumnRenamed("own", "own_b"), "look").where("own_a < own_b").select("own_a", "own_b")
    rows = kept.select("own", "id").distinct()
    both = pairs.join(rows.toDF("own_a", "x"), "own_a").join(rows.toDF("own_b", "y"), "own_b").where("x <> y")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
