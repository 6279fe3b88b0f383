"""Column functions over page text, all evaluated inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The named entities that are decoded; the ampersand comes last.
ENTITIES = (("&nbsp;", "\xa0"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&copy;", "©"), ("&reg;", "®"), ("&#8211;", "–"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
# The frame of a wrapped page.
FRAME_HEAD = '<!DOCTYPE html>\n<html>\n<head>\n<meta charset="utf-8">\n<title>Text rendering of '
FRAME_BODY = "</title>\n</head>\n<body>\n"
FRAME_END = "\n</pre>\n</body>\n</html>\n"

#: White space as a text's right end has it: Unicode blanks and line ends, and the four separators.
TRAILING = r"(?U)[\s\x1c-\x1f\x85]+\z"


def escape_html(c: Column) -> Column:
    """``& < > " '`` as entities, the ampersand first; null stays null."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def strip_end(c: Column) -> Column:
    """Without any Unicode white space at the right end (``rtrim`` takes spaces only)."""
    return F.regexp_replace(c, TRAILING, "")


def wrap_page(title: Column, body: Column, front: Column) -> Column:
    """One page of HTML from a title, a plain body and ready markup for the notice; nulls count as empty."""
    title, body, front = (F.coalesce(x, F.lit("")) for x in (title, body, front))
    head = escape_html(title)
    return F.concat(F.lit(FRAME_HEAD), head, F.lit(FRAME_BODY), front, F.lit("<h1>"), head, F.lit("</h1>\n<pre>\n"), strip_end(escape_html(body)), F.lit(FRAME_END))


_WESTERN = {chr(b): bytes((b,)).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decode_western(content: Column) -> Column:
    """Bytes in Windows-1252 to text; the five undefined bytes become controls. (``decode`` knows only a few charsets.)"""
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(_WESTERN), "".join(_WESTERN.values()))


def article_of(html: Column) -> Column:
    """The page from its first ``<h1>``; empty if it has none."""
    return F.regexp_extract(html, r"(?is)(<h1\b.*)", 1)


def title_of(html: Column) -> Column:
    """What the title element holds, in whatever case its tags are, in one line."""
    return collapse_spaces(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title\s*>", 1))


def strip_scripts(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")


def strip_tags(html: Column) -> Column:
    """Text without scripts, comments and tags; entities decoded, the ampersand last."""
    return decode_entities(F.regexp_replace(strip_scripts(html), r"<[^>]+>", ""))


def collapse_spaces(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normal_label(c: Column) -> Column:
    """A printed label in lower case without its colon or white space at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.trim(c)), r"\s*:\s*$", ""))


def decode_entities(c: Column) -> Column:
    for entity, raw in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(raw))
    return c


def requirement_rows(html: Column) -> Column:
    """array of (label, value) from table rows of two cells; empty cells stay empty, they aren't null. A row ends where the next begins, too."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr\b|<tr\b|</table\b|\z)"), 1)
    cell = lambda row, k: decode_entities(F.regexp_replace(F.coalesce(F.get(F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]\b|<t[dh]\b|\z)"), 1), F.lit(k)), F.lit("")), r"(?s)<[^>]+>|\s+", " "))
    return F.transform(rows, lambda r: F.struct(normal_label(cell(r, 0)).alias("label"), collapse_spaces(cell(r, 1)).alias("value")))


def row_value(rows: Column, labels: list[str]) -> Column:
    """The value of the first of some (label, value) rows with one of the labels; null if there is none."""
    return F.get(F.filter(rows, lambda r: r["label"].isin(*labels)), F.lit(0))["value"]


def page_fields(html: Column) -> Column:
    """struct(title, signature, runs_on, versions, header, link) of a reference page."""
    rows = requirement_rows(html)
    signature = collapse_spaces(decode_entities(F.regexp_replace(F.regexp_extract(html, r"(?is)<pre\b[^>]*>(.*?)</pre\s*>", 1), r"<[^>]+>", "")))
    return F.struct(
        title_of(html).alias("title"), signature.alias("signature"), row_value(rows, ["runs on", "platform"]).alias("runs_on"), row_value(rows, ["versions", "version"]).alias("versions"),
        row_value(rows, ["defined in", "declared in", "header"]).alias("header"), row_value(rows, ["link to", "link library", "library"]).alias("link"),
    )


def markdown_rows(md: Column) -> Column:
    """array of (label, value) from ``| label | value |`` lines, rules and head lines aside."""
    lines = F.filter(F.split(md, r"\r?\n"), lambda x: x.rlike(r"^\s*\|.*\|.*\|\s*$") & ~x.rlike(r"^[\s|:\-]+$"))
    part = lambda x, k: F.trim(F.regexp_replace(F.get(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), F.lit(k)), r"\*\*", ""))
    return F.transform(lines, lambda x: F.struct(normal_label(part(x, 0)).alias("label"), markdown_unescape(part(x, 1)).alias("value")))


def markdown_unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([_\[\]*])", "$1")


VERSION = r"\d{1,2}\.\d{1,2}"


def parse_version(raw: Column) -> Column:
    """struct(min, max, open_ended, status) of a printed version statement.

    parsed: the whole statement is understood; partial: an open range stands in it with something else; unparsed: neither. Null and
    blank statements have a null status.
    """
    t = F.lower(collapse_spaces(raw))
    lead = r"^(?:release |version )?"
    opened = F.regexp_extract(t, rf"{lead}(?:from )?({VERSION})(?:\+| or newer| and later)$", 1)
    since = F.regexp_extract(t, rf"{lead}from ({VERSION})$", 1)
    low, high = (F.regexp_extract(t, rf"{lead}({VERSION}) to ({VERSION})$", k) for k in (1, 2))
    one = F.coalesce(F.nullif(F.regexp_extract(t, rf"{lead}only ({VERSION})$", 1), F.lit("")), F.nullif(F.regexp_extract(t, rf"{lead}({VERSION})(?: only)?$", 1), F.lit("")))
    listed = t.rlike(rf"{lead}{VERSION}(?:(?:, ?| and ){VERSION})+$")
    first, last = F.regexp_extract(t, rf"({VERSION})", 1), F.regexp_extract(t, rf".*?({VERSION})$", 1)
    within = F.regexp_extract(t, r"(\d+\.\d+)(?:\+| or newer| and later)", 1)
    blank = F.coalesce(t, F.lit("")) == ""
    case = lambda a, b, c, d, e: F.when(blank, F.lit(None)).when(opened != "", a).when(since != "", b).when(low != "", c).when(one.isNotNull(), d).when(listed, e)
    yes, no = F.lit(True), F.lit(False)
    return F.struct(
        case(opened, since, low, one, first).otherwise(F.nullif(within, F.lit(""))).alias("min"),
        case(F.lit(None), F.lit(None), high, one, last).alias("max"),
        case(yes, yes, no, no, no).otherwise(within != "").alias("open_ended"),
        case(*[F.lit("parsed")] * 5).when(within != "", "partial").otherwise("unparsed").alias("status"),
    )


def version_rank(name: Column, order: list[str]) -> Column:
    """The place of a version name in an explicit list; names aren't numbers (2.1 and 2.10 differ), those not listed have none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in ((v, i) for i, v in enumerate(order)) for x in pair)), F.trim(name))


def numeric_literal(raw: Column) -> Column:
    """A hexadecimal or decimal literal as DECIMAL(20,0); suffixes and brackets around it go; expressions are null."""
    t = F.regexp_replace(F.trim(raw), r"^\((.*)\)$", "$1")
    t = F.regexp_replace(F.trim(t), r"(?i)(?<=[0-9a-f])(?:u|l|ul|lu|ull|llu|ll)$", "")
    hexa = F.when(t.rlike(r"^0[xX][0-9A-Fa-f]{1,16}$"), F.conv(F.substring(t, 3, 16), 16, 10).cast("decimal(20,0)"))
    return F.coalesce(hexa, F.when(t.rlike(r"^-?[0-9]{1,19}$"), t.try_cast("decimal(20,0)")))


def unicode_ansi_pair(text: Column) -> Column:
    """struct(unicode, ansi) of ``X (Unicode) and Y (ANSI)``; null where the statement isn't made."""
    t = markdown_unescape(F.replace(text, F.lit("**"), F.lit("")))
    uni, ansi = (F.regexp_extract(t, r"(\w+) \(Unicode\) and (\w+) \(ANSI\)", k) for k in (1, 2))
    return F.when(uni != "", F.struct(uni.alias("unicode"), ansi.alias("ansi")))


def alias_names(typenames: Column) -> Column:
    """The names of a typedef line, pointers without their star."""
    return F.filter(F.transform(F.split(typenames, r","), lambda x: F.trim(F.replace(x, F.lit("*"), F.lit("")))), lambda x: x != "")


def uid_parts(uid: Column) -> Column:
    """struct(kind, header, name) of ``UID: KIND:header.name``."""
    u = F.regexp_replace(uid, r"^UID:\s*", "")
    return F.struct(F.upper(F.regexp_extract(u, r"^(\w+):", 1)).alias("kind"), F.regexp_extract(u, r"^\w+:([^.]*)\.", 1).alias("header"), F.regexp_extract(u, r"^\w+:[^.]*\.(.*)$", 1).alias("name"))


def header_parts(c: Column) -> Column:
    """struct(header, include_header) of ``Name.h (include Other.h)``, both in lower case."""
    t = F.lower(F.trim(c))
    return F.struct(F.trim(F.regexp_extract(t, r"^([^(]*)", 1)).alias("header"), F.nullif(F.regexp_extract(t, r"\(include ([^)]+)\)", 1), F.lit("")).alias("include_header"))


def library_names(c: Column) -> Column:
    """The libraries of a list with semicolons, lower case, qualifiers in brackets taken off."""
    return F.filter(F.transform(F.split(F.lower(c), ";"), lambda x: F.trim(F.regexp_replace(x, r"\(.*?\)", ""))), lambda x: x != "")


def link_targets(html: Column) -> Column:
    """All ``href`` values of anchors in order, repeats kept."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*href\s*=\s*["']?([^"'> ]+)"""), 1)


def keyword_links(html: Column) -> Column:
    """Targets of keyword-link parameters, with ``.3a3a.`` read as ``::``."""
    return F.transform(F.regexp_extract_all(html, F.lit(r'(?i)<param\s+name="?item\d+"?\s+value="([^"]*)"'), 1), lambda x: F.replace(x, F.lit(".3a3a."), F.lit("::")))


def grouped_int(c: Column) -> Column:
    """``1,234`` to a number; null if it isn't one."""
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("bigint")


def format_int(c: Column) -> Column:
    return F.format_number(c, 0)


def compact_time(c: Column) -> Column:
    """``yyyyMMddHHmmss`` to a timestamp; null if it isn't one."""
    return F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss"))


def utc_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss 'UTC'"))


def month_day_year(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit("MM/dd/yyyy")))


def mentions(columns: list[Column], words: list[str]) -> Column:
    """Whether any of the columns (a page's header fields, say, not its body) holds any of the words, in whatever case."""
    text = F.lower(F.concat_ws("\n", *columns))
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w.lower())) for w in words), F.lit(False))


def strip_snippet(html: Column, pattern: str) -> Column:
    """Without an embedded snippet, given by its pattern."""
    return F.regexp_replace(html, pattern, "")


def constant_line(line: Column) -> Column:
    """struct(name, value) of a C#-like constant declaration in one line; null if it is none."""
    p = r"\bconst\s+\w+\s+(\w+)\s*=\s*([^;]+);"
    return F.when(line.rlike(p), F.struct(F.regexp_extract(line, p, 1).alias("name"), F.trim(F.regexp_extract(line, p, 2)).alias("value")))


def import_line(line: Column) -> Column:
    """struct(library, name) of an attribute that imports from a library."""
    p = r'\[DllImport\(\s*"([^"]+)"'
    return F.when(line.rlike(p), F.struct(F.lower(F.regexp_extract(line, p, 1)).alias("library"), F.nullif(F.regexp_extract(line, r'EntryPoint\s*=\s*"([^"]+)"', 1), F.lit("")).alias("name")))


def define_line(line: Column) -> Column:
    """struct(name, value) of a ``#define`` with a value, comments aside."""
    p = r"^\s*#\s*define\s+(\w+)\s+(\S.*?)\s*(?:/\*.*|//.*)?$"
    return F.when(line.rlike(p), F.struct(F.regexp_extract(line, p, 1).alias("name"), F.regexp_extract(line, p, 2).alias("value")))


def export_line(line: Column) -> Column:
    """The name that a line of an export list gives; null for section lines, comments and blanks."""
    t = F.trim(F.regexp_replace(line, r";.*$", ""))
    return F.when((t != "") & ~t.rlike(r"(?i)^(library|exports|name|description)\b"), F.regexp_extract(t, r"^(\w+)", 1))


def front_matter(text: Column) -> Column:
    """struct(front map<string,string>, lists map<string,array<string>>, body) of a text that begins with a ``---`` block.

    Flow lists and block lists both come out in ``lists``; keys without a value are empty strings; without a block both maps are empty.
    """
    t = F.regexp_replace(text, r"\r\n?", "\n")
    block = F.regexp_extract(t, r"(?s)\A---\n(.*?\n)---\n?", 1)
    joined = F.regexp_replace(block, r"\n[ \t]*- +", "\u0001")  # items stay with the key before them
    lines = F.filter(F.split(joined, "\n"), lambda x: x.rlike(r"^[\w.\-]+\s*:"))
    key = lambda x: F.trim(F.regexp_extract(x, r"^([\w.\-]+)\s*:", 1))
    value = lambda x: F.trim(F.regexp_extract(x, r"(?s)^[\w.\-]+\s*:(.*)$", 1))
    scalars = F.filter(lines, lambda x: ~value(x).rlike("^\\[.*\\]$|\u0001"))
    listed = F.filter(lines, lambda x: value(x).rlike("^\\[.*\\]$|\u0001"))
    unquoted = lambda x: F.regexp_replace(F.trim(x), r"""^["'](.*)["']$""", "$1")
    items = lambda x: F.filter(F.transform(F.when(F.contains(value(x), F.lit("\u0001")), F.split(value(x), "\u0001")).otherwise(F.split(F.regexp_replace(value(x), r"^\[|\]$", ""), ",")), unquoted), lambda v: v != "")
    last = lambda keys, values: F.map_from_entries(F.array_compact(F.transform(keys, lambda x, i: F.when(F.array_position(F.slice(F.transform(keys, key), i + 2, F.size(keys)), key(x)) == 0, F.struct(key(x), values(x))))))
    body = F.regexp_replace(t, r"(?s)\A---\n.*?\n---\n?", "")
    return F.struct(last(scalars, lambda x: unquoted(value(x))).alias("front"), last(listed, items).alias("lists"), body.alias("body"))


def zip_header(json_rows: Column) -> Column:
    """array of maps from a JSON array of arrays whose first row is the header; empty for an empty array."""
    rows = F.from_json(json_rows, "array<array<string>>")
    return F.transform(F.filter(rows, lambda x, i: i > 0), lambda r: F.map_from_arrays(F.get(rows, F.lit(0)), r))
