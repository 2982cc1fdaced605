"""Wiki storage markup to markdown-like text, by column expressions alone."""

from __future__ import annotations

from html import unescape
from html.entities import html5
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what each tag turns into
BLOCK_TAGS = "p|div|section|article|table|tr|blockquote|pre|ul|ol|h[1-6]|ac:layout|ac:layout-section|ac:layout-cell"
INLINE = {"strong|b": "**", "em|i": "_", "code": "`"}
KEPT_SCHEMES = "https?://|mailto:|#"
# the named character references of HTML, with their semicolon; some are known without it too
REFERENCES = {name: value for name, value in html5.items() if name.endswith(";")}
_BARE = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True))
_NAMED = "[A-Za-z][A-Za-z0-9]{1,31};"
_REFERENCE = rf"&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|{_NAMED}|(?:{_BARE}))"
# numbers that do not stand for the character of that number
_CONTROLS = {str(n): unescape(f"&#{n};") for n in range(160) if unescape(f"&#{n};") != chr(n)}
# places between blocks, and white space between tags, until the end
_GAP, _BLANK = "\x01", "\x02"


def _tag(names: str, slash: str = "/?") -> str:
    return rf"(?i)<{slash}(?:{names})(?=[\s/>])[^>]*>"


def _named(value: Column, shown: Callable[[Column], Column]) -> Column:
    """``shown`` of a value that is computed once, however often ``shown`` uses it: an element has a name in a lambda."""
    return F.get(F.transform(F.array(value), shown), F.lit(0))


def _where(text: Column, found: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts in which ``found`` sees what it changes; one look instead of many replacements."""
    return _named(text, lambda t: F.when(found(t), change(t)).otherwise(t))


def _holds(*parts: str) -> Callable[[Column], Column]:
    def found(text: Column) -> Column:
        seen = F.lit(False)
        for part in parts:
            seen = seen | text.contains(part)
        return seen

    return found


def _replaced(pattern: str, by: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_replace(text, pattern, by)


def _ends(text: Column) -> Column:
    """Without the white space at both ends; a line separator that ends a text stays, but not the white space before it."""
    odd = lambda t: t.endswith("\x85") | t.endswith("\u2028") | t.endswith("\u2029")
    return _named(text, lambda t: F.when(odd(t), F.regexp_replace(t, r"^\s+|\s+$", "")).otherwise(F.btrim(t, F.lit(" \t\n\x0b\f\r"))))


def _drop(text: Column) -> Column:
    text = _where(text, _holds("\r", "\x01", "\x02"), _replaced("[\r\x01\x02]", ""))
    text = _where(text, _holds("<!"), _replaced(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", ""))
    toc = r'(?is)<ac:structured-macro(?=[^>]*\bac:name="toc")'

    def without(t: Column) -> Column:
        t = F.regexp_replace(t, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
        return F.regexp_replace(F.regexp_replace(t, toc + r"[^>]*/>", ""), toc + r"[^>]*>.*?</ac:structured-macro\s*>", "")

    return _where(text, lambda t: t.rlike(r"(?i)<(?:script|style|ac:structured-macro)"), without)


def _links(text: Column, base: str) -> Column:
    """``[label](address)``, the address made absolute by its start; without one the label alone in brackets."""
    root = base.rstrip("/").replace("\\", "\\\\").replace("$", "\\$")
    label = r'(?:\s[^>]*)?>(.*?)</a\s*>'
    for start, more, prefix in ((f"(?:{KEPT_SCHEMES})", "*", ""), ("/", "*", root), ("", "+", f"{root}/")):
        # in double quotes, in single quotes, or bare
        double, single = rf'"\s*({start}(?!\s)[^"]{more}?)\s*"', rf"'\s*({start}(?!\s)[^']{more}?)\s*'"
        bare = rf"""({start}{'' if start else "(?![\"'])"}[^\s>]{more})"""
        text = F.regexp_replace(text, rf"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:{double}|{single}|{bare}){label}", rf"[$4]({prefix}$1$2$3)")
    return F.regexp_replace(text, rf"(?is)<a{label}", "[$1]")


#: Tags and texts whose results are put together before they join those of the others.
_TOGETHER = 256


def _lists(text: Column) -> Column:
    """Items on lines of their own, indented by depth. The open lists are one letter each, inmost last.

    An accumulated array is copied with each element that it gets. So tags and texts go through in pieces, and what comes of a piece
    is one element: the work grows with the text as long as it has fewer pieces than a piece has tags, a thousand times over.
    """
    found = F.regexp_extract_all(text, F.lit(r"(?is)(<[^>]*>|[^<]+|<)"), 1)

    def step(acc: Column, part: Column) -> Column:
        tag = F.lower(F.regexp_extract(part, r"^<(/?\w+)", 1))
        opened = acc["open"]
        inner = F.right(opened, F.lit(1))
        lead = F.concat(F.lit("\n"), F.repeat(F.lit("  "), F.greatest(F.length(opened) - 1, F.lit(0))), F.when(inner == "o", "1. ").otherwise("- "))
        return F.struct(
            F.when(tag.isin("ol", "ul"), F.concat(opened, F.left(tag, F.lit(1))))
            .when(tag.isin("/ol", "/ul") & (inner == F.substring(tag, 2, 1)), F.left(opened, F.length(opened) - 1))
            .otherwise(opened)
            .alias("open"),
            F.concat(acc["out"], F.array(F.when(tag == "li", lead).otherwise(part))).alias("out"),
        )

    def start(opened: Column) -> Column:
        return F.struct(opened.alias("open"), F.array().cast("array<string>").alias("out"))

    def piece(acc: Column, parts: Column) -> Column:
        # a lambda over one element names a value, so that it is computed once
        done = F.transform(F.array(F.aggregate(parts, start(acc["open"]), step)), lambda d: F.struct(d["open"].alias("open"), F.array_join(d["out"], "").alias("text")))
        return F.get(F.transform(done, lambda d: F.struct(d["open"].alias("open"), F.concat(acc["out"], F.array(d["text"])).alias("out"))), F.lit(0))

    def cut(parts: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _TOGETHER).cast("int"))
        return F.transform(places, lambda i: F.slice(parts, i * _TOGETHER + 1, F.lit(_TOGETHER)))

    pieces = F.get(F.transform(F.array(found), cut), F.lit(0))
    shown = F.aggregate(pieces, start(F.lit("")), piece, lambda acc: F.array_join(acc["out"], ""))
    return F.when(text.rlike(r"(?i)<li[\s/>]"), shown).otherwise(text)


def _table(entries: dict[str, str]) -> Column:
    """One literal for a whole map."""
    return F.str_to_map(F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in entries.items())), F.lit("\x1e"), F.lit("\x1f"))


def _references(text: Column) -> Column:
    """References as ``html.unescape`` reads them: names, the longest of those without semicolon, and numbers."""

    def number(body: Column) -> Column:
        digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
        value = F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        # as many digits as this name no character; none are a zero
        code = F.when(F.length(digits) > 7, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(value.try_cast("int"))
        missing = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        none = code.between(0xFDD0, 0xFDEF) | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
        # char() knows one byte only; the four bytes of UTF-32 name any character
        shown = F.when(missing, F.lit("�")).when(none, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(code < 160, F.coalesce(F.try_element_at(_table(_CONTROLS), code.cast("string")), shown)).otherwise(shown)

    def character(body: Column) -> Column:
        bare = F.regexp_extract(body, f"^(?:{_BARE})", 0)
        name = F.when(bare == "", F.concat(F.lit("&"), body)).otherwise(
            F.concat(F.try_element_at(_table({k: v for k, v in html5.items() if not k.endswith(";")}), bare), F.substr(body, F.length(bare) + 1))
        )
        return F.when(body.startswith("#"), number(body)).otherwise(F.coalesce(F.try_element_at(_table(REFERENCES), body), name))

    shown = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), 1), character)
    gaps = F.split(text, _REFERENCE, -1)
    joined = F.array_join(F.transform(F.arrays_zip(gaps.alias("g"), shown.alias("s")), lambda z: F.concat(z["g"], F.coalesce(z["s"], F.lit("")))), "")
    return F.when(text.contains("&") & text.rlike(_REFERENCE), joined).otherwise(text)


def markdown(column: Column | str, base: str) -> Column:
    """Markdown of a markup column; NULL stays NULL.

    Tables of contents, comments, scripts and styles go; other macros keep what they hold. Blocks are
    set apart by an empty line, items of lists by a line each. References are read once, all
    names of HTML and numbers; tags without a meaning go.
    """
    text = _drop(F.col(column) if isinstance(column, str) else column)
    text = _where(text, lambda t: t.rlike(r"(?i)<a[\s>]"), lambda t: _links(t, base))
    text = _ends(F.regexp_replace(text, r">\s+<", f">{_BLANK}<"))

    def marked(t: Column) -> Column:
        for names, mark in INLINE.items():
            t = F.regexp_replace(t, _tag(names), mark)
        t = _named(F.regexp_replace(t, _tag("br"), "\n"), _lists)
        for level in range(1, 7):
            t = F.regexp_replace(t, _tag(f"h{level}", ""), _GAP + "#" * level + " ")
        t = F.regexp_replace(t, _tag("blockquote", ""), f"{_GAP}> ")
        return F.regexp_replace(F.regexp_replace(t, _tag("pre", ""), f"{_GAP}```\n"), _tag("pre", "/"), f"\n```\n{_GAP}")

    # where none of these tags is, each step leaves the text as it is
    text = _where(text, lambda t: t.rlike(rf"(?i)</?(?:{'|'.join(INLINE)}|br|li|h[1-6]|blockquote|pre)[\s/>]"), marked)
    text = F.regexp_replace(text, _tag(BLOCK_TAGS), _GAP)
    text = _where(text, _holds("<"), _replaced(r"(?s)</?[A-Za-z!?][^>]*>", ""))
    text = _where(text, _holds(_BLANK), lambda t: F.regexp_replace(F.regexp_replace(t, rf"(^|[\n {_GAP}]){_BLANK}+", "$1"), _BLANK + "+", " "))
    text = _where(F.regexp_replace(text, rf"\n*{_GAP}[\n{_GAP}]*", "\n\n"), _holds("\n\n\n"), _replaced(r"\n{3,}", "\n\n"))
    return _ends(_named(text, _references))
