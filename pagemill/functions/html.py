"""Expressions over saved HTML. Regular expressions are no HTML parser; each docstring states the limit."""

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

SCRIPT_STYLE_COMMENT = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
#: An href anywhere in the tag, in double quotes, single quotes or none.
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
QUOTES = r"""^["']|["']$"""
BLOCK = r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"
TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
LANG = r'(?is)<html[^>]*\slang="([^"]*)"'

# The entities decoded by built-in expressions, ampersand last so that nothing is decoded twice.
ENTITIES = (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def clean_html(page: Column) -> Column:
    """HTML without scripts, styles and comments."""
    return F.regexp_replace(page, SCRIPT_STYLE_COMMENT, "")


def page_title(page: Column) -> Column:
    """Content of the first title element; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(page, TITLE, 1), F.lit(""))


def page_lang(page: Column) -> Column:
    """Language named on the html element, null if none."""
    return F.nullif(F.regexp_extract(page, LANG, 1), F.lit(""))


def page_text(page: Column) -> Column:
    """Visible text: tags become a space, white space is squeezed, ends are trimmed. Entities stay as they are."""
    spaced = F.regexp_replace(clean_html(page), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(spaced, r"[ \t\r\n]+", " "))


def decode_entities(text: Column) -> Column:
    """Decode the common entities with built-ins; ``&amp;lt;`` becomes ``&lt;``."""
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def decode_all_entities(text: Column) -> Column:
    """Decode every named and numeric entity once, as browsers do, with built-ins.

    What follows each ampersand is looked up in the standard's table of names, the longest first where the semicolon is
    missing. Numbers from 128 to 159 stand for the characters of the Windows code page, numbers beyond the code points and
    surrogates for the replacement character, and numbers of control characters and noncharacters for nothing.
    """
    names: dict[str, dict[str, str]] = {}
    for name, character in html.entities.html5.items():
        names.setdefault(name[:2], {})[name] = character
    by_start = F.from_json(F.lit(json.dumps(names)), "map<string,map<string,string>>")

    def named(tail: Column) -> Column:
        word = F.regexp_extract(tail, r"^[A-Za-z][A-Za-z0-9]{1,31};?", 0)
        known = F.when(word != "", F.try_element_at(by_start, F.left(word, F.lit(2))))
        longest_first = F.transform(F.sequence(F.lit(0), F.greatest(F.length(word) - 2, F.lit(0))), lambda cut: F.left(word, F.length(word) - cut))
        found = F.when(known.isNotNull(), F.get(F.filter(longest_first, lambda name: F.map_contains_key(known, name)), F.lit(0)))
        decoded = F.concat(F.element_at(known, found), F.substring(tail, F.length(found) + 1, F.length(tail)))
        return F.when(found.isNull(), F.concat(F.lit("&"), tail)).otherwise(decoded)

    def numbered(tail: Column) -> Column:
        digits = F.regexp_extract(tail, r"^#([xX]?)([0-9a-fA-F]+)", 2)
        hexadecimal = F.regexp_extract(tail, r"^#([xX]?)", 1) != ""
        digits = F.when(hexadecimal, digits).otherwise(F.regexp_extract(tail, r"^#([0-9]*)", 1))
        head = F.length(digits) + F.when(hexadecimal, 2).otherwise(1)
        significant = F.regexp_replace(digits, "^0+(?=.)", "")
        value = F.when(hexadecimal, F.conv(significant, 16, 10)).otherwise(F.conv(significant, 10, 10)).cast("long")
        code = F.when(F.length(significant) > 8, F.lit(1 << 40)).otherwise(value)
        rest = F.substring(tail, head + 1 + F.when(F.substring(tail, head + 1, F.lit(1)) == ";", 1).otherwise(0), F.length(tail))
        return F.concat(_character(code), rest)

    pieces = F.split(text, "&", -1)
    first, tails = pieces[0], F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    is_number = lambda tail: tail.rlike(r"^#([0-9]|[xX][0-9a-fA-F])")
    decoded = F.transform(tails, lambda tail: F.when(is_number(tail), numbered(tail)).otherwise(named(tail)))
    return F.concat(first, F.array_join(decoded, ""))


def _character(code: Column) -> Column:
    """The character that a numeric entity stands for."""
    old = _windows(code)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    control = code.between(1, 8) | code.between(14, 31) | code.between(127, 159) | (code == 11)
    nothing = control | code.between(0xFDD0, 0xFDEF) | (F.shiftright(code, 1).bitwiseAND(0x7FFF) == 0x7FFF)
    beyond = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return F.when(beyond, "\ufffd").when(old.isNotNull(), old).when(code == 13, "\r").when(nothing, "").otherwise(plain)


def _windows(code: Column) -> Column:
    """The character of the Windows code page for 128 to 159; null for other codes."""
    page = F.array(*(F.lit(bytes([i]).decode("cp1252", "ignore") or chr(i)) for i in range(128, 160)))
    return F.when(code.between(128, 159), F.get(page, (code - 128).cast("int")))


def content_hash(page: Column) -> Column:
    return F.sha2(page, 256)
