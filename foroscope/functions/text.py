"""Text expressions shared by the operators. Character classes are written out so that they mean the same
in Java and RE2."""

from functools import cache
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"


#: The same characters for use in a longer class.
WORD_CHARS = WORD[1:-2]


@cache
def _cases() -> dict[str, str]:
    """Characters that become each lower-case character; none beyond the basic plane becomes one of a listed word."""
    out: dict[str, str] = {}
    for c in map(chr, range(1, 0xD800)):
        out[c.lower()] = out.get(c.lower(), "") + c
    return out


def any_of(listed: list[str], latin: bool = False) -> str:
    """Pattern for the listed words in any case, with shared beginnings written once. Words of letters only; with ``latin``
    only those of A-Z, matched by these alone."""
    listed = [w for w in listed if w.isascii() or not latin]
    tree: dict = {}
    for word in listed:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node):
        parts = [f"[{c + c.upper() if latin else _cases()[c]}]{written(child)}" for c, child in sorted(node.items()) if c]
        return "" if not parts else f"(?:{'|'.join(parts + [''] * ('' in node))})"

    return written(tree)


def strip(col) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def words(col) -> Column:
    return F.regexp_extract_all(col, F.lit(f"({WORD})"), F.lit(1))


def without_links(col) -> Column:
    """Tags and links to blanks."""
    return F.regexp_replace(F.regexp_replace(col, r"<[^>]+>", " "), r"https?://\S+", " ")


def letters_only(col) -> Column:
    """Tags and links to blanks, then lower-case Latin letters and white space only."""
    return F.lower(F.regexp_replace(without_links(col), r"[^a-zA-Z\s]", " "))


def letter_words(col) -> Column:
    return F.regexp_extract_all(letters_only(col), F.lit(r"([a-z]+)"), F.lit(1))


def decode_entities(col: Column) -> Column:
    """Numeric and named HTML entities to characters, the ampersand last; unknown names stay."""
    def distinct(text, pattern):
        return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))

    def numeric(out, prefix, digits, base):
        code = F.conv(digits, base, 10).cast("bigint")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(valid, F.replace(out, F.concat(F.lit(prefix), digits, F.lit(";")), char)).otherwise(out)

    table = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    out = F.aggregate(distinct(col, r"&#([0-9]{1,7});"), col, lambda t, d: numeric(t, "&#", d, 10))
    out = F.aggregate(distinct(col, r"&#x([0-9A-Fa-f]{1,6});"), out, lambda t, d: numeric(t, "&#x", d, 16))
    out = F.aggregate(distinct(col, r"&([A-Za-z]+[0-9]*);"), out, lambda t, n: F.coalesce(
        F.replace(t, F.concat(F.lit("&"), n, F.lit(";")), F.try_element_at(table, n)), t))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def strip_markup(col) -> Column:
    """Script and style blocks, tags, board codes (with attributes), entities and links removed; blanks collapsed."""
    out = F.regexp_replace(col, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", " ")
    out = F.regexp_replace(out, r"\[/?[A-Za-z][^\]]*\]", " ")
    out = F.replace(decode_entities(out), F.lit("\u00a0"), F.lit(" "))
    out = F.regexp_replace(out, r"https?://\S+", " ")
    return strip(F.regexp_replace(out, r"\s+", " "))


# The standard HTML entity names, except the ampersand.
ENTITIES = {name: chr(code) for name, code in sorted(name2codepoint.items()) if name != "amp"}


def local_part(col) -> Column:
    """Name before ``@`` of an address, or between the ``!``/``@`` prefix and ``:`` of a room id."""
    room = F.regexp_replace(col, r"^[!@]+", "")
    return F.when(F.col(col).rlike(r"^[!@]"), F.substring_index(room, ":", 1)).otherwise(
        F.substring_index(F.col(col), "@", 1))
