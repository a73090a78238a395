"""Text cleaning. Every expression reads the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmill.constants import TRIM_CLASS
from scholarmill.functions.literals import constant_map

# Script and style bodies and comments: whichever opens first swallows the others.
HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# A ">" in quotes does not end a tag; where quotes do not pair up, the first ">" does. Runs are possessive,
# so a long tag costs no stack.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TAG = rf"(?s)<[A-Za-z/!?]{_INSIDE}>|<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
# The value of the first href of a whole opening tag, in any case, in either quotes or in none.
LINK_TAG = (
    r"""(?i)<[a-z](?:[^>"'\s]++|"[^"]*+"|'[^']*+'|\s++(?!href\s*=))*+\s+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    + f"(?={_INSIDE}>)"
)
HOST = r"^(?i:https?:)?//(?:[^/?#@]*@)?([^/?#:]+)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"

# Named character references.
ENTITIES = [
    ("amp", "&"),
    ("apos", "'"),
    ("bull", "•"),
    ("cent", "¢"),
    ("copy", "©"),
    ("deg", "°"),
    ("euro", "€"),
    ("frac12", "½"),
    ("gt", ">"),
    ("hellip", "…"),
    ("laquo", "«"),
    ("ldquo", "“"),
    ("lsquo", "‘"),
    ("lt", "<"),
    ("mdash", "—"),
    ("middot", "·"),
    ("nbsp", " "),
    ("ndash", "–"),
    ("para", "¶"),
    ("plusmn", "±"),
    ("pound", "£"),
    ("quot", '"'),
    ("raquo", "»"),
    ("rdquo", "”"),
    ("reg", "®"),
    ("rsquo", "’"),
    ("sect", "§"),
    ("times", "×"),
    ("trade", "™"),
    ("yen", "¥"),
]
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def trimmed(text: Column) -> Column:
    """Strip white space of every kind from both ends."""
    return F.regexp_replace(text, rf"^[{TRIM_CLASS}]+|[{TRIM_CLASS}]+\z", "")


def _character(name: Column) -> Column:
    """The character that a reference names; NULL for an unknown name."""
    hexadecimal = name.rlike("^#[xX]")
    digits = F.when(hexadecimal, F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))
    number = F.when(name.startswith("#"), digits).cast("int")
    exists = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    point = F.decode(F.unhex(F.lpad(F.hex(F.when(exists, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(name.startswith("#"), point).otherwise(constant_map(ENTITIES)[name])


def _decoded(text: Column) -> Column:
    """Character references, named and numeric, as characters; each is decoded once, unknown ones stay."""

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, REFERENCE, 1)
        return F.coalesce(F.concat(_character(name), F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    decoded = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _plain(markup: Column) -> Column:
    text = _decoded(F.regexp_replace(markup, TAG, " "))
    return F.trim(F.regexp_replace(text, r"[\s\x{00a0}]+", " "))


def page_text(html: Column) -> Column:
    """Visible text of a page: no scripts, styles, comments or tags, single spaces."""
    return _plain(F.regexp_replace(html, HIDDEN_MARKUP, " "))


def page_title(html: Column) -> Column:
    return _plain(F.regexp_extract(html, TITLE, 1))


def page_links(html: Column) -> Column:
    """Targets of all links of a page, outside scripts, styles and comments, entities decoded."""
    values = F.regexp_extract_all(F.regexp_replace(html, HIDDEN_MARKUP, " "), F.lit(LINK_TAG), F.lit(1))
    bare = F.transform(values, lambda v: F.regexp_replace(v, "^[\"']|[\"']$", ""))
    return F.transform(bare, lambda v: F.trim(_decoded(v)))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def link_kind(link: Column, host: Column, own_host: Column) -> Column:
    """home for the site's own pages, scholar and dblp for profile pages, other for the rest.

    ``host`` is the link's, ``own_host`` the page's. A link without scheme and host is relative to its
    page, so it is one of the site's own.
    """
    relative = ~link.rlike(SCHEME) & ~link.startswith("//")
    return (
        F.when(host.startswith("scholar.google."), "scholar")
        .when(host.isin("dblp.org", "dblp.uni-trier.de"), "dblp")
        .when(relative | ((host != "") & (host == own_host)), "home")
        .otherwise("other")
    )


def first_match(text: Column, rules: list[tuple[str, str]], default: str = "other") -> Column:
    """Class of the first rule whose needle occurs in ``text``."""
    found = F.lit(default)
    for needle, label in reversed(rules):
        found = F.when(text.contains(needle), label).otherwise(found)
    return found
