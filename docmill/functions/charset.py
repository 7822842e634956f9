r"""Character classes spelled so that every regex engine reads them alike.

WS is white space as scripting languages see it (with no-break space, byte order mark and the Unicode
separators), which neither Java's nor RE2's ``\s`` is. END_WORD and START_WORD are ASCII word boundaries.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: The characters of WS, for classes that hold more. A repeated class takes any run, where a repeated group of alternatives takes a stack frame for each repetition.
WS_CHARS = WS[1:-1]
END_WORD, START_WORD = r"(?![A-Za-z0-9_])", r"(?<![A-Za-z0-9_])"
MARKS = r"[\x{300}-\x{36F}]"


@lru_cache(maxsize=1)
def accents() -> tuple[str, str]:
    """Two strings of equal length: every character whose canonical base is an ASCII letter or digit, and that base."""
    found = [(c, d[0]) for n in range(0x80, 0x2FFFF) if not 0xD800 <= n < 0xE000 for c in (chr(n),) if len(d := unicodedata.normalize("NFD", c)) > 1 and d[0].isascii() and d[0].isalnum() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(c for c, _ in found), "".join(b for _, b in found)


#: The characters of WS themselves, for functions that take no pattern.
WS_TEXT = "".join(map(chr, (*range(9, 14), 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
# WS for Java alone: a letter is told from white space by a table and one range, where WS asks for each range in turn.
_FAST = rf"[\t\n\x0B\f\r \xA0[\x{{1680}}-\x{{FEFF}}&&{WS}]]"


def trim(c: Column) -> Column:
    return F.trim(c, F.lit(WS_TEXT))


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, none at either end; a single space, which is most of them, is not touched."""
    return trim(F.regexp_replace(c, f" {_FAST}+|(?! ){_FAST}+", " "))


def fold(c: Column) -> Column:
    """Lower case without accents; ASCII has none."""
    old, new = accents()
    plain = lambda x: F.octet_length(x) == F.length(x)
    return bind(F.lower(c), lambda x: F.when(plain(x), x).otherwise(F.regexp_replace(F.translate(x, old, new), MARKS, "")))


def bind(c: Column, use) -> Column:
    """use(c) with c evaluated once, however often use refers to it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def replace_each(c: Column, pattern: str, use) -> Column:
    """Every match of pattern replaced by use(match), which no regex replacement string can compute."""
    pieces = F.arrays_zip(F.split(c, pattern, -1).alias("gap"), F.regexp_extract_all(c, F.lit(pattern), F.lit(0)).alias("hit"))
    return F.array_join(F.transform(pieces, lambda x: F.concat(x.gap, F.coalesce(use(x.hit), F.lit("")))), "")
