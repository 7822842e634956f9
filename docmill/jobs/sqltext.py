"""DuckDB spellings of the text expressions, for the SQL that checks the queries. RE2 has no look-around, and its word boundary is ASCII."""

from __future__ import annotations

from docmill.functions import keys, text
from docmill.functions.charset import MARKS, WS, accents

NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(e: str, pattern: str, to: str = "''", flags: str = "g") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {to}, '{flags}')"


def trim(e: str) -> str:
    return rr(e, f"^{WS}+|{WS}+$")


def squeeze(e: str) -> str:
    return trim(rr(e, f"{WS}+", "' '"))


def fold(e: str) -> str:
    old, new = accents()
    return rr(f"translate(lower({e}), {q(old)}, {q(new)})", MARKS)


def decode(e: str) -> str:
    for name, char in text.ENTITIES.items():
        e = f"replace({e}, '&{name};', {q(char)})"
    return e


def title_case(e: str, acronyms: tuple[str, ...] = ("IA",)) -> str:
    """Pieces between the places of a capital, and these places."""
    t, p = f"lower({normalize_spaces(e)})", q(text.WORD_START)
    joined = f"array_to_string(list_transform(list_zip(string_split_regex({t}, {p}), regexp_extract_all({t}, {p})), lambda z: z[1] || coalesce(upper(z[2]), '')), '')"
    for a in acronyms:
        joined = rr(joined, rf"\b{a.capitalize()}\b", q(a))
    return joined


def html_to_text(e: str) -> str:
    e = rr(e, "(?s)<!--.*?-->")
    for tag in text.DROPPED:
        e = rr(e, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>")
    e = rr(rr(e, rf"(?i)<br{WS}*/?{WS}*>", NL), "(?i)</(p|div|li|h[1-6]|tr|article|section)>", NL)
    e = decode(rr(rr(e, "(?i)<li[^>]*>", "'- '"), "<[^>]+>"))
    e = rr(rr(f"replace({e}, chr(13) || chr(10), {NL})", r"[ \t]+", "' '"), r"\n[ \t]+", NL)
    return trim(f"array_to_string(list_filter(string_split({e}, {NL}), lambda x: {trim('x')} NOT IN ('-', '')), {NL})")


def title(e: str) -> str:
    return trim(decode(f"regexp_extract({e}, '(?is)<title[^>]*>(.*?)</title>', 1)"))


def section_title(e: str) -> str:
    inner = [trim(decode(rr(f"regexp_extract({e}, '(?is)<{h}[^>]*>(.*?)</{h}>', 1)", "<[^>]+>"))) for h in ("h1", "h2")]
    return f"coalesce(nullif({inner[0]}, ''), {inner[1]})"


CUT = r"""(?is)(<footer\b|<div[^>]+id=["']footer["']|<div[^>]+class=["'][^"']*\bfooter\b|<div[^>]+id=["']widgets["']|<aside\b).*"""
BLOG_START = r"""(?is)^.*?<div[^>]*class=["'][^"']*\bblog-content\b[^"']*["'][^>]*>"""
BLOG_END = r"""(?is)(<footer\b|<aside\b|<div[^>]+class=["'][^"']*\bsidebar\b|<div[^>]+id=["']footer).*"""


def crop_main(e: str) -> str:
    return rr(e, CUT, "''", "c")


def blog_content(e: str) -> str:
    start = q(r"""(?i)<div[^>]*class=["'][^"']*\bblog-content\b[^"']*["'][^>]*>""")
    return f"CASE WHEN regexp_matches({e}, {start}) THEN {rr(rr(e, BLOG_START, chr(39) * 2, 'c'), BLOG_END, chr(39) * 2, 'c')} ELSE {e} END"


def normalize_spaces(e: str) -> str:
    e = rr(f"replace({e}, chr(160), ' ')", r"[ \t]+", "' '")
    return trim(rr(rr(e, r"\n[ \t]+", NL), r"\n{3,}", f"{NL} || {NL}"))


def lines(e: str) -> str:
    return f"string_split({e}, {NL})"


def slug(e: str, empty: str | None = "index") -> str:
    out = rr(rr(fold(f"coalesce({e}, '')"), "[^a-z0-9]+", "'-'"), "^-+|-+$")
    return out if empty is None else f"coalesce(nullif({out}, ''), '{empty}')"


def title_key(e: str) -> str:
    return trim(rr(fold(normalize_spaces(f"coalesce({e}, '')")), "[^a-z0-9]+", "' '"))


def names(values: tuple[str, ...]) -> str:
    return ", ".join(map(q, values))


def name_key(e: str) -> str:
    words = f"string_split({trim(rr(rr(fold(f'coalesce({e}, {chr(39) * 2})'), '[.,/]', chr(39) + ' ' + chr(39)), f'{WS}+', chr(39) + ' ' + chr(39)))}, ' ')"
    return f"array_to_string(list_sort(list_distinct(list_filter({words}, lambda w: w <> '' AND w NOT IN ({names(keys.HONORIFICS)})))), ' ')"


def folder_key(e: str) -> str:
    return rr(trim(fold(f"coalesce({e}, '')")), f"(?:{WS}|[_-])+", "'-'")


def keywords(e: str) -> str:
    folded = rr(fold(f"coalesce({e}, '')"), "[^a-z0-9]+", "' '")
    return f"list_filter(string_split({folded}, ' '), lambda w: length(w) > 2 AND w NOT IN ({names(keys.STOP_WORDS)}))"
