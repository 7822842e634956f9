"""Text operators over landed HTML and Markdown (TXT-01 to TXT-21), as Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.charset import END_WORD, START_WORD, WS, WS_CHARS, bind, replace_each, squeeze, trim

# Named entities and what they stand for.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú",
    "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú",
    "ntilde": "ñ", "Ntilde": "Ñ", "uuml": "ü", "Uuml": "Ü",
    "iquest": "¿", "iexcl": "¡", "deg": "°", "ordm": "º", "ordf": "ª",
    "laquo": "«", "raquo": "»", "ldquo": "“", "rdquo": "”", "lsquo": "‘", "rsquo": "’",
    "ndash": "–", "mdash": "—", "hellip": "…", "middot": "·", "bull": "•",
    "copy": "©", "reg": "®", "trade": "™", "euro": "€",
    "amp": "&",
}

# Containers whose whole content is dropped, in this order.
DROPPED = ("script", "style", "noscript", "nav", "header", "footer", "aside")
# Where the main content ends, and where a content container starts and ends.
CUT = rf"""(?i)<footer{END_WORD}|<div[^>]+id=["']footer["']|<div[^>]+class=["'][^"']*{START_WORD}footer{END_WORD}|<div[^>]+id=["']widgets["']|<aside{END_WORD}"""
BLOG_START = rf"""(?i)<div[^>]*class=["'][^"']*{START_WORD}blog-content{END_WORD}[^"']*["'][^>]*>"""
BLOG_END = rf"""(?i)<footer{END_WORD}|<aside{END_WORD}|<div[^>]+class=["'][^"']*{START_WORD}sidebar{END_WORD}|<div[^>]+id=["']footer"""
# Headings of a course page, in the order in which its parts are looked for.
COURSE_HEADINGS = (
    "Fundamentación",
    "Destinatarios",
    "Requisitos",
    "Contenidos",
    "Objetivos",
    "Datos clave del cursado",
    "Perfil de egreso",
    "Modalidad de cursado",
    "Evaluación",
    "Certificación",
    "Docentes",
    "Costo",
)
# What a capital may follow in a title, and the letters that may get one.
WORD_START = rf"(?:^|[{WS_CHARS}:—-])[a-záéíóúñü]"
NOISE_STARTS = ("Fundamentación", "Destinatarios", "Requisitos", "Contenidos")
NOISE_ENDS = ("\nCONSULTAS\n", "\nEntorno Virtual\n", "\nCursos de Formación\n", "\nCopyright ©")


def _code_point(digits: Column, base: int, m: Column) -> Column:
    """The character of a numeric entity; one out of range stays as it is written."""
    hexed = F.conv(digits, base, 16)
    value = F.conv(digits, base, 10).cast("decimal(20,0)")
    fine = (F.length(digits) <= 8) & (value > 0) & (value <= 0x10FFFF) & ~value.between(0xD800, 0xDFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")).otherwise(m)


def decode_entities(c: Column) -> Column:
    """Decimal, then hexadecimal, then named entities (TXT-01); unknown names stay."""
    dec, hexa = r"&#(\d+);", r"&#[xX]([0-9a-fA-F]+);"
    c = bind(c, lambda x: F.when(x.rlike(dec), replace_each(x, dec, lambda m: _code_point(F.regexp_extract(m, dec, 1), 10, m))).otherwise(x))
    c = bind(c, lambda x: F.when(x.rlike(hexa), replace_each(x, hexa, lambda m: _code_point(F.regexp_extract(m, hexa, 1), 16, m))).otherwise(x))
    named = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    one = r"&([a-zA-Z]+);"
    return bind(c, lambda x: F.when(x.rlike(one), replace_each(x, one, lambda m: F.coalesce(F.try_element_at(named, F.regexp_extract(m, one, 1)), m))).otherwise(x))


def html_to_text(c: Column) -> Column:
    """Text of an HTML page, one line per block, list items marked with a hyphen (TXT-02)."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    for tag in DROPPED:
        c = F.regexp_replace(c, rf"(?is)<{tag}{END_WORD}[^>]*>.*?</{tag}>", "")
    c = F.regexp_replace(c, rf"(?i)<br{WS}*/?{WS}*>", "\n")
    c = F.regexp_replace(c, r"(?i)</(p|div|li|h[1-6]|tr|article|section)>", "\n")
    c = F.regexp_replace(c, r"(?i)<li[^>]*>", "- ")
    c = decode_entities(F.regexp_replace(c, r"<[^>]+>", ""))
    c = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"[ \t]+", " ")
    c = F.regexp_replace(c, r"\n[ \t]+", "\n")
    lines = F.filter(F.split(c, "\n", -1), lambda x: ~trim(x).isin("-", ""))
    return trim(F.array_join(lines, "\n"))


def title(c: Column) -> Column:
    """First title element (TXT-03)."""
    return trim(decode_entities(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def section_title(c: Column) -> Column:
    """First h1 with text, else the first h2 with text, else empty (TXT-04)."""
    inner = [trim(decode_entities(F.regexp_replace(F.regexp_extract(c, rf"(?is)<{h}[^>]*>(.*?)</{h}>", 1), r"<[^>]+>", ""))) for h in ("h1", "h2")]
    return F.coalesce(F.nullif(inner[0], F.lit("")), inner[1])


def _before(c: Column, pattern: str) -> Column:
    at = F.regexp_instr(c, F.lit(pattern))
    return F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(c)


def crop_main(c: Column) -> Column:
    """What stands before the first footer, widget or aside marker (TXT-05)."""
    return _before(c, CUT)


def blog_content(c: Column) -> Column:
    """From the content container to its end marker; the whole page if it has none (TXT-06)."""
    at = F.regexp_instr(c, F.lit(BLOG_START))
    opened = F.length(F.regexp_extract(c, BLOG_START, 0))
    return F.when(at > 0, bind(F.substr(c, at + opened), lambda x: _before(x, BLOG_END))).otherwise(c)


def normalize_spaces(c: Column) -> Column:
    """No-break spaces to spaces, runs to one, at most one empty line (TXT-08); single spaces, which are most, are not touched."""
    c = F.regexp_replace(F.replace(c, F.lit("\xa0"), F.lit(" ")), r" [ \t]+|\t[ \t]*", " ")
    return trim(F.regexp_replace(F.replace(c, F.lit("\n "), F.lit("\n")), r"\n{3,}", "\n\n"))


def student_text(c: Column) -> Column:
    """Normalized lines without empty ones and image or iframe markers (TXT-09); within a line only its ends are left to do."""
    lines = F.transform(F.split(normalize_spaces(c), "\n", -1), trim)
    return F.array_join(F.filter(lines, lambda x: ~F.lower(x).isin("", "image", "iframe")), "\n")


def clean_length(c: Column) -> Column:
    """Length once white space is collapsed; null counts as empty (TXT-10)."""
    return F.length(squeeze(F.coalesce(c, F.lit(""))))


def sanitize_runs(c: Column) -> Column:
    """Overlong rules and padding shortened line by line (TXT-11)."""
    for pattern, to in ((r":-{4,}", ":---"), (r"-{4,}", "---"), (r"={4,}", "==="), (r"_{4,}", "___"), (r" {80,}", " ")):
        c = F.regexp_replace(c, pattern, to)
    return c


def scrub_ids(c: Column) -> Column:
    """National identity numbers removed (TXT-12)."""
    c = F.regexp_replace(c, rf"(?i){START_WORD}D\.?{WS}*N\.?{WS}*I\.?{WS}*(?:N[°º]?|:)?{WS}*\d[\d.{WS_CHARS}]{{5,}}\d", "DNI [omitido]")
    return F.regexp_replace(c, rf"(?i)\({WS}*D\.?N\.?I\.?[^)]*\)", "(DNI [omitido])")


def neutral_date(c: Column, today: str) -> Column:
    """Today's ISO date replaced by a marker, so that a hash outlives the day (TXT-13)."""
    return F.replace(c, F.lit(today), F.lit("{DATE}"))


def strip_fence(c: Column) -> Column:
    """The content of a text that is one fenced block as a whole (TXT-14)."""
    pattern = rf"(?is)^{WS}*```(?:markdown|md)?{WS}*\n(.*?)\n```{WS}*$"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c)


def clean_subject(c: Column) -> Column:
    """A subject's name without line breaks, quotes and leading hyphens (TXT-15)."""
    c = F.regexp_replace(F.regexp_replace(c, r"[\r\n]+", " "), "[“”\"']", "")
    return squeeze(F.regexp_replace(c, f"^[{WS_CHARS}\\-]+", ""))


def clean_cell(c: Column) -> Column:
    """A value that may stand in a table cell (TXT-15)."""
    c = squeeze(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("/")))
    return F.when(c == "", F.lit("N/D")).otherwise(c)


def cut_noise(c: Column) -> Column:
    """From the first listed heading that occurs to the earliest end marker (TXT-16)."""
    body = bind(c, lambda x: F.substr(x, F.coalesce(*[F.nullif(F.instr(x, s), F.lit(0)) for s in NOISE_STARTS], F.lit(1))))
    cut = bind(body, lambda x: F.substr(x, F.lit(1), F.least(*[F.nullif(F.instr(x, e), F.lit(0)) for e in NOISE_ENDS], F.length(x) + 1) - 1))
    return normalize_spaces(cut)


def title_case(c: Column, acronyms: tuple[str, ...] = ("IA",)) -> Column:
    """Lower case, with a capital where a letter of WORD_START begins a word, and the given acronyms in capitals (TXT-17)."""
    c = bind(F.lower(normalize_spaces(c)), lambda x: replace_each(x, WORD_START, F.upper))
    for a in acronyms:
        c = F.regexp_replace(c, f"{START_WORD}{a.capitalize()}{END_WORD}", a)
    return c


def h1_title(c: Column, fallback: Column) -> Column:
    """First Markdown heading of level 1, else the fallback (TXT-18)."""
    found = trim(F.regexp_extract(c, r"(?m)^#[ \t]+(.+)$", 1))
    return F.when(found != "", found).otherwise(fallback)


def for_diff(c: Column) -> Column:
    """Text without lines that carry a review or update date, white space collapsed (TXT-20); a text without ``**`` has no such line."""
    lines = lambda x: F.filter(F.split(x, "\n", -1), lambda y: ~y.rlike(r"(?iu)\*\*Última (?:revisión humana|actualización del dato)\*\*"))
    return squeeze(bind(c, lambda x: F.when(F.contains(x, F.lit("**")), F.array_join(lines(x), "\n")).otherwise(x)))


def bullets(c: Column) -> Column:
    """Non-empty lines as list items (EXP-11)."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n", -1), squeeze), lambda x: x != "")
    return F.transform(lines, lambda x: F.when(x.rlike(rf"^[-*]{WS}+"), x).otherwise(F.concat(F.lit("- "), x)))
