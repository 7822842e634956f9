"""URL operators (URL-01 to URL-05, STR-04)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.charset import bind

# Extensions of documents that are linked but not read, and of media that are neither.
DOCUMENTS = r"(?i)\.(pdf|docx?|xlsx?|pptx?|odt|ods|odp|csv|zip|rar|7z)$"
ASSETS = r"(?i)\.(jpe?g|png|gif|webp|svg|bmp|tiff?|ico|avif|mp4|webm|mov|avi|mp3|wav|ogg)$"
UPLOADS = r"(?i)/wp-content/uploads/"


def origin(url: Column) -> Column:
    """Scheme and host, in lower case."""
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """Path of an absolute URL, ``/`` if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def absolute(href: Column, base: Column) -> Column:
    """A reference resolved against a page (URL-01); null if it is empty or of a scheme that is no page.

    Absolute, protocol-relative, root-relative, query, fragment and relative references are covered, with any
    number of dot segments.
    """
    return bind(F.trim(href), lambda h: bind(_joined(h, base), lambda x: F.when(x.rlike(r"^[^?#]*/\.\.?(?:[/?#]|$)"), without_dots(x)).otherwise(x)))


def _joined(href: Column, base: Column) -> Column:
    root = origin(base)
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    return (
        F.when(href.rlike(r"^(?i)[a-z][a-z0-9+.\-]*://"), F.concat(origin(href), F.substr(href, F.length(origin(href)) + 1)))
        .when(href.rlike(r"^(?i)[a-z][a-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(F.startswith(href, F.lit("?")), F.concat(root, path(base), href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href != "", F.concat(root, folder, href))
    )


def without_dots(url: Column) -> Column:
    """An absolute URL with the dot segments of its path resolved; steps above the root stay at the root."""
    parts = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)([^?#]*)(.*)$"
    steps = F.split(F.regexp_extract(url, parts, 2), "/", -1)
    kept = F.aggregate(steps, F.expr("CAST(array() AS array<string>)"), lambda done, x: F.when(x == ".", done).when((x == "..") & (F.size(done) > 1), F.slice(done, 1, F.size(done) - 1)).when(x == "..", done).otherwise(F.array_append(done, x)))
    # a path that ends in a dot segment names a folder
    folder = F.when(F.element_at(steps, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.concat(F.regexp_extract(url, parts, 1), F.array_join(folder, "/"), F.regexp_extract(url, parts, 3))


def normalized(url: Column) -> Column:
    """Without query, fragment and slashes at the end (URL-02); what is no URL stays."""
    clean = F.regexp_replace(path(url), "/+$", "")
    return F.when(origin(url) == "", url).otherwise(F.concat(origin(url), F.when(clean == "", F.lit("/")).otherwise(clean)))


def is_http(url: Column) -> Column:
    """URL-03."""
    return F.coalesce(url.rlike(r"^(?i)https?://[^/?#\s]+"), F.lit(False))


def link_kind(url: Column, system_hosts: tuple[str, ...], internal_suffixes: tuple[str, ...], system_words: tuple[str, ...] = ()) -> Column:
    """First of: spreadsheet, PDF, system, internal, external (URL-04)."""
    low, at = F.lower(url), host(url)
    system = at.isin(*system_hosts)
    for w in system_words:
        system |= low.contains(w)
    inside = F.lit(False)
    for s in internal_suffixes:
        inside |= F.endswith(at, F.lit(s))
    return F.when((at == "docs.google.com") & low.contains("/spreadsheets/"), "google_sheet").when(F.endswith(low, F.lit(".pdf")) | low.contains(".pdf?"), "pdf").when(system, "system").when(inside, "internal").otherwise("external")


def target_kind(url: Column) -> Column:
    """document, media or page, in this order (URL-05)."""
    p = path(url)
    return F.when(p.rlike(DOCUMENTS), "document").when(p.rlike(ASSETS) | p.rlike(UPLOADS), "media").otherwise("page")


def safe_path(p: Column, prefixes: tuple[str, ...]) -> Column:
    """A Markdown path below an allowed folder, without steps upwards; else null (STR-04)."""
    inside = F.lit(False)
    for x in prefixes:
        inside |= F.startswith(p, F.lit(x))
    return F.when(inside & F.endswith(p, F.lit(".md")) & ~p.contains("..") & ~p.contains("//"), p)
