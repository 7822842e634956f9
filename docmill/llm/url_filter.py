"""URL filters: a bit-parallel wildcard automaton.

Glob rules are packed side by side into Shift-And masks of several 64-bit words. One pass over the bytes
of the canonical URLs moves the states of all patterns at once, for a whole batch of URLs together.

In a rule ``*`` stands for any run of bytes, ``@`` for a run without ``/``, ``?`` and ``#`` (one or more labels of
a host, say); all else stands for itself. Every rule is matched against the whole canonical URL, which is
host, path and query. Null and empty URLs, and those without ``://``, have an empty host and path, fit no
rule of the table, and are judged like any other string by the globs, which none of them fits: allow.
Repeated rows get equal verdicts; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docmill.llm.common import fresh, table

#: Verdict by host and path prefix; each holds for the host's subdomains too, and the longest fitting rule wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: For URLs that no rule fits: blocked if any of these globs does.
BLOCKED = ("*spam*", "*cheap-pills*", "*casino*", "*/wp-login*", "*.exe", "*/feed/*")


def parts(url: str | None) -> tuple[str, str, str]:
    """Host (A to Z in lower case), path and query (with its ?) of a URL."""
    if not url or (at := url.find("://")) < 0:
        return "", "", ""
    rest = url[at + 3 :]
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:].split("#", 1)[0]
    path, mark, query = rest.partition("?")
    return host, path, mark + query


class Automaton:
    """All patterns in one row of bits: a start bit for each, then one bit per literal byte."""

    def __init__(self, patterns: list[str]) -> None:
        literal: list[tuple[int, int]] = []  # (bit, byte)
        loops: list[tuple[int, bool]] = []  # (bit, over any byte)
        starts, self.ends, bit = [], [], 0
        for p in patterns:
            starts.append(bit)
            for c in p:
                if c in "*@":
                    loops.append((bit, c == "*"))
                else:
                    for byte in c.encode():
                        bit += 1
                        literal.append((bit, byte))
            self.ends.append(bit)
            bit += 1
        self.words = (bit + 63) // 64
        self.start, self.step, self.stay = self._zeros(), self._zeros(256), self._zeros(256)
        for b in starts:
            self._set(self.start, b)
        for b, byte in literal:
            self._set(self.step[byte], b)
        for b, any_byte in loops:
            for byte in range(256):
                if any_byte or byte not in b"/?#":
                    self._set(self.stay[byte], b)

    def _zeros(self, *shape: int) -> np.ndarray:
        return np.zeros((*shape, self.words), np.uint64)

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, one column per pattern: whether the pattern fits the whole text."""
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        # texts in order of falling length, so that those still running are always the first ones
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        falling = lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        for k in range(int(falling[0]) if len(texts) else 0):
            n = int(np.searchsorted(-falling, -k, side="left"))
            c = flat[begin[:n] + k]
            s = state[:n]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            state[:n] = (moved & self.step[c]) | (s & self.stay[c])
        out = np.zeros((len(texts), len(self.ends)), bool)
        for j, b in enumerate(self.ends):
            out[order, j] = (state[:, b // 64] >> np.uint64(b % 64)) & one
        return out


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, blocked: tuple[str, ...] = BLOCKED) -> DataFrame:
    """pages (with url) and host, path, rule, verdict; names that pages has already get a leading underscore."""
    names = fresh(pages, "host", "path", "rule", "verdict")
    schema = T.StructType([*pages.schema.fields, *(T.StructField(n, T.StringType()) for n in names)])
    at = pages.columns.index("url")
    # longest last, so that the last fitting one wins; each rule is two patterns: its host, and subdomains
    ranked = sorted(rules, key=lambda r: (len(r[1]), r[1]))
    patterns = [p for _, r in ranked for p in (f"{r}*", f"@.{r}*")] + list(blocked)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(patterns)
        for b in batches:
            split = [parts(u) for u in b.column(at).to_pylist()]
            hit = automaton.matches(["".join(p).encode("utf-8", "surrogatepass") for p in split])
            fits = hit[:, : 2 * len(ranked)].reshape(-1, len(ranked), 2).any(axis=2)
            best = np.where(fits.any(axis=1), len(ranked) - 1 - fits[:, ::-1].argmax(axis=1), -1)
            bad = hit[:, 2 * len(ranked) :].any(axis=1)
            new = [
                [p[0] for p in split],
                [p[1] for p in split],
                [ranked[k][1] if k >= 0 else None for k in best],
                [ranked[k][0] if k >= 0 else "block" if x else "allow" for k, x in zip(best, bad, strict=True)],
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.string()) for c in new)], names=[*b.schema.names, *names])

    return pages.mapInArrow(rows, schema)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM cut
), ruled AS (
  SELECT *, '.' || host AS h, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host || path || query, '(?s)spam|cheap-pills|casino|/wp-login|\.exe$|/feed/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
