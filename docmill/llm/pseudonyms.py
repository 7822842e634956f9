r"""PII: format-preserving Feistel pseudonyms, all in DataFrame expressions.

Found in whole texts: mail addresses, phone numbers with a country code, IPv4 addresses (octets checked),
card and account numbers (13 to 19 digits, bare or in groups), dates (YYYY-MM-DD, DD/MM/YYYY, DD.MM.YYYY;
real days from 1800 to 2199) and hexadecimal secrets of 32 to 64 digits. Each is permuted within its own
format by a Feistel network keyed with SHA-256, so equal values get equal pseudonyms in every document,
different ones different pseudonyms, and nobody without the key can go back:

* numbers: all digits but the last are permuted as one number; the last one keeps its distance from the
  Luhn check digit, so valid numbers stay valid and others stay others;
* dates: the day's number in the 400 years (146,097 = 189 * 773 days) is permuted and written in the same way;
* phones: the digits after the country code; IPv4: the four octets; mail: letters and digits before the @,
  each within its kind; secrets: digits and the letters a to f, each within its kind.

All else is left as it is. Null texts stay null, empty ones empty; equal rows give equal rows; no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import fresh, table

ROUNDS = 10
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
PHONE = r"(?<![\w+])\+\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
IPV4 = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"
ISO = r"(?<![\w\-])\d{4}-\d{2}-\d{2}(?![\w\-])"
DAY = r"(?<![\w/.])\d{2}([/.])\d{2}\1\d{4}(?!\w|[/.]\d)"
NUMBER = r"(?<![\w.+])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\w)"
SECRET = r"(?<!\w)(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?!\w)"
FOUND = "|".join((MAIL, PHONE, IPV4, ISO, r"(?<![\w/.])\d{2}(?:/\d{2}/|\.\d{2}\.)\d{4}(?!\w|[/.]\d)", NUMBER, SECRET))
DAYS, DAYS_LEFT, DAYS_RIGHT = 146_097, 189, 773


def _word(key: str, tag: Column, r: Column, other: Column) -> Column:
    """60 bits from the key, the kind of value, the round and the other half."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(key), tag, r.cast("string"), other.cast("string")).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _feistel(key: str, tag: Column, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """struct(l, r): the pair permuted within left_size * right_size; even rounds move left, odd ones right."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), left_size.cast("long").alias("a"), right_size.cast("long").alias("b")),
        lambda s, k: F.struct(
            F.when(k % 2 == 0, (s.l + F.pmod(_word(key, tag, k, s.r), s.a)) % s.a).otherwise(s.l).alias("l"),
            F.when(k % 2 == 1, (s.r + F.pmod(_word(key, tag, k, s.l), s.b)) % s.b).otherwise(s.r).alias("r"),
            s.a.alias("a"),
            s.b.alias("b"),
        ),
    )


def _ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _digits(key: str, tag: str, digits: Column) -> Column:
    """A string of 2 to 20 digits permuted among those of its length."""
    a = (F.length(digits) / 2).cast("int")
    b = F.length(digits) - a
    of = F.concat_ws("/", F.lit(tag), F.length(digits).cast("string"))
    half = _feistel(key, of, F.substr(digits, F.lit(1), a).cast("long"), F.substr(digits, a + 1, b).cast("long"), _ten_to(a), _ten_to(b))
    return _bind(half, lambda s: F.concat(F.lpad(s.l.cast("string"), F.length(s.a.cast("string")) - 1, "0"), F.lpad(s.r.cast("string"), F.length(s.b.cast("string")) - 1, "0")))


def _bind(value: Column, use) -> Column:
    """use(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _put_back(shape: Column, digits: Column) -> Column:
    """digits at the places of shape's digits, one by one."""
    return F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), digits.alias("d")),
        lambda s, c: F.struct(F.concat(s.out, F.when(c.rlike("[0-9]"), F.substr(s.d, s["at"], F.lit(1))).otherwise(c)).alias("out"), F.when(c.rlike("[0-9]"), s["at"] + 1).otherwise(s["at"]).alias("at"), s.d.alias("d")),
        lambda s: s.out,
    )


def _luhn(digits: Column) -> Column:
    """The check digit that follows these digits."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return F.pmod(-total, F.lit(10))


def _number(key: str, m: Column) -> Column:
    def permuted(d: Column) -> Column:
        body, last = F.substr(d, F.lit(1), F.length(d) - 1), F.right(d, F.lit(1)).cast("int")
        return _bind(F.struct(_digits(key, "number", body).alias("new"), (last - _luhn(body)).alias("off")), lambda s: F.concat(s.new, F.pmod(_luhn(s.new) + s.off, F.lit(10)).cast("string")))

    return _put_back(m, _bind(F.regexp_replace(m, "[^0-9]", ""), permuted))


def _phone(key: str, m: Column) -> Column:
    code = F.regexp_extract(m, r"^\+(?:\d{1,3}(?=[ .\-(]))?", 0)
    rest = F.substr(m, F.length(code) + 1)
    return F.concat(code, _put_back(rest, _bind(F.regexp_replace(rest, "[^0-9]", ""), lambda d: _digits(key, "phone", d))))


def _ipv4(key: str, m: Column) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    half = _bind(o, lambda x: _feistel(key, F.lit("ipv4"), x[0] * 256 + x[1], x[2] * 256 + x[3], F.lit(65536), F.lit(65536)))
    return _bind(half, lambda s: F.concat_ws(".", *[(F.floor(h / 256) if k == 0 else h % 256).cast("string") for h in (s.l, s.r) for k in (0, 1)]))


def _date(key: str, m: Column) -> Column:
    iso = m.rlike(r"^\d{4}-")
    day = F.when(iso, F.try_to_timestamp(m, F.lit("yyyy-MM-dd"))).when(m.contains("/"), F.try_to_timestamp(m, F.lit("dd/MM/yyyy"))).otherwise(F.try_to_timestamp(m, F.lit("dd.MM.yyyy"))).cast("date")
    origin = F.lit("1800-01-01").cast("date")
    k = F.datediff(day, origin)
    moved = _bind(k, lambda x: _feistel(key, F.lit("date"), F.floor(x / DAYS_RIGHT), F.pmod(x, F.lit(DAYS_RIGHT)), F.lit(DAYS_LEFT), F.lit(DAYS_RIGHT)))
    new = _bind(moved, lambda s: F.date_add(origin, (s.l * DAYS_RIGHT + s.r).cast("int")))
    written = F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(m.contains("/"), F.date_format(new, "dd/MM/yyyy")).otherwise(F.date_format(new, "dd.MM.yyyy"))
    return F.when(k.between(0, DAYS - 1), written).otherwise(m)


def _letters(key: str, tag: str, value: Column, letters: int) -> Column:
    """A string with digits, and the first so many letters of either case, permuted each within its kind."""

    def shifted(half: Column, r: Column, other: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(tag), r.cast("string"), other).cast("binary"), 256)

        def move(c: Column, i: Column, d: Column) -> Column:
            by = F.conv(F.substr(d, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            kinds = ((r"[0-9]", 48, 10), (r"[a-z]", 97, letters), (r"[A-Z]", 65, letters))
            out = F.when(F.lit(False), c)
            for kind, first, n in kinds:
                out = out.when(c.rlike(kind), F.char(F.lit(first) + F.pmod(F.ascii(c) - first + by, F.lit(n))))
            return out.otherwise(c)

        return _bind(digest, lambda d: F.array_join(F.transform(F.split(half, ""), lambda c, i: move(c, i, d)), ""))

    a = F.ceil(F.length(value) / 2).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(F.substr(value, F.lit(1), a).alias("l"), F.substr(value, a + 1).alias("r")),
        lambda s, k: F.struct(F.when(k % 2 == 0, shifted(s.l, k, s.r)).otherwise(s.l).alias("l"), F.when(k % 2 == 1, shifted(s.r, k, s.l)).otherwise(s.r).alias("r")),
        lambda s: F.concat(s.l, s.r),
    )


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one found value."""
    return (
        F.when(m.contains("@"), F.concat(_letters(key, "mail", F.substring_index(m, "@", 1), 26), F.lit("@"), F.substring_index(m, "@", -1)))
        .when(m.startswith("+"), _phone(key, m))
        .when(m.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), _ipv4(key, m))
        .when(m.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{2}[/.]\d{2}[/.]\d{4})$"), _date(key, m))
        .when(m.rlike(r"^\d[\d \-]*$") & (F.length(F.regexp_replace(m, "[^0-9]", "")) <= 19), _number(key, m))
        .otherwise(_letters(key, "secret", m, 6))
    )


#: The setting that holds the key, and the key of sessions that set none, as in tests: it hides nothing.
KEY_SETTING, TEST_KEY = "spark.docmill.pseudonym.key", "not a secret"


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """docs with text rewritten, and n_private, the number of values found (renamed with a leading underscore if taken).

    key: who holds it can go back. It is a literal of the plan, so plans and event logs are to be kept as it is.
    """
    name, found = fresh(docs, "n_private", "found")
    matches = F.when(F.col("text").rlike(FOUND), F.regexp_extract_all("text", F.lit(FOUND), F.lit(0)))
    marked = docs.withColumn(found, matches)
    pieces = F.arrays_zip(F.split("text", FOUND, -1).alias("gap"), F.col(found).alias("hit"))
    text = F.array_join(F.transform(pieces, lambda x: F.concat(x.gap, F.coalesce(pseudonym(x.hit, key), F.lit("")))), "")
    rewritten = F.when(F.col(found).isNull(), F.col("text")).otherwise(text)
    columns = [rewritten.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return marked.select(*columns, F.coalesce(F.size(found), F.lit(0)).cast("long").alias(name))


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its private values replaced by linked pseudonyms, by the key of the session's setting."""
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(KEY_SETTING, TEST_KEY))
