"""Queries over irregular sheets, made of the orders and events tables, and over catalogs of parts and their routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions import keys
from docmill.jobs import sqltext as s
from docmill.operators import grid, reports, routing
from docmill.sources.tables import table


def _cells(rows: DataFrame, values: list) -> DataFrame:
    return rows.select("sheet", "r", F.posexplode(F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values])).alias("c", "v"))


def _rows(rows: DataFrame, values: list) -> DataFrame:
    return rows.select("sheet", "r", grid.filled(F.array(*[F.coalesce(v.cast("string"), F.lit("")) for v in values])).alias("cells")).where(F.size("cells") > 0)


def exam_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of 200 orders: a day row, an enrolment row, a heading, then exams."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 200").alias("sheet"), (F.col("o_orderkey") % 200).cast("int").alias("r"), "o_orderkey", "o_orderdate", "o_orderpriority")
    k = F.col("r") % 9
    day = F.element_at(F.array(F.lit("Lunes"), F.lit("Martes"), F.lit("Miércoles")), (F.floor(F.col("r") / 9) % 3 + 1).cast("int"))
    date = F.concat_ws("/", F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate"))
    exam = (k > 2) | ((k == 1) & (F.col("o_orderkey") % 2 == 0))
    return _cells(
        o,
        [
            F.when(k == 0, day).when(k == 1, "Desde el").when(k == 2, "Fecha Examen"),
            F.when(k == 0, date).when(k == 1, "1/4/2026"),
            F.when(k == 1, " al "),
            F.when(k == 1, F.concat(F.col("r").cast("string"), F.lit("/4/2026"))),
            F.when(exam, F.col("o_orderkey").cast("string")),
            F.when(exam & (F.col("o_orderkey") % 7 != 0), F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))),
            F.when(F.col("o_orderkey") % 5 != 0, "09:00 Hs"),
        ],
    )


def _schedule(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    """Rows and columns of sheets of 200 orders with two blocks side by side, titles above headers, merged cells and notes."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 200").alias("sheet"), (F.col("o_orderkey") % 200).cast("int").alias("r"), "o_orderkey", "o_orderpriority")
    k, r = F.col("r") % 11, F.col("r")
    data = (k > 1) & (k != 6)
    day = F.element_at(F.array(F.lit("Lunes"), F.lit("Martes"), F.lit("Jueves")), (r % 3 + 1).cast("int"))
    com = F.concat(F.lit("Com. N° "), (r % 4).cast("string"))
    values = [
        F.when(k == 0, F.concat(F.lit("- Materia  "), (F.col("o_orderkey") % 17).cast("string"))).when(k == 1, " Comisiones").when(k == 6, "- Anual -").when(data & (r % 2 == 0), com),
        F.when(k == 1, "Días").when((k == 6) | (data & (r % 5 != 0)), day),
        F.when(k == 1, "Horario").when(data & (r % 3 != 0), F.concat((r % 24).cast("string"), F.lit(" hs"))),
        F.when(k == 1, "Docente").when(k == 6, "nobody").when(data & (r % 4 == 0), F.col("o_orderpriority")),
        F.lit(""),
        F.when(k == 1, "Comisiones 2").when(data & (r % 3 == 0), com),
        F.when(k == 1, "Días").when(data & (r % 7 == 0), day),
        F.when((k == 0) & (F.col("o_orderkey") % 2 == 0), "Otra").when(k == 1, "Horario").when(data, "10 hs"),
        F.when(k == 1, "Docente").when(data & (r % 5 == 0), "Dr. Roe, Jane"),
    ]
    return o, values


def schedule_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(*_schedule(spark, sf_dir))


def _texts(rows: DataFrame, values: list) -> DataFrame:
    """(sheet, body): each sheet of 200 rows as a CSV text, cells quoted where they need it or stand in every third column; missing rows are empty lines."""
    plain = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    cells = [F.when(v.rlike('[",\\n]') | F.lit(k % 3 == 2), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v) for k, v in enumerate(plain)]
    lines = rows.select("sheet", "r", F.concat_ws(",", *cells).alias("line")).groupBy("sheet").agg(F.map_from_entries(F.collect_list(F.struct("r", "line"))).alias("lines"))
    return lines.select("sheet", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(199)), lambda r: F.coalesce(F.try_element_at("lines", r), F.lit(""))), "\r\n").alias("body"))


def csv_schedule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, SRC-10, TAB-02 to TAB-04: the same sheets written as CSV texts and read from them."""
    return grid.schedule_of(grid.csv_rows(_texts(*_schedule(spark, sf_dir)), "sheet", "body"))


def headless_schedule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, TAB-05: CSV sheets without a header: notes, a title, then commissions, days, hours and teachers with gaps."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 200").alias("sheet"), (F.col("o_orderkey") % 200).cast("int").alias("r"), "o_orderkey", "o_orderpriority")
    r, data = F.col("r"), F.col("r") > 3
    values = [
        F.when(r < 2, "nota").when(r == 2, F.concat(F.lit("- Materia  "), F.col("sheet").cast("string"))).when(data & (r % 4 == 1), F.concat(F.lit("Com. N° "), (r % 5).cast("string"))).when(data & (r % 11 == 0), "otra nota"),
        F.when(data & (r % 3 != 0), F.element_at(F.array(F.lit("Lunes"), F.lit("Martes")), (r % 2 + 1).cast("int"))),
        F.when(data & (r % 5 != 0), F.concat((r % 24).cast("string"), F.lit(" hs"))),
        F.when(data & (r % 6 == 1), F.concat(F.lit("Roe, "), "o_orderpriority")),
    ]
    return grid.schedule_without_header(grid.csv_cells(_texts(o, values), "sheet", "body"))


def elective_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, TAB-06, EXP-09: CSV sheets whose columns are found by name, which stand in another order on odd sheets; some hours hold several commissions."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 200").alias("sheet"), (F.col("o_orderkey") % 200).cast("int").alias("r"), "o_orderkey", "o_orderpriority")
    r, odd = F.col("r"), F.col("sheet") % 2 == 1
    subject = F.when(r == 0, "Nombre de la materia").when(r % 10 != 9, F.concat(F.lit('- "Optativa" '), F.col("o_orderkey").cast("string")))
    teacher = F.when(r == 0, "Docente a cargo").when(r % 4 != 0, F.col("o_orderpriority"))
    hours = F.when(r == 0, "Horarios").when(r % 3 == 0, "C1: Lunes 8 hs Profesor Ana Roe.\nC2 : Martes  9 hs;").when(r % 3 == 1, "Viernes 10 hs")
    return grid.electives_of(grid.csv_rows(_texts(o, [F.when(odd, hours).otherwise(subject), teacher, F.when(odd, subject).otherwise(hours)]), "sheet", "body"))


def exam_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TAB-01, WIN-01, SRC-09."""
    return grid.exams(exam_cells(spark, sf_dir))


def schedule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TAB-02, TAB-03, TAB-04, JOI-08, JOI-09, WIN-02."""
    return grid.schedule_of(schedule_sheet(spark, sf_dir))


def exam_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-01, EXP-12: one Markdown table per sheet."""
    e = grid.exams(exam_cells(spark, sf_dir))
    out = reports.md_table(e, ["sheet"], ["r"], {"Fecha": F.col("date"), "Día": F.col("day"), "Código": F.col("code"), "Materia": F.col("subject"), "Hora": F.col("hour"), "Inscripción": F.col("enrolment")})
    return out.select("sheet", F.length("md").alias("length"), keys.content_hash(F.col("md")).alias("hash"))


def schedule_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-02, AGG-06: one Markdown table per sheet and subject."""
    e = grid.schedule_of(schedule_sheet(spark, sf_dir))
    out = reports.md_table(e, ["sheet", "subject"], ["r", "start"], {"Comisión": F.col("commission"), "Día": F.col("day"), "Horario": F.col("hours"), "Docente": F.col("teacher")})
    return out.select("sheet", "subject", F.length("md").alias("length"), keys.content_hash(F.col("md")).alias("hash"))


def fill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01: each event with its user's last purchase value."""
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(w).alias("last_value"))


def segment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02: events of each user cut at every purchase, with the size of each run."""
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("run", F.sum((F.col("event_type") == "purchase").cast("int")).over(w)).groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def nearest_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TAB-03, JOI-08: nearest title above each header, as cells."""
    return grid.subjects_above(schedule_sheet(spark, sf_dir))


def asof_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-09: each event with the event that governs it, the user's last view at or before it."""
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("event_id", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w).alias("header_id"))


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-03, SET-02: first event of each user and type; an aggregate, so no group is held whole."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f")).select("user_id", "event_type", "f.event_id")


def teacher_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07, AGG-06, KEY-06, EXP-08: rows by name, however it is written."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "Dra. ").otherwise(""), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Pérez "), "o_orderpriority")).otherwise(F.concat("o_orderpriority", F.lit(", PEREZ"))))
    rows = o.select(name.alias("name"), (F.col("o_custkey") % 50).alias("subject"), F.col("o_orderstatus").alias("group"), F.col("o_orderkey").alias("ord"))
    return routing.inverted_index(rows, "name", "ord", ["subject", "group"])


def teacher_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07, EXP-08, ORD-02, STR-02: the index of teachers as a document in blocks of 100 lines; every third cell holds two names."""
    o = table(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    one = F.concat(F.when(n % 3 == 0, "Dra. ").otherwise(""), F.when(n % 2 == 0, F.concat(F.lit("Pérez "), F.trim("o_orderpriority"))).otherwise(F.concat(F.trim("o_orderpriority"), F.lit(", PEREZ"))))
    rows = o.select(
        F.when(n % 3 == 1, F.concat(one, F.lit(" - roe "), F.lower("o_orderstatus"), F.lit(" -"))).when(n % 11 == 0, "N/D").otherwise(one).alias("teacher"), F.concat(F.lit("Materia | "), F.col("o_custkey") % 50).alias("subject"),
        F.when(n % 4 > 0, F.concat(F.lit("Com.<br>"), n % 4)).alias("commission"), F.when(n % 5 == 0, "Ver horarios").otherwise("Lunes").alias("day"), F.when(n % 7 > 0, F.concat(n % 7, F.lit(" hs"))).alias("hours"), n.alias("ord"),
    )
    blocks = routing.teacher_table(rows, size=100)
    return blocks.select("block", "n_lines", F.length("md").alias("length"), F.sha2("md", 256).alias("hash"))


#: Rules over parts: their brand is the path, their name the title, their type the category.
TAXONOMY = routing.Taxonomy(
    sectors={"first": routing.Match(path_prefix=("brand#1",)), "metal": routing.Match(category_includes=("steel", "brass"), title_includes=("7",)), "third": routing.Match(path_includes=("#3",)), "exact": routing.Match(category_equals=("promo tin",))},
    fallback="rest",
    overrides=(("third", routing.Match(title_includes=("99",)), True), ("metal", routing.Match(path_includes=("2",)), False)),
    aliases={"first": ("Académica", "aulas-virtuales"), "metal": ("02 - source_EN",), "third": ("source_fr", "07 SOURCE_DE")},
)


def route_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUL-01, RUL-02, JOI-10: sector of every part."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("path"), F.col("p_name").alias("title"), F.col("p_type").alias("category"), F.when(F.col("p_partkey") % 10 == 0, "exact").when(F.col("p_partkey") % 10 == 1, "nowhere").alias("sector"))
    return p.select("p_partkey", TAXONOMY.route().alias("routed"))


def route_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUL-01, RUL-02, JOI-10: parts by a taxonomy of some thousands of rules: a sector for each size, with the keys of its parts as parts of titles."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("path"), F.concat(F.col("p_partkey").cast("string"), F.lit(" "), "p_name").alias("title"), F.col("p_type").alias("category"), F.when(F.col("p_partkey") % 10 == 0, "z07").alias("sector"))
    sectors = {f"z{k:02d}": routing.Match(title_includes=tuple(f"{j}" for j in range(100 + k, 3100, 40)), category_equals=(f"promo {k}",)) for k in range(40)}
    many = routing.Taxonomy(sectors, "rest", (("z01", routing.Match(path_includes=("#55",)), True), ("z02", routing.Match(path_prefix=("brand#1",)), False)))
    return many.assign(p, "routed").select("p_partkey", "routed")


def routing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, SNK-05: parts per sector, with zeros."""
    dim = spark.createDataFrame([(x,) for x in (*TAXONOMY.sectors, "rest", "unused")], "routed string")
    return dim.join(route_rules(spark, sf_dir).groupBy("routed").agg(F.count("*").alias("n")), "routed", "left").select("routed", F.coalesce("n", F.lit(0)).alias("n"))


def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-14, KEY-07: sector of a folder by its aliases."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lpad((F.col("doc_id") % 20).cast("string"), 2, "0"), F.lit(" - source_"), F.upper("lang")).alias("folder"))
    return TAXONOMY.by_folder(d, "folder").select("doc_id", "sector")


def reply_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-03: sectors of JSON replies, some fenced, unsure, unknown or broken."""
    n = F.col("doc_id")
    body = F.concat(F.lit('{"sector": "'), F.element_at(F.array(F.lit("first"), F.lit("metal"), F.lit("nowhere")), (n % 3 + 1).cast("int")), F.lit('", "confidence": 0.'), (n % 10).cast("string"), F.when(n % 7 == 0, "").otherwise("}"))
    reply = F.when(n % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return table(spark, sf_dir, "documents").select("doc_id", routing.parse_reply(reply, tuple(TAXONOMY.sectors), "rest").alias("sector"))


def token_overlap_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-07, ORD-03, KEY-09: for every document whose id is divisible by 20, the 3 others whose titles share most keywords with it."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), keys.keywords(F.substring_index("text", "\n", 1)).alias("words"))
    return routing.overlap(d.where("id % 20 = 0"), d)


_EXAM = """
o AS (SELECT o_orderkey // 200 AS sheet, o_orderkey % 200 AS r, o_orderkey, o_orderdate, o_orderpriority, (o_orderkey % 200) % 9 AS k FROM orders),
x AS (SELECT sheet, r, k, o_orderkey, trim(o_orderpriority) AS p, CASE WHEN k = 0 THEN ['Lunes', 'Martes', 'Miércoles'][(r // 9) % 3 + 1] END AS d, CASE WHEN k = 0 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) END AS t,
  CASE WHEN k = 1 THEN 'Desde el 1/4/2026 al ' || r || '/4/2026' END AS e FROM o WHERE k <> 2),
f AS (SELECT sheet, r, k, o_orderkey, p, coalesce(last_value(d IGNORE NULLS) OVER w, '') AS day, coalesce(last_value(t IGNORE NULLS) OVER w, '') AS date, coalesce(last_value(e IGNORE NULLS) OVER w, '') AS enrolment FROM x WINDOW w AS (PARTITION BY sheet ORDER BY r ROWS UNBOUNDED PRECEDING)),
exam AS (SELECT sheet, r, day, date, enrolment, CAST(o_orderkey AS VARCHAR) AS code, p AS subject, CASE WHEN o_orderkey % 5 <> 0 THEN '09:00 Hs' ELSE '' END AS hour FROM f WHERE (k > 2 OR (k = 1 AND o_orderkey % 2 = 0)) AND o_orderkey % 7 <> 0)"""
_SCHEDULE = """
o AS (SELECT o_orderkey // 200 AS sheet, o_orderkey % 200 AS r, o_orderkey, o_orderpriority, (o_orderkey % 200) % 11 AS k FROM orders),
h AS (SELECT sheet, r AS hr, lead(r) OVER (PARTITION BY sheet ORDER BY r) AS next_r FROM o WHERE k = 1),
b AS (SELECT h.*, 0 AS start, coalesce('Materia ' || (o.o_orderkey % 17), 'Materia sin nombre') AS subject FROM h LEFT JOIN o ON h.sheet = o.sheet AND o.r = h.hr - 1
  UNION ALL SELECT h.*, 5, CASE WHEN o.o_orderkey % 2 = 0 THEN 'Otra' WHEN y.r % 3 = 0 THEN 'Com. N° ' || (y.r % 4) WHEN y.r % 7 = 0 THEN ['Lunes', 'Martes', 'Jueves'][y.r % 3 + 1] WHEN y.r IS NOT NULL THEN '10 hs' ELSE 'Materia sin nombre' END FROM h LEFT JOIN o ON h.sheet = o.sheet AND o.r = h.hr - 1 LEFT JOIN o y ON h.sheet = y.sheet AND y.r = h.hr - 2),
v AS (SELECT sheet, r, 0 AS start, CASE WHEN r % 2 = 0 THEN 'Com. N° ' || (r % 4) END AS com, CASE WHEN r % 5 <> 0 THEN ['Lunes', 'Martes', 'Jueves'][r % 3 + 1] END AS day, CASE WHEN r % 3 <> 0 THEN (r % 24) || ' hs' END AS hours, CASE WHEN r % 4 = 0 THEN o_orderpriority END AS teach FROM o WHERE k > 1 AND k <> 6
  UNION ALL SELECT sheet, r, 5, CASE WHEN r % 3 = 0 THEN 'Com. N° ' || (r % 4) END, CASE WHEN r % 7 = 0 THEN ['Lunes', 'Martes', 'Jueves'][r % 3 + 1] END, '10 hs', CASE WHEN r % 5 = 0 THEN 'Dr. Roe, Jane' END FROM o WHERE k > 1 AND k <> 6
  UNION ALL SELECT sheet, r, 5, NULL, NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'Otra' END, NULL FROM o WHERE k = 0),
j AS (SELECT v.*, b.hr, b.subject FROM v JOIN b ON v.sheet = b.sheet AND v.start = b.start AND v.r > b.hr AND (b.next_r IS NULL OR v.r < b.next_r) WHERE coalesce(com, day, hours, teach) IS NOT NULL),
sched AS (SELECT sheet, start, r, subject, coalesce(last_value(com IGNORE NULLS) OVER w, 'N/D') AS commission, coalesce(day, 'N/D') AS day, coalesce(hours, 'N/D') AS hours, coalesce(last_value(teach IGNORE NULLS) OVER w, 'N/D') AS teacher, day IS NOT NULL OR hours IS NOT NULL AS shown
  FROM j WINDOW w AS (PARTITION BY sheet, hr, start ORDER BY r ROWS UNBOUNDED PRECEDING))"""
_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
_NAME = "CASE WHEN o_orderkey % 3 = 0 THEN 'Dra. ' ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN 'Pérez ' || o_orderpriority ELSE o_orderpriority || ', PEREZ' END"
_ROUTED = """
r AS (SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%99%' THEN 'third' WHEN p_partkey % 10 = 0 THEN 'exact' WHEN lower(p_name) LIKE '%99%' THEN 'third' WHEN lower(p_brand) LIKE '%2%' THEN 'metal' WHEN lower(p_brand) LIKE 'brand#1%' THEN 'first'
  WHEN lower(p_name) LIKE '%7%' OR lower(p_type) LIKE '%steel%' OR lower(p_type) LIKE '%brass%' THEN 'metal' WHEN lower(p_brand) LIKE '%#3%' THEN 'third' WHEN lower(p_type) = 'promo tin' THEN 'exact' ELSE 'rest' END AS routed FROM part)"""

QUERIES = {f.__name__: f for f in (exam_rows, schedule_rows, csv_schedule_rows, headless_schedule_rows, elective_rows, exam_tables, schedule_tables, fill_down, segment_runs, nearest_above, asof_header, keep_first, teacher_index, teacher_document, route_rules, route_many_rules, routing_counts, alias_lookup, reply_sectors, token_overlap_top3)}
SQL = {
    "exam_rows": f"WITH {_EXAM} SELECT * FROM exam",
    "schedule_rows": f"WITH {_SCHEDULE} SELECT sheet, start, r, subject, commission, day, hours, teacher FROM sched WHERE shown",
    "csv_schedule_rows": f"WITH {_SCHEDULE} SELECT CAST(sheet AS VARCHAR) AS sheet, start, r, subject, commission, day, hours, teacher FROM sched WHERE shown",
    "headless_schedule_rows": """
WITH o AS (SELECT o_orderkey // 200 AS sheet, o_orderkey % 200 AS r, trim(o_orderpriority) AS p FROM orders),
v AS (SELECT sheet, r, CASE WHEN r < 2 THEN 'nota' WHEN r = 2 THEN '- Materia  ' || sheet WHEN r > 3 AND r % 4 = 1 THEN 'Com. N° ' || (r % 5) WHEN r > 3 AND r % 11 = 0 THEN 'otra nota' END AS com, CASE WHEN r > 3 AND r % 3 <> 0 THEN ['Lunes', 'Martes'][r % 2 + 1] END AS day,
  CASE WHEN r > 3 AND r % 5 <> 0 THEN (r % 24) || ' hs' END AS hours, CASE WHEN r > 3 AND r % 6 = 1 THEN 'Roe, ' || p END AS teach FROM o),
f AS (SELECT sheet, min(r) AS first FROM v WHERE com LIKE 'Com.%' GROUP BY sheet), t AS (SELECT sheet, count_if(r = 2) > 0 AS titled FROM o GROUP BY sheet),
b AS (SELECT v.*, CASE WHEN titled THEN 'Materia ' || sheet ELSE 'Materia sin nombre' END AS subject FROM v JOIN f USING (sheet) JOIN t USING (sheet) WHERE r >= first AND (com LIKE 'Com.%' OR day IS NOT NULL OR hours IS NOT NULL OR com IS NULL AND teach IS NOT NULL)),
w AS (SELECT sheet, r, subject, last_value(com IGNORE NULLS) OVER c AS commission, day, hours, last_value(teach IGNORE NULLS) OVER c AS teacher FROM b WINDOW c AS (PARTITION BY sheet ORDER BY r ROWS UNBOUNDED PRECEDING))
SELECT CAST(sheet AS VARCHAR) AS sheet, r, subject, coalesce(commission, 'N/D') AS commission, coalesce(day, 'N/D') AS day, coalesce(hours, 'N/D') AS hours, coalesce(teacher, 'N/D') AS teacher FROM w WHERE day IS NOT NULL OR hours IS NOT NULL""",
    "elective_rows": """
WITH o AS (SELECT o_orderkey // 200 AS sheet, o_orderkey % 200 AS r, o_orderkey AS k, trim(o_orderpriority) AS p FROM orders),
v AS (SELECT o.*, CASE WHEN r % 4 <> 0 THEN p END AS t FROM o WHERE r > 0 AND r % 10 <> 9 AND sheet IN (SELECT sheet FROM o WHERE r = 0)),
e AS (SELECT sheet, r, k, 'C1' AS commission, 'Lunes' AS day, '8 hs' AS hours, 'Ana Roe' AS teacher FROM v WHERE r % 3 = 0 UNION ALL SELECT sheet, r, k, 'C2', 'Martes', '9 hs', coalesce(t, 'N/D') FROM v WHERE r % 3 = 0
  UNION ALL SELECT sheet, r, k, 'Única', 'Ver horarios', CASE WHEN r % 3 = 1 THEN 'Viernes 10 hs' ELSE '' END, coalesce(t, '') FROM v WHERE r % 3 <> 0)
SELECT CAST(sheet AS VARCHAR) AS sheet, r, 'Optativa ' || k AS subject, commission, day, hours, teacher FROM e""",
    "exam_tables": f"WITH {_EXAM}, m AS (SELECT sheet, '| Fecha | Día | Código | Materia | Hora | Inscripción |' || chr(10) || '| :--- | :--- | :--- | :--- | :--- | :--- |' || chr(10) || string_agg('| ' || coalesce(nullif(date, ''), '-') || ' | ' || coalesce(nullif(day, ''), '-') || ' | ' || code || ' | ' || subject || ' | ' || coalesce(nullif(hour, ''), '-') || ' | ' || coalesce(nullif(enrolment, ''), '-') || ' |', chr(10) ORDER BY r) AS md FROM exam GROUP BY sheet) SELECT sheet, length(md) AS length, sha256(md) AS hash FROM m",
    "schedule_tables": f"WITH {_SCHEDULE}, m AS (SELECT sheet, subject, '| Comisión | Día | Horario | Docente |' || chr(10) || '| :--- | :--- | :--- | :--- |' || chr(10) || string_agg('| ' || commission || ' | ' || day || ' | ' || hours || ' | ' || teacher || ' |', chr(10) ORDER BY r, start) AS md FROM sched WHERE shown GROUP BY sheet, subject) SELECT sheet, subject, length(md) AS length, sha256(md) AS hash FROM m",
    "fill_down": f"SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) {_W} AS last_value FROM events",
    "segment_runs": f"SELECT user_id, run, count(*) AS n, min(event_id) AS first_id FROM (SELECT user_id, event_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) {_W} AS run FROM events) GROUP BY user_id, run",
    "nearest_above": f"WITH {_SCHEDULE} SELECT sheet, hr AS r, start, subject FROM b",
    "asof_header": "SELECT e.event_id, h.event_id AS header_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) e ASOF LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE event_type = 'view') h ON e.user_id = h.user_id AND e.n >= h.n",
    "keep_first": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1",
    "teacher_index": f"""
WITH n AS (SELECT {_NAME} AS name, o_custkey % 50 AS subject, o_orderstatus AS "group", o_orderkey AS ord FROM orders), k AS (SELECT *, {s.name_key('name')} AS name_key FROM n), d AS (SELECT name_key, arg_min(name, ord) AS display FROM k GROUP BY 1)
SELECT name_key, display, subject, "group", min(ord) AS ord FROM k JOIN d USING (name_key) WHERE name_key <> '' GROUP BY ALL""",
    "teacher_document": f"""
WITH o AS (SELECT o_orderkey AS n, {_NAME.replace('o_orderpriority', 'trim(o_orderpriority)')} AS one, lower(o_orderstatus) AS st, o_custkey FROM orders),
r AS (SELECT n, CASE WHEN n % 3 = 1 THEN [one, 'roe ' || st] WHEN n % 11 = 0 THEN [] ELSE [one] END AS names, 'Materia / ' || (o_custkey % 50) AS subject, CASE WHEN n % 4 > 0 THEN 'Com. ' || (n % 4) ELSE 'N/D' END AS commission,
  CASE WHEN n % 5 > 0 AND n % 7 > 0 THEN 'Lunes — ' || (n % 7) || ' hs' WHEN n % 5 > 0 THEN 'Lunes' WHEN n % 7 > 0 THEN (n % 7) || ' hs' ELSE 'N/D' END AS time FROM o),
e AS (SELECT n, unnest(names) AS name, unnest(range(len(names))) AS i, subject, commission, time FROM r), k AS (SELECT *, {s.name_key('name')} AS key FROM e),
d AS (SELECT key, arg_min(name, n * 10 + i) AS display FROM k GROUP BY key), u AS (SELECT key, subject, commission, time, min(n * 10 + i) AS ord FROM k GROUP BY ALL),
p AS (SELECT '| ' || display || ' | ' || subject || ' | ' || commission || ' | ' || time || ' |' AS line, row_number() OVER (ORDER BY key, ord, subject, commission, time) AS place FROM u JOIN d USING (key)),
b AS (SELECT (place - 1) // 100 + 1 AS block, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY place) AS md FROM p GROUP BY 1
  UNION ALL SELECT 0, count(*), '| Docente | Materia | Comisión | Día y Horario |' || chr(10) || '| :--- | :--- | :--- | :--- |' FROM p)
SELECT block, n_lines, length(md) AS length, sha256(md) AS hash FROM b""",
    "route_rules": f"WITH {_ROUTED} SELECT p_partkey, routed FROM r",
    "route_many_rules": """
WITH t AS (SELECT p_partkey, p_brand, p_partkey || ' ' || lower(p_name) AS title FROM part), n AS (SELECT CAST(j AS VARCHAR) AS needle, (j - 100) % 40 AS k FROM range(100, 3100) x(j)),
f AS (SELECT p_partkey, min(k) AS k FROM t JOIN n ON contains(title, needle) GROUP BY p_partkey)
SELECT p_partkey, CASE WHEN lower(p_brand) LIKE '%#55%' THEN 'z01' WHEN p_partkey % 10 = 0 THEN 'z07' WHEN lower(p_brand) LIKE 'brand#1%' THEN 'z02' WHEN k IS NOT NULL THEN 'z' || lpad(CAST(k AS VARCHAR), 2, '0') ELSE 'rest' END AS routed FROM t LEFT JOIN f USING (p_partkey)""",
    "routing_counts": f"WITH {_ROUTED} SELECT d.routed, count(r.routed) AS n FROM (VALUES ('first'), ('metal'), ('third'), ('exact'), ('rest'), ('unused')) d(routed) LEFT JOIN r ON d.routed = r.routed GROUP BY d.routed",
    "alias_lookup": "SELECT doc_id, CASE lang WHEN 'en' THEN 'metal' WHEN 'fr' THEN 'third' WHEN 'de' THEN 'third' END AS sector FROM documents",
    "reply_sectors": "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND doc_id % 10 >= 6 AND doc_id % 3 < 2 THEN ['first', 'metal'][doc_id % 3 + 1] ELSE 'rest' END AS sector FROM documents",
    "token_overlap_top3": f"""
WITH k AS (SELECT doc_id AS id, {s.keywords('split_part(text, chr(10), 1)')} AS w FROM documents), a AS (SELECT id AS left_id, unnest(w) AS word FROM k WHERE id % 20 = 0), b AS (SELECT id AS right_id, unnest(list_distinct(w)) AS word FROM k),
c AS (SELECT left_id, right_id, count(*) AS score FROM a JOIN b USING (word) WHERE left_id <> right_id GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS rank FROM c)
SELECT left_id, rank, right_id, score FROM r WHERE rank <= 3""",
}
