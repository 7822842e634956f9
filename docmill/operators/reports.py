"""Freshness and rendered Markdown (FRS, ORD, RND, SNK-06, SNK-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.dates import whole_days
from docmill.operators.ranks import numbered

DRAFT = r"(?iu)PENDIENTE — draft autogenerado(?: el)? (\d{4}-\d{2}-\d{2})"
REVIEWED = r"(?iu)\*\*Última revisión humana\*\*:?\s*(\d{4}-\d{2}-\d{2})"


def freshness(items: DataFrame, sources: DataFrame, state: DataFrame, today: str) -> DataFrame:
    """One row per indexed document with its staleness by people and by machine (FRS-01, JOI-11, DAT-03), icons (FRS-02) and the four sort keys' order (ORD-01).

    items: path, title, category, md. sources: path, slug, ord (the first of a path counts). state: slug,
    checked (timestamp). No date means never, which sorts before all numbers of days.
    """
    source = sources.groupBy("path").agg(F.min_by("slug", "ord").alias("slug"))
    both = items.join(source, "path", "left").join(state.select("slug", "checked"), "slug", "left")
    draft, review = (F.nullif(F.regexp_extract(F.coalesce("md", F.lit("")), p, 1), F.lit("")) for p in (DRAFT, REVIEWED))
    human = F.coalesce(draft, review).try_cast("timestamp")
    now = F.lit(today).cast("timestamp")
    out = both.select(
        "path", "title", "category",
        F.when(draft.isNotNull(), "draft").when(review.isNotNull(), "reviewed").otherwise("pending").alias("review_status"),
        whole_days(now, human).alias("human_days"), whole_days(now, F.col("checked")).alias("auto_days"),
    )
    red = F.col("human_days").isNull() | (F.col("human_days") > 180)
    out = out.withColumn("human_icon", F.when(red, "red").when(F.col("review_status") == "draft", "yellow").otherwise("green"))
    out = out.withColumn("auto_icon", F.when(F.col("auto_days").isNull() | (F.col("auto_days") > 14), "red").otherwise("green"))
    return out.withColumn("priority", F.when(F.col("review_status") == "reviewed", 1).otherwise(0))


def by_urgency(report: DataFrame) -> DataFrame:
    """The report in its order: unreviewed first, then the stalest, then path (ORD-01)."""
    return report.orderBy("priority", F.desc_nulls_first("human_days"), F.desc_nulls_first("auto_days"), "path")


def urgency_place(report: DataFrame, by: str) -> DataFrame:
    """report with place, its order by_urgency() within each group (ORD-01).

    Rows of equal priority and days are counted first, and the running sums of these counts, which are few,
    give where each such run starts; so a window holds one run of a group, never the group.
    """
    n = report.groupBy(by, "priority", "human_days").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("priority", F.desc_nulls_first("human_days")).rowsBetween(Window.unboundedPreceding, -1)
    starts = n.select(F.col(by).alias("_by"), F.col("priority").alias("_priority"), F.col("human_days").alias("_days"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("priority") == F.col("_priority")) & F.col("human_days").eqNullSafe(F.col("_days"))
    run = Window.partitionBy(by, "priority", "human_days").orderBy(F.desc_nulls_first("auto_days"), "path")
    return report.withColumn("_run", F.row_number().over(run)).join(starts, same).withColumn("place", F.col("_start") + F.col("_run")).select(*report.columns, "place")


def by_name(df: DataFrame, column: str, locale: str = "es") -> DataFrame:
    """In the order of a language, not of code points (ORD-02)."""
    return df.orderBy(F.expr(f"`{column}` COLLATE {locale}"))


def name_rank(df: DataFrame, column: str, by: list[str], locale: str = "es") -> DataFrame:
    """df with place, the order of by_name() inside each group (ORD-02)."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.expr(f"`{column}` COLLATE {locale}"), column)))


def md_row(*cells: Column) -> Column:
    """One line of a Markdown table; empty cells are a hyphen."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("-")) for c in cells]), F.lit(" |"))


def md_table(rows: DataFrame, by: list[str], order: list[str], header: dict[str, Column]) -> DataFrame:
    """(by, md) with one Markdown table per group, its rows in order (RND-01, RND-02, EXP-12)."""
    head = "| " + " | ".join(header) + " |\n| " + " | ".join([":---"] * len(header)) + " |\n"
    lines = F.transform(F.sort_array(F.collect_list(F.struct(*order, md_row(*header.values()).alias("line")))), lambda x: x.line)
    return rows.groupBy(*by).agg(F.concat(F.lit(head), F.array_join(lines, "\n")).alias("md"))


def blocks(lines: DataFrame, order: list[str], header: str, size: int = 1000, empty: str = "") -> DataFrame:
    """(block, n_lines, md): a document whose lines may be more than a task holds, in the order of some columns (AGG-07, ORD-02).

    lines: a column line, and those of the order. Block 0 is the manifest: the header, or the text for an empty
    document, and the number of all lines. Blocks 1, 2, ... hold ``size`` lines each; all blocks joined by line breaks are
    the document. Places come from ranges of the order, so no task sees more than its range or block.
    """
    placed = numbered(lines.select(*order, "line"), order, "place")
    body = placed.groupBy((F.floor((F.col("place") - 1) / size) + 1).alias("block")).agg(F.count("*").alias("n_lines"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x.line), "\n").alias("md"))
    head = lines.agg(F.count("*").alias("n_lines")).select(F.lit(0).cast("long").alias("block"), "n_lines", F.when(F.col("n_lines") > 0, header).otherwise(empty).alias("md"))
    return head.unionByName(body)


def document(title: Column, parts: dict[str, Column], closing: Column) -> Column:
    """A Markdown document: title, one section for each part that isn't empty, closing line (RND-03 to RND-05, SNK-02)."""
    body = [F.when(F.coalesce(p, F.lit("")) != "", F.concat(F.lit(f"## {name}\n\n"), p)) for name, p in parts.items()]
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), *body, closing)


def summary(counts: DataFrame, label: str, value: str) -> DataFrame:
    """One row with a Markdown list of counts in the order of their names (RND-06, SNK-06)."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct(F.col(label).alias("k"), F.concat(F.lit("- **"), label, F.lit("**: "), F.col(value).cast("string")).alias("line")))), lambda x: x.line)
    return counts.agg(F.array_join(lines, "\n").alias("md"))


def preview(md: Column, n: int = 8) -> Column:
    """The first lines (ORD-04)."""
    return F.array_join(F.slice(F.split(md, "\n", -1), 1, n), "\n")
