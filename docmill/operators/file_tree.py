"""The state of a tree of files from run to run (INC-03, INC-04, FLT-07, JOI-06): complete rows, not only what happened to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a state besides the key id; a listing has them up to link, and duplicate.
FIELDS = {"name": "string", "mime": "string", "modified": "timestamp", "path": "string", "slug": "string", "sector": "string", "status": "string", "hash": "string", "explanation": "string", "error": "string", "link": "string", "last_processed": "timestamp"}
# Statuses of a file.
CANDIDATE, UNWRITTEN, DUPLICATE, FAILED, DELETED = "candidate", "pending-write", "skipped (duplicate)", "error", "deleted"


def _whole(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """df with id and all fields; those that it lacks are null."""
    return df.select("id", *(F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in fields.items()))


def next_state(listing: DataFrame, state: DataFrame, now: str, force: bool = False, write: bool = True) -> DataFrame:
    """The state after a run, with what the run did to each file (outcome).

    listing: id, modified, slug, path, hash of the text, duplicate and explanation (what a checker said), error,
    and other FIELDS. state: the rows of the last run. now: the time of the run.

    * unchanged: known with the same time and slug, and not forced. The row stays as it is.
    * failed: there is an error. A known file's row stays as it is, a new one gets the status error.
    * same: other time or slug, but the same hash, and not forced. Time, path and slug are taken over; the
      status stays, whatever it was.
    * duplicate, processed: a new row; write=False makes it pending instead of a candidate.
    * deleted: known but not listed. A tombstone stays, with all that was known; gone: it was one already.

    Of listed rows with one id the one with the latest time counts, of those the one with the largest path;
    rows without an id are new each time. An empty listing deletes all; an empty state makes all files new.
    One join; whatever the checkers cost has been paid before, so give them only what changed() lets through.
    """
    listed = _whole(listing, {**FIELDS, "duplicate": "boolean"}).drop("status", "last_processed")
    known = listed.where("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct(*listed.columns), F.struct("modified", "path")).alias("new")).select("id", "new")
    nameless = listed.where("id IS NULL").select("id", F.struct(*listed.columns).alias("new"))
    old = _whole(state, FIELDS).select("id", F.struct("id", *FIELDS).alias("old"))
    both = known.unionByName(nameless).join(old, "id", "full_outer").select("new", "old")
    at = F.lit(now).cast(state.schema["last_processed"].dataType if "last_processed" in state.columns else "timestamp")
    new, old_ = F.col("new"), F.col("old")
    same_hash = F.coalesce(old_["hash"] == new["hash"], F.lit(False)) & F.lit(not force)
    outcome = (
        F.when(new.isNull() & (old_["status"] == DELETED), "gone")
        .when(new.isNull(), "deleted")
        .when(old_.isNotNull() & ~_moved(force), "unchanged")
        .when(new["error"].isNotNull(), "failed")
        .when(same_hash, "same")
        .when(F.coalesce(new["duplicate"], F.lit(False)), "duplicate")
        .otherwise("processed")
    )
    seen = ("id", "name", "mime", "modified", "path", "slug")
    kinds = {f.name: f.dataType for f in both.schema["old"].dataType}

    def fresh(status: str, *kept: str) -> Column:
        """A row of a listed file, with a status and those of its other fields that the status keeps."""
        values = {c: new[c] for c in (*seen, *kept)} | {"status": F.lit(status), "last_processed": at}
        return F.struct(*(values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in ("id", *FIELDS)))

    row = (
        F.when(F.col("outcome").isin("gone", "unchanged"), old_)
        .when(F.col("outcome") == "deleted", old_.withField("status", F.lit(DELETED)).withField("last_processed", at))
        .when((F.col("outcome") == "failed") & old_.isNotNull(), old_)
        .when(F.col("outcome") == "failed", fresh(FAILED, "error"))
        .when(F.col("outcome") == "same", old_.withField("modified", new["modified"]).withField("path", new["path"]).withField("slug", new["slug"]).withField("last_processed", at))
        .when(F.col("outcome") == "duplicate", fresh(DUPLICATE, "hash", "explanation"))
        .otherwise(fresh(CANDIDATE if write else UNWRITTEN, "sector", "hash", "link"))
    )
    return both.withColumn("outcome", outcome).select(row.alias("row"), "outcome").select("row.*", "outcome")


def _moved(force: bool) -> Column:
    return F.lit(force) | ~F.col("new")["modified"].eqNullSafe(F.col("old")["modified"]) | ~F.col("new")["slug"].eqNullSafe(F.col("old")["slug"])


def changed(listing: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """The listed rows that a run has to read (FLT-07): new ones, and those whose time or slug is another; all if forced."""
    if force:
        return listing
    old = state.select("id", F.col("modified").alias("_modified"), F.col("slug").alias("_slug"))
    same = listing["modified"].eqNullSafe(old["_modified"]) & listing["slug"].eqNullSafe(old["_slug"])
    return listing.join(old, (listing["id"] == old["id"]) & same, "left_anti")
