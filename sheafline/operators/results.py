"""A result set of seven tables, checked as a whole: keys, references and ranges in one pass, and what may be shown of each bin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import written

# The tables of a result set, the columns that each needs, and the ones that identify a row.
TABLES = {
    "bins": (("bin_id", "status"), ("bin_id",)),
    "definitions": (("pathway", "component"), None),
    "summary": (("bin_id", "pathway", "panel_percent"), ("bin_id", "pathway")),
    "hits": (("bin_id", "protein", "status", "target_call"), None),
    "components": (("bin_id", "component"), ("bin_id", "component")),
    "neighborhoods": (("bin_id",), None),
    "operons": (("bin_id",), None),
}
SHOWN = ("current", "preview_unverified")


def _checked(name: str, table: DataFrame) -> DataFrame:
    """A row for each row of a table: its bin, its key as text where rows must differ, and whether a value is out of range."""
    needed, key = TABLES[name]
    if missing := [c for c in needed if c not in table.columns]:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    percent = F.col("panel_percent").cast("string").try_cast("double") if name == "summary" else F.lit(None).cast("double")
    return table.select(
        F.lit(name).alias("table"),
        (text("bin_id") if "bin_id" in needed else F.lit(None).cast("string")).alias("bin"),
        (F.concat_ws("/", *map(text, key)) if key else F.lit(None).cast("string")).alias("key"),
        F.coalesce(~percent.between(0, 100) & ~F.isnan(percent) & (F.abs(percent) < float("inf")), F.lit(False)).alias("out_of_range"),
    )


def faults(tables: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """All that is wrong with a result set (table, key, problem, n), and the number of rows of each table.

    The seven tables become one table of constraint rows, which is written once; the counts are observed on the way. Of it, rows of a
    key are counted, combined before the shuffle, and bins are looked up by name. A number that cannot be read is no fault.
    """
    if missing := [t for t in TABLES if t not in tables]:
        raise ValueError(f"missing tables: {', '.join(missing)}")
    rows = None
    for name in TABLES:
        part = _checked(name, tables[name])
        rows = part if rows is None else rows.unionByName(part)
    seen = Observation("results")
    counted = written(rows.observe(seen, *[F.count(F.when(F.col("table") == t, 1)).alias(t) for t in TABLES]), "constraints")
    twice = counted.where("key IS NOT NULL").groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").select("table", "key", F.lit("given more than once").alias("problem"), "n")
    per_bin = counted.where("table <> 'bins' AND bin IS NOT NULL").groupBy("table", F.col("bin").alias("key")).agg(F.count("*").alias("n"))
    known = counted.where("table = 'bins'").select(F.col("bin").alias("key")).distinct()
    unknown = per_bin.join(known, "key", "left_anti").select("table", "key", F.lit("unknown bin").alias("problem"), "n")
    wrong = counted.where("out_of_range").groupBy("table", "key").agg(F.count("*").alias("n")).select("table", "key", F.lit("percentage outside 0-100").alias("problem"), "n")
    return twice.unionByName(unknown).unionByName(wrong), {t: seen.get[t] for t in TABLES}


def bin_states(bins: DataFrame, recorded: DataFrame, current: DataFrame, verify: bool = True) -> DataFrame:
    """The bins with source_state and trusted: whether the recorded digest (bin_id, digest) of a bin's input is that of its file now.

    Without a check of inputs all are previews; a bin without a file is missing, one without a record unverified. Failed bins are not trusted.
    """
    j = bins.join(recorded.select("bin_id", F.col("digest").alias("_old")), "bin_id", "left").join(current.select("bin_id", F.col("digest").alias("_new")), "bin_id", "left")
    state = F.when(F.lit(not verify), "preview_unverified").when(F.col("_new").isNull(), "missing_bin").when(F.col("_old").isNull(), "unverified").when(F.col("_old") == F.col("_new"), "current").otherwise("stale_input")
    return j.withColumn("source_state", state).withColumn("trusted", F.col("source_state").isin(*SHOWN) & F.coalesce(F.col("status") != "failed", F.lit(True))).drop("_old", "_new")


def shown(tables: dict[str, DataFrame], states: DataFrame) -> dict[str, DataFrame]:
    """The result set as it may be shown: of bins that are not trusted the summary keeps its rows with their state in place of its values, the
    other tables lose theirs; bins gain counts of accepted models and proteins and of hits to review."""
    out = dict(tables)
    known = states.select("bin_id", "trusted", "source_state", F.when(F.col("status") == "failed", "bin_failed").otherwise(F.col("source_state")).alias("_why"))
    summary = tables["summary"].join(known, "bin_id")
    values = [c for c in tables["summary"].columns if c not in ("bin_id", "pathway", "panel_status", "route_status", "panel_percent")]
    out["summary"] = summary.select(
        "bin_id", "pathway", F.when(F.col("trusted"), F.col("panel_percent").cast("string").try_cast("double")).alias("panel_percent"),
        *[(F.when(F.col("trusted"), F.col(c)).otherwise(F.col("_why")) if c in tables["summary"].columns else F.when(~F.col("trusted"), F.col("_why"))).alias(c) for c in ("panel_status", "route_status")],
        *[F.when(F.col("trusted"), F.col(c)).alias(c) for c in values], "source_state",
    )
    good = known.where("trusted").select("bin_id")
    for name in ("hits", "components", "neighborhoods", "operons"):
        out[name] = tables[name].join(good, "bin_id", "left_semi")
    accepted = F.col("status") == "accepted"
    per = out["hits"].groupBy("bin_id").agg(F.count(F.when(accepted, 1)).alias("accepted_models"), F.countDistinct(F.when(accepted, F.col("protein"))).alias("accepted_proteins"), F.count(F.when(~accepted | (F.col("target_call") != "specific"), 1)).alias("review_hits"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out["bins"] = states.join(per, "bin_id", "left").select(*states.columns, *map(zero, ("accepted_models", "accepted_proteins", "review_hits")))
    return out
