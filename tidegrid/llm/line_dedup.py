"""Cross-site boilerplate lines, found by the number of distinct sites that a line is on.

A line's key is its text without outer spaces; blank lines are never boilerplate. A HyperLogLog sketch of the
sites is aggregated per line hash (a pair of hashes, 96 bits), so a line on a third of all documents is one small
sketch per task. Lines whose estimate is within ``BAND`` of the threshold get an exact distinct count; estimates
beyond the band are further off than the sketch can err. A line on ``SITES`` sites or more is boilerplate: it
stays at its first place in the document with the smallest id that has it, and is removed everywhere else.

DataFrame functions only. Lines travel as hashes; texts are joined once with the places that each document loses.

Defined cases: a null text stays null; null sites are not counted; a document without lines left has an empty text
and stays; rows without id lose their boilerplate, and a line that only they have is kept nowhere; rows that
repeat an id are treated alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stage

SITES = 10
SKETCH = 12
# Share of the threshold on both sides in which counts are made exact; the sketch's standard error is 1.6 %.
BAND = 0.1
# Lines of more words are passages, for ``strip_passages``.
PASSAGE_WORDS = 50


def _hash(line: Column, over: int = 0) -> Column:
    """Hash of a line that is not blank and, with ``over``, has more words than that."""
    key = F.trim(line)
    wanted = key != ""
    if over:
        wanted &= F.size(F.split(F.regexp_replace(key, r"^\s+|\s+$", ""), r"\s+")) > over
    return F.when(wanted, F.struct(F.xxhash64(key).alias("x"), F.hash(key).alias("m")))


def _row_key() -> list[Column]:
    """What names a row: its id and its text's hash."""
    return [F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text")]


def boilerplate(lines: DataFrame, sites: int = SITES, sketch: int = SKETCH, band: float = BAND) -> DataFrame:
    """(line, first) of lines (line, site, doc_id) on at least ``sites`` sites; first is the smallest doc_id."""
    width = max(1.0, sites * band)
    estimates = (
        lines.groupBy("line").agg(F.hll_sketch_agg("site", sketch).alias("sketch"), F.min("doc_id").alias("first"))
        .select("line", "first", F.hll_sketch_estimate("sketch").alias("n")).where(F.col("n") >= sites - width)
    )
    likely = stage(estimates, "lines")
    near = likely.where(F.col("n") <= sites + width)
    exact = (
        lines.where("site IS NOT NULL").join(near.select("line"), "line", "left_semi").select("line", "site").distinct()
        .groupBy("line").count().where(F.col("count") >= sites).select("line")
    )
    sure = likely.where(F.col("n") > sites + width).select("line", "first")
    return sure.unionByName(near.join(exact, "line", "left_semi").select("line", "first"))


def strip(docs: DataFrame, sites: int = SITES, site: str = "source", counts: bool = False) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``; ``counts`` adds n_lines and n_removed, in place of columns of these names."""
    parted = docs.select(*_row_key(), "doc_id", F.col(site).cast("string").alias("site"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = parted.select("key_id", "key_text", "doc_id", "site", "pos", _hash(F.col("line")).alias("line")).where("line IS NOT NULL")
    common = stage(boilerplate(lines, sites), "boilerplate")
    return _without(docs, lines, common, F.coalesce(F.col("key_id") == F.col("first"), F.lit(False)), counts)


def strip_passages(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` without repeated lines of over ``words`` words: such a line stays in the first of the rows that have it.

    It is enough that two rows have the line, on whatever sites. The first row is that of the smallest id, of equal ids
    that of the smallest text hash; rows without id come last. Only whole lines count.
    """
    parted = docs.select(*_row_key(), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = parted.select("key_id", "key_text", "pos", _hash(F.col("line"), words).alias("line")).where("line IS NOT NULL")
    place = F.struct(F.col("key_id").isNull().alias("no_id"), "key_id", "key_text")
    common = lines.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("NOT first <=> last").select("line", "first")
    return _without(docs, lines, stage(common, "passages"), place.eqNullSafe(F.col("first")), False)


def _without(docs: DataFrame, lines: DataFrame, common: DataFrame, is_first: Column, counts: bool) -> DataFrame:
    """``docs`` without the lines in ``common``, but for their first place in the rows where ``is_first`` holds.

    ``lines`` has the place of each line. A row gets the places that it loses, and keeps the others in one step, so the
    work grows with its lines.
    """
    key = ["key_id", "key_text"]
    places = F.array_sort(F.collect_set("pos"))
    found = lines.select(*key, "pos", "line").join(common, "line").select(*key, "pos", "line", is_first.alias("kept"))
    # Rows that are equal have the same places.
    per_line = found.groupBy(*key, "line", "kept").agg(places.alias("at"))
    lost = F.when(F.col("kept"), F.slice("at", F.lit(2), F.size("at"))).otherwise(F.col("at"))
    own = per_line.select(*key, F.explode(lost).alias("pos")).groupBy(*key).agg(F.collect_list("pos").alias("lost"))
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    joined = docs.select(*_row_key(), row).alias("d").join(
        own.alias("o"), F.col("d.key_id").eqNullSafe(F.col("o.key_id")) & F.col("d.key_text").eqNullSafe(F.col("o.key_text")), "left"
    ).select("row", "lost", F.split("row.text", "\n", -1).alias("lines"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    left = F.array_join(F.transform(stays, lambda at: F.get("lines", at)), "\n")
    text = F.when(F.col("lost").isNull(), F.col("row.text")).otherwise(left)
    added = {}
    if counts:
        added["n_lines"] = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
        added["n_removed"] = F.coalesce(F.size("lost"), F.lit(0)).cast("long")
    columns = [text.alias("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in docs.columns if name not in added]
    return joined.select(*columns, *(column.alias(name) for name, column in added.items()))
