"""Boilerplate lines, found by how many sites hold them.

For every distinct line two HyperLogLog sketches are built, one of its sites and one of the
texts it stands in; its spread is the smaller of the two counts, so that a text copied from
site to site does not make its own lines boilerplate. Sketches of one line merge in the
aggregation: a line that a third of all rows hold reaches the shuffle once per task. Lines
whose estimates are clear of the limit by more than the sketches can err are decided by
them; for lines near it the sites and texts are counted exactly.

Lines at or over the limit are removed everywhere but in their home, the document with the
smallest id that holds them, so no line vanishes from the corpus. Lines are the same if
they differ in blanks around them only, and every line that is not blank takes part.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import fewer, line_key, narrow, stored, unused

SITES, BLANKS = 5, " \t\r"
#: Boilerplate lines in one file, at least, if there are as many.
LINES_AT_ONCE = 50_000
#: 2^12 registers: a standard error of 1.6 percent, so 8 percent are five of them.
SKETCH_BITS, MARGIN = 12, 0.08


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def held_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, site, text_hash, h1, h2`` for every line that is not blank."""
    lines = docs.select("doc_id", F.coalesce("site", F.lit("")).alias("site"), F.xxhash64("text").alias("text_hash"),
                        F.explode(split_lines(F.col("text"))).alias("line"))
    lines = lines.withColumn("line", trimmed(F.col("line"))).filter(F.length("line") > 0)
    return lines.select("doc_id", "site", "text_hash", *line_key(F.col("line")))


def spreads(lines: DataFrame, sites: int) -> DataFrame:
    """``h1, h2, home, spread``: of each line that may reach the limit, by its sketches."""
    return (lines.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("home"), F.count("*").alias("n"),
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sites"), F.hll_sketch_agg("text_hash", SKETCH_BITS).alias("texts"))
        .filter(F.col("n") >= sites)
        .withColumn("spread", F.least(F.hll_sketch_estimate("sites"), F.hll_sketch_estimate("texts")))
        .filter(F.col("spread") >= sites * (1 - MARGIN)).select("h1", "h2", "home", "spread"))


def exact_spreads(lines: DataFrame, near: DataFrame) -> DataFrame:
    """``h1, h2, exact``, combined before each shuffle."""
    wanted = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
    n_sites = wanted.groupBy("h1", "h2", "site").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("*").alias("n_sites"))
    n_texts = wanted.groupBy("h1", "h2", "text_hash").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("*").alias("n_texts"))
    return n_sites.join(n_texts, ["h1", "h2"]).select("h1", "h2", F.least("n_sites", "n_texts").alias("exact"))


def boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``h1, h2, home`` of the lines at or over the limit. Of ``doc_id, text, site``."""
    lines = held_lines(docs)
    candidates = stored(spreads(lines, sites))
    clear = F.col("spread") > sites * (1 + MARGIN)
    counted = exact_spreads(lines, candidates.filter(~clear)).filter(F.col("exact") >= sites)
    found = candidates.filter(clear).select("h1", "h2", "home").union(
        candidates.filter(~clear).join(counted, ["h1", "h2"]).select("h1", "h2", "home"))
    return fewer(found, candidates.count(), LINES_AT_ONCE)


def remove_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES,
                       n_lines: str = "__n_lines", n_removed: str = "__n_removed") -> DataFrame:
    """Every row with its own columns, the text without its boilerplate lines, and its number of
    lines and of those removed, under the names given.

    Documents that hold none are not changed; a text may become empty, its row stays. A null
    text stays null and has no lines; an empty one has one empty line. A null site is a site
    of its own. Rows without an id are never a home. Repeated rows are one text on one site,
    and stay repeated. Columns may have any names but those two; an empty table stays empty.
    """
    rows = narrow(docs, doc_id=doc_id, text=text, site=site)
    found = stored(boilerplate(rows, sites))
    lines, left, gone, other = unused(docs, "__lines", "__left", "__gone", "__id")
    bad = (held_lines(rows).join(found, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("home")))
           .groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias(gone)).withColumnRenamed("doc_id", other))
    own = F.col(f"`{text}`")
    stay = F.filter(lines, lambda x: ~F.array_contains(gone, F.struct(*line_key(trimmed(x)))) | (F.length(trimmed(x)) == 0))
    joined = docs.join(bad, F.col(f"`{doc_id}`").eqNullSafe(F.col(other)), "left").withColumn(lines, split_lines(own))
    joined = joined.withColumn(left, F.when(F.col(gone).isNotNull(), stay).otherwise(F.col(lines)))
    kept = F.when(F.col(gone).isNull(), own).otherwise(F.array_join(left, "\n"))
    counted = F.when(own.isNull(), 0).otherwise(F.size(lines)).alias(n_lines)
    removed = (F.size(lines) - F.size(left)).alias(n_removed)
    return joined.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], counted, removed)


def strip_documents(docs: DataFrame) -> DataFrame:
    """The documents with their columns, texts and ``n_chars`` after removal of boilerplate lines.

    Nulls, repeated rows, empty tables and other columns as ``remove_boilerplate`` has them; ``n_chars``
    of a text that has lost nothing is left as it was."""
    n_lines, n_removed = unused(docs, "__n_lines", "__n_removed")
    stripped = remove_boilerplate(docs, n_lines=n_lines, n_removed=n_removed)
    count = F.length("text").cast("long")
    return stripped.select(*[F.when(F.col(n_removed) > 0, count).otherwise(F.col("n_chars")).alias(c) if c == "n_chars"
                             else F.col(f"`{c}`") for c in docs.columns])
