"""Removal of lines that many sites share, by sketches of distinct sites.

Lines are cut at line feeds and compared without the white space around them. A line's spread is the
number of distinct sites it stands on; HyperLogLog sketches per line hash, merged by aggregation, estimate
it. Lines whose estimate is near a threshold get exact distinct counts.

Copies of a document share lines too, and are not boilerplate. Therefore two more sketches count a
line's distinct surroundings (the lines before and after it) and the distinct texts that hold it:
boilerplate stands in ``SITES`` sites or more, in as many different surroundings, and in different ones
in at least half of its texts, while the lines of a copied document keep their neighbours.

Only lines that occur often enough to reach the threshold are sketched; occurrences are counted by a partial
aggregation first. Where the lines meet that count, each is dealt to ``SALTS`` tasks by its text, so that a line that a
third of all documents hold is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.llm.tables import join_rows, placed, stored

SITES = 10
SHARE = 0.5
NEAR = 0.25  # far above the sketch's error of 1.6 %
LG_K = 12
SALTS = 16


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")


def _lines(docs: DataFrame) -> DataFrame:
    """``line, around, whole, site``: a hash of each line, of its neighbours and of its text."""
    cut = docs.select(
        F.transform(F.split("text", "\n"), lambda x: F.xxhash64(_bare(x))).alias("all"),
        F.xxhash64("text").alias("whole"), F.xxhash64("site").alias("site"),
    )
    near = lambda step: F.get("all", F.col("i") + step)
    return cut.select("all", "whole", "site", F.posexplode("all").alias("i", "line")).where(F.col("line") != F.xxhash64(F.lit(""))).select(
        "line", F.xxhash64(near(-1), near(1)).alias("around"), "whole", "site"
    )


def boilerplate(docs: DataFrame, sites: int = SITES, share: float = SHARE) -> DataFrame:
    """``(line)``: hashes of the lines that spread over many sites; see the module."""
    lines = _lines(docs)
    often = lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    often = often.select("line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = lines.withColumn("salt", F.pmod("whole", F.lit(SALTS)).cast("int"))
    seen = stored(dealt.join(often, ["line", "salt"], "left_semi").drop("salt").distinct(), "lines")
    counted = ("site", "around", "whole")
    sketched = seen.groupBy("line").agg(
        *(F.hll_sketch_estimate(F.hll_sketch_agg(c, LG_K)).alias(c) for c in counted)
    )

    def spread(slack: float) -> Column:
        enough = [F.col(c) >= sites * slack for c in counted]
        return enough[0] & enough[1] & (F.col("around") >= F.col("whole") * share * slack)

    graded = sketched.where(spread(1 - NEAR)).select("line", spread(1 + NEAR).alias("far"))
    near = graded.where(~F.col("far")).select("line")
    exact = seen.join(near, "line", "left_semi").groupBy("line").agg(*(F.countDistinct(c).alias(c) for c in counted))
    return graded.where("far").select("line").unionAll(exact.where(spread(1.0)).select("line"))


def line_dedup(docs: DataFrame, site: str = "source", sites: int = SITES, share: float = SHARE) -> DataFrame:
    """Per document ``doc_id, n_lines, n_removed, text``: the text without cross-site boilerplate lines.

    The other lines stay as they are, in order, empty ones too. A null text stays null, with no lines; an
    empty text has one empty line. A null site is a site. Texts are taken whole; columns other than
    ``doc_id``, ``text`` and ``site`` are ignored; no rows give no rows. A document may end up empty. Rows with the
    same doc_id or none are cleaned each for itself.
    """
    told = _cut(placed(docs, F.col(site).cast("string").alias("site")), sites, share)
    return told.select("doc_id", "n_lines", "n_removed", "text")


def clean_lines(docs: DataFrame, site: str = "source") -> DataFrame:
    """The rows of ``docs``, all their columns, with the cleaned text and, where there is one, its ``n_chars``."""
    taken = {"doc_id", "text"}
    others = [F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in taken)).alias("others")] if set(docs.columns) - taken else []
    told = _cut(placed(docs, F.col(site).cast("string").alias("site"), *others), SITES, SHARE)
    lengths = {"n_chars": F.length("text").cast("long")}
    return told.select(*(
        lengths.get(c, F.col(c) if c in taken else F.col(f"others.`{c}`")).alias(c) for c in docs.columns
    ))


def _cut(docs: DataFrame, sites: int, share: float) -> DataFrame:
    """``docs`` with the cleaned text, ``n_lines`` and ``n_removed``."""
    found = stored(boilerplate(docs, sites, share), "boilerplate")
    cut = docs.select("doc_id", "place", F.posexplode_outer(F.split("text", "\n")).alias("i", "body"))
    hashed = cut.select("doc_id", "place", "i", F.xxhash64(_bare(F.col("body"))).alias("line")).where("i IS NOT NULL")
    # Only the places of boilerplate lines are shuffled by document, not the lines.
    gone = hashed.join(found, "line").groupBy("doc_id", "place").agg(F.collect_set("i").alias("gone"))
    joined = join_rows(docs, gone, "left").withColumns(
        {"lines": F.split("text", "\n"), "gone": F.coalesce("gone", F.array().cast("array<int>"))}
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(left, lambda i: F.get("lines", i))
    return joined.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long"),
        "n_removed": F.size("gone").cast("long"),
        "text": F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")),
    })


ORACLE_SQL = rf"""
WITH cut AS (
    SELECT doc_id, text, source, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, text, source, unnest(list_transform(parts, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS line,
           unnest(range(len(parts))) AS i FROM cut WHERE text IS NOT NULL
), placed AS (
    SELECT *, lag(line) OVER w AS before, lead(line) OVER w AS after FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), spread AS (
    SELECT line, count(DISTINCT coalesce(source, chr(0))) AS sites, count(DISTINCT text) AS texts,
           count(DISTINCT {{'b': coalesce(before, chr(0)), 'a': coalesce(after, chr(0))}}) AS around
    FROM placed WHERE line <> '' GROUP BY line
), gone AS (
    SELECT line FROM spread WHERE sites >= {SITES} AND around >= {SITES} AND around >= {SHARE} * texts
), marked AS (
    SELECT doc_id, i, line IN (SELECT line FROM gone) AS out FROM lines
), parts AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed, list(i) FILTER (WHERE NOT out) AS stay
    FROM marked GROUP BY doc_id
)
SELECT c.doc_id, coalesce(p.n_lines, 0) AS n_lines, coalesce(p.n_removed, 0) AS n_removed,
       CASE WHEN c.text IS NULL OR coalesce(p.n_removed, 0) = 0 THEN c.text
            ELSE array_to_string(list_transform(list_sort(coalesce(p.stay, [])), lambda k: c.parts[k + 1]), chr(10)) END AS text
FROM cut c LEFT JOIN parts p USING (doc_id)
"""
