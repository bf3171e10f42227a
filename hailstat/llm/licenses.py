"""License text in documents, by an exact set-similarity join of text blocks with license templates.

A block is a paragraph, the text between lines without words. It matches a template if one of its lines, or,
as notices are wrapped, ``SPAN`` times as many consecutive words of it as the template has, hold at least
``CONTAINMENT`` of the template's distinct words. Words are ordered by their count over all documents, rarest first.
Of a template with n words of which k are needed, any match shares one of its first n - k + 1 (the prefix
filter); the block has k words or more (the length filter); and the words of the template from that first
shared one on must be k or more (the positional filter). Candidates are verified on the whole sets, then line by line and span by span.

All steps are DataFrame operations. Texts are searched without regard to ASCII case, never copied in lower
case; only blocks with a prefix word are looked at more closely, and each meets a template once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.llm.tables import documents, running_sums, stored

CONTAINMENT = 0.9
SPAN = 2  # leaves room for words that stand at the margin of wrapped lines
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences that name a license, and its label.
TEMPLATES = [
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license version 2 1", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The lower-case words of a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), lowered)


def any_of(listed: list[str]) -> Column:
    """A pattern for whole words of a list, in any ASCII case."""
    letter = WORD[:-1]
    return F.lit(f"(?i)(?<!{letter})(?:{'|'.join(sorted(listed))})(?!{letter})")


def default_templates(spark) -> DataFrame:
    return spark.createDataFrame([(i, t, label) for i, (t, label) in enumerate(TEMPLATES)], "template_id int, template string, label string")


def block_matches(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, block, template_id, label, containment)`` of every block and template that match.

    ``templates`` has ``template_id, template, label``; null, empty and wordless templates match nothing,
    equal ones all match. A null text has no blocks.
    """
    needed = F.ceil(F.lit(containment) * F.size("set") - 1e-9).cast("int")
    sets = templates.select("template_id", "label", F.array_distinct(words(F.col("template"))).alias("set"), (SPAN * F.size(words(F.col("template")))).alias("span")).where(F.size("set") > 0)
    sets = stored(sets.withColumn("needed", F.greatest(F.lit(1), needed)), "templates")
    vocabulary = sets.select(F.explode("set").alias("word")).distinct()

    listed = [r[0] for r in vocabulary.collect()]  # words of the templates
    paragraphs = documents(docs).select("doc_id", F.posexplode(F.split("text", GAP)).alias("block", "body"))
    if not listed:
        return paragraphs.where("false").selectExpr("doc_id", "block", "0 AS template_id", "'' AS label", "0D AS containment")

    # Counts of these words over all documents, folded before the shuffle.
    every = documents(docs).select(F.explode(F.regexp_extract_all("text", any_of(listed), F.lit(0))).alias("word"))
    counts = every.groupBy("word").agg(F.count("*").alias("n")).groupBy(lowered(F.col("word")).alias("word")).agg(F.sum("n").alias("n"))
    order = vocabulary.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    ranked = (
        sets.select("template_id", F.explode("set").alias("word"))
        .join(order, "word")
        .groupBy("template_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]).alias("ranked"))
    )
    prefixes = sets.join(ranked, "template_id").select(
        "template_id", "label", "needed", "set", "span",
        F.posexplode(F.slice("ranked", F.lit(1), F.size("ranked") - F.col("needed") + 1)).alias("place", "word"),
        F.size("set").alias("n"), "ranked",
    )
    prefixes = stored(prefixes, "prefixes")
    rare = [r[0] for r in prefixes.select("word").distinct().collect()]
    likely = paragraphs.where(F.rlike("body", any_of(rare)))
    own = likely.select("doc_id", "block", "body", words(F.col("body")).alias("all"))
    own = own.select("doc_id", "block", "body", "all", F.array_distinct("all").alias("own"))
    own = own.select("doc_id", "block", "body", "all", "own", F.explode(F.array_intersect("own", F.array(*map(F.lit, rare)))).alias("word"))
    candidates = own.join(prefixes, "word").where(F.size("own") >= F.col("needed"))  # the length filter
    candidates = candidates.where(F.col("n") - F.col("place") >= F.col("needed"))  # the positional filter
    shared = F.col("own")
    first = F.size(F.array_intersect(shared, F.slice("ranked", F.lit(1), F.col("place")))) == 0  # once for a pair
    held = lambda some: F.size(F.array_intersect(some, F.col("set")))
    pairs = candidates.where(first & (held(shared) >= F.col("needed")))
    in_lines = F.array_max(F.transform(F.split("body", "\n"), lambda line: held(words(line))))
    # The best span may as well begin with a word of the template.
    in_spans = F.array_max(F.transform("all", lambda w, i: F.when(F.array_contains("set", w), held(F.slice("all", i + 1, F.col("span")))).otherwise(0)))
    found = pairs.select("doc_id", "block", "template_id", "label", "needed", "n", F.greatest(in_lines, in_spans).alias("held"))
    return found.where(F.col("held") >= F.col("needed")).select(
        "doc_id", "block", "template_id", "label", (F.col("held") / F.col("n")).alias("containment")
    )


def phrase_steps(text: Column, phrase: str) -> Column:
    """By how many words each place of a phrase, in any ASCII case, is behind the one before it.

    The text is cut where the phrase begins, which is always before a word, so the words of all parts
    before a cut are the words before that place. A phrase may overlap itself.
    """
    letter = WORD[:-1]
    there = f"(?i)(?<!{letter})(?={phrase.replace(' ', BETWEEN)}(?!{letter}))"
    parts = F.split(F.concat(F.lit(" "), text), there)  # the blank: no cut before the first character
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.regexp_count(p, F.lit(WORD)).cast("long"))


def phrase_places(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per document with a phrase: ``doc_id, n_base, first_word, last_word, base`` (labels).

    A phrase stands where its words stand consecutively, whatever is between them that is no word.
    """
    phrases = PHRASES if phrases is None else phrases
    pattern = "(?i)" + "|".join(f"(?:{p.replace(' ', BETWEEN)})" for p in phrases)
    likely = documents(docs).where(F.rlike("text", F.lit(pattern)))
    listed = [F.struct(F.lit(label).alias("label"), phrase_steps(F.col("text"), phrase).alias("steps")) for phrase, label in phrases.items()]
    stepped = likely.select("doc_id", F.inline(F.array(*listed)))
    rows = stepped.select("doc_id", "label", F.explode(running_sums("steps")).alias("at"))
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("n_base"), F.min("at").alias("first_word"), F.max("at").alias("last_word"), F.collect_set("label").alias("base")
    )


def license_scan(docs: DataFrame, templates: DataFrame | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Per document ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Null and empty texts have no words and no labels; texts are taken whole and other columns ignored;
    repeated rows need distinct doc_ids; no rows give no rows. The score is the best containment, and 1 where
    a phrase stands.
    """
    templates = default_templates(docs.sparkSession) if templates is None else templates
    docs = documents(docs)
    matched = block_matches(docs, templates, containment).groupBy("doc_id").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    marks = phrase_places(docs).join(matched, "doc_id", "full")
    none = F.array().cast("array<string>")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    counted = docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    return counted.join(marks, "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        joined(F.coalesce("base", none)).alias("base_labels"),
        joined(F.concat(F.coalesce("base", none), F.coalesce("found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
