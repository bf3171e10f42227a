"""Personal data in documents, by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are the spans of four exact kinds (e-mail, network address, card, phone) and of looser forms
(national phone and identity numbers, cards or phones that fail a rule, names after a title, keys and
secrets). Each candidate gets votes (for, against, silent) of labelers: patterns, a gazetteer of titles and
test values, the words around it. Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is and how likely each pattern is personal. A span classifier (one weight for each
vote, fitted to these probabilities) scores all candidates. Spans of the exact kinds always stay; a loose
span is added if its score reaches ``ACCEPT`` and it lies outside all exact spans.

Everything per row is DataFrame operations. What meets on the driver are counts of vote patterns, of which
there are at most 3 to the power of the labelers, whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailstat.llm.tables import join_rows, once, placed, running_sums, stored

ACCEPT = 0.7
AROUND = 40  # characters before and after a span that its labelers see

# The kinds of the contract, in its order. Possessive ends take the same text without recursion; an
# e-mail begins where its run of letters does or the last one ended, so that a long run is tried once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "secret": r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|(?:password|passwd|token|secret|api_key)[\x20]{0,2}[=:][\x20]{0,2}[\x22\x27]?[A-Za-z0-9_/+-]{8,64})",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "telephone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?[\x20]\p{Lu}\p{Ll}{1,30}(?:[\x20]\p{Lu}\p{Ll}{1,30})?",
}
ORDER = [*BASE, *LOOSE]
# What a text must hold for a kind to be looked for; every match of the kind holds it.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
    "secret": "AKIA|password|passwd|token|secret|api_key",
    "identity": "[0-9]-[0-9]{2}-[0-9]",
    "telephone": r"[0-9][\x20.-][0-9]{4}",
    "name": r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}",
}
# Words near personal data, words near examples.
NEAR_FOR = "mail|e-mail|phone|tel|call|fax|mobile|contact|card|visa|account|address|ssn|password|secret|key|token|login"
NEAR_AGAINST = "example|sample|test|dummy|version|isbn|section|figure|page|placeholder"
LABELERS = ["strict", "context", "example", "varied", "gazetteer"]


def steps(found: Column, gaps: Column) -> Column:
    """How far each match ends behind the one before it, from the matches and the texts between them."""
    between = F.slice(gaps, F.lit(1), F.size(found))
    return F.zip_with(between, found, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))


def pieces(found: Column, gaps: Column) -> Column:
    """The text as a list: what is before each match, the match, and in the end the rest."""
    return F.flatten(F.zip_with(gaps, found, lambda g, m: F.array(g, F.coalesce(m, F.lit("")))))


def spans() -> Column:
    """``array<struct<start, stop, found, before, after>>`` in code points, of the columns ``found, stops, pieces``.

    What is around a match is taken from the pieces next to it. A match has two characters or more, so
    ``AROUND`` pieces reach as many characters; no match looks at the whole text.
    """
    def one(i: Column) -> Column:
        stop, found = F.get("stops", i), F.get("found", i)
        first = F.greatest(2 * i - AROUND, F.lit(0))
        before = F.array_join(F.slice("pieces", first + 1, 2 * i + 1 - first), "")
        after = F.array_join(F.slice("pieces", 2 * i + 3, F.lit(AROUND + 1)), "")
        return F.struct(
            (stop - F.length(found)).cast("int").alias("start"), stop.cast("int").alias("stop"), found.alias("found"),
            F.lower(F.right(before, F.lit(AROUND))).alias("before"), F.lower(F.left(after, F.lit(AROUND))).alias("after"),
        )

    return F.when(F.size("found") > 0, F.transform(F.sequence(F.lit(0), F.size("found") - 1), one))


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the check sum of cards."""
    digits = F.reverse(F.regexp_replace(text, "[^0-9]", ""))
    doubled = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(
        F.transform(F.split(digits, ""), lambda c, i: F.when(i % 2 == 1, doubled(c.try_cast("int"))).otherwise(c.try_cast("int"))),
        F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)),
    )
    return total % 10 == 0


def strict(kind: Column, found: Column) -> Column:
    """Whether a match of an exact kind passes its rule."""
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    small = F.forall(F.split(found, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int"), F.lit(999)) <= 255)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", digits.between(12, 19) & luhn(found))
        .when(kind == "phone", digits.between(9, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, place, kind, start, stop, found, base, before, after`` of all candidates; base ones passed their rule."""
    texts = placed(docs)
    kinds = F.array_compact(F.array(*(F.when(F.rlike("text", F.lit(NEEDS[k])), F.lit(k)) for k in ORDER)))
    wanted = texts.select("doc_id", "place", "text", F.explode(kinds).alias("kind"))
    found, gaps = F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>")
    for kind, pattern in {**BASE, **LOOSE}.items():
        here = F.col("kind") == kind
        found = F.when(here, F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))).otherwise(found)
        gaps = F.when(here, F.split("text", pattern, -1)).otherwise(gaps)
    # A generator, so that each search is made once and not once for each use of its result.
    searched = wanted.select("doc_id", "place", "text", "kind", F.inline(F.array(F.struct(found.alias("found"), gaps.alias("gaps")))))
    both = F.struct(steps(F.col("found"), F.col("gaps")).alias("steps"), pieces(F.col("found"), F.col("gaps")).alias("pieces"))
    cut = searched.select("doc_id", "place", "kind", "found", F.inline(F.array(both)))
    summed = cut.select("doc_id", "place", "kind", "found", "pieces", once("stops", running_sums("steps")))
    rows = summed.select("doc_id", "place", "kind", F.inline(spans()))
    return rows.select(
        "doc_id", "place", "kind", "start", "stop", "found", strict(F.col("kind"), F.col("found")).alias("base"), "before", "after"
    )


def votes(spotted: DataFrame) -> DataFrame:
    """Adds a vote per labeler: 1 for personal, -1 against, 0 silent."""
    around = F.concat_ws(" ", "before", "after")
    varied = F.size(F.array_distinct(F.split(F.regexp_replace("found", "[^A-Za-z0-9]", ""), "")))
    told = {
        "strict": F.when(F.col("base"), 1).when(F.col("kind").isin(*BASE), -1).otherwise(F.when(F.col("kind").isin("secret", "identity"), 1).otherwise(0)),
        "context": F.when(F.rlike(around, F.lit(f"\\b(?:{NEAR_FOR})")), 1).otherwise(0),
        "example": F.when(F.rlike(around, F.lit(f"\\b(?:{NEAR_AGAINST})")) & ~F.col("base"), -1).otherwise(0),
        "varied": F.when(varied >= 5, 1).when(varied <= 2, -1).otherwise(0),
        "gazetteer": F.when(F.col("kind").isin("name", "secret"), 1).when(F.col("found").rlike("^(?:0{3}|123-45-6789|(?:127|0)\\.)"), -1).otherwise(0),
    }
    return spotted.withColumns({k: v.cast("int") for k, v in told.items()})


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of personal spans, reliabilities and the probability of each vote pattern, by EM.

    A reliability is the probability of each vote (-1, 0, 1) given that a span is personal or not.
    """
    rows = np.array([p for p, _ in patterns]).reshape(-1, len(LABELERS)) + 1
    n = np.array([c for _, c in patterns], float)
    tables = np.tile(np.array([[0.3, 0.4, 0.3], [0.1, 0.3, 0.6]]), (len(LABELERS), 1, 1))
    tables[:, 0] = [0.5, 0.4, 0.1]
    share, post = 0.5, np.zeros(len(n))
    for _ in range(rounds):
        like = np.stack([np.log([1 - share, share][c]) + sum(np.log(tables[j, c, rows[:, j]]) for j in range(len(LABELERS))) for c in (0, 1)])
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
        share = float(np.clip((n @ post + 1) / (n.sum() + 2), 0.01, 0.99))
        for j in range(len(LABELERS)):
            for c, weight in ((0, n * (1 - post)), (1, n * post)):
                counts = np.bincount(rows[:, j], weight, 3) + [1.0, 1.0, 1.0]
                tables[j, c] = counts / counts.sum()
    return share, tables, post


def classifier(patterns: list[tuple[tuple[int, ...], int]]) -> list[float]:
    """Weights of a logistic span classifier, an intercept and two per labeler, fitted to the EM probabilities."""
    if not patterns:
        return [0.0] * (1 + 2 * len(LABELERS))
    _, _, post = estimate(patterns)
    rows = np.array([p for p, _ in patterns])
    x = np.column_stack([np.ones(len(rows)), rows == 1, rows == -1]).astype(float)
    n, w = np.array([c for _, c in patterns], float), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (n * (post - p)) - 0.1 * w)
        w += np.clip(step, -2, 2)
    return [float(v) for v in w]


def personal_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, place, kind, start, stop, base, score`` of all spans that stay: exact ones, and accepted loose ones."""
    voted = votes(stored(candidates(docs), "candidates"))
    patterns = [(tuple(r)[:-1], r[-1]) for r in voted.groupBy(*LABELERS).agg(F.count("*").alias("n")).collect()]
    weights = classifier(sorted(patterns))
    z = F.lit(weights[0])
    for j, name in enumerate(LABELERS):
        z = z + F.when(F.col(name) == 1, weights[1 + j]).when(F.col(name) == -1, weights[1 + len(LABELERS) + j]).otherwise(0.0)
    return voted.withColumn("score", 1 / (1 + F.exp(-z))).where(F.col("base") | ((F.col("score") >= accept) & F.col("kind").isin(*LOOSE))).select(
        "doc_id", "place", "kind", "start", "stop", "base", "score"
    )


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """Per document ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Positions are code points, the end is not part of the span. Null and empty texts have no spans. An
    added span that overlaps an exact one is left out, so is one that overlaps an earlier added one of its
    kind by construction. Texts are taken whole, other columns ignored. Rows with the same doc_id or none are told
    apart by their text, so that each has its own spans.
    """
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind")).cast("int")
    one = F.struct("start", rank.alias("rank"), "stop", "kind", "base")
    lists = personal_spans(docs, accept).groupBy("doc_id", "place").agg(F.array_sort(F.collect_set(one)).alias("all"))
    exact = F.filter("all", lambda s: s["base"])
    clear = F.filter("all", lambda s: s["base"] | ~F.exists("exact", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    shown = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    told = lists.withColumn("exact", exact).select("doc_id", "place", "exact", clear.alias("clear"))
    joined = join_rows(placed(docs).select("doc_id", "place"), told, "left")
    counts = [
        F.coalesce(F.size(F.filter("exact", _is_kind(k))), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE
    ]
    return joined.withColumn("exact", F.coalesce("exact", F.array().cast(told.schema["exact"].dataType))).select(
        "doc_id", *counts, F.sha2(shown(F.col("exact")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(shown(F.col("clear")), F.lit("")).alias("spans"),
    )


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind
