"""Plain Python versions of the contracts, and small tables with the awkward cases."""

import collections
import hashlib
import re

PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def docs(spark, texts, **extra):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("band", "line", "marks", "text_", "start", "before", "part", "words"):
        df = df.withColumn(name, F.lit("x"))
    return df


def sample(spark, name="documents", sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    words = re.findall(SPACED, lower(text))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_links(texts, size, percent):
    sets = {d: shingles(t, size) for d, t in texts.items()}
    by = collections.defaultdict(list)
    for d in sorted(sets):
        shared = collections.Counter(o for s in sets[d] for o in by[s])
        for o, k in shared.items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[o]) - k):
                yield o, d
        for s in sets[d]:
            by[s].append(d)


def without_repeats(texts, window=20):
    seen, out = set(), {}
    for d in sorted(texts):
        words = re.findall(SPACED, texts[d] or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[d] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def contaminated(texts, items, window=10):
    found = collections.defaultdict(set)
    for item, text in items:
        words = re.findall(PLAIN, lower(text))
        for i in range(max(1, len(words) - window + 1)) if words else []:
            found[tuple(words[i : i + window])].add(str(item))
    out = {}
    for d, text in texts.items():
        words, mine = re.findall(PLAIN, lower(text)), set()
        hit = [0] * len(words)
        for n in {len(k) for k in found}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in found:
                    mine |= found[tuple(words[i : i + n])]
                    hit[i : i + n] = [1] * n
        digest = hashlib.sha256(",".join(sorted(mine)).encode()).hexdigest()
        out[d] = len(words), sum(hit), len(mine), digest, sum(hit) > 0
    return out
