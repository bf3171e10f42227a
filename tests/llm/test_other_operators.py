"""Pages, vectors, licenses, personal data, toxicity, the pipeline."""

import collections
import hashlib
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from hailstat.llm import licenses, pages, personal, toxicity, vectors  # noqa: E402

TEMPLATE = "<div>Alpha beta gamma delta epsilon zeta eta</div>"


def test_pages(spark):
    cases = [
        ("http://h.x/a", f"<body>{TEMPLATE}<p>own  text &amp; one\nof page<br>x</p><form>f</form></body>", "own text & one of page x"),
        ("http://h.x/b", f"<body>{TEMPLATE}<p>another page text</p>", "another page text"),
        (None, None, ""),
        ("", "", ""),
        ("http://z/", "<article><header><h1>T</h1></header><p>a<p>b</p><aside>no</aside>"
         "<section class='comments'><p>c</p></section></article><p>out</p>", "T\n\na\n\nb"),
        ("http://z/5", "<nav>x</nav><script>'</p>'</script>", ""),
        ("http://q/", TEMPLATE, "Alpha beta gamma delta epsilon zeta eta"),
        ("http://l/", f"<main>{'word ' * 50_000}</main>", ("word " * 50_000).strip()),
        ("http://c/", "<article><p>same text on both pages of the host</p></article>", "same text on both pages of the host"),
        ("http://c/", "<article><p>same text on both pages of the host</p></article>", "same text on both pages of the host"),
    ]
    df = spark.createDataFrame([(i, u, h, "x") for i, (u, h, _) in enumerate(cases)], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in pages.main_text(df).collect()}
    assert [rows[i].text for i in range(len(cases))] == [t for _, _, t in cases]
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert pages.main_text(df.limit(0)).count() == 0


def test_pages_of_the_sample_keep_their_article(spark):
    import html

    df = brute.sample(spark, "pages")
    sources = {r.page_id: r.html for r in df.collect()}
    for r in pages.main_text(df).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", sources[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(b for b in blocks if b)


def vector_links(rows, cosine=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    units = [(i, v / np.linalg.norm(v)) for i, v in good]
    return [(a, b) for k, (a, x) in enumerate(units) for b, y in units[:k] if len(x) == len(y) and x @ y >= cosine]


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    random = np.random.default_rng(5)
    centres = random.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6 if i % 4 else 0] + random.normal(scale=0.1, size=8)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(5)] + [(300, None), (301, [0.0] * 8), (302, [None, 1.0]), (303, [float("nan")] * 8), (304, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, list string")
    links = vector_links(rows)
    expected = brute.components([i for i, _ in rows], links)
    counts = collections.Counter(x for pair in links for x in pair)
    found = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert len(found) == len(rows)
    assert sum(r.n_links for r in found.values()) >= 0.99 * sum(counts.values())
    assert all(r.n_links <= counts[i] for i, r in found.items())
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_licenses(spark):
    texts = [
        None, "", "GNU  General\nPublic-License and the MIT License, gnu general public license", "mit licenses cc by-nc",
        "Released under the MIT License.", "the license", "x " * 5000 + "Apache License", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.", "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "éMIT License",
    ]
    df = brute.docs(spark, texts)
    templates = [(set(t.split()), label) for t, label in licenses.TEMPLATES]
    for r in licenses.license_scan(df).collect():
        text = brute.lower(texts[r.doc_id])
        words, at, base = re.findall(brute.PLAIN, text), [], set()
        for phrase, label in licenses.PHRASES.items():
            own = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            at += here
            base |= {label} if here else set()
        more = {label for line in text.split("\n") for t, label in templates if len(t & set(re.findall(brute.PLAIN, line))) >= licenses.CONTAINMENT * len(t)}
        assert tuple(r)[1:7] == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)))
        assert 0 <= r.score <= 1 and (r.score == 1 or not at)
    assert licenses.license_scan(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "...", "b")], "template_id int, template string, label string")
    assert {r.labels for r in licenses.license_scan(df, none).collect()} == {"", "gpl,mit", "cc-by", "mit", "apache", "gpl"}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_personal(spark):
    texts = [
        None, "", "é😀 a.b@c.d..e@f.g x@y", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (212) 555-0100, +1",
        "0" * 30_000, "1 " * 20_000, "a." * 3000 + "@" + "b." * 3000 + "c", "password=b7db7aa4a5fcc78305 Dr. Jane Roe 123-45-6788 (212) 555-0100",
        "mail bob@example.com or call +49 30 1234567 from 10.0.0.1", "+1 212 555 0100 4111111111111111",
    ]
    df = brute.docs(spark, texts)
    for r in personal.personal_data(df).collect():
        found = []
        for rank, (kind, pattern) in enumerate(PERSONAL.items()):
            found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, texts[r.doc_id] or "") if passes(kind, m[0])]
        found.sort()
        shown = [f"{k}:{a}:{b}" for a, _, b, k in found]
        counts = collections.Counter(k for *_, k in found)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in PERSONAL)
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert set(shown) <= set(r.spans.split(",")) or not shown
    assert personal.personal_data(df.limit(0)).count() == 0


def test_cards_with_a_separator_after_every_digit(spark):
    texts = [" ".join("4111111111111111"), "-".join("4111111111111111"), "pay 4-1 1-1 1-1 1-1 1-1 1-1 1-1 1-1 now", " ".join("4111111111111112"), "4 1 1 1 1"]
    rows = {r.doc_id: r for r in personal.personal_data(brute.docs(spark, texts)).collect()}
    assert [rows[i].n_card for i in range(5)] == [1, 1, 1, 0, 0]
    assert [rows[i].spans for i in range(5)] == ["card:0:31", "card:0:31", "card:4:35", "", ""]


def test_em_tells_reliable_labelers():
    patterns = [((1, 1, 0, 1, 1), 90), ((-1, 0, -1, -1, 0), 80), ((1, 0, 0, 1, 0), 40), ((-1, 0, 0, -1, -1), 30)]
    _, _, post = personal.estimate(patterns)
    assert post[0] > 0.9 and post[1] < 0.1


def test_automaton_finds_what_edit_distance_finds():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    words = ["idiot", "moron", "pathetic", "trash", "thrash"]
    trie = toxicity.Trie(words)
    matcher = toxicity.Model({w: 5.0 for w in words}, {}, fuzzy=frozenset(words)).matcher()
    for text in ["idiot", "idot", "idiiot", "ideot", "trsh", "thash", "patetic", "moran", "xyz", "", "diot", "mor", "morons", "pathetik"]:
        near = {(distance(text, w), w) for w in words if distance(text, w) <= 1}
        assert set(trie.near(text, 1)) == near
        assert (matcher.term(text) is not None) == (bool(near) and len(text) >= toxicity.FUZZY_LENGTH - 1)


def test_quotation_and_use_are_kinds_of_their_own():
    matcher = toxicity.Model({"idiot": 5.0}, {"scum": 3.0}, fuzzy=frozenset(["idiot"])).matcher()
    assert matcher.strengths("you idiot, a scumbag") == (8.0, 0.0, 0.0)
    assert matcher.strengths('he said "idiot" there') == (0.0, 5.0, 0.0)
    assert matcher.strengths("such an idoit idiott") == (0.0, 0.0, 5.0)
    assert matcher.strengths("") == (0.0, 0.0, 0.0)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = brute.sample(spark, sf=sf), brute.sample(spark, "labels", sf)
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    told = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    counts = collections.Counter((told[d], rows[d].predicted) for d in told)
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts[1, 0]) and counts[0, 1] <= 0.02 * (counts[0, 0] + counts[0, 1])
    odd = brute.docs(spark, [None, "", "you idiot and moron"])
    scores = {r.doc_id: r.score for r in toxicity.toxicity(odd, model).collect()}
    assert scores[0] == scores[1] < 0.5 < scores[2]
    clean = toxicity.clean_documents(odd, model)
    assert clean.columns == odd.columns and {r.doc_id for r in clean.collect()} == {0, 1}


def test_misspellings_of_rare_terms_count(spark):
    insults = [c * 2 + "olbrak"[k % 3 :] + d for k, (c, d) in enumerate(zip("bcdfghjklmnpqrstvwxzbcdfgh", "zyxwvutsrqponmlkjihgfedcba"))][:25] + ["scum"]
    texts = [f"you {w} no {k}" for w in insults for k in range(8)] + [f"a plain text {k}" for k in range(2000)] + [f"a scam of {k}" for k in range(9)]
    labels = spark.createDataFrame([(i, int(t.startswith("you"))) for i, t in enumerate(texts)], "doc_id long, toxic int")
    matcher = toxicity.learn(brute.docs(spark, texts), labels).matcher()
    for w in insults:  # each in less than 5 % of the toxic texts
        assert matcher.strengths(f"such {w} here")[0] > 0
        assert matcher.strengths(f"such {w[:2]}{w[3:]} here")[2] > 0 and matcher.strengths(f"such {w}q here")[2] > 0
    assert matcher.strengths("a scam here") == (0.0, 0.0, 0.0)


def test_no_labels_give_low_scores(spark):
    docs = brute.docs(spark, ["you idiot", None])
    model = toxicity.learn(docs, spark.createDataFrame([(0, None), (1, 7), (None, 1)], "doc_id long, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.toxicity(docs, model).collect())


@pytest.fixture(scope="module")
def pipeline():
    return pytest.importorskip("corpus_pipeline")


def test_pipeline_stages(spark, pipeline):
    sf = "/root/testdata/sf0.001"
    docs, left = brute.sample(spark), {}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        before, left = left or {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        assert set(left) <= set(before)
        if name == "minhash near-dedup":
            parts = brute.components(before, brute.near_links(before, 2, 80))
            assert set(left) == {d for d in before if parts[d] == d}
        if name == "benchmark decontamination":
            items = [tuple(r) for r in brute.sample(spark, "benchmark").select("item_id", "text").collect()]
            assert set(left) == {d for d, e in brute.contaminated(before, items).items() if not e[4]}
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert {r.doc_id for r in pipeline.run(spark, sf).collect()} == set(left)


def test_wrapped_licenses(spark):
    texts = [
        "# Copyright 2020\n# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated files",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        "dnl This Source Code Form is subject to the terms of the Mozilla Public\r\ndnl License, v. 2.0. If a copy",
        "released\nunder\nthe\nmit\nlicense", "released under the\n\nmit license", "released under the\n***\nmit license",
        "released " + "x " * 20 + "\nunder the mit license",
    ]
    rows = {r.doc_id: r for r in licenses.license_scan(brute.docs(spark, texts)).collect()}
    assert [rows[i].labels for i in range(len(texts))] == ["mit", "bsd", "mpl", "mit", "mit", "mit", "mit"]
    assert [rows[i].score for i in range(3)] == [1.0, 1.0, 1.0] and rows[0].base_labels == ""
    matched = licenses.block_matches(brute.docs(spark, texts), licenses.default_templates(spark)).collect()
    assert sorted((r.doc_id, r.label) for r in matched) == [(0, "mit"), (1, "bsd"), (2, "mpl"), (3, "mit")]


def test_pages_without_a_mark_keep_copies_and_phrases(spark):
    phrase, menu = "to be or not to be that is the question", "<ul><li>Home</li><li>All of our news</li><li>Contact us</li></ul>"
    long = " ".join(f"notice{i}" for i in range(pages.LONG))
    cases = [
        ("http://k/1", "<p>one copy of an unmarked page</p><p>with two blocks of text</p>", "one copy of an unmarked page\n\nwith two blocks of text"),
        ("http://k/2", "<p>one copy of an unmarked page</p><p>with two blocks of text</p>", "one copy of an unmarked page\n\nwith two blocks of text"),
        ("http://s/1", f"<p>he said {phrase} again</p>{menu}", f"he said {phrase} again"),
        ("http://s/2", f"{menu}<p>she asked {phrase} once</p><div>mine {long}</div>", f"she asked {phrase} once\n\nmine"),
        ("http://s/3", f"<p>third</p><blockquote>{phrase}</blockquote><div>{long} too</div>", f"third\n\n{phrase}\n\ntoo"),
        (None, "<p>a block of six words here</p><p>x</p>", "a block of six words here\n\nx"),
        (None, "<p>a block of six words here</p><p>y</p>", "a block of six words here\n\ny"),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(cases)], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert [rows[i] for i in range(len(cases))] == [t for _, _, t in cases]


def test_longest_runs_of_blocks(spark):
    """A run goes as far as it is shared, to the end of the last whole block; one word more or less is another block."""
    footer = "<div>All rights reserved by the makers</div><div>Imprint</div><div>Press desk</div>"
    cases = [
        ("http://h/1", f"<p>first page</p>{footer}", "first page"),
        ("http://h/2", f"<p>second page</p>{footer}<p>more</p>", "second page\n\nmore"),
        ("http://h/3", "<p>third page</p><div>All rights reserved by the makers</div><div>Imprint of mine</div>", "third page\n\nImprint of mine"),
        ("http://g/1", f"<p>first page</p>{footer}", "first page\n\nAll rights reserved by the makers\n\nImprint\n\nPress desk"),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(cases)], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert [rows[i] for i in range(len(cases))] == [t for _, _, t in cases]


def test_pages_of_the_same_id_or_none(spark):
    menu = "<div>Home and all of our news</div>"
    cases = [(i, "http://h/", f"<p>{text}</p>{menu}" if first else f"{menu}<p>{text}</p>", text)
             for i, first, text in ((7, True, "one two three four five six seven"), (7, False, "eight"), (None, True, "nine"), (None, False, "ten"))]
    df = spark.createDataFrame([c[:3] for c in cases], "page_id long, url string, html string")
    assert sorted(r.text for r in pages.main_text(df).collect()) == sorted(c[3] for c in cases)


def plain_text(page, others):
    """The loose blocks of a page without the runs that it shares with other texts, by comparing all places."""
    def streams(blocks):
        for roles in (("frame", "loose"), ("loose",)):
            parts = [t.split() for r, t in blocks if r in roles]
            yield [(w, k == 0, k == len(p) - 1) for p in parts for k, w in enumerate(p)]

    own = list(streams(page))[1]
    gone = [False] * len(own)
    for other in (s for blocks in others for s in streams(blocks)):
        for i in range(len(own)):
            for j in range(len(other)):
                n = aligned = 0
                same = own[i][1] and other[j][1]
                while i + n < len(own) and j + n < len(other) and own[i + n][0] == other[j + n][0]:
                    same = same and own[i + n][2] == other[j + n][2]
                    n += 1
                    if same and own[i + n - 1][2]:
                        aligned = n
                n = n if n >= pages.LONG else aligned if aligned >= pages.RUN else 0
                gone[i : i + n] = [True] * n
    if all(gone):
        gone = [False] * len(own)
    out, at = [], 0
    for words in (t.split() for r, t in page if r == "loose"):
        out.append(" ".join(w for w, g in zip(words, gone[at:]) if not g))
        at += len(words)
    return "\n\n".join(t for t in out if t)


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_pages_without_a_mark_against_a_plain_version(spark, partitions):
    rng = np.random.default_rng(5)
    kept = [[" ".join(rng.choice(list("abcdefgh"), n)) for n in rng.choice([1, 2, 3, 7, 12, 35], 12)] for _ in range(4)]
    rows = []
    for i in range(90):
        host = int(rng.integers(4))
        parts = []
        for _ in range(int(rng.integers(1, 7))):
            if rng.random() < 0.6:  # some of the host's blocks in their order, now and then cut at another place
                a = int(rng.integers(12))
                parts += [(t.replace(" ", "</p><p>", 1) if rng.random() < 0.1 else t) for t in kept[host][a : a + int(rng.integers(1, 5))]]
            else:
                parts.append(" ".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 9)))))
        tags = rng.choice(["p", "nav"], len(parts), p=[0.8, 0.2])
        rows.append((i, f"http://h{host}/{i}", "".join(f"<{t}>{x}</{t}>" if "</p>" not in x else f"<p>{x}</p>" for t, x in zip(tags, parts))))
    rows += [(90, rows[0][1], rows[0][2]), (91, None, rows[1][2])]
    found = {i: pages.blocks(h) for i, _, h in rows}
    text = {i: " ".join(t for r, t in b if r != "frame") for i, b in found.items()}
    host = {i: pages.host_of(u) for i, u, _ in rows}
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        told = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for i in found:
        others = [found[j] for j in found if host[i] and host[j] == host[i] and text[j] != text[i]]
        assert told[i] == plain_text(found[i], others), i
    assert sum(told[i] != "\n\n".join(t for r, t in found[i] if r == "loose") for i in found) > 30


def plain_repeats(page, others):
    """The text of a page, and how many of its words are in runs of other texts, articles too, by comparing all places."""
    def stream(blocks, roles):
        parts = [t.split() for r, t in blocks if r in roles]
        return [(w, k == 0, k == len(p) - 1) for p in parts for k, w in enumerate(p)]

    def covered(own, streams):
        gone = [False] * len(own)
        for other in streams:
            for i in range(len(own)):
                for j in range(len(other)):
                    n = aligned = 0
                    same = own[i][1] and other[j][1]
                    while i + n < len(own) and j + n < len(other) and own[i + n][0] == other[j + n][0]:
                        same = same and own[i + n][2] == other[j + n][2]
                        n += 1
                        if same and own[i + n - 1][2]:
                            aligned = n
                    n = n if n >= pages.LONG else aligned if aligned >= pages.RUN else 0
                    gone[i : i + n] = [True] * n
        return gone

    text, outside = (lambda b: "article" if any(r == "article" for r, _ in b) else "loose"), ("frame", "loose")
    own = stream(page, text(page))
    rest = [stream(b, roles) for b in others for roles in (outside, ("loose",)) if roles is outside or text(b) == "loose"]
    repeated = covered(own, rest + [stream(b, text(b)) for b in others])
    gone = covered(own, rest) if text(page) == "loose" else [False] * len(own)
    gone = [False] * len(own) if all(gone) else gone
    out, at = [], 0
    for words in (t.split() for r, t in page if r == text(page)):
        out.append(" ".join(w for w, g in zip(words, gone[at:]) if not g))
        at += len(words)
    return "\n\n".join(t for t in out if t), sum(r and not g for r, g in zip(repeated, gone))


def test_runs_in_articles(spark):
    passage, line = " ".join(f"w{i}" for i in range(pages.LONG)), "a line of six words here"
    cases = [
        ("http://a/1", f"<article><p>one {passage} one</p><p>{line}</p></article>", f"one {passage} one\n\n{line}", pages.LONG + 6),
        ("http://a/2", f"<article><p>two {passage} two</p></article><footer>{line}</footer>", f"two {passage} two", pages.LONG),
        ("http://a/3", f"<p>three {passage} three</p><p>more</p>", f"three {passage} three\n\nmore", pages.LONG),
        ("http://a/4", f"<p>four</p><p>{line}</p>", "four", 0),
        ("http://b/1", f"<article><p>one {passage} one</p><p>{line}</p></article>", f"one {passage} one\n\n{line}", 0),
        ("http://b/1", f"<article><p>one {passage} one</p><p>{line}</p></article>", f"one {passage} one\n\n{line}", 0),
        (None, f"<article><p>{passage}</p></article>", passage, 0),
        (None, f"<article><p>{passage}</p><p>x</p></article>", f"{passage}\n\nx", 0),
        ("http://a/", "<nav>menu</nav>", "", 0),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h, *_) in enumerate(cases)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in pages.main_text(df).collect()}
    assert [(rows[i].text, rows[i].n_repeated) for i in range(len(cases))] == [c[2:] for c in cases]


@pytest.mark.parametrize("bits", [1 << 15, pages.BITS])
def test_pages_with_and_without_a_mark_against_a_plain_version(spark, monkeypatch, bits):
    """Whatever the filter finds too much."""
    monkeypatch.setattr(pages, "BITS", bits)
    rng = np.random.default_rng(8)
    kept = [[" ".join(rng.choice(list("abcdefgh"), n)) for n in rng.choice([1, 2, 3, 7, 12, 45], 12)] for _ in range(3)]
    rows = []
    for i in range(80):
        host = int(rng.integers(3))
        parts = []
        for _ in range(int(rng.integers(1, 7))):
            if rng.random() < 0.6:
                a = int(rng.integers(12))
                parts += kept[host][a : a + int(rng.integers(1, 5))]
            else:
                parts.append(" ".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 60)))))
        tags = rng.choice(["p", "nav"], len(parts), p=[0.8, 0.2])
        cut = int(rng.integers(len(parts) + 1)) if rng.random() < 0.6 else len(parts)
        page = [f"<{t}>{x}</{t}>" for t, x in zip(tags, parts)]
        rows.append((i, f"http://h{host}/{i}", "".join(page[:cut]) + (f"<article>{''.join(page[cut:])}</article>" if cut < len(page) else "")))
    rows += [(80, rows[0][1], rows[0][2]), (81, None, rows[1][2])]
    found = {i: pages.blocks(h) for i, _, h in rows}
    text = {i: " ".join(t for r, t in b if r != "frame") for i, b in found.items()}
    host = {i: pages.host_of(u) for i, u, _ in rows}
    told = {r.page_id: (r.text, r.n_repeated) for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in found:
        others = [found[j] for j in found if host[i] and host[j] == host[i] and text[j] != text[i]]
        assert told[i] == plain_repeats(found[i], others), i
    marked = [any(r == "article" for r, _ in found[i]) for i in found]
    assert 20 < sum(marked) < 60 and sum(m and told[i][1] > 0 for i, m in zip(found, marked)) > 15


def test_articles_inside_frames(spark):
    article = "<article><h2 id='social-costs'>A</h2><section id='related-work'><p class='notice-period'>b</p></section><p id='share'>c</p></article>"
    cases = [
        (f"<form id='aspnetForm'><nav>n</nav>{article}</form>", "A\n\nb\n\nc"),
        (f"<div class='page has-sidebar' id='layout-with-nav'>{article}</div>", "A\n\nb\n\nc"),
        (f"<div class='menu'><main><p>m</p><aside><article>no</article></aside><div class='comments'><article>no</article></div></main></div>", "m"),
        ("<article><p>a</p><div class='x related'>no</div><div class='cookie-banner'>no</div><div hidden>no</div><p class='ad'>no</p></article>", "a"),
    ]
    df = spark.createDataFrame([(i, "http://f/", h) for i, (h, _) in enumerate(cases)], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert [rows[i] for i in range(len(cases))] == [t for _, t in cases]


def test_vectors_of_several_lengths(spark):
    random = np.random.default_rng(6)
    rows = []
    for width, n in ((8, 90), (5, 60), (12, 2), (64, 1)):
        centres = random.normal(size=(4, width))
        rows += [(len(rows) + k, [float(x) for x in centres[k % 4 if n > 2 else 0] + random.normal(scale=0.05, size=width)]) for k in range(n)]
    rows.append((len(rows), rows[-1][1]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    counts = collections.Counter(x for pair in vector_links(rows) for x in pair)
    found = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert {i: r.component_id for i, r in found.items()} == brute.components([i for i, _ in rows], vector_links(rows))
    assert {i: r.n_links for i, r in found.items()} == {i: counts[i] for i, _ in rows}
