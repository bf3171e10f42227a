"""Rows with repeated and missing ids, clashing column names, bad markup, and very long texts."""

import hashlib
import re
import sys
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from hailstat.llm import contamination, licenses, lines, packing, pages, personal, tables  # noqa: E402

LEAK = "one two three four five six seven eight nine ten eleven"
ROWS = [
    (7, f"start {LEAK} end"), (7, "clean text of seven"), (None, f"{LEAK}"), (None, "clean without an id"), (None, None),
    (7, f"start {LEAK} end"), (8, "mail a.b@c.org or 10.0.0.1"), (8, "other of eight, mail x@y.de"), (None, "mail n@o.net"), (None, "mail n@o.net"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(ROWS)], "doc_id long, text string, source string")
    for name in ("place", "row", "gone", "exact", "hits", "at"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [("i1", LEAK), ("i2", LEAK.replace("one", "zero")), ("i3", "two three"), ("i4", None), ("i5", LEAK)]
    return spark.createDataFrame(items, "item_id string, text string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [contamination.BLOCK_WORDS, 1])
def test_contamination(docs, benchmark, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block)
    found = contamination.contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    texts = dict(enumerate(t for _, t in ROWS))
    told = brute.contaminated(texts, [(r.item_id, r.text) for r in benchmark.collect()])
    assert rows_of(found) == sorted(((ROWS[k][0], *told[k]) for k in texts), key=repr)
    kept = contamination.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(ROWS[k] for k in texts if not told[k][-1])


def test_personal(docs):
    found = personal.personal_data(docs).select("doc_id", "n_email", "n_ip", "spans").collect()
    expected = Counter((i, len(re.findall("@", t or "")), 1 if "10.0.0.1" in (t or "") else 0) for i, t in ROWS)
    assert Counter((r.doc_id, r.n_email, r.n_ip) for r in found) == expected
    assert all(len(r.spans.split(",")) == r.n_email + r.n_ip for r in found if r.n_email)


def test_packing(docs):
    pieces = packing.pack(docs).collect()
    coder = packing._tokens(packing.vocabulary_path("tiktoken"), packing.vocabulary_path())
    expected = []
    for i, t in ROWS:
        ids = [*coder.encode(t or "").tolist(), packing.END]
        expected.append((i, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)), len(ids)))
    assert Counter((r.doc_id, r.ids_crc32, r.doc_tokens) for r in pieces) == Counter(expected)
    ends = sorted((r.sequence_id, r.offset, r.length) for r in pieces)
    assert [e[1] for e in ends] == [sum(e[2] for e in ends[:k]) for k in range(len(ends))]


def test_lines(spark):
    boiler = [f"notice {k}" for k in range(2)]
    rows = [(k % 12, f"own {k} a\n{boiler[k % 2]}\nown {k} b", f"s{k // 2 % 12}") for k in range(48)]
    rows += [(100, f"keep a\n{boiler[0]}\nx", "s1"), (100, f"{boiler[1]}\nkeep b\nkeep c", "s2"), (None, f"{boiler[0]}\nno id", "s3"), (None, None, "s3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("place", F.lit(1))
    expected = Counter((i, t and "\n".join(x for x in t.split("\n") if x not in boiler)) for i, t, _ in rows)
    assert Counter((r.doc_id, r.text) for r in lines.line_dedup(df).collect()) == expected
    cleaned = lines.clean_lines(df)
    assert cleaned.columns == df.columns and Counter((r.doc_id, r.text) for r in cleaned.collect()) == expected


def test_running_sums(spark):
    lists = [[], [5], list(range(1, 129)), list(range(1000)), [3] * 257]
    df = spark.createDataFrame([(x,) for x in lists], "x array<bigint>").select("x", tables.running_sums("x").alias("sums"))
    for r in df.collect():
        assert r.sums == [sum(r.x[: k + 1]) for k in range(len(r.x))]


def seconds(build, *sizes):
    out = []
    for n in sizes:
        taken = []
        for _ in range(2):
            started = time.perf_counter()
            build(n).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        out.append(min(taken))
    return out


LONG = {
    "mails": (lambda n: "a.b@c.org " * n, personal.personal_data),
    "letters": (lambda n: "x" * (4 * n) + " @ ", personal.personal_data),
    "phrases": (lambda n: "mit license " * n, licenses.license_scan),
    "lines": (lambda n: "\n".join(f"line {k}" for k in range(n)), lines.line_dedup),
}


@pytest.mark.parametrize("kind", LONG)
def test_long_texts_take_time_in_proportion(spark, kind):
    text, operator = LONG[kind]

    def build(n):
        return operator(spark.createDataFrame([(1, text(n), "s")], "doc_id long, text string, source string"))

    small, large = seconds(build, 8_000, 32_000)
    assert large < 5 * small + 2


def test_many_matches_in_one_text(spark):
    text = "a.b@c.org, +49 30 1234567 and 10.0.0.1; " * 300
    r = personal.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    starts = defaultdict(list)
    for kind, pattern in {"email": r"a\.b@c\.org", "phone": r"\+49 30 1234567", "ip": r"10\.0\.0\.1"}.items():
        for m in re.finditer(pattern, text):
            starts[m.start()] = f"{kind}:{m.start()}:{m.end()}"
    listed = ",".join(starts[k] for k in sorted(starts))
    assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.n_email == r.n_phone == r.n_ip == 300


def test_mails_side_by_side(spark):
    texts = ["a@b.c.x@d.e", "a@b.cd@e.f", "..a@b.c", "a@b@c.d", "x" * 50 + "@", "a@b.c,d@e.f;@g.h", "é@b.c", "a@b..c a@-.-"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = {r.doc_id: r.base_sha256 for r in personal.personal_data(df).collect()}
    for k, text in enumerate(texts):
        found = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
        listed = ",".join(f"email:{m.start()}:{m.end()}" for m in found)
        assert told[k] == hashlib.sha256(listed.encode()).hexdigest(), text


MARKUP = {
    "<article><p title=it's>hello</p><p>it's second</p></article>": "hello\n\nit's second",
    '<article><p class="a"">hello world</p></article>': "hello world",
    "<article>a <math><mi>x</mi></math> b<svg><svg><text>in</text></svg><text>rest</text></svg> c</article>": "a x b c",
    '<article>a<script>if (a<b) write("<script>x</"+"script>"); <!-- </script>b</article>': "ab",
    '<article>a <b title="x > y">c</b> <a href=x/>d</a> <i title = \'q>\' >e</i></article>': "a c d e",
    "<article>x<textarea><p>no</textarea>y</article> tail": "xy",
    "<article>a<style>p{}<b>no</STYLE >c</article>": "ac",
    "<article>never closed <script>shown": "never closed shown",
    '<article><p data-x="1>0" title=\'>\'>in</p></article>': "in",
    "<article><template><p>no</p><template>no</template>no</template>yes</article>": "yes",
}


def test_bad_markup(spark):
    df = spark.createDataFrame([(k, "http://h/x", page) for k, page in enumerate(MARKUP)], "page_id long, url string, html string")
    told = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert [told[k] for k in range(len(MARKUP))] == list(MARKUP.values())


def test_pages_take_time_in_proportion():
    def taken(n, close):
        page = "<article>" + f"<script>x{close}t " * n + "</article>"
        best = []
        for _ in range(3):
            started = time.process_time()
            pages.blocks(page)
            best.append(time.process_time() - started)
        return min(best)

    for close in ("</script>", " "):
        assert taken(16_000, close) < 8 * taken(4_000, close) + 0.05
