"""Byte-level BPE against the tiktoken library, token alignment and spelling variants against plain versions."""

import hashlib
import random
import sys
import time
import zlib
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from hailstat.llm import alignment, bytepairs, variants  # noqa: E402

AWKWARD = [
    None, "", " ", " \n\t ", "one", "ONE", "  two  spaces  ", "a b", "▁under", "<|endoftext|> is text", "é Ü ß × ÷", "漢字😀", "x" * 5000,
    "word " * 3000, "it's 12,5 \n\n end ", "ﬁ ligature", "tab\there", "same text", "same text", "spelling spelling speling", "Spelling ​",
]


@pytest.fixture(scope="module")
def tables(spark):
    awkward = [*enumerate(AWKWARD), (3, "again three"), (3, "again three"), (None, "no id"), (None, "no id, another")]
    odd = spark.createDataFrame([(i, t, "s", 0) for i, t in awkward], "doc_id long, text string, source string, word int")
    return {"awkward": odd, "sample": brute.sample(spark), "empty": odd.limit(0)}


KINDS = ["awkward", "sample", "empty"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def library():
    import public_tokenizers
    import tiktoken

    own = bytepairs.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@pytest.mark.parametrize("kind", KINDS)
def test_round_trip(tables, kind):
    docs, (_, coder) = tables[kind], library()
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = coder.encode_ordinary(r.text or "")
        expected.append((
            r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(coder.decode_bytes(ids)).hexdigest(),
        ))
    found = bytepairs.round_trip(docs)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(found) == sorted(expected, key=repr)


def test_encode_and_decode(tables):
    docs = tables["awkward"]
    coded = bytepairs.encode(docs)
    back = Counter((r.doc_id, bytes(r.bytes)) for r in bytepairs.decode(coded).collect())
    assert back == Counter((r.doc_id, (r.text or "").encode()) for r in docs.collect())


def test_odd_words():
    own, coder = library()
    pick = random.Random(7)
    parts = ["a", "e", "the", "  ", "\n", "\x1c", "\x85", " ", " ", "0", "é", "漢", "😀", "!", "-", "'s", "'", "_", "​", "̀"]
    for n in [1, 2, 5, 20, 300] * 60:
        text = "".join(pick.choice(parts) for _ in range(n))
        assert own.encode(text) == coder.encode_ordinary(text), repr(text)
    for letters in ("a", "ab", "abcdefghij", "aAé"):  # ties and overlapping pairs of one rank
        for n in (2, 3, 17, 1000):
            word = "".join(pick.choice(letters) for _ in range(n))
            assert own.encode(word) == coder.encode_ordinary(word), word


def test_words_without_a_space_take_time_in_proportion():
    own, _ = library()
    pick = random.Random(1)

    def seconds(n):
        word = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        best = []
        for _ in range(3):
            started = time.process_time()
            own.encode(word)
            best.append(time.process_time() - started)
        return min(best)

    assert seconds(200_000) < 8 * seconds(50_000)


def plain_alignment(docs):
    """Byte by byte: which tokens of either side cover it."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_of_letter()
    told, counts = [], Counter()
    for doc_id, text in docs:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        pieces = [two.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            told.append((doc_id, [], [], [], set()))
            continue
        of_a = [k for k, t in enumerate(bytes_a) for _ in t]
        of_b = [k for k, t in enumerate(bytes_b) for _ in t]
        linked = set(zip(of_a, of_b))
        parts, start = [], 0
        for i in range(len(of_a)):
            last = i + 1 == len(of_a)
            if last or (of_a[i] != of_a[i + 1] and of_b[i] != of_b[i + 1]):
                parts.append((sorted(set(of_a[start : i + 1])), sorted(set(of_b[start : i + 1]))))
                start = i + 1
        told.append((doc_id, a, b, parts, linked))
        counts.update({(a[x], b[y]) for x, y in linked})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, a, b, parts, linked in told:
        written = ";".join(",".join(str(a[k]) for k in p) + "|" + ",".join(str(b[k]) for k in q) for p, q in parts)
        seen = [(a[x], counts[a[x], b[y]]) for x, y in linked]
        out.append((
            doc_id, len(a), len(b), len(parts), len(linked), sum(n == best[x] for x, n in seen), sum(n for _, n in seen),
            hashlib.sha256(written.encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", KINDS)
def test_alignment(tables, kind):
    docs = tables[kind]
    found = alignment.alignment(docs.repartition(3))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(found) == plain_alignment([(r.doc_id, r.text) for r in docs.collect()])


def test_alignment_over_many_chunks(tables, monkeypatch, spark):
    import numpy as np

    ends_a, ends_b = np.array([2, 4, 5, 9, 12]), np.array([1, 3, 5, 12])
    cuts = alignment.groups(ends_a, ends_b)
    assert [c.tolist() for c in cuts] == [[3, 5], [3, 4]]
    a, b = alignment.links(ends_a, ends_b, *cuts)
    assert set(zip(a.tolist(), b.tolist())) == {(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (3, 3), (4, 3)}
    one_each = tables["sample"].repartition(40)
    assert rows_of(alignment.alignment(one_each)) == rows_of(alignment.alignment(tables["sample"].coalesce(1)))


def near(x, y):
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\x80" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    around = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        if around[w]:
            best = min(around[w], key=lambda v: (-words[v], v))
            if words[best] >= 10 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(around[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out, key=repr)


CHAIN = (
    "spelling " * 2 + "spellinga " * 25 + "spellingab " * 260 + "spellingabc " * 2700 + "Éclairs éclairs éclairs ÉCLAIRS éclaire éclaire "
    + "letters lettres lettres letters aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa tieaaaa tieaaaa tieaaab tieaaab tieaaac tieaaac "
)


@pytest.mark.parametrize("kind", [*KINDS, "chain"])
def test_variants(tables, spark, kind):
    if kind == "chain":
        docs = spark.createDataFrame([(i, CHAIN) for i in range(40)] + [(None, CHAIN)], "doc_id long, text string")
    else:
        docs = tables[kind]
    found = variants.spelling_variants(docs).select("word", "n", "n_near", "form", "form_n", "root")
    expected = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(found) == expected
    if kind == "chain":
        assert max(len(r[0]) for r in expected if r[5] != r[0]) > 7 and any(r[3] and r[3] != r[5] for r in expected)


def test_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 10)
    text = "wordone wordtwo,wordthree " + "x" * 50 + " wordone"
    cut = list(variants.slices(text))
    assert "".join(cut) == text and len(cut) > 2
    assert [r for part in cut for r in variants.RUN.findall(part)] == variants.RUN.findall(text)


def test_near_words_share_a_signature():
    pick = random.Random(3)
    for _ in range(300):
        word = "".join(pick.choice("abcdeé") for _ in range(pick.randint(7, 15)))
        i, c = pick.randrange(len(word)), pick.choice("abcdeéz")
        for other in (word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]):
            one, two = variants.signatures([word, other])
            assert (one == two).any()
