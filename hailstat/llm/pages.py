"""Main text of web pages: page structure, and suffix arrays over the token streams of a host.

A page is cut into blocks at its block elements. Blocks inside elements that are never content (menus,
headers, footers, side bars, notices, adverts, forms, comments of readers, by element or by the words of
class and id) are frame. Blocks inside ``article`` or ``main`` are the article, also where a frame is
around it, but not inside side matter (side bars, comments, adverts, related pages, what is hidden).
Everything else is loose. Headings and paragraphs are never frame by their id. The text of a page is its article,
or its loose blocks if it marks none.

The texts of all pages of a host are one concatenated token stream, and so are their frame and loose blocks. Their
suffixes are sorted over all tasks: those with ``LONG`` tokens or more from any place, six words to a symbol, and
those from the start of a block, word by word with a mark on the last word of each block. The longest common prefix
of a suffix with its nearest neighbours of another text is a run that repeats, if it has ``LONG`` tokens, or whole
blocks with ``RUN`` tokens or more together, as many as are shared. A longer run is covered by the suffixes inside it,
so none is compared beyond ``LONG`` tokens.

Most text stands on one page alone, so a suffix is sorted only if its seed stands in several texts: what all suffixes
that start with the same run have in common, the least symbol of the ``LONG`` tokens or the fewest whole blocks. That
is looked up in a filter of fixed size, which may find too much, never too little. One seed serves thirteen places on
average, and the keys of one run start alike, so that its suffixes meet in one task.

A run is boilerplate if it repeats outside of articles. Loose blocks lose the tokens that such runs cover and keep the
rest, so what repeats is told from what is a page's own without names of elements. Copies of a page are one text, so
they keep theirs, and so does a page of which nothing would stay. A phrase inside longer blocks is no boilerplate. A
page whose url names no host has no other pages. A page that marks its article keeps it whole, even where it repeats on
other pages. How many words of a text repeat, in articles or not, stands beside it.
"""

from __future__ import annotations

import html
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property, partial
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm import words as W
from hailstat.llm.tables import stored

RUN = 6
LONG = 5 * RUN
SOME = 20_000  # suffixes that are folded at a time

# Element names of the HTML standard by role.
SILENT = frozenset("script style template noscript iframe object svg head title textarea select".split())
# Of these, what may hold elements of its own name; the content of the others is no markup.
NESTED = frozenset("template noscript object svg head select".split())
FRAME = frozenset("nav header footer aside form menu dialog button".split())
CONTENT = frozenset("article main".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class, id or role that mark what is not the article.
FRAME_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent "
    "cookie cookies disqus feedback footer header menu modal nav navbar navigation newsletter notice notices notification popup promo "
    "promoted related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Of these, what holds articles that are not the page's own.
SIDE = frozenset("aside nav footer".split())
SIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts comment comments complementary disqus footer nav navbar navigation promo "
    "promoted related sidebar sponsor sponsored widget".split()
)
UNNAMED = frozenset("h1 h2 h3 h4 h5 h6 p".split())
# A quote opens a value only behind an equals sign; anywhere else a tag ends at the next ">".
ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)(" + ATTRIBUTES + r")(?:>|\Z)", re.S
)
NAMES = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


@cache
def _ends(name: str) -> re.Pattern:
    """Where elements of a name open or close."""
    return re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])(?:{ATTRIBUTES}>)?", re.I)


def _behind(page: str, at: int, name: str) -> int | None:
    """The place behind a silent element that opened before ``at``; None if it is never closed."""
    depth = 1
    for found in _ends(name).finditer(page, at):
        if found[1]:
            depth -= 1
        elif name in NESTED and not found[0].endswith("/>"):
            depth += 1
        if not depth:
            return found.end() if found[0].endswith(">") else len(page)
    return None


def _frame(name: str, attributes: str) -> str:
    """``side``, ``frame`` or nothing; a name with hyphens counts if all its parts are frame words."""
    if name in FRAME:
        return "side" if name in SIDE else "frame"
    if name in ("html", "body") or not attributes:
        return ""
    if HIDDEN.search(attributes):
        return "side"
    kind = ""
    for attribute, *values in NAMES.findall(attributes):
        if attribute.lower() == "id" and name in UNNAMED:
            continue
        for whole in "".join(values).lower().split():
            parts = re.split(r"[-_]+", whole.strip("-_"))
            if all(w in FRAME_WORDS for w in parts):
                kind = "side" if kind == "side" or any(w in SIDE_WORDS for w in parts) else "frame"
    return kind


def blocks(page: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the blocks in page order; the role is ``article``, ``frame`` or ``loose``.

    White space inside a block is one space, character references are decoded. Elements that are not
    closed end with the element around them.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # names and roles of open elements
    pieces: list[str] = []
    at = 0
    open_ended: set[str] = set()  # silent elements that nothing closes any more

    def role() -> str:
        return stack[-1][1] if stack else "loose"  # ``side`` is a frame that no article opens

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append(("frame" if role() == "side" else role(), text))

    while token := TOKEN.search(page, at):
        if at < token.start():
            pieces.append(page[at : token.start()])
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        closing = bool(token[1])
        if name in SILENT:
            if not closing and name not in open_ended and not token[3].rstrip().endswith("/"):
                behind = _behind(page, at, name)
                if behind is None:
                    open_ended.add(name)
                else:
                    at = behind
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BREAKS:
            flush()
        if name in VOID:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
            continue
        if name == "p" and any(n == "p" for n, _ in stack):  # a paragraph ends where the next begins
            depth = max(i for i, (n, _) in enumerate(stack) if n == "p")
            if all(n not in BREAKS for n, _ in stack[depth + 1 :]):
                del stack[depth:]
        own = role()
        if own != "side":
            if name in CONTENT:
                own = "article"
            elif own != "frame" and name == "header" and any(r == "article" for _, r in stack):
                own = "article"  # the article's own head line
            else:
                own = _frame(name, token[3]) or own
        stack.append((name, own))
    pieces.append(page[at:])
    flush()
    return out


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", url or "")
    return (found[1].rpartition("@")[2].partition(":")[0] if found else "").lower()


HEAD = 9  # bytes that all suffixes with a run in common share: the kind, and two symbols or the fewest whole blocks
SYMBOL = 8
SHORT = 4  # bytes of a symbol of ``RUN`` words
FIRST = np.uint64(1)  # in the hash of a word: the last one of its block


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` neighbours."""
    width = 1
    while width < n:
        step = min(width, n - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values


@dataclass
class Stream:
    """Hashes of the words of some blocks of all pages, one page after another."""

    hashes: np.ndarray
    first: np.ndarray  # the first word of each page, and the number of words
    stops: np.ndarray  # where each block ends
    pages: np.ndarray  # the page of each block

    @classmethod
    def of(cls, words: W.Words, hashes: np.ndarray, pages: np.ndarray, chosen: np.ndarray, n: int) -> Stream:
        counts, pages = words.counts[chosen], pages[chosen]
        stops = np.cumsum(counts)
        first = np.concatenate([np.zeros(1, np.int64), stops])[np.searchsorted(pages, np.arange(n + 1))]
        return cls(hashes[W.gather(counts, words.first[:-1][chosen])], first, stops, pages)

    @cached_property
    def symbols(self) -> np.ndarray:
        """A hash of ``RUN`` words from each place."""
        at = np.arange(max(len(self.hashes) - RUN + 1, 0))
        return W.runs(self.hashes, at, at + RUN)

    @cached_property
    def marked(self) -> np.ndarray:
        """The hashes, whose last bit marks the last word of each block."""
        marked = self.hashes & ~FIRST
        marked[self.stops - 1] |= FIRST
        return marked

    def long_runs(self, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, page and seed of each run of ``LONG`` words. The seed is the least of its symbols and the host."""
        n = max(len(self.hashes) - LONG + 1, 0)
        pages = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero((pages[:n] == pages[LONG - 1 :]) & (hosts[pages[:n]] != 0)) if n else np.zeros(0, np.int64)
        least = _least(self.symbols, LONG - RUN + 1)[at] if n else np.zeros(0, np.uint64)
        return at, pages[at], W.mix(least ^ hosts[pages[at]])

    def block_runs(self, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place, page, seed and end of as many whole blocks as ``LONG`` words hold. The seed is the fewest blocks of ``RUN`` words."""
        starts = np.concatenate([np.zeros(1, np.int64), self.stops])[:-1]
        fewest = np.searchsorted(self.stops, starts + RUN)
        ends = np.append(self.stops, np.iinfo(np.int64).max)[fewest]
        kept = np.flatnonzero((ends <= np.minimum(starts + LONG, self.first[self.pages + 1])) & (hosts[self.pages] != 0))
        starts, pages = starts[kept], self.pages[kept]
        last = np.minimum(np.searchsorted(self.stops, starts + LONG, side="right"), np.searchsorted(self.pages, pages, side="right")) - 1
        return starts, pages, W.mix(~W.runs(self.marked, starts, ends[kept]) ^ hosts[pages]), self.stops[last]

    def long_keys(self, at: np.ndarray, hosts: np.ndarray) -> list[bytes]:
        """The sort keys of suffixes from any place, ``RUN`` words to a symbol."""
        symbols = W.mix(self.symbols[at[:, None] + np.arange(0, LONG, RUN)] ^ hosts[:, None]) >> np.uint64(32)
        rows, width = symbols.astype(">u4").tobytes(), SHORT * LONG // RUN
        return [b"\0" + rows[k : k + width] for k in range(0, len(rows), width)]

    def block_keys(self, starts: np.ndarray, seeds: np.ndarray, stops: np.ndarray) -> list[bytes]:
        """The sort keys of suffixes from the start of a block, a word to a symbol."""
        rows, heads = self.marked.astype(">u8").tobytes(), seeds.astype(">u8").tobytes()
        return [
            b"\1" + heads[SYMBOL * k : SYMBOL * (k + 1)] + rows[SYMBOL * a : SYMBOL * b] for k, (a, b) in enumerate(zip(starts.tolist(), stops.tolist()))
        ]


ROLES = {"article": 0, "frame": 1, "loose": 2}


class Pages:
    """Some rows of pages: their blocks, host, and the streams of their text and of all that is no article.

    ``told`` names the host and the blocks of the text, ``whole`` the words beside the frame; copies of a page agree in both.
    Pages without a host or a text have any name, since no runs are looked up by it.
    """

    def __init__(self, part: pa.RecordBatch):
        found = [blocks(page or "") for page in part.column("html").to_pylist()]
        n = len(found)
        self.found = found
        roles = np.array([ROLES[r] for page in found for r, _ in page], np.int8)
        pages = np.repeat(np.arange(n), [len(page) for page in found])
        self.marked = np.bincount(pages[roles == ROLES["article"]], minlength=n) > 0
        own = roles == np.where(self.marked, ROLES["article"], ROLES["loose"])[pages]
        words = W.find_words(pa.array([t for page in found for _, t in page], pa.string()), W.SPACED, lower=False)
        hashes, other = words.hashes(), roles != ROLES["article"]
        self.text = Stream.of(words, hashes, pages, own, n)
        self.rest = Stream.of(words, hashes, pages, other, n)
        self.shared = np.repeat(own[other], words.counts[other])  # words of ``rest`` that stand in ``text`` too
        names = [host_of(u) for u in part.column("url").to_pylist()]
        told = W.find_words(pa.array([x or "-" for x in names], pa.string()), W.SPACED, lower=False)
        known = np.array([bool(x) for x in names], bool)
        self.hosts = np.where(known, W.runs(told.hashes(), told.first[:-1], told.first[1:]) | FIRST, np.uint64(0))
        beside = Stream.of(words, hashes, pages, roles != ROLES["frame"], n)
        self.whole = W.runs(beside.hashes, beside.first[:-1], beside.first[1:]).view(np.int64)
        text = W.runs(self.text.marked, self.text.first[:-1], self.text.first[1:])
        text = np.where(known & (np.diff(self.text.first) > 0), text ^ self.hosts ^ self.marked.astype(np.uint64), np.arange(n, dtype=np.uint64))
        self.told = W.mix(text).view(np.int64)

    @property
    def texts(self) -> list[str]:
        return ["\n\n".join(t for r, t in page if r == ("article" if m else "loose")) for page, m in zip(self.found, self.marked.tolist())]

    def runs(self) -> Iterator[tuple[bool, bool, tuple[np.ndarray, ...]]]:
        """For the stream of the text and what the other has besides: whether it is the text's, whether from any place, and the runs."""
        inside = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.shared)])
        for own, stream in ((True, self.text), (False, self.rest)):
            for long in (True, False):
                found = stream.long_runs(self.hosts) if long else stream.block_runs(self.hosts)
                if not own:
                    stops = found[0] + LONG if long else found[3]
                    more = inside[stops] - inside[found[0]] < stops - found[0]
                    found = tuple(x[more] for x in found)
                yield own, long, found


SEEDS = "seed long, whole long"


def _seeds(batches) -> Iterator[pa.RecordBatch]:
    """The seeds of all runs that may repeat, with the text that they stand in."""
    for part in W.chunks(batches, column="html"):
        pages = Pages(part)
        for _, _, (_, at, seeds, *_) in pages.runs():
            new = np.ones(len(seeds), bool)
            new[1:] = (seeds[1:] != seeds[:-1]) | (at[1:] != at[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(seeds[new].view(np.int64)), pa.array(pages.whole[at[new]])], ["seed", "whole"])


BITS = 1 << 28  # of a filter at most, 32 MB


def _filter(values: DataFrame) -> np.ndarray:
    """Bits for a stored column of longs, two for each value; what it holds besides grows with the table beyond ``BITS``."""
    bits = min(BITS, 1 << max(16, (32 * values.count()).bit_length()))
    value = F.col(values.columns[0])
    slot = F.explode(F.array(*(v.bitwiseAND(bits - 1) + 1 for v in (value, F.shiftright(value, 32)))))
    rows = values.select(slot.alias("slot")).select(F.bitmap_bucket_number("slot").alias("bucket"), F.bitmap_bit_position("slot").alias("bit"))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for bucket, found in rows.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():
        out[bucket - 1] = np.frombuffer(found, np.uint8)
    return out.reshape(-1)


def _among(values: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each value."""
    found = np.ones(len(values), bool)
    for some in (values, values >> np.uint64(32)):
        slots = some & np.uint64(8 * len(told) - 1)
        found &= (told[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


SUFFIXES = "key binary, low long, high long, told long, places array<int>, outside boolean"
SUFFIX_TYPES = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.bool_())


def _suffixes(batches, repeated: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The suffixes whose seeds may stand in several texts, with the least and the greatest of the texts that they stand in.

    Equal ones are folded: those of a page's own text into its name and their places, the others all together.
    """
    seen: dict[bytes, tuple[int, int]] = {}
    placed: dict[tuple[int, int, bytes], tuple[bool, list[int]]] = {}

    def own_rows() -> pa.RecordBatch:
        rows = [(key, whole, whole, told, found, outside) for (told, whole, key), (outside, found) in placed.items()]
        placed.clear()
        return _table(rows, SUFFIXES, SUFFIX_TYPES)

    def other_rows() -> pa.RecordBatch:
        rows = [(key, low, high, None, None, True) for key, (low, high) in seen.items()]
        seen.clear()
        return _table(rows, SUFFIXES, SUFFIX_TYPES)

    for part in W.chunks(batches, column="html"):
        pages = Pages(part)
        names = list(zip(pages.told.tolist(), pages.whole.tolist(), (~pages.marked).tolist()))
        once = np.zeros(len(names), bool)  # copies of a page have the same places
        once[list({name: k for k, name in enumerate(names)}.values())] = True
        for own, long, found in pages.runs():
            chosen = _among(found[2], repeated)
            if own:
                chosen &= once[found[1]]
            starts, at, seeds, *stops = (x[chosen] for x in found)
            stream = pages.text if own else pages.rest
            for a in range(0, len(starts), SOME):
                some = slice(a, a + SOME)
                keys = stream.long_keys(starts[some], pages.hosts[at[some]]) if long else stream.block_keys(starts[some], seeds[some], stops[0][some])
                for key, page, place in zip(keys, at[some].tolist(), (starts[some] - stream.first[at[some]]).tolist()):
                    told, whole, outside = names[page]
                    if own:
                        placed.setdefault((told, whole, key), (outside, []))[1].append(place)
                    else:
                        low, high = seen.get(key, (whole, whole))
                        seen[key] = min(low, whole), max(high, whole)
                if len(placed) >= SOME:
                    yield own_rows()
                if len(seen) >= SOME:
                    yield other_rows()
        yield own_rows()
    yield other_rows()


def _table(rows: list[tuple], columns: str, types: tuple) -> pa.RecordBatch:
    listed = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(listed, types)], [c.split()[0] for c in columns.split(", ")])


def common_prefix(a: bytes, b: bytes) -> int:
    """The number of symbols at the start of both keys; none if their kinds or the fewest blocks differ."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    same = n - (differ.bit_length() + 7) // 8
    return max(0, same - HEAD) // SYMBOL if a[0] else max(0, same - 1) // SHORT


def _run_words(key: bytes, symbols: int) -> int:
    """The words of a run that is the first symbols of a key, cut back to whole blocks; 0 if it is too short."""
    if not key[0]:
        return LONG if symbols * RUN >= LONG else 0
    while symbols and not key[HEAD + SYMBOL * symbols - 1] & 1:
        symbols -= 1
    return symbols if symbols >= RUN else 0


class _Neighbours:
    """The longest run at the start of each of the sorted suffixes that are put in.

    Neighbours of one text that start with one run are passed over together; on either side of them stands another text,
    or no run is shared.
    """

    def __init__(self):
        self.before: tuple | None = None
        self.held: list[tuple] = []

    def put(self, row: tuple) -> Iterator[tuple[tuple, int]]:
        last = self.held[-1] if self.held else None
        if last and not (row[1] == row[2] and row[1:3] == last[1:3] and _run_words(row[0], common_prefix(row[0], last[0]))):
            yield from self.out(row)
        self.held.append(row)

    def out(self, after: tuple | None = None) -> Iterator[tuple[tuple, int]]:
        for row in self.held:
            key, low, high, *_ = row
            if low < high:
                symbols = (len(key) - HEAD) // SYMBOL if key[0] else LONG // RUN
            else:
                symbols = max((common_prefix(key, other[0]) for other in (self.before, after) if other), default=0)
            if words := _run_words(key, symbols):
                yield row, words
        self.before, self.held = self.held[-1] if self.held else self.before, []


def _sorted_rows(batches) -> Iterator[tuple[tuple, tuple | None]]:
    """Sorted suffixes, equal ones as one, with the texts and places where they stand; and the same outside of articles."""
    names = [c.split()[0] for c in SUFFIXES.split(", ")]
    rows = chain.from_iterable(zip(*(batch.column(c).to_pylist() for c in names)) for batch in batches)
    for key, equal in groupby(rows, lambda row: row[0]):
        bounds: list = [None, None, None, None]
        tolds, places = array("q"), array("i")
        for _, low, high, told, found, outside in equal:
            for k in (0, 2) if outside else (0,):
                bounds[k] = low if bounds[k] is None else min(bounds[k], low)
                bounds[k + 1] = high if bounds[k + 1] is None else max(bounds[k + 1], high)
            if told is not None:
                tolds.extend([told] * len(found))
                places.extend(found)
        yield (key, *bounds[:2], tolds, places), (key, *bounds[2:], tolds, places) if bounds[2] is not None else None


RUNS = "told long, place int, stop int, cut boolean"
RUN_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.bool_())


def _longest(batches) -> Iterator[pa.RecordBatch]:
    """The longest run from each place of a page's text; ``cut`` if it also stands outside of the articles of other texts."""
    every, outside = _Neighbours(), _Neighbours()
    out: list[tuple] = []

    def told(found: Iterator[tuple[tuple, int]], cut: bool) -> Iterator[pa.RecordBatch]:
        for (_, _, _, tolds, places), words in found:
            for page, place in zip(tolds, places):
                out.append((page, place, place + words, cut))
                if len(out) >= SOME:
                    yield _table(out, RUNS, RUN_TYPES)
                    out.clear()

    for row, loose in _sorted_rows(batches):
        yield from told(every.put(row), False)
        if loose:
            yield from told(outside.put(loose), True)
    yield from told(every.out(), False)
    yield from told(outside.out(), True)
    yield _table(out, RUNS, RUN_TYPES)


PLACES = "told long, places array<struct<place:int,stop:int,cut:boolean>>"
PLACE_TYPES = (pa.int64(), pa.list_(pa.struct({"place": pa.int32(), "stop": pa.int32(), "cut": pa.bool_()})))


def _spans(batches) -> Iterator[pa.RecordBatch]:
    """Runs sorted by text and place; those that meet are one."""
    rows = chain.from_iterable(zip(*(batch.column(c).to_pylist() for c in ("told", "cut", "place", "stop"))) for batch in batches)
    out: list[tuple] = []
    for told, runs in groupby(rows, lambda row: row[0]):
        spans: list[dict] = []
        for _, cut, place, stop in runs:
            if spans and spans[-1]["cut"] == cut and place <= spans[-1]["stop"]:
                spans[-1]["stop"] = max(stop, spans[-1]["stop"])
            else:
                spans.append({"place": place, "stop": stop, "cut": cut})
        out.append((told, spans))
        if len(out) >= SOME:
            yield _table(out, PLACES, PLACE_TYPES)
            out.clear()
    yield _table(out, PLACES, PLACE_TYPES)


def repeated_runs(pages: DataFrame) -> DataFrame:
    """``told, places``: the words of each text, by its host and blocks, in runs that stand in several texts of the host.

    Suffixes that start with one run also share a seed, so those whose seed stands in one text only are not sorted; and
    they share the first bytes of their keys, so that none of them meet across tasks.
    """
    seeds = pages.mapInArrow(_seeds, SEEDS).groupBy("seed").agg(F.min("whole").alias("low"), F.max("whole").alias("high"))
    repeated = _filter(stored(seeds.where("low < high").select("seed"), "seeds"))
    suffixes = pages.mapInArrow(partial(_suffixes, repeated=repeated), SUFFIXES)
    runs = suffixes.repartition(F.substring("key", 1, HEAD)).sortWithinPartitions("key").mapInArrow(_longest, RUNS)
    return runs.repartition("told").sortWithinPartitions("told", "cut", "place").mapInArrow(_spans, PLACES)


TEXTS = "page_id long, url string, text string, n_repeated long"
PACKED = "told long, page_id long, url string, marked boolean, size int, packed binary"
CODEC = "zstd"


def _packed(batches) -> Iterator[pa.RecordBatch]:
    """The texts of pages as bytes that take little of a shuffle."""
    codec = pa.Codec(CODEC)
    for part in W.chunks(batches, column="html"):
        pages = Pages(part)
        texts = [t.encode() for t in pages.texts]
        columns = [pa.array(pages.told), part.column("page_id"), part.column("url"), pa.array(pages.marked),
                   pa.array(list(map(len, texts)), pa.int32()), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PACKED.split(", ")])


def _own_text(batches) -> Iterator[pa.RecordBatch]:
    """Articles, and loose blocks without the tokens that runs outside of articles cover; and how many of the words repeat."""
    codec = pa.Codec(CODEC)
    for batch in batches:
        texts: list[str] = []
        counts: list[int] = []
        size = done = 0
        for at, row in enumerate(zip(*(batch.column(c).to_pylist() for c in ("marked", "size", "packed", "places")))):
            marked, length, packed, places = row
            text, n = codec.decompress(packed, length, asbytes=True).decode(), 0
            if places:
                text, n = _kept(text, places, marked)
            texts.append(text)
            counts.append(n)
            size += length
            if size >= W.CHUNK_BYTES or at + 1 == batch.num_rows:
                part = batch.slice(done, at + 1 - done)
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in TEXTS.split(", ")])
                texts, counts, size, done = [], [], 0, at + 1


def _kept(text: str, places: list[dict], marked: bool) -> tuple[str, int]:
    """A text without what is cut, unless that is all, and how many words of it repeat."""
    tokens = [t.split() for t in text.split("\n\n")]
    n = sum(map(len, tokens))
    repeated, covered = np.zeros(n, bool), np.zeros(n, bool)
    for place in places:
        repeated[place["place"] : place["stop"]] = True
        if place["cut"] and not marked:
            covered[place["place"] : place["stop"]] = True
    if covered.all() or not covered.any():
        return text, int(repeated.sum())
    at, kept = 0, []
    for block in tokens:
        own = [t for t, c in zip(block, covered[at : at + len(block)]) if not c]
        at += len(block)
        if own:
            kept.append(" ".join(own))
    return "\n\n".join(kept), int((repeated & ~covered).sum())


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages(page_id, url, html)``: ``page_id, url, text, n_chars, n_repeated``.

    ``n_repeated`` words of the text stand in runs that other texts of the host have too, in an article or not.
    A null or empty page, or one without text, has an empty text. A page without a host has no other pages.
    Pages are read whole, other columns never; repeated rows give repeated results, and pages with the same
    page_id or none are told apart by their host and words; no rows give no rows. The rows are read three times,
    since what is made of them would take more disk than they do.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    places = stored(repeated_runs(pages), "runs")
    texts = pages.mapInArrow(_packed, PACKED).join(places.hint("merge"), "told", "left").mapInArrow(_own_text, TEXTS)
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
