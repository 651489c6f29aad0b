"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased and their blanks collapsed.  A benchmark item of m characters is cut into
floor(m / q) q-grams that don't overlap; k edits spoil at most k of them, so that any stretch of a document
within k edits has the other ones, on diagonals no more than k apart.  Hits are counted in
overlapping bands of diagonals; a band with too few is discarded by the lemma, the others are aligned
within the band.  k is a tenth of m, rounded down, at every length; q is the largest of 8, 6, 5 and 4 of which at least two have to match.
Items of fewer than ``SHORT`` characters are names and numbers more than passages: these match without edits, as whole words.

Documents are scanned once for each block of the benchmark (at most ``BLOCK_CHARS`` characters, one block at a time, which bounds what is
sent to executors and the driver) and aren't shuffled.  Q-grams are compared as folded bytes (the low byte of each
code point): equal text has equal bytes, so that none is lost, and the alignment compares characters.  Where many items share q-grams,
items are taken in ranges, so that about ``MOST_HITS`` hits are held at once.

Defined results: null and empty texts match nothing, and null and empty items are in nothing; repeated items match each by themselves, as
repeated documents do; of equally good places the first one counts; an empty benchmark leaves every document; very long texts are searched in
parts, and only what lies around a candidate is aligned.  ``contaminated`` ignores other columns; ``clean_documents`` keeps them as they are.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime

SIZES = (8, 6, 5, 4)
SHORT = 16
#: Edits allowed for each character of an item; at most 0.2, so that q-grams of 4 still have to match.
EDITS = 0.1
BLOCK_CHARS = 4_000_000
CHUNK_CHARS = 1 << 16
MOST_HITS = 1 << 20
FILTER_BITS = 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def folded(text: str) -> np.ndarray:
    return codes_of(text).astype(np.uint8)


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q-gram at each position, as one integer: q is at most 8, so that there are no collisions."""
    if len(data) < q:
        return np.empty(0, np.uint64)
    padded = np.concatenate((data, np.zeros(8 - q, np.uint8)))
    out = np.ndarray((len(data) - q + 1,), np.dtype("<u8"), padded, 0, (1,)).copy()
    return out if q == 8 else out & np.uint64((1 << (8 * q)) - 1)


class Samples:
    """The q-grams of one size, with the items and places that they are sampled from."""

    def __init__(self, q: int, parts: list[tuple[int, np.ndarray, np.ndarray]], items: int):
        self.q = q
        gram, at = (np.concatenate([x[k] for x in parts]) for k in (1, 2))
        item = np.repeat([i for i, _, _ in parts], [len(g) for _, g, _ in parts])
        order = np.argsort(gram, kind="stable")
        self.gram, self.start, self.many = np.unique(gram[order], return_index=True, return_counts=True)
        self.item, self.at = item[order], at[order]
        self.key = np.repeat(np.arange(len(self.gram)), self.many) * items + self.item  # ascending
        self.items = items
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.slot(self.gram)] = True

    @staticmethod
    def slot(gram: np.ndarray) -> np.ndarray:
        return ((gram * SPREAD) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in data, and numbers of the grams there."""
        gram = grams(data, self.q)
        where = np.flatnonzero(self.maybe[self.slot(gram)])
        near = np.minimum(np.searchsorted(self.gram, gram[where]), len(self.gram) - 1)
        same = self.gram[near] == gram[where]
        return where[same], near[same]

    def postings(self, near: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For found grams: which of them, the items from low to high - 1 that have it, and where."""
        first, last = (np.searchsorted(self.key, near * self.items + x) for x in (low, high))
        many = last - first
        each = np.repeat(np.arange(len(near)), many)
        posting = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(each))
        return each, self.item[posting], self.at[posting]


class Index:
    """The q-gram samples of some items."""

    def __init__(self, items: list[tuple[object, str]], edits: float = EDITS):
        if edits > 0.2:
            raise ValueError("at most 0.2 edits for each character")
        found = [(i, n) for i, t in items if (n := normal(t))]
        self.ids, self.texts = [i for i, _ in found], [t for _, t in found]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.where(self.length < SHORT, 0, (edits * self.length).astype(np.int64))
        self.least = np.ones(len(found), np.int64)
        parts: dict[int, list] = {}
        for i, text in enumerate(self.texts):
            m, k = len(text), int(self.budget[i])
            if m < SHORT:
                q, size = min(8, m), 1
            else:
                q = next((q for q in SIZES if m // q - k >= 2), SIZES[-1])
                size = m // q
                self.least[i] = size - k
            own = grams(folded(text), q)[::q][:size]
            parts.setdefault(q, []).append((i, own, np.arange(len(own)) * q))
        self.samples = [Samples(q, some, len(found)) for q, some in sorted(parts.items())]

    def hits(self, texts: list[str]):
        """(text, position, item, position in the item) of equal q-grams, for one range of items after another."""
        found = []
        for part, text, begin, size in pieces(texts):
            for s, sample in enumerate(self.samples):
                where, near = sample.find(part)
                k = np.searchsorted(begin, where, "right") - 1
                inside = where - begin[k] < size[0][k]
                found.append((s, text[k][inside], (where - begin[k] + size[1][k])[inside], near[inside]))
        total = sum(int(self.samples[s].many[near].sum()) for s, _, _, near in found)
        ranges = min(max(1, len(self.texts)), -(-total // MOST_HITS))
        edges = np.linspace(0, len(self.texts), ranges + 1).astype(np.int64)
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            out = []
            for s, text, position, near in found:
                each, item, at = self.samples[s].postings(near, low, high)
                if len(each):
                    out.append((text[each], position[each], item, at))
            if out:
                yield tuple(np.concatenate(x) for x in zip(*out, strict=True))


def pieces(texts: list[str]):
    """Folded characters of about CHUNK_CHARS: a long text's parts, with a few characters more for the grams that begin in a part.

    Each has the texts, where their parts begin in the piece, and (how many grams may begin there, where the part begins in the text)."""
    some, size = [], 0
    for t, text in enumerate(texts):
        for a in range(0, len(text), CHUNK_CHARS):
            some.append((t, a, text[a : a + CHUNK_CHARS + 7]))
            size += len(some[-1][2])
            if size >= CHUNK_CHARS:
                yield _piece(some)
                some, size = [], 0
    if some:
        yield _piece(some)


def _piece(some: list[tuple[int, int, str]]):
    data = np.concatenate([x for _, _, part in some for x in (folded(part), np.ones(1, np.uint8))])
    begin = np.concatenate(([0], np.cumsum([len(part) + 1 for _, _, part in some])[:-1]))
    return data, np.array([t for t, _, _ in some]), begin, (np.array([min(len(part), CHUNK_CHARS) for _, _, part in some]), np.array([a for _, a, _ in some]))


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """The fewest edits (at most ``most``) between the item and a stretch of text that starts near the
    diagonals [low, high), and where the stretch ends.  Rows are items' characters, columns the band."""
    low, high = low - most, high + most
    width = high - low
    step = np.arange(width)
    row = np.zeros(width, np.int64)
    columns = low + step
    row[(columns < 0) | (columns > len(text))] = most + 1
    padded = np.full(len(item) + width + 1, -1, np.int64)
    a, b = max(0, low), min(len(text), low + len(padded))
    if a < b:
        padded[a - low : b - low] = text[a:b]
    wide = np.full(width + 1, most + 1, np.int64)
    for i, c in enumerate(item):
        wide[:-1] = row
        row = np.minimum(row + (padded[i : i + width] != c), wide[1:] + 1)
        row = np.minimum.accumulate(row - step) + step
        if row.min() > most:
            return None
    best = int(row.argmin())
    return int(row[best]), low + len(item) + best


def candidates(index: Index, texts: list[str]):
    """(text, item, first diagonal) of the bands with enough hits."""
    for text, position, item, at in index.hits(texts):
        # Bands of diagonals: band b is [b, b + 2) steps of k + 1, so that k neighbouring diagonals are in one band.
        band = np.floor_divide(position - at, index.budget[item] + 1)
        order = np.lexsort((band, item, text))
        text, item, band = text[order], item[order], band[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(text)))
        text, item, band = text[first], item[first], band[first]
        beside = np.zeros(len(first), np.int64)
        joined = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (band[1:] == band[:-1] + 1)
        beside[:-1][joined] = count[1:][joined]
        enough = count + beside >= index.least[item]
        yield from zip(text[enough].tolist(), item[enough].tolist(), (band * (index.budget[item] + 1))[enough].tolist(), strict=True)


def matches(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) for each item that a text holds, at its best place; offsets in normalised text, the start estimated by the item's length."""
    normals = [normal(t) for t in texts]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, i, low in candidates(index, normals):
        if best.get((t, i), (1,))[0] == 0:
            continue
        item, text, most = index.texts[i], normals[t], int(index.budget[i])
        if len(item) < SHORT:
            if text.startswith(item, low) and not (low and _joins(text[low - 1], item[0])) and not (low + len(item) < len(text) and _joins(item[-1], text[low + len(item)])):
                best[t, i] = (0, low, low + len(item))
            continue
        at = text.find(item, max(0, low), max(0, low) + 2 * (most + 1) + len(item))
        if at >= 0:
            best[t, i] = (0, at, at + len(item))
            continue
        begin = max(0, low - most)
        got = align(codes_of(item).astype(np.int64), codes_of(text[begin : low + len(item) + 4 * (most + 1)]).astype(np.int64), low - begin, low - begin + 2 * (most + 1), most)
        if got and got[0] < best.get((t, i), (most + 1,))[0]:
            end = begin + got[1]
            best[t, i] = (got[0], max(0, end - len(item)), min(end, len(text)))
    return [(t, i, start, end, edits) for (t, i), (edits, start, end) in sorted(best.items())]


def _joins(a: str, b: str) -> bool:
    """Whether two neighbouring characters are of one word."""
    return bool(re.match(r"\w\w", a + b))


def _chunks(texts: list):
    first, some, size = 0, [], 0
    for i, t in enumerate(texts):
        some.append(t)
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield first, some
            first, some, size = i + 1, [], 0
    if some:
        yield first, some


def blocks(benchmark: DataFrame, item_col: str, text_col: str, edits: float):
    """The benchmark's index, in blocks of bounded size: one block is on the driver at a time."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("_item"), F.col(f"`{text_col}`").cast("string").alias("_text")).where("_text IS NOT NULL")
    total = items.agg(F.sum(F.char_length("_text"))).first()[0] or 0
    many = -(-total // BLOCK_CHARS)
    part = F.pmod(F.xxhash64("_item", "_text"), F.lit(max(1, many)))
    for k in range(many):
        index = Index(sorted(((r._item, r._text) for r in items.where(part == k).collect()), key=str), edits)
        if index.ids:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS) -> DataFrame:
    """A row for each document and item that it holds: the id, the item, start, end (in normalised text) and edits."""
    runtime.prepare(docs, __name__)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind, item_kind = rows.schema["_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"_id {kind}, _item {item_kind}, start bigint, end bigint, edits bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in blocks(benchmark, item_col, item_text_col, edits):
        # With its classes, so that executors need not have the package.
        sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

        def run(batches, sent=sent):
            import pyarrow as pa

            index = cloudpickle.loads(sent.value)
            for batch in batches:
                found = [(first + t, *rest) for first, texts in _chunks(batch.column(1).to_pylist()) for t, *rest in matches(texts, index)]
                if found:
                    at, item, *numbers = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([index.ids[i] for i in item]), *(pa.array(x, pa.int64()) for x in numbers)], names=["_id", "_item", "start", "end", "edits"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out.withColumnsRenamed({"_id": id_col, "_item": item_col})


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS) -> DataFrame:
    """``docs`` without those that hold an item; no shuffle."""
    runtime.prepare(docs, __name__)
    at = docs.columns.index(text_col)
    for index in blocks(benchmark, item_col, item_text_col, edits):
        # With its classes, so that executors need not have the package.
        sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

        def run(batches, sent=sent):
            import pyarrow as pa

            index = cloudpickle.loads(sent.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, texts in _chunks(batch.column(at).to_pylist()):
                    keep[[first + m[0] for m in matches(texts, index)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
