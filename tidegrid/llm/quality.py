"""Quality classifier: a supervised subword model.

A document is the mean of the learned vectors of its words and of the character 3- and 4-grams
of its words (with their edges), all hashed into tables of fixed size; a softmax layer follows.
A mean doesn't show that a text repeats itself, so each word also has one of two features more: whether a
window of three words around it occurs again in the text, or not.
Both are trained by stochastic gradient descent in numpy, on at most ``max_rows`` labelled rows, those
with the smallest hashes of their ids, as far as ``max_bytes`` of features go; the fitted tables have a fixed size.  As the output layer is
linear in the mean, scoring needs one number for each table entry, held as an integer so that a
score doesn't depend on how rows are batched.

Defined results: null and empty texts have no features and get the model's prior; without labels
of both classes (or of an empty table) the score is the share of label 1, or 0.5 without any; an id with several labels has the largest; rows are
independent, so that repeated rows get equal scores; an empty table gives an empty result.  Words are runs of characters other than 0x20 and
0x09-0x0D.  Very long texts are read in pieces.  Other columns are kept as they are, but for ``score``, which the operator's own replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime, textcore

#: Table sizes as powers of two: words, 3-grams, 4-grams.
BITS = (18, 17, 17)
STARTS = (0, 1 << 18, (1 << 18) + (1 << 17))
#: The last two: a word in a window that occurs again in its text, and any other word.
REPEATED, FRESH = (1 << 19), (1 << 19) + 1
FEATURES = (1 << 19) + 2
WINDOW = 3
FIXED = 1 << 20


@dataclass
class Model:
    #: By feature: its part of the difference of the two logits, times FIXED.
    weights: np.ndarray
    bias: float


def features(texts: list[str], repeats: bool = True):
    """Pieces of the texts' features: feature numbers, and where each text's begin (and the last one's end)."""
    data, offsets = textcore.joined_bytes([x.encode("utf-8", "surrogatepass") for x in texts])
    words = textcore.Words(data, offsets)
    hashes = words.hashes()
    yield (hashes >> np.uint64(64 - BITS[0])).astype(np.int64), words.first
    if repeats:
        yield np.where(repeated(hashes, words.first), REPEATED, FRESH), words.first
    # Characters, with a line feed before each text and at the end; a gram belongs to the piece in which it begins.
    joined = "\n" + "\n".join(texts) + "\n"
    edges = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts])))
    for a in range(0, len(joined), textcore.CHUNK):
        codes = np.frombuffer(joined[a : a + textcore.CHUNK + 3].encode("utf-32-le", "surrogatepass"), np.uint32)
        for number, where in grams(codes, min(textcore.CHUNK, len(joined) - a)):
            yield number, np.searchsorted(where, edges - a)


def grams(codes: np.ndarray, most: int):
    """The 3- and 4-grams that begin in the first ``most`` characters: numbers and places.  Only a gram's ends may be blank."""
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    k = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]
    d = np.where(blank, np.uint32(1), codes) * np.uint32(0xCC9E2D51)
    d ^= d >> np.uint32(15)
    solid = ~blank
    for size, bits, at in ((3, BITS[1], STARTS[1]), (4, BITS[2], STARTS[2])):
        m = max(0, min(most, len(codes) - size + 1))
        h = np.zeros(m, np.uint32)
        whole = np.ones(m, bool)
        for j in range(size):
            h += d[j : j + m] * k[j]
            if 0 < j < size - 1:
                whole &= solid[j : j + m]
        where = np.flatnonzero(whole)
        h = h[where]
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        yield (h >> np.uint32(32 - bits)).astype(np.int64) + at, where


def repeated(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words are in a window that occurs more than once in its text."""
    out = np.zeros(len(words), bool)
    keys, text = textcore.windows(words, first, WINDOW)
    if len(keys):
        keys = textcore.mix(keys + textcore.mix(text.astype(np.uint64) * textcore.MIX[3]))
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = np.flatnonzero(of[: len(of) - WINDOW + 1] == of[WINDOW - 1 :])[twice]
        for k in range(WINDOW):
            out[at + k] = True
    return out


def text_chunks(column):
    """Lists of texts with about textcore.CHUNK characters together."""
    batch, size, first = [], 0, 0
    for i, text in enumerate(column.to_pylist()):
        batch.append(text or "")
        size += len(text or "")
        if size >= textcore.CHUNK:
            yield first, batch
            batch, size, first = [], 0, i + 1
    if batch:
        yield first, batch


def counted(text: str) -> tuple[bytes, bytes]:
    """A text's distinct features and their counts, for training."""
    number, many = np.empty(0, np.int64), np.empty(0, np.int64)
    for some, _ in features([text]):
        number, at = np.unique(np.concatenate((number, some)), return_inverse=True)
        many = np.bincount(at, weights=np.concatenate((many, np.ones(len(some), np.int64)))).astype(np.int64)
    return number.astype(np.uint32).tobytes(), np.minimum(many, (1 << 32) - 1).astype(np.uint32).tobytes()


def sparse_rows(batches):
    import pyarrow as pa

    for batch in batches:
        pairs = [counted(text or "") for text in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(batch.num_columns - 1)), pa.array([x for x, _ in pairs], pa.binary()), pa.array([x for _, x in pairs], pa.binary())], names=[*batch.schema.names[:-1], "features", "counts"])


def train(rows: list[tuple[int, bytes, bytes]], dim: int = 8, epochs: int = 8, rate: float = 0.4, batch: int = 16, seed: int = 5) -> Model:
    """Gradient descent on the cross entropy of the softmax over the mean vector.  Empties ``rows``, so that features are held once."""
    random = np.random.default_rng(seed)
    labels = np.array([r[0] for r in rows], np.int64)
    if len(rows) == 0 or labels.min() == labels.max():
        share = labels.mean() if len(rows) else 0.5
        return Model(np.zeros(FEATURES, np.int32), float(np.clip(np.log(max(share, 1e-6) / max(1 - share, 1e-6)), -4, 4)))
    docs = []
    rows.reverse()
    while rows:  # what is read is let go
        _, ids, counts = rows.pop()
        weight = np.frombuffer(counts, np.uint32).astype(np.float32)
        weight /= max(weight.sum(), 1)
        docs.append((np.frombuffer(ids, np.uint32), weight))
    table = np.empty((FEATURES, dim), np.float32)
    for a in range(0, FEATURES, 1 << 14):
        table[a : a + (1 << 14)] = random.uniform(-1 / dim, 1 / dim, (min(1 << 14, FEATURES - a), dim))
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(docs), 0
    scale = 1 / np.sqrt(np.mean([np.dot(w, w) for _, w in docs if len(w)] or [1]))  # vectors of few common features move as fast as those of many
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            step = rate * (1 - done / steps)
            done += len(some)
            mean = np.stack([w @ table[i] if len(i) else np.zeros(dim, np.float32) for i, w in (docs[k] for k in some)])
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            back = p @ out.T
            out -= step * mean.T @ p
            bias -= step * p.mean(0)
            for row, k in enumerate(some):
                i, w = docs[k]
                table[i] -= (step * scale) * w[:, None] * back[row]
    lean = (table @ (out[:, 1] - out[:, 0])).astype(np.float64)
    return Model(np.rint(lean * FIXED).astype(np.int64), float(bias[1] - bias[0]))


def train_in_task(seed: int):
    """The model of all rows of a partition, in the order of their values."""

    def run(batches):
        import pyarrow as pa

        rows = [row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
        rows.sort()
        model = train(rows, seed=seed)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype(np.int64).tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])

    return run


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    total, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for number, at in features(texts):
        total += textcore.sums_by(model.weights[number], at)
        count += np.diff(at)
    logit = model.bias + total / (np.maximum(count, 1) * float(FIXED))
    return np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 9)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_on: Column | None = None, max_rows: int = 4000, max_bytes: int = 256 << 20, seed: int = 5) -> Model:
    """Fit on at most ``max_rows`` rows of ``labels`` (those with the smallest id hashes where ``train_on`` holds), and of these on as many
    as ``max_bytes`` of features hold, in the same order."""
    runtime.prepare(docs, __name__, textcore.__name__)
    known = labels.where(train_on) if train_on is not None else labels
    known = known.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_label")).dropna().where("_label IN (0, 1)")
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).withColumn("_h", F.xxhash64("_id", F.lit(seed))).orderBy("_h", "_id").limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")).join(F.broadcast(known), "_id").select("_h", "_label", "_text")
    rows = runtime.settle(texts.mapInArrow(sparse_rows, "_h bigint, label int, features binary, counts binary"))
    # First the sizes alone come to the driver (two numbers a row, at most a few rows for each of ``max_rows`` ids), then what fits.
    sizes = rows.groupBy("_h").agg(F.sum(F.octet_length("features") + F.octet_length("counts")).alias("n")).orderBy("_h").collect()
    held, last = 0, None
    for h, n in sizes:
        held += n
        if held > max_bytes:
            break
        last = h
    if last is None:
        return train([], seed=seed)
    # One task trains, so that the driver holds the fitted table and none of the features.
    found = rows.where(F.col("_h") <= last).select("label", "features", "counts").coalesce(1).mapInArrow(train_in_task(seed), "weights binary, bias double").first()
    return Model(np.frombuffer(bytes(found.weights), np.int64), found.bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_at: float | None = None) -> DataFrame:
    """``docs`` with the column ``score``; with ``keep_at``, only the rows that reach it and without the column."""
    runtime.prepare(docs, __name__, textcore.__name__)
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    own = [c for c in docs.columns if c != "score"]

    def run(batches):
        import pyarrow as pa

        fitted = Model(*sent.value)
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for first, texts in text_chunks(batch.column(at)):
                scores[first : first + len(texts)] = score_texts(texts, fitted)
            if keep_at is None:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(scores)], names=[*own, "score"])
            else:
                yield batch.filter(pa.array(scores >= keep_at))

    if keep_at is not None:
        return docs.mapInArrow(run, docs.schema)
    schema = docs.select(*(F.col(f"`{c}`") for c in own)).schema
    return docs.mapInArrow(run, schema.add("score", "double"))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


THRESHOLD = 0.7


def fitted_on(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs, labels, train_on=~held_out())


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    scored = score(docs.select("doc_id", "text"), fitted_on(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
