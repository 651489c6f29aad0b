"""LM scoring: masked pseudo-likelihood under a bidirectional window network.

Every token is predicted from the ``SIDE`` tokens on either side of it; a document's score is the sum of the
log-probabilities of its tokens.  Tokens are lower-cased words.  The vocabulary comes from counts over all documents in 2**20
buckets of the word's hash: the most frequent buckets are tokens of their own, half the square root of the corpus's words of
them, and the rest share ``REST`` tokens.  A word of a shared token has the token's probability times its bucket's share of the token's
words, by the counts plus one.  The network adds one vector for each place of the window, applies tanh, and predicts first
the token's class and then the token in its class; there are as many classes as tokens in a class, so that a prediction of
one of 1024 tokens costs 64 outputs.

It is trained in numpy on every token of every document (a larger ``stride`` takes every ``stride``-th, shifted from text to
text).  Texts are dealt by a hash of id and text into parts of ``PART_TOKENS`` words or more on average, and parts into up to
``ROUNDS`` rounds.  In a round each part trains one pass from the last average, in the order of the hash, and the parameters
are averaged by the numbers of tokens.  So each text is learned from once, and the model doesn't depend on the input's
partitions (scores only by float32's rounding, in the fourth decimal of the sum).  What is gathered grows with the number of parts.

Defined results: null and empty texts and texts without words have no tokens and a score of 0; the mean is null then; rows are
independent, repeated rows get equal scores; words of equal frequency are ranked by their bucket; an empty table gives an empty result.  Of a very
long text, some 100 bytes a word are held.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime, textcore

BUCKETS = 1 << 20
#: Of a small corpus.
CLASSES, IN_CLASS = 32, 32
TOKENS = CLASSES * IN_CLASS
REST = 256
SIDE = 2
DIM = 16
REACH = 64
#: Words of a training part on average, at least; a corpus of fewer is one part.
PART_TOKENS = 1 << 20
#: Times that the parameters are averaged, if there are as many parts.
ROUNDS = 4
#: Parameters are added as whole numbers of 1 / SCALE.
SCALE = 1 << 24


def shapes(tokens: int) -> dict[str, tuple[int, ...]]:
    """Of the parameters, for a square number of tokens.  The token after the last is the one beside a text's ends."""
    side = math.isqrt(tokens)
    return {"table": (2 * SIDE, tokens + 1, DIM), "start": (DIM,), "to_class": (DIM, side), "class_bias": (side,), "to_token": (side, DIM, side), "token_bias": (side, side)}


def tokens_of(size: int) -> int:
    """The number of tokens of ``size`` parameters."""
    side = CLASSES
    while sum(int(np.prod(x)) for x in shapes(side * side).values()) < size:
        side += 1
    return side * side


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = textcore.Words(textcore.LOWER[data], offsets)
    return words.hashes(), words.first


def count_words(batches):
    import pyarrow as pa
    from pyspark import TaskContext

    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offsets = textcore.column_bytes(batch.column(0))
        for i, j in textcore.chunks(offsets):
            hashes, _ = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            np.add.at(counts, slot(hashes), 1)
    if counts.any():
        blocks = runtime.pack(counts)
        salt = (TaskContext.get().partitionId() if TaskContext.get() else 0) % 64
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([salt] * len(blocks), pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["block", "salt", "payload"])


def vocabulary(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token of each bucket, how often each token occurs, and the logarithm of each bucket's share of its token.

    Tokens are dealt to classes in the order of their frequency."""
    side = max(CLASSES, math.isqrt(math.isqrt(int(counts.sum())) // 2 + REST - 1) + 1)
    own = side * side - REST
    order = np.lexsort((np.arange(BUCKETS), -counts))[:own]
    order = order[counts[order] > 0]
    token = own + (np.arange(BUCKETS) * 2654435761 >> 7) % REST
    shared = np.bincount(token, weights=counts + 1)
    shared -= np.bincount(token[order], weights=counts[order] + 1, minlength=len(shared))
    share = np.log((counts + 1) / shared[token])
    share[order] = 0
    token[order] = np.arange(len(order))
    return token.astype(np.int32), np.bincount(token, weights=counts, minlength=side * side), share.astype(np.float32)


def initial(frequency: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    net = {k: (random.standard_normal(shape) * 0.1).astype(np.float32) for k, shape in shapes(len(frequency)).items()}
    share = ((frequency + 1) / (frequency + 1).sum()).reshape(net["token_bias"].shape)
    net["start"][:] = 0
    net["class_bias"] = np.log(share.sum(1)).astype(np.float32)
    net["token_bias"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return net


def flatten(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in shapes(net["token_bias"].size)])


def unflatten(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in shapes(tokens_of(len(values))).items():
        size = int(np.prod(shape))
        out[k] = np.asarray(values[at : at + size], np.float32).reshape(shape)
        at += size
    return out


def beside(tokens: np.ndarray, first: np.ndarray, edge: int, at: np.ndarray | None = None) -> np.ndarray:
    """The tokens beside each position (or those ``at``), ``edge`` beyond a text's ends."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(tokens)) if at is None else at
    low, high = first[text[at]], first[text[at] + 1]
    out = np.empty((2 * SIDE, len(at)), np.int64)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        other = at + shift
        inside = (other >= low) & (other < high)
        out[k] = np.where(inside, tokens[np.clip(other, 0, len(tokens) - 1)], edge)
    return out


def hidden(net: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    out = net["table"][0].take(near[0], axis=0)
    out += net["start"]
    for k in range(1, 2 * SIDE):
        out += net["table"][k].take(near[k], axis=0)
    return np.tanh(out, out=out)


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(-1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(-1, keepdims=True))
    return logits


def safe(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether the exponential of no logit can over- or underflow: hidden values are between -1 and 1.  Else the largest has to be taken off first."""
    return bool(np.abs(weights).max() * weights.shape[-2] + np.abs(bias).max() < 60)


def softmax(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    logits = h @ weights
    logits += bias
    if not safe(weights, bias):
        return np.exp(log_softmax(logits))
    out = np.exp(logits, out=logits)
    out /= (out @ np.ones(out.shape[-1], np.float32))[..., None]
    return out


def log_softmax_at(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, rows: int = 4096) -> np.ndarray:
    """Each row's logarithm of the softmax at one place.  Few rows at a time stay in the processor's cache."""
    out, is_safe, ones = np.empty(len(h), np.float64), safe(weights, bias), np.ones(len(bias), np.float32)
    for a in range(0, len(h), rows):
        logits = h[a : a + rows] @ weights
        logits += bias
        row, place = np.arange(len(logits)), at[a : a + rows]
        if is_safe:
            own = logits[row, place]
            out[a : a + rows] = own - np.log(np.exp(logits, out=logits) @ ones)
        else:
            out[a : a + rows] = log_softmax(logits)[row, place]
    return out


def sorted_rows(values: np.ndarray) -> np.ndarray:
    """A stable argsort along the last axis; numbers of 16 bits are sorted by radix."""
    return np.argsort(values.astype(np.uint16) if values.size and values.max() < 1 << 16 else values, axis=-1, kind="stable")


def log_probabilities(net: dict[str, np.ndarray], tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each token's log-probability, given the tokens beside it."""
    out = np.empty(len(tokens), np.float64)
    classes, in_class = net["token_bias"].shape
    for a in range(0, len(tokens), 1 << 16):
        at = np.arange(a, min(len(tokens), a + (1 << 16)))
        h = hidden(net, beside(tokens, first, classes * in_class, at))
        group, inner = np.divmod(tokens[at].astype(np.int64), in_class)
        order = sorted_rows(group)
        h, group, inner = h[order], group[order], inner[order]
        value = log_softmax_at(h, net["to_class"], net["class_bias"], group)
        edges = np.searchsorted(group, np.arange(classes + 1))
        for c in np.flatnonzero(np.diff(edges)):
            i, j = edges[c], edges[c + 1]
            value[i:j] += log_softmax_at(h[i:j], net["to_token"][c], net["token_bias"][c], inner[i:j])
        out[at[order]] = value
    return out


def bands(many: np.ndarray, most: tuple[int, ...] = (0, 8, 32, 128)) -> list[np.ndarray]:
    """The classes with targets, those of like numbers of targets together; each with very many alone."""
    alike = [np.flatnonzero((many > low) & (many <= high)) for low, high in zip(most, most[1:], strict=False)]
    return [x for x in alike if len(x)] + [np.array([c]) for c in np.flatnonzero(many > most[-1])]


def learn(net: dict[str, np.ndarray], tokens: np.ndarray, near: np.ndarray, rate: float, batch: int = 2048) -> None:
    """One pass of gradient descent over the given targets and their neighbours, in place.

    What a batch says of a class's tokens or of a table's row comes from few of its targets: these steps are ``REACH`` times
    the mean over the batch, but at most half the mean over the targets concerned.  The rest steps by the batch's mean."""
    classes, _, in_class = net["to_token"].shape
    places, width, dim = net["table"].shape
    table = net["table"].reshape(-1, dim)
    group, inner = np.divmod(tokens.astype(np.int64), in_class)
    for a in range(0, len(tokens), batch):
        order = sorted_rows(group[a : a + batch])
        n, g, w = near[:, a : a + batch][:, order], group[a : a + batch][order], inner[a : a + batch][order]
        step = rate / len(g)
        # One row more, of zeros, which fills up classes with fewer targets than their band's most.
        h = np.zeros((len(g) + 1, dim), np.float32)
        h[:-1] = hidden(net, n)
        p = softmax(h[:-1], net["to_class"], net["class_bias"])
        p[np.arange(len(g)), g] -= 1
        back = np.zeros_like(h)
        back[:-1] = p @ net["to_class"].T
        edges = np.searchsorted(g, np.arange(classes + 1))
        many = np.diff(edges)
        for c in bands(many):
            place = np.arange(many[c].max())
            real = place < many[c][:, None]
            at = np.where(real, edges[c][:, None] + place, len(g))
            x, weights = h.take(at, axis=0), net["to_token"][c]
            q = softmax(x, weights, net["token_bias"][c][:, None])
            k, i = np.nonzero(real)
            q[k, i, w[at[k, i]]] -= 1
            q[~real] = 0
            back[at] += q @ weights.transpose(0, 2, 1)
            own = np.minimum(step * REACH, rate / 2 / many[c]).astype(np.float32)
            net["to_token"][c] = weights - own[:, None, None] * (x.transpose(0, 2, 1) @ q)
            net["token_bias"][c] -= own[:, None] * q.sum(1)
        h, back = h[:-1], back[:-1]
        net["to_class"] -= step * (h.T @ p)
        net["class_bias"] -= step * p.sum(0)
        back *= 1 - h * h
        net["start"] -= step * back.sum(0)
        # Sums by place and token: sorted, then added in runs, which is faster than adding at indices.
        order = sorted_rows(n)
        key = (np.take_along_axis(n, order, 1) + (np.arange(places) * width)[:, None]).ravel()
        first = np.append(0, np.flatnonzero(np.diff(key)) + 1)
        own = np.minimum(step * REACH, rate / 2 / np.diff(first, append=len(key))).astype(np.float32)
        # Two numbers are added as one complex number, in half the steps.
        sums = np.add.reduceat(back.take(order.ravel(), axis=0).view(np.complex64), first, axis=0).view(np.float32)
        table[key[first]] -= own[:, None] * sums


def tokenise(token, stride: int):
    """Of each text that has some: its tokens, and the first place that is trained on."""

    def run(batches):
        import pyarrow as pa

        of = token.value
        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(2))
            part, key = batch.column(0), batch.column(1)
            for i, j in textcore.chunks(offsets):
                hashes, first = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                tokens = of[slot(hashes)]
                some = np.flatnonzero(np.diff(first))
                shift = (hashes[first[:-1][some]] % np.uint64(stride)).astype(np.int32)
                own = [tokens[first[k] : first[k + 1]].tobytes() for k in some]
                yield pa.RecordBatch.from_arrays([part.take(pa.array(i + some)), key.take(pa.array(i + some)), pa.array(shift), pa.array(own, pa.binary())], names=["part", "key", "shift", "tokens"])

    return run


def train_parts(now, stride: int, rate: float):
    """Trains one network for each part: ``now`` is where all start.  A part's rows come one after another."""

    def trained(part: int, texts: list):
        import pyarrow as pa

        net = {k: v.copy() for k, v in unflatten(now.value).items()}
        tokens = np.concatenate([x for x, _ in texts])
        first = np.concatenate(([0], np.cumsum([len(x) for x, _ in texts])))
        shift = np.array([k for _, k in texts])
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        every = np.flatnonzero((np.arange(len(tokens)) - first[text] + shift[text]) % stride == 0)
        for a in range(0, len(every), 1 << 16):
            at = every[a : a + (1 << 16)]
            learn(net, tokens[at], beside(tokens, first, net["token_bias"].size, at), rate)
        # Whole numbers, so that the order of adding doesn't matter; the weight counts as one more parameter.
        weight = (len(every) + 1023) // 1024
        sums = np.append(np.rint(flatten(net).astype(np.float64) * SCALE).astype(np.int64), 1) * weight
        blocks = runtime.pack(sums)
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([part % 64] * len(blocks), pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["block", "salt", "payload"])

    def run(batches):
        now_part, texts = None, []
        for batch in batches:
            parts, shifts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for part, shift, own in zip(parts.tolist(), shifts.tolist(), batch.column(2), strict=True):
                if part != now_part and texts:
                    yield trained(now_part, texts)
                    texts = []
                now_part = part
                texts.append((np.frombuffer(own.as_buffer(), np.int32).copy(), shift))
        if texts:
            yield trained(now_part, texts)

    return run


def fit(docs: DataFrame, text_col: str = "text", stride: int = 1, rate: float = 1.0, seed: int = 11, id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token of each bucket, the logarithm of the bucket's share of it, and the parameters."""
    runtime.prepare(docs, __name__, textcore.__name__, runtime.__name__)
    context = docs.sparkSession.sparkContext
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(text.alias("_text"))
    counts = runtime.add_arrays(texts.mapInArrow(count_words, "block int, salt int, payload binary"), BUCKETS, "int64")
    token, frequency, share = vocabulary(counts)
    fitted = flatten(initial(frequency, seed))
    total = int(counts.sum())
    if not total:
        return token, share, fitted
    parts = max(1, total // PART_TOKENS)
    rounds = min(ROUNDS, parts)
    # By id and text, so that exact copies are dealt apart.
    key = F.xxhash64(*([F.col(f"`{id_col}`").cast("string")] if id_col in docs.columns else []), text)
    keyed = docs.select(F.pmod(key, F.lit(parts)).cast("int").alias("part"), key.alias("key"), text.alias("_text"))
    dealt = keyed.mapInArrow(tokenise(context.broadcast(token), stride), "part int, key bigint, shift int, tokens binary")
    dealt = runtime.settle(dealt.repartition(2 * parts, "part").sortWithinPartitions("part", "key", "tokens"))
    for k in range(rounds):
        some = dealt.where(F.col("part") % rounds == k).select("part", "shift", "tokens")
        nets = some.mapInArrow(train_parts(context.broadcast(fitted), stride, rate), "block int, salt int, payload binary")
        sums = runtime.add_arrays(nets, len(fitted) + 1, "int64")
        if sums[-1]:
            fitted = (sums[:-1] / (sums[-1] * SCALE)).astype(np.float32)
    return token, share, fitted


def score(docs: DataFrame, fitted: tuple[np.ndarray, np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_tokens, log_prob (the sum) and mean_log_prob."""
    runtime.prepare(docs, __name__, textcore.__name__, runtime.__name__)
    sent = docs.sparkSession.sparkContext.broadcast(fitted)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches):
        import pyarrow as pa

        of, share, net = *sent.value[:2], unflatten(sent.value[2])
        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(1))
            many, total = [np.empty(0, np.int64)], [np.empty(0)]
            for i, j in textcore.chunks(offsets):
                hashes, first = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                logs = log_probabilities(net, of[slot(hashes)], first) + share[slot(hashes)]
                sums = np.concatenate(([0], np.cumsum(np.rint(logs * (1 << 20)).astype(np.int64))))  # whole numbers: the order doesn't matter
                many.append(np.diff(first))
                total.append((sums[first[1:]] - sums[first[:-1]]) / (1 << 20))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(many).astype(np.int64)), pa.array(np.round(np.concatenate(total), 4))], names=["_id", "n_tokens", "log_prob"])

    kind = rows.schema["_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"_id {kind}, n_tokens bigint, log_prob double")
    return out.select(F.col("_id").alias(id_col), "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.round(F.col("log_prob") / F.col("n_tokens"), 6)).alias("mean_log_prob"))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, fit(docs, text_col, id_col=id_col), id_col, text_col)
