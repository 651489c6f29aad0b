"""Quality rules: a learned decision list over counts that people can read.

The counts come from vectorised passes over whole texts.  The list is learned by sequential
covering: from labelled statistics, rules (conjunctions of thresholds) that find bad documents
are grown by information gain, pruned on rows held back, and added until none is precise enough.  It is
emitted as one ordered Spark conditional expression.

Fitted on at most ``max_rows`` labelled rows, those with the smallest hashes of their ids.  Defined
results: null and empty texts have zero counts and fail the base rule; without labels of both
classes the list is empty and the base rule decides alone; rows are independent, so that repeated rows get equal results; an empty
table gives an empty result; very long texts are read in parts, of which only numbers a word and line are held.  Equal lines are
confirmed by their bytes; windows are compared by their words' hashes (modulo a prime, mixed to 64 bits) within a text.  In the
search for rules the first of equal gains counts, by the order of the features and then of the thresholds.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime, textcore

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words", "n_symbol_words")
WINDOW = 8
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
MARK = np.zeros(256, bool)
MARK[list(b"!?")] = True
FEED = np.zeros(256, bool)
FEED[10] = True
LEAD = np.ones(256, bool)
LEAD[0x80:0xC0] = False


def again(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def distinct_by(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each text has."""
    tagged = textcore.mix(keys + textcore.mix(text.astype(np.uint64) * textcore.MIX[3]))
    order = np.argsort(tagged, kind="stable")
    first = np.ones(len(keys), bool)
    first[1:] = tagged[order][1:] != tagged[order][:-1]
    return np.bincount(text[order[first]], minlength=n)


def repeats(keys: np.ndarray, text: np.ndarray, n: int, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of each text's stretches equal an earlier one.  Hashes put equal ones side by side, their bytes decide."""
    tagged = textcore.mix(keys + textcore.mix(text.astype(np.uint64) * textcore.MIX[3]))
    order = np.argsort(tagged, kind="stable")
    same = np.flatnonzero(tagged[order][1:] == tagged[order][:-1])
    one, other = order[same], order[same + 1]
    length = end - start
    equal = (text[one] == text[other]) & (length[one] == length[other])
    equal[equal] = textcore.same_bytes(data, start[one[equal]], start[other[equal]], length[one[equal]])
    out = np.bincount(text[other], minlength=n)
    for t in np.unique(np.concatenate((text[one[~equal]], text[other[~equal]]))):  # a collision: count these texts' stretches by their bytes
        own = np.flatnonzero(text == t)
        out[t] = len(own) - len({data[start[k] : end[k]].tobytes() for k in own})
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of some texts, given as UTF-8 bytes.  Besides the bytes, some 100 bytes a word and line are held."""
    n = len(offsets) - 1
    words = textcore.Words(data, offsets)
    total = lambda table: textcore.count_bytes(table, data, offsets)
    out = {"n_words": np.diff(words.first), "word_chars": total(~textcore.SPACE & LEAD), "n_symbols": total(SYMBOL), "n_upper": total(UPPER), "n_digits": total(DIGIT), "n_marks": total(MARK)}
    hashes = words.hashes()
    # Lines: from each text's start or line feed to the next line feed or the text's end.
    feed = textcore.positions(FEED, data)
    start = np.sort(np.concatenate((offsets[:-1], feed + 1)), kind="stable")
    stop = np.sort(np.concatenate((feed, offsets[1:])), kind="stable")
    line_text = np.repeat(np.arange(n), np.diff(np.searchsorted(feed, offsets)) + 1)
    has_word = np.searchsorted(words.start, stop) > np.searchsorted(words.start, start)
    out["n_lines"] = np.bincount(line_text, minlength=n)
    start, stop, line_text = start[has_word], stop[has_word], line_text[has_word]
    out["n_dup_lines"] = repeats(textcore.hashes_of(data, start, stop), line_text, n, data, start, stop)
    # Words in windows that occur again in the same text.
    keys, text = textcore.windows(hashes, words.first, WINDOW)
    found = again(textcore.mix(keys + textcore.mix(text.astype(np.uint64) * textcore.MIX[3])))
    at = np.flatnonzero(words.text[: len(words.text) - WINDOW + 1] == words.text[WINDOW - 1 :])[found] if len(keys) else np.empty(0, np.int64)
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    out["n_repeat_words"] = textcore.sums_by(np.cumsum(cover[:-1]) > 0, words.first)
    out["n_distinct_words"] = distinct_by(hashes, words.text, n)
    out["n_symbol_words"] = np.bincount(words.text[np.unique(np.searchsorted(words.end, textcore.positions(SYMBOL, data), "right"))], minlength=n)
    return out


def count_batches(batches):
    import pyarrow as pa

    for batch in batches:
        data, offsets = textcore.column_bytes(batch.column(batch.num_columns - 1))
        parts = {c: [np.empty(0, np.int64)] for c in COUNTS}
        for i, j in textcore.chunks(offsets):
            got = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            for c in COUNTS:
                parts[c].append(got[c])
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), *(pa.array(np.concatenate(parts[c]).astype(np.int64)) for c in COUNTS)], names=[*batch.schema.names[:-1], *COUNTS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the counts of each text."""
    runtime.prepare(docs, __name__, textcore.__name__)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(count_batches, f"_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)).withColumnRenamed("_id", id_col)


#: What rules are about: a name, and a count over another.
RATIOS = {
    "words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"), "symbol_words": ("n_symbol_words", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"), "duplicate_lines": ("n_dup_lines", "n_lines"), "upper_letters": ("n_upper", "word_chars"), "digits": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"), "distinct_words": ("n_distinct_words", "n_words"), "words_per_line": ("n_words", "n_lines"),
}


def ratio(name: str) -> Column:
    above, below = RATIOS[name]
    return F.col(above).cast("double") if below is None else F.col(above).cast("double") / F.greatest(F.col(below), F.lit(1)).cast("double")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return ratio(self.feature) >= self.threshold if self.above else ratio(self.feature) < self.threshold

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    support: int

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.mask(x) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold:.6g}" for c in self.conditions)


def _cuts(values: np.ndarray, many: int) -> np.ndarray:
    seen = np.unique(np.quantile(values, np.linspace(0, 1, many + 1)[1:-1])) if len(values) else values
    return seen


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int, many: int) -> tuple[Condition, ...]:
    """Conditions by information gain, until only bad rows are left."""
    inside, out = np.ones(len(bad), bool), []
    while len(out) < longest and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best = (0.0, None)
        for name, values in x.items():
            v, b = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            ranked, positives = v[order], np.concatenate(([0], np.cumsum(b[order])))
            both = np.unique(np.concatenate((_cuts(v, many), _cuts(v[b], many))))
            for t in both:
                k = int(np.searchsorted(ranked, t, "left"))
                for above, p, size in ((False, positives[k], k), (True, positives[-1] - positives[k], len(v) - k)):
                    if p and size < len(v):
                        gain = p * (np.log2(p / size) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        out.append(best[1])
        inside &= best[1].mask(x)
    return tuple(out)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, least: int = 5, most_rules: int = 12, longest: int = 4, many: int = 32, seed: int = 3) -> list[Rule]:
    """Sequential covering: grow on two thirds, prune on the third, drop what the rule covers, and go on."""
    rules, left = [], np.ones(len(bad), bool)
    random = np.random.default_rng(seed)
    held = random.random(len(bad)) < 1 / 3
    while len(rules) < most_rules and (bad & left & ~held).sum() >= least:
        some = left & ~held
        conditions = _grow({k: v[some] for k, v in x.items()}, bad[some], longest, many)
        if not conditions:
            break
        check = {k: v[left & held] for k, v in x.items()}

        def worth(n: int) -> tuple[float, int]:
            inside = np.logical_and.reduce([c.mask(check) for c in conditions[:n]])
            p, size = bad[left & held][inside].sum(), inside.sum()
            return ((2 * p - size) / size if size else -1.0, -n)

        conditions = conditions[: -max(worth(n) for n in range(1, len(conditions) + 1))[1]]
        inside = np.logical_and.reduce([c.mask(x) for c in conditions]) & left
        hits, support = int(bad[inside].sum()), int(inside.sum())
        if support < least or hits < precision * support:
            break
        rules.append(Rule(conditions, hits / support, support))
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: false (bad) by the first rule that holds, else true."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 10_000, seed: int = 3) -> list[Rule]:
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_label")).dropna().where("_label IN (0, 1)")
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(known), "_id").select(F.struct("_label", "_id").alias("_key"), "_text")
    stats = text_statistics(texts, "_key", "_text").select("_key._label", "_key._id", *(ratio(name).alias(name) for name in RATIOS))
    rows = stats.orderBy("_id", "_label", *RATIOS).toPandas()
    bad = (rows["_label"] == 0).to_numpy()
    if not len(rows) or bad.all() or not bad.any():
        return []
    return learn({name: rows[name].to_numpy() for name in RATIOS}, bad, seed=seed)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    rules = fit_rules(docs, labels)
    stats = text_statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), verdict(rules).alias("_good"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("_good")).alias("kept"))
