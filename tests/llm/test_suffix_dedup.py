import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.common import frame, rows, values, with_clashes, words
from tidegrid.llm import suffix_dedup


def expected(data, length=200):
    seen = Counter()
    for _, t, *_ in data:
        b = (t or "").encode()
        seen.update(b[s : s + length] for s in range(len(b) - length + 1))
    out = []
    for i, t, *_ in data:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_brute_force(spark):
    data = [r for r in rows() if r[0] != 9] + [(30, "é" * 150 + "x", None, None, None), (31, "z" + "é" * 150, None, None, None), (32, words(30, 5) * 2 + "q" * 300, None, None, None)]
    assert values(suffix_dedup.substring_digest(with_clashes(frame(spark, data))), *COLUMNS) == expected(data)


def test_near_copies_and_hot_anchors(spark):
    rng = random.Random(4)
    base = words(150, 9)
    data = []
    for k in range(40):
        x = list(base)
        for _ in range(rng.randint(0, 4)):
            x[rng.randrange(len(x))] = rng.choice("XYZ")
        data.append((k, "".join(x), None, None, None))
    want = expected(data)
    assert values(suffix_dedup.substring_digest(frame(spark, data)), *COLUMNS) == want
    # The path for anchors with very many contexts gives the same.
    from pyspark.sql import functions as F

    hot = suffix_dedup.dedup_substrings(frame(spark, data), keep="none", hot=3).withColumn("kept_sha256", F.sha2("kept", 256))
    assert values(hot, *COLUMNS) == want


def test_keep_first(spark):
    base = words(100, 11)
    data = [(3, base, None, None, None), (1, "head " + base, None, None, None), (2, base + " tail", None, None, None)]
    out = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.dedup_substrings(frame(spark, data)).collect()}
    assert out[1][0] == 0 and out[3][1] == b"" and out[2][1].endswith(b"tail") and len(out[2][1]) < 10


def test_parameters_and_empty_table(spark):
    with pytest.raises(ValueError):
        suffix_dedup.dedup_substrings(frame(spark), keep="last")
    assert suffix_dedup.substring_digest(frame(spark, [])).collect() == []


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    data = np.frombuffer(words(900, 6).encode(), np.uint8)
    whole = np.array([0, len(data)])
    parts = [suffix_dedup.contexts(data[a:b], e, 200) + (s,) for a, b, _, e, s in suffix_dedup.blocks(whole, 200)]
    starts = np.concatenate([np.concatenate([np.arange(x, x + n) + s for x, n in zip(p[3], p[4], strict=True)]) for *p, s in parts])
    assert sorted(starts) == list(range(len(data) - 199))


def test_factors():
    earlier, twice, edges = suffix_dedup.factors([b"abcabcabcabcabcabcabc", b"xabcabcabcabcabcabc"], np.array([6, 4]), 16)
    assert twice[:6].tolist() == [True] * 6 and not earlier[0] and earlier[3] and edges.tolist() == [0, 6, 10]
