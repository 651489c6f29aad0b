import random
import re
from fractions import Fraction

import pytest

from tests.llm.common import frame, rows, values, with_clashes, words
from tidegrid.llm import graph, ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(data, n, t):
    least = lambda i: -(1 << 63) if i is None else i
    sets = []
    for i, text, *_ in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append((least(i), {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
    best = [i for i, _ in sets]
    changed = True
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a][1] and sets[b][1] and (m := len(sets[a][1] & sets[b][1])) * t.denominator >= t.numerator * (len(sets[a][1]) + len(sets[b][1]) - m)]
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            changed |= best[a] != low or best[b] != low
            best[a] = best[b] = low
    real = lambda i: None if i == -(1 << 63) else i
    return sorted([(real(i), len(s), real(c)) for (i, s), c in zip(sets, best, strict=True)], key=lambda r: tuple((x is None, str(x)) for x in r))


def family(seed, count, size, edits):
    rng = random.Random(seed)
    base = words(size, seed).split()
    out = []
    for _ in range(count):
        x = list(base)
        for _ in range(rng.randint(0, edits)):
            x[rng.randrange(len(x))] = words(1, rng.randrange(10**6))
        out.append(" ".join(x))
    return out


@pytest.mark.parametrize("n,t", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_brute_force(spark, n, t):
    texts = [x for f in ((1, 40, 120, 5), (2, 30, 60, 3), (3, 20, 15, 1), (4, 10, 400, 30)) for x in family(*f)]
    data = [(1000 - k, x, None, None, None) for k, x in enumerate(texts)] + rows()
    member, _ = ngram_join.similar_documents(with_clashes(frame(spark, data)), n=n, threshold=t)
    assert values(member, "doc_id", "n_shingles", "component_id") == expected(data, n, t)


def test_one_of_each_group(spark):
    data = [(1000 + k, x, None, None, None) for k, x in enumerate(family(5, 30, 200, 2))] + rows()
    groups = {c for _, _, c in expected(data, 5, Fraction(4, 5))}
    kept = ngram_join.first_of_groups(with_clashes(frame(spark, data)))
    assert {r.doc_id for r in kept.collect()} == groups | {None} and kept.where("_id <> 7").count() == 0


def test_empty(spark):
    assert ngram_join.join_digest(frame(spark, [])).collect() == []
    assert ngram_join.first_of_groups(frame(spark, [])).collect() == []


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50 + k) for k in range(30)] + [(7, 7), (200, 201)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert {got[k] for k in range(41)} == {0} and got[100] == 50 and got[201] == 200
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
