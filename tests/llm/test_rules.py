import re
from collections import Counter

import numpy as np

from tests.llm.common import frame, rows, values, with_clashes, words
from tidegrid.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    data = [*rows(), (40, "a b c d e f g h " * 5 + "# $ <x>", None, None, None), (41, "same line\nsame line \nsame line\n\n\n", None, None, None)]
    got = rules.text_statistics(with_clashes(frame(spark, data)))
    want = sorted([(i, *expected(t)) for i, t, *_ in data], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert values(got, "doc_id", *rules.COUNTS[:5]) == want


def labelled(spark, n=300):
    data = [(k, ("#! " + " ".join(f"{x}***" for x in words(60, k).split())) if k % 4 == 0 else words(80, k), None, None, None) for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(0, n, 2)] + [(1, None), (None, 1)], "doc_id bigint, quality int")
    return frame(spark, data), labels


def test_learned_list(spark):
    docs, labels = labelled(spark)
    found = rules.fit_rules(docs, labels)
    assert found and all(r.precision >= 0.9 for r in found) and "CASE WHEN" in str(rules.verdict(found)._jc.toString()).upper()
    out = {r.doc_id: r.kept for r in rules.rules_digest(docs, labels).collect()}
    assert sum(out[k] == (k % 4 != 0) for k in out) >= 0.98 * len(out)


def test_no_labels(spark):
    docs, labels = labelled(spark, 20)
    assert rules.fit_rules(docs, labels.limit(0)) == []
    out = rules.rules_digest(docs.union(frame(spark)), labels.where("quality = 1")).collect()
    assert {r.kept for r in out if r.n_words < 20} == {False}
    assert rules.rules_digest(frame(spark, []), labels).collect() == []


def test_covering_finds_a_conjunction():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] < 0.4)
    found = rules.learn(x, bad)
    hit = np.logical_or.reduce([r.mask(x) for r in found])
    assert (hit == bad).mean() > 0.97
