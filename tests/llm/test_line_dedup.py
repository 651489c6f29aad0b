import hashlib
from collections import defaultdict

from tests.llm.common import frame, rows, values, with_clashes
from tidegrid.llm import line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(data):
    least = lambda i: -(1 << 63) if i is None else i
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text, *_ in data:
        for x in (text or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(least(i))
    out = []
    for i, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or least(i) == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_brute_force(spark):
    assert values(line_dedup.line_digest(frame(spark)), "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected(rows())


def test_clashing_columns_stay(spark):
    df = with_clashes(frame(spark))
    out = line_dedup.dedup_lines(df)
    assert values(out, "doc_id", "text") == values(line_dedup.dedup_lines(frame(spark)), "doc_id", "text")
    assert out.select("_id", "_row").distinct().collect() == [(7, 7)]


def test_empty_table(spark):
    assert line_dedup.line_digest(frame(spark, [])).collect() == []


def test_ascii_only_lower_case(spark):
    texts = [(k, x, None, None, None) for k, x in enumerate(["É" + "abcdefghijklmnopqrstuvwxyz", "é" + "abcdefghijklmnopqrstuvwxyz", "É" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "É" + "abcdefghijklmnopqrstuvwxyZ"])]
    out = {r.doc_id: r.n_dropped for r in line_dedup.line_digest(frame(spark, texts)).collect()}
    assert out == {0: 1, 1: 0, 2: 1, 3: 0}


def test_many_dropped_lines(spark):
    shared = "\n".join(f"shared line number {k:05d} of all" for k in range(2000))
    data = [(k, shared + f"\nown line of document {k} here", None, None, None) for k in range(3)]
    out = {r.doc_id: (r.n_dropped, r.text) for r in line_dedup.dedup_lines(frame(spark, data)).collect()}
    assert out[0] == (2000, "own line of document 0 here") and out[2][0] == 0
