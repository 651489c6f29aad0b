import pytest

from tests.llm.common import frame, values, with_clashes, words
from tidegrid.llm import mixing


def table(spark, seed=0):
    data = [(k, words(5 + (k * 37) % 400, k), "en", None if k % 17 == 0 else f"s{min(k % 9, 5)}", 1) for k in range(400)]
    return frame(spark, data)


def test_targets_and_closeness(spark):
    out = mixing.mix_digest(table(spark)).collect()
    sources = {}
    by_id = {r.doc_id: r for r in out}
    for r in out:
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        name = None if r.doc_id % 17 == 0 else f"s{min(r.doc_id % 9, 5)}"
        s = sources.setdefault(name, [r.source_size, r.target, 0, 0])
        s[2] += r.taken
        s[3] += r.size
    total = sum(s[0] for s in sources.values())
    assert len(by_id) == 400 and sum(s[1] for s in sources.values()) == pytest.approx(total)
    for size, target, taken, added in sources.values():
        assert added == size and target <= 3 * size + 1e-9 and abs(taken - target) <= max(5, 0.01 * target)


def test_water_filling(spark):
    data = [(1, words(10, 1), None, "a", 1), (2, words(1000, 2), None, "b", 1), (3, words(1000, 3), None, "c", 1)]
    got = {r.doc_id: r.target for r in mixing.mix_digest(frame(spark, data)).collect()}
    # a stops at 30; b and c share the rest 2 : 3
    assert got == {1: 30.0, 2: pytest.approx(1980 * 2 / 5), 3: pytest.approx(1980 * 3 / 5)}


def test_reruns_and_partitions_agree(spark):
    a = values(mixing.mix_digest(table(spark)), "doc_id", "taken")
    assert a == values(mixing.mix_digest(table(spark).repartition(7)), "doc_id", "taken")


def test_awkward_rows(spark):
    out = mixing.mix_sources(with_clashes(frame(spark)))
    assert out.where("text IS NULL AND taken <> 0").count() == 0 and out.count() == frame(spark).count()
    assert out.select("_id", "_row").distinct().collect() == [(7, 7)]
    assert mixing.mix_digest(frame(spark, [])).collect() == []
    zero = mixing.mix_digest(frame(spark, [(1, None, None, "a", 1), (2, " ", None, None, 1)])).collect()
    assert [(r.target, r.taken) for r in zero] == [(0.0, 0), (0.0, 0)]


def test_inclusion_is_in_proportion_to_size(spark):
    """Many sources with texts of the same sizes: those with weight 1 and 3 want half of their words from the sample."""
    sizes = [*list(range(2, 14)) * 12, 40, 40]
    data = [(1000 * s + k, "w " * n, None, f"s{s:03d}", 1) for s in range(60) for k, n in enumerate(sizes)]
    out = mixing.mix_digest(frame(spark, data)).collect()
    missing = sum(sizes) / 2
    certain = [n for n in sizes if n * missing / sum(x * x for x in sizes) >= 1]
    assert certain == [40, 40]
    rate = (missing - sum(certain)) / sum(n * n for n in sizes if n not in certain)
    seen = {n: [] for n in sizes}
    for r in out:
        if r.doc_id // 1000 % 3 != 1:
            seen[r.size].append(r.taken // r.size - (1 if r.doc_id // 1000 % 3 == 2 else 0))
    for n, taken in seen.items():
        # What fills the last words up comes in small sizes and on top.
        assert abs(sum(taken) / len(taken) - min(1.0, rate * n)) < 0.1, (n, sum(taken) / len(taken), rate * n)


def test_one_very_long_text_does_not_stop_a_source(spark):
    data = [(k, words(20 + k * 37 % 90 * 10, k), None, f"s{k % 6}", 1) for k in range(240)] + [(999, words(20_000, 1), None, "s2", 1)]
    out = mixing.mix_digest(frame(spark, data)).collect()
    taken, target = {}, {}
    for r in out:
        s = "s2" if r.doc_id == 999 else f"s{r.doc_id % 6}"
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    assert all(abs(taken[s] - target[s]) <= max(0.01 * target[s], 20) for s in taken), (taken, target)


@pytest.mark.parametrize("missing", [None, 7])
def test_a_row_without_id_is_taken_like_any_other(spark, missing):
    data = [(missing, "a " * 20, None, "a", 1), (2, "a " * 30, None, "a", 1), (3, "b " * 400, None, "b", 1), (4, "c " * 300, None, "c", 1)]
    out = mixing.mix_digest(frame(spark, data)).collect()
    a = [r for r in out if r.size in (20, 30)]
    assert sum(r.taken for r in a) > 0 and min(abs(sum(r.taken for r in a) - a[0].target), 30) < 30


def test_equal_rows_go_together(spark):
    data = [(1, "x " * 9, None, "a", 1)] * 6 + [(2, "y " * 100, None, "b", 1), (None, "z " * 7, None, "a", 1), (None, "z " * 7, None, "a", 1)]
    by = {}
    for r in mixing.mix_digest(frame(spark, data)).collect():
        by.setdefault((r.doc_id, r.size), set()).add(r.taken)
    assert all(len(x) == 1 for x in by.values())
