import random
import re

from tests.llm.common import frame, rows, values, with_clashes, words
from tidegrid.llm import decontaminate


def distance(item, text):
    """Fewest edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def planted(n=30, seed=1):
    rng = random.Random(seed)
    items = [(k, words(rng.randint(6, 30), 100 + k)) for k in range(8)]
    data = []
    for k in range(n):
        x = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 2 + len(x) // 8)):
            p, o = rng.randrange(len(x)), rng.random()
            if o < 0.4:
                x[p] = rng.choice("xyzé")
            elif o < 0.7:
                del x[p]
            else:
                x.insert(p, "q")
        data.append((k, words(rng.randint(0, 40), 500 + k) + "\n " + "".join(x).upper() + " " + words(20, 900 + k), None, None, None))
    return data, items


def test_brute_force(spark):
    data, items = planted()
    bench = spark.createDataFrame([*items, (90, None), (91, "short"), (92, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(with_clashes(frame(spark, data + rows())), bench).collect()}
    index = decontaminate.Index(items)
    items = [*items, (91, "short")]
    index.ids.append(91)
    index.budget = [*index.budget, 0]
    want = {}
    for i, text, *_ in data + rows():
        for k, item in items:
            d = distance(decontaminate.normal(item), decontaminate.normal(text))
            if text and d <= index.budget[index.ids.index(k)]:
                want[i, k] = d
    assert got == want and len(want) > 10


def test_the_budget_is_a_tenth_at_every_length():
    for m in range(1, 1500):
        index = decontaminate.Index([(1, "x" * m)])
        assert index.budget[0] == (m // 10 if m >= 16 else 0) and index.least[0] >= (2 if m >= 16 else 1)


def test_items_of_all_lengths(spark):
    rng = random.Random(8)
    items, data = [], []
    for m in [1, 2, 5, 7, 8, 9, 15, *range(16, 100, 4)]:
        item = "".join(rng.choice("abcdefghij") for _ in range(m))
        items.append((m, item))
        x = list(item)
        for k in rng.sample(range(m), m // 10 if m >= 16 else 0):
            x[k] = "Z"
        data += [(m, words(30, m) + " (" + "".join(x) + ") " + words(5, m + 1), None, None, None), (m + 1000, words(30, m) + " b" + item[:-1] + "ZZ", None, None, None)]
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(frame(spark, data), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = {}
    for i, text, *_ in data:
        for k, item in items:
            d = distance(item, decontaminate.normal(text))
            if k < 16 and re.search(rf"(?<!\w){item}(?!\w)", decontaminate.normal(text)):
                want[i, k] = 0
            elif k >= 16 and d <= k // 10:
                want[i, k] = d
    assert got == want and {m for m, _ in items} <= {i for i, _ in got}


def test_long_texts_and_shared_grams(monkeypatch):
    opening = words(15, 77)
    items = [(k, opening + " " + words(8, 300 + k)) for k in range(200)]
    index = decontaminate.Index(items)
    texts = [words(500, 1) + " " + items[17][1] + " " + words(30, 2), None, "", items[3][1][:-3], opening]
    whole = decontaminate.matches(texts, index)
    assert {(t, i) for t, i, *_ in whole} >= {(0, 17), (3, 3)}
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", 64)
    monkeypatch.setattr(decontaminate, "MOST_HITS", 50)
    assert decontaminate.matches(texts, index) == whole


def test_blocks_give_the_same(spark, monkeypatch):
    data, items = planted()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(tuple, decontaminate.contaminated(frame(spark, data), bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert sorted(map(tuple, decontaminate.contaminated(frame(spark, data), bench).collect())) == one


def test_clean_documents(spark):
    data, items = planted()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    hit = {r.doc_id for r in decontaminate.contaminated(frame(spark, data), bench).collect()}
    kept = decontaminate.clean_documents(with_clashes(frame(spark, data + rows())), bench)
    assert values(kept, "doc_id", "text") == values(frame(spark, [r for r in data if r[0] not in hit] + rows()), "doc_id", "text") and hit
    assert kept.columns == with_clashes(frame(spark, [])).columns


def test_empty(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(frame(spark), bench).collect() == []
    assert decontaminate.clean_documents(frame(spark), bench).count() == len(rows())
    assert decontaminate.contaminated(frame(spark, []), spark.createDataFrame([(1, "x" * 50)], "item_id bigint, text string")).collect() == []
