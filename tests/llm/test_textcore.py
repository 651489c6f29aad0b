import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidegrid.llm import ngram_join, rules, suffix_dedup, textcore


def thue_morse(n: int, flip: int = 0) -> bytes:
    return bytes(97 + (bin(i).count("1") + flip) % 2 for i in range(n))


def arrays(texts: list[bytes]):
    return textcore.joined_bytes(texts)


def test_words_and_hashes_of_long_texts():
    rng = random.Random(1)
    texts = [b"", b"x" * 150_000, bytes(rng.choice(b"ab  \n") for _ in range(200_000)), b"y" + b"x" * 150_000 + b" z", b"end"]
    data, offsets = arrays(texts)
    words = textcore.Words(data, offsets)
    found = [(m.start() + a, m.end() + a) for t, a in zip(texts, offsets, strict=False) for m in re.finditer(rb"[^\x20\x09-\x0d]+", t)]
    assert list(zip(words.start, words.end, strict=True)) == found
    hashes, names = words.hashes(), [data[a:b].tobytes() for a, b in found]
    assert len(set(zip(hashes.tolist(), names, strict=True))) == len(set(names)) == len(set(hashes.tolist()))
    assert textcore.count_bytes(textcore.SPACE, data, offsets).tolist() == [sum(c in b" \n" for c in t) for t in texts]


def test_strings_that_collide_modulo_powers_of_two_are_told_apart():
    one, other = thue_morse(1024), thue_morse(1024, 1)
    assert rules.statistics(*arrays([one + b"\n" + other, one + b"\n" + one]))["n_dup_lines"].tolist() == [0, 1]
    a, b = (b" ".join([w, b"and", b"more", w]) for w in (one, other))
    keys, text = ngram_join.shingles(*arrays([a, b]), 3)
    assert not set(keys[text == 0].tolist()) & set(keys[text == 1].tolist())
    assert Fraction(9, 10)


def test_a_collision_of_lines_is_settled_by_their_bytes():
    lines = [b"one line", b"another!", b"one line", b"a third."]
    data, _ = arrays([b"\n".join(lines)])
    start = np.array([0, 9, 18, 27])
    got = rules.repeats(np.zeros(4, np.uint64), np.zeros(4, np.int64), 1, data, start, start + 8)
    assert got.tolist() == [1]


def test_nearest_smaller():
    for seed in range(20):
        order = np.random.default_rng(seed).permutation(50)
        want = [max((j for j in range(i) if order[j] < order[i]), default=-1) for i in range(50)]
        assert suffix_dedup.nearest_smaller(order).tolist() == want
    assert suffix_dedup.nearest_smaller(np.arange(1000)[::-1]).tolist() == [-1] * 1000


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcd"])
def test_longest_previous_factors(alphabet):
    rng = random.Random(len(alphabet))
    text = bytes(rng.choice(alphabet) for _ in range(120))
    length, last = 20, 120 - 20 + 1
    joined = np.frombuffer(text + bytes(8), np.uint8)
    got, source = suffix_dedup.longest_previous_factors(joined, suffix_dedup.ranks_by_doubling(joined, len(text), length), np.arange(last))
    for i in range(last):
        common = [next((k for k in range(length) if text[i + k] != text[j + k]), length) for j in range(i)]
        assert got[i] == max(common, default=0)
        assert source[i] == -1 if got[i] == 0 else common[source[i]] == got[i]


def test_factors_of_several_texts():
    rng = random.Random(7)
    base = bytes(rng.choice(b"abc") for _ in range(40))
    texts = [base[:30], base[5:35], base[10:40], bytes(30)]
    earlier, twice, edges = suffix_dedup.factors(texts, np.array([11] * 4), 20)
    grams = [t[k : k + 20] for t in texts for k in range(11)]
    seen = Counter(grams)
    assert twice.tolist() == [seen[g] > 1 for g in grams]
    assert earlier.tolist() == [g in grams[:k] for k, g in enumerate(grams)]
    assert edges.tolist() == [0, 11, 22, 33, 44]
