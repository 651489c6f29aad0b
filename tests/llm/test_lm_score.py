import random

import numpy as np

from tests.llm.common import frame, rows, values, with_clashes
from tidegrid.llm import lm_score


def grammar(spark, n=1500):
    rng = random.Random(0)
    pairs = [(f"a{k}", f"b{k}", f"c{k}") for k in range(20)]
    real = [" ".join(w for _ in range(40) for w in rng.choice(pairs)) for _ in range(n)]
    mixed = [" ".join(rng.sample(x.split(), len(x.split()))) for x in real[:50]]
    return frame(spark, [(k, t, None, None, None) for k, t in enumerate(real + mixed)])


def test_order_matters(spark):
    docs = grammar(spark)
    fitted = lm_score.fit(docs.where("doc_id < 1500"), stride=1)
    out = {r.doc_id: r.mean_log_prob for r in lm_score.score(docs, fitted).collect()}
    assert np.mean([out[k] for k in range(50)]) > np.mean([out[1500 + k] for k in range(50)]) + 0.5


def test_probabilities_add_up():
    net = lm_score.initial(np.arange(lm_score.TOKENS), 1)
    first = np.array([0, lm_score.TOKENS])
    near = np.zeros((2 * lm_score.SIDE, lm_score.TOKENS), np.int64)
    h = lm_score.hidden(net, near)[:1]
    total = 0
    for c in range(lm_score.CLASSES):
        p = np.exp(lm_score.log_softmax(h @ net["to_class"] + net["class_bias"]))[0, c]
        total += p * np.exp(lm_score.log_softmax(h @ net["to_token"][c] + net["token_bias"][c])).sum()
    assert abs(total - 1) < 1e-4 and first[1] == lm_score.TOKENS


def test_gradient():
    rng = np.random.default_rng(0)
    tokens, near = rng.integers(0, lm_score.TOKENS, 64), rng.integers(0, lm_score.TOKENS, (4, 64))

    def loss(net):
        h = lm_score.hidden(net, near)
        g, w = np.divmod(tokens, lm_score.IN_CLASS)
        a = lm_score.log_softmax(h @ net["to_class"] + net["class_bias"])[np.arange(64), g]
        b = lm_score.log_softmax(np.einsum("nd,ndk->nk", h, net["to_token"][g]) + net["token_bias"][g])[np.arange(64), w]
        return -(a + b).mean()

    net = lm_score.initial(np.ones(lm_score.TOKENS), 2)
    before = loss(net)
    lm_score.learn(net, tokens, near, 0.5)
    assert loss(net) < before


def test_awkward_rows(spark):
    out = lm_score.lm_scores(with_clashes(frame(spark)))
    got = out.collect()
    assert len(got) == len(rows()) and all((r.n_tokens == 0) == (r.mean_log_prob is None) for r in got)
    assert all(r.log_prob == 0 for r in got if r.n_tokens == 0) and all(r.log_prob < 0 for r in got if r.n_tokens)
    assert lm_score.lm_scores(frame(spark, [])).collect() == []


def test_order_matters_on_the_defaults(spark):
    docs = grammar(spark)
    out = {r.doc_id: r.mean_log_prob for r in lm_score.score(docs, lm_score.fit(docs.where("doc_id < 1500"))).collect()}
    assert np.mean([out[k] for k in range(50)]) > np.mean([out[1500 + k] for k in range(50)]) + 0.5


def test_every_token_is_trained_on(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_score, "tokenise", lambda token, stride, f=lm_score.tokenise: seen.append(stride) or f(token, stride))
    lm_score.fit(frame(spark))
    assert seen == [1]


def test_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_TOKENS", 8000)
    docs = grammar(spark, 200)
    few, many = (lm_score.fit(docs.repartition(n)) for n in (4, 200))
    assert all(np.array_equal(x, y) for x, y in zip(few, many, strict=True))
    # Scoring's matrices differ in shape with the partitions, so that float32 rounds differently in the last place.
    a, b = (values(lm_score.score(docs.repartition(n), few), "doc_id", "log_prob") for n in (4, 200))
    assert [x for x, _ in a] == [x for x, _ in b] and np.allclose([y for _, y in a], [y for _, y in b], rtol=0, atol=1e-3)


def test_shared_tokens_are_split_and_the_vocabulary_grows():
    counts = np.random.default_rng(0).zipf(1.3, lm_score.BUCKETS).clip(max=10**6)
    token, frequency, share = lm_score.vocabulary(counts)
    large = lm_score.vocabulary(counts * 100)[1]
    assert len(large) > len(frequency) > lm_score.TOKENS and frequency.sum() == counts.sum()
    sums = np.bincount(token, weights=np.exp(share.astype(float)), minlength=len(frequency))
    assert np.allclose(sums, 1, atol=1e-3)
    assert lm_score.unflatten(lm_score.flatten(lm_score.initial(large, 1)))["token_bias"].size == len(large)


def test_rare_words_score_below_frequent_ones(spark):
    rng = random.Random(1)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7))}" if rng.random() < 0.9 else f"x{rng.random()}" for _ in range(100)) for _ in range(300)]
    known = " ".join(f"w{k}" for k in range(100, 140))
    odd = " ".join(f"never{k}" for k in range(40))
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate([*texts, known, odd])])
    out = {r.doc_id: r.mean_log_prob for r in lm_score.score(docs, lm_score.fit(docs.where("doc_id < 300"))).collect()}
    assert out[300] > out[301] + 1


def test_softmax_of_few_and_of_very_large_weights():
    random = np.random.default_rng(5)
    h = np.tanh(random.standard_normal((9000, 16))).astype(np.float32)
    at = random.integers(0, 40, len(h))
    for size, safe in ((0.5, True), (200.0, False)):
        weights, bias = (random.standard_normal((16, 40)) * size).astype(np.float32), random.standard_normal(40).astype(np.float32)
        want = lm_score.log_softmax((h @ weights + bias).astype(np.float64))[np.arange(len(h)), at]
        assert lm_score.safe(weights, bias) == safe
        assert np.allclose(lm_score.log_softmax_at(h, weights, bias, at), want, atol=1e-2 if size > 1 else 1e-4)
        assert np.allclose(lm_score.softmax(h, weights, bias).sum(1), 1, atol=1e-4)


def test_classes_learn_in_bands_as_one_by_one():
    random = np.random.default_rng(6)
    classes, many = 40, 2048
    net = lm_score.initial(np.arange(classes * classes, 0, -1) ** 2, 3)
    tokens = np.minimum(random.zipf(1.2, many), classes * classes) - 1
    near = random.integers(0, classes * classes + 1, (4, many))
    want = {k: v.copy() for k, v in net.items()}
    lm_score.learn(net, tokens, near, 1.0)
    h, (g, w) = lm_score.hidden(want, near), np.divmod(tokens, classes)
    sizes = np.bincount(g, minlength=classes)
    assert [len(x) for x in lm_score.bands(sizes)][-1] == 1 and sorted(np.concatenate(lm_score.bands(sizes))) == np.flatnonzero(sizes).tolist()
    for c in np.flatnonzero(sizes):
        own, x = min(lm_score.REACH / many, 0.5 / sizes[c]), h[g == c]
        q = np.exp(lm_score.log_softmax(x @ want["to_token"][c] + want["token_bias"][c]))
        q[np.arange(len(x)), w[g == c]] -= 1
        assert np.allclose(net["to_token"][c], want["to_token"][c] - own * (x.T @ q), atol=1e-5) and np.allclose(net["token_bias"][c], want["token_bias"][c] - own * q.sum(0), atol=1e-5)
