from tests.llm.common import frame, values, with_clashes
from tidegrid.llm import licenses

MIT = licenses._MIT


def brute(data, threshold=0.8):
    templates = [(k, n, set(licenses.bigrams(t)), licenses.words(t)) for k, (n, t) in enumerate(licenses.TEMPLATES)]

    def fits(own, name, grams, around=None):
        return own >= grams & licenses.KEYS and not any(g in (around or own) for g in licenses.NEVER.get(name, ()) if g not in grams)

    out = set()
    for i, text, *_ in data:
        lines = (text or "").split("\n")
        for at, unit in [*enumerate(lines), *([(-1, " ".join(lines))] if len(lines) > 1 else [])]:
            own = set(licenses.bigrams(unit))
            found = [(-2 * len(own & g) / (len(own) + len(g)), n) for _, n, g, _ in templates if own and fits(own, n, g)]
            best = min(found, default=(0, ""))
            if -best[0] >= threshold:
                out.add((i, at, -1, best[1], round(-best[0], 6)))
        all_words, best = licenses.words(text or ""), {}
        for _, n, g, w in templates:
            step = max(1, len(w) // 10)
            for start in range(0, len(all_words), step):
                window = all_words[start : start + len(w)]
                own = [f"{a} {b}" for a, b in zip(window, window[1:], strict=False)]
                more = " ".join(all_words[start : start + len(w) + licenses.AHEAD])
                if own and fits(set(own), n, g, set(licenses.bigrams(more))):
                    best[n] = min(best.get(n, (0, 0)), (-2 * len(set(own) & g) / (len(own) + len(g)), start))
        out |= {(i, -2, start, n, round(-d, 6)) for n, (d, start) in best.items() if -d >= threshold}
    return sorted(out, key=str)


def wrapped(text, width=9, lead="# "):
    w = text.split()
    return "\n".join(lead + " ".join(w[k : k + width]) for k in range(0, len(w), width))


def test_brute_force(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "intro\nReleased under the MIT license!\nmore text here", MIT.replace(". ", ".\n"), "All rights reserved. " * 3, "all RIGHTS\nreserved", None, "", "one", "Licensed under the Apache License, Version 2.0 only",
             "// Released under the MIT License. See the LICENSE file for more details, please.", "a b c d e " * 50 + wrapped(licenses._ISC) + " and so on " * 40]
    data = [(k, t, None, None, None) for k, t in enumerate(texts)] + [(0, texts[0], None, None, None), (None, texts[0], None, None, None)]
    got = licenses.scan_licenses(with_clashes(frame(spark, data)))
    assert values(got, "doc_id", "line", "word", "license", "dice") == sorted(brute(data), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_whole_licenses_and_wrapped_headers(spark):
    code = "import os\n\ndef main():\n    return os.getcwd()\n" * 30
    gpl = licenses._GNU.format("", 2)
    files = {
        "MIT": f"MIT License\n\nCopyright (c) 2020 Some One\n\n{wrapped(MIT, 12, '')}\n\n{wrapped(licenses._MIT_END, 12, '')}\n",
        "BSD-2-Clause": f"Copyright (c) 2020, Some One\n\n{wrapped(licenses._BSD, 12, '')}\n\n{wrapped(licenses._BSD_END, 12, '')}",
        "BSD-3-Clause": f"Copyright (c) 2020, Some One\n\n{wrapped(licenses._BSD, 12, '')}\n{wrapped(licenses._BSD_3, 12, '')}\n{wrapped(licenses._BSD_END, 12, '')}",
        "Apache-2.0": wrapped(f"Copyright 2020 Some One {licenses._APACHE} {licenses._APACHE_END}") + code,
        "GPL-2.0": wrapped(f"My program. {gpl} {licenses._GNU_END}", lead=" * ") + code,
        "GPL-3.0": code + wrapped(f"My program. {licenses._GNU.format('', 3)} {licenses._GNU_END}", lead=" * "),
        "LGPL-3.0": code + wrapped(licenses._GNU_LIBRARY.format(3)) + code,
    }
    names = list(files)
    got = licenses.scan_licenses(frame(spark, [(k, files[n], None, None, None) for k, n in enumerate(names)])).collect()
    found = {n: {r.license for r in got if names[r.doc_id] == n} for n in names}
    assert found == {n: {n} for n in names}


def test_templates_without_keys(spark):
    assert all(licenses.keys_of(licenses.bigrams(t)) for _, t in licenses.TEMPLATES)
    own = [("Own-1.0", "You may use these files in any way that pleases you, said the cat."), ("MIT", "Released under the MIT License.")]
    data = [(1, "x y\nyou may use these files in any way that pleases you said the dog\nz", None, None, None), (2, "released under the mit license", None, None, None), (3, "nothing here", None, None, None)]
    got = licenses.scan_licenses(frame(spark, data), templates=own)
    assert {(r.doc_id, r.line, r.license) for r in got.collect()} == {(1, 1, "Own-1.0"), (1, -2, "Own-1.0"), (1, -1, "Own-1.0"), (2, 0, "MIT"), (2, -2, "MIT")}


def test_blocks_of_templates_give_the_same(spark, monkeypatch):
    data = [(1, wrapped(MIT), None, None, None), (2, "Licensed under CC BY 4.0.\nall rights reserved", None, None, None)]
    one = values(licenses.scan_licenses(frame(spark, data)), "doc_id", "line", "word", "license", "dice")
    monkeypatch.setattr(licenses, "BLOCK_TEMPLATES", 15)
    assert values(licenses.scan_licenses(frame(spark, data)), "doc_id", "line", "word", "license", "dice") == one and len(one) >= 4


def test_empty(spark):
    assert licenses.scan_licenses(frame(spark, [])).collect() == []
    assert licenses.scan_licenses(frame(spark), templates=[]).collect() == []


def test_every_match_has_a_word_of_each_set():
    import random

    rng = random.Random(0)
    for _, text in licenses.TEMPLATES:
        grams = licenses.bigrams(text)
        sets = licenses.word_sets(grams, 0.8, known=frozenset(["software", "under", "license"]))
        for _ in range(30):
            own = licenses.words(text)
            for _ in range(rng.randint(0, len(own) // 4)):
                own.insert(rng.randrange(len(own)), "zzz") if rng.random() < 0.5 else own.pop(rng.randrange(len(own)))
            mine = set(licenses.bigrams(" ".join(own)))
            if mine and 2 * len(mine & set(grams)) / (len(mine) + len(grams)) >= 0.8:
                assert all(set(s) & set(own) for s in sets)


def test_dice_alone(spark, monkeypatch):
    import random

    rng, data = random.Random(4), []
    for k, (_, text) in enumerate(licenses.TEMPLATES):
        own = text.split()
        for _ in range(max(1, len(own) // 12)):
            own.insert(rng.randrange(len(own)), "zzz") if rng.random() < 0.5 else own.pop(rng.randrange(len(own)))
        data.append((k, " ".join(own) if k % 2 else wrapped(" ".join(own)), None, None, None))
    data += [(99, MIT.replace("hereby ", ""), None, None, None), (100, "nothing of the kind", None, None, None), (101, None, None, None, None)]
    columns = ("doc_id", "line", "word", "license", "dice")
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))
    with_keys = values(licenses.scan_licenses(frame(spark, data)), *columns)
    assert order(with_keys) == order(brute(data)) and all(r[0] != 99 for r in with_keys)
    got = values(licenses.scan_licenses(frame(spark, data), keys=frozenset(), never={}), *columns)
    monkeypatch.setattr(licenses, "KEYS", frozenset())
    monkeypatch.setattr(licenses, "NEVER", {})
    assert order(got) == order(brute(data)) and {r[3] for r in got if r[0] == 99} == {"MIT"}
