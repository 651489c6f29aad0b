"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ["_id", "_text", "_th", "size", "score", "n_lines", "spans", "gram", "c", "_row", "label"]


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows() -> list[tuple]:
    line = "This line is shared by several documents."
    base = words(120, 1)
    near = base.split()
    near[50] = "changed"
    texts = {
        0: base, 1: base, 2: " ".join(near), 3: None, 4: "", 5: " \n\t\n", 6: f"{line}\nfirst own line of this one here", 7: f"  {line.upper()}\t\nsecond own line of this one here",
        8: f"third own line, quite long\n{line}\n{line}", 9: words(3000, 2), 10: "one", 11: "One", 12: "naïve ÉTÉ café — 文字 😀\r\nx", 13: "a" * 900, 14: words(80, 3) + " " + base, 15: "\n" * 50 + "end",
    }
    out = [(k, t, "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t)) for k, t in texts.items()]
    return [*out, out[6], out[6], (None, base, None, "s1", None), (None, line, None, None, 1), (20, line, "en", "s1", 1)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(7).alias(c) for c in CLASH))


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
