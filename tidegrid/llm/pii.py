"""Personal data: e-mail addresses, IP addresses, card and phone numbers, plain or disguised.

Plain ones are found by the base patterns, leftmost and non-overlapping for each kind.  For disguised
ones, transducers rewrite the text (homoglyphs and wide forms to ASCII, spelled digits to digits,
"(at)" and "dot" to signs) and keep for every rewritten character the stretch of the source that it
came from; the same detectors run on the rewritten text, and what they find is mapped back.  A
span that needs no rewriting is left to the base patterns.

Offsets are code points, end exclusive.  Defined results: null and empty texts have no spans; every
detector is linear in the text; rows are independent, so that repeated rows get equal results and an
empty table an empty one; of overlapping spans of a kind the base one counts.  ``find_pii`` returns the id and the spans alone, and ``mask_pii``
keeps all columns, whatever their names.  Texts are read as wholes, so that a very long one takes some 30 bytes a character where it hides something.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime

# The kinds, in the order of the digest, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Digit words of four languages.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
#: Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝвкмнтАВЕЅІЈКМНОРСТУХΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρι", "aeopcyxijshdqwbkmhtABESIJKMHOPCTYXABEZHIKMNOPTYXaovpi", strict=True))
#: Other signs for at, dot, plus, hyphen and space.
SIGNS = {"\uff20": "@", "\ufe6b": "@", "\u2024": ".", "\u3002": ".", "\uff61": ".", "\ufe52": ".", "\uff0b": "+", "\ufe62": "+", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-", "\uff0d": "-", "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ", "\u3000": " "}
#: Characters without a shape.
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
FEWEST_SPELLED = 4
#: Last parts of domains that a spelled "at" with a plain dot, or one of more than four letters, needs.
DOMAINS = frozenset("com org net edu gov mil int info biz name mobi museum travel jobs online store shop cloud email agency academy company digital group network systems technology university app dev ai io co me eu uk us ca au nz ie de at ch fr be nl lu it es pt mx ar cl pe br pl cz dk se no fi ru jp cn in kr".split())
#: Words that announce a phone number.
CUE = re.compile(r"(?i)(?:phone|tel|call|dial|mobile|cell|fax|whatsapp|number|reach|contact|sms|anruf|ruf|nummer|handy|appel|num[eé]ro|portable|tel[eé]fono|llam|m[oó]vil)")
#: What Python's \s matches, spelled out for RE2, whose own is ASCII alone.
BLANK = "[\\t\\n\\x0b\\f\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _folds() -> dict[int, str]:
    table = {ord(k): v for k, v in (LOOKALIKES | SIGNS).items()} | {ord(c): "" for c in HIDDEN}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F) if c not in table}
    for c in range(0x80, 0x20000):
        if c not in table and (d := unicodedata.decimal(chr(c), None)) is not None:
            table[c] = str(d)
    return table


FOLDS = _folds()
FOLDABLE = re.compile("[" + "".join(map(re.escape, map(chr, sorted(FOLDS)))) + "]")
_digit = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_open, _close = r"[\[({<]\s?", r"\s?[\])}>]"
AT_DOT = re.compile(rf"\s?{_open}(?:(?P<at>at|@|arroba|chez)|(?P<dot>dot|punto|punkt|point|\.)){_close}\s?", re.I)
BARE = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?P<at> at |_at_| @ |@)[A-Za-z0-9-]{1,63}(?:(?: dot |_dot_|\.)[A-Za-z0-9-]{1,63}){1,8}(?![A-Za-z0-9-])", re.I)
BARE_SIGN = re.compile(r"(?P<at> at |_at_| @ )|(?P<dot> dot |_dot_)", re.I)
SPELLED = re.compile(rf"(?<!\w)(?:(?P<plus>plus)[\s-]+)?(?:{_digit}|[0-9](?![0-9]))(?:[\s,()-]{{1,3}}(?:(?:dot|point|punkt|punto)[\s-]+)?(?:{_digit}|[0-9](?![0-9]))){{{FEWEST_SPELLED - 1},}}(?!\w)", re.I)
SPELLED_TOKEN = re.compile(rf"(?P<plus>plus)|(?P<dot>dot|point|punkt|punto)|(?P<word>{_digit})|(?P<digit>[0-9])", re.I)
#: What RE2 looks for, so that Python sees only texts that may hold something.
PLAIN = r"@|[0-9]\.[0-9]|\+[0-9]|(?:[0-9][ -]?){15}[0-9]"
_separators = rf"(?:{BLANK}|[,()-]){{1,3}}(?:(?:dot|point|punkt|punto)(?:{BLANK}|-)+)?"
DISGUISED = rf"(?i)[\[({{<]{BLANK}?(?:at|@|arroba|chez|dot|punto|punkt|point|\.){BLANK}?[\])}}>]| dot |_dot_| @ |_at_| at [a-z0-9-]+\.[a-z0-9]|(?:{_digit}|[0-9]){_separators}{_digit}{_separators}(?:{_digit}|[0-9])"


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """By the sign in its middle, so that long words without it cost nothing."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base spans by kind."""
    digits = lambda x: [c for c in x if "0" <= c <= "9"]
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(d := digits(m[0])) <= 19 and luhn("".join(d))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15] if "+" in text else [],
    }


class Rewritten:
    """A text and, for each of its characters, the stretch [start, end) of the source."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.changed = text, None, None, []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches (in order, not overlapping) of the present text."""
        if not edits:
            return
        n = len(self.text)
        start, end = self.start or list(range(n)), self.end or list(range(1, n + 1))
        marks = self.changed or [False] * n
        text, new_start, new_end, new_marks, at = [], [], [], [], 0
        for a, b, put in [*edits, (n, n, "")]:
            text.append(self.text[at:a])
            new_start += start[at:a]
            new_end += end[at:a]
            new_marks += marks[at:a]
            if put:
                text.append(put)
                new_start += [start[a]] * len(put)
                new_end += [end[b - 1]] * len(put)
                new_marks += [True] * len(put)
            elif a < b and new_marks:
                new_marks[-1] = True  # a hidden character went after it
            at = b
        self.text, self.start, self.end, self.changed = "".join(text), new_start, new_end, new_marks

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


def bare_edits(text: str) -> list[tuple[int, int, str]]:
    """Signs written as words, in what is an address as a whole.

    Words like "at" and "dot" occur by themselves.  So a spelled dot needs a last part of at most four letters or one of ``DOMAINS`` ("look at the
    dot product" has neither); a spelled "at" with plain dots alone needs one of ``DOMAINS`` and, as a word of its own, a local part that looks like one."""
    out, low = [], text.lower()
    if not any(x in low for x in (" dot ", "_dot_", " @ ", " at ", "_at_")):
        return out
    for m in BARE.finditer(text):
        signs = list(BARE_SIGN.finditer(text, m.start(), m.end()))
        last = re.split(r" dot |_dot_|\.", m[0], flags=re.I)[-1].lower()
        known = last in DOMAINS
        if any(x["dot"] for x in signs):
            fits = known or re.fullmatch(r"[a-z]{2,4}", last)
        elif any(x[0] == " @ " for x in signs):
            fits = True
        else:
            local = re.split(r" at |_at_", m[0], maxsplit=1, flags=re.I)[0]
            fits = known and signs and (signs[0][0].lower() == "_at_" or re.search(r"[A-Za-z0-9][0-9._-]+[A-Za-z0-9]|[0-9]$", local))
        if fits:
            out += [(x.start(), x.end(), "@" if x["at"] else ".") for x in signs]
    return out


def is_counting(digits: str) -> bool:
    """Whether digits look counted or repeated rather than dialled: all but one of them go up or down by one, or there are fewer than four different ones."""
    steps = [(int(b) - int(a)) % 10 for a, b in zip(digits, digits[1:], strict=False)]
    run, last = 0, None
    for step in steps:
        run = run + 1 if step == last else 1
        last = step
        if step in (1, 9) and run >= len(digits) - 2:
            return True
    return len(set(digits)) < 4


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in SPELLED.finditer(text):
        tokens = list(SPELLED_TOKEN.finditer(text, m.start(), m.end()))
        if sum(bool(t["word"]) for t in tokens) < 3:
            continue
        for k, t in enumerate(tokens):
            put = "+" if t["plus"] else "." if t["dot"] else DIGIT_WORDS[t[0].lower()] if t["word"] else t[0]
            stop = tokens[k + 1].start() if k + 1 < len(tokens) else t.end()  # separators go
            out.append((t.start(), stop, put))
    return out


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Spans that only the rewritten text shows."""
    new = Rewritten(text)
    if not text.isascii() and FOLDABLE.search(text):
        new.rewrite([(m.start(), m.end(), FOLDS[ord(m[0])]) for m in FOLDABLE.finditer(text)])
    new.rewrite([(m.start(), m.end(), "@" if m["at"] else ".") for m in AT_DOT.finditer(new.text)])
    new.rewrite(bare_edits(new.text))
    new.rewrite(spelled_edits(new.text))
    if not new.changed:
        return []
    found = detect(new.text)
    found["email"] = [(a, b) for a, b in found["email"] if re.fullmatch(r"[A-Za-z]{2,24}", new.text[a:b].rpartition(".")[2])]
    # A number that is spelled out is a phone number without a plus, too, if a word says so or it doesn't look like counting.
    taken = [x for k in ("ip", "card", "phone") for x in found[k]]
    for m in re.finditer(r"(?<![0-9.+])[0-9]{10,15}(?![0-9.])", new.text):
        said = CUE.search(new.text, max(0, m.start() - 40), m.start()) is not None
        if sum(new.changed[m.start() : m.end()]) >= 8 and (said or not is_counting(m[0])) and not any(a < m.end() and m.start() < b for a, b in taken):
            found["phone"].append(m.span())
    return [(kind, *new.source(a, b)) for kind in KINDS for a, b in found[kind] if any(new.changed[a:b])]


def spans_of(text: str, may_hide: bool = True) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base), by kind and then start."""
    base = detect(text)
    out = [(kind, a, b, True) for kind in KINDS for a, b in base[kind]]
    if may_hide:
        out += [(kind, a, b, False) for kind, a, b in disguised(text) if not any(x <= a and b <= y for x, y in base[kind])]
    return sorted(set(out), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_spans(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    for batch in batches:
        text = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.large_string()), "")
        hides = pc.or_(pc.match_substring_regex(text, DISGUISED), pc.match_substring_regex(text, FOLDED))
        look = pc.or_(pc.match_substring_regex(text, PLAIN), hides)
        out = [[] for _ in range(batch.num_rows)]
        for i in pc.indices_nonzero(look).to_pylist():
            out[i] = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans_of(text[i].as_py(), hides[i].as_py())]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(out, kind)], names=[*batch.schema.names[:-1], "spans"])


def _re2_class() -> str:
    """The foldable characters, as ranges."""
    codes, out = sorted(FOLDS), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out if b >= 0x80) + "]"


FOLDED = _re2_class()


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``spans``: array of (kind, start, end, base)."""
    runtime.prepare(docs, __name__)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(find_spans, f"_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>").withColumnRenamed("_id", id_col)


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans, the one that starts first and then the longer."""
    if not text:
        return text
    out, at = [], 0
    for kind, a, b, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])


def mask_batches(batches, at: int):
    import pyarrow as pa

    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        columns[at] = pa.array([masked(x) for x in columns[at].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of its texts masked."""
    runtime.prepare(docs, __name__)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(lambda batches: mask_batches(batches, at), docs.schema)


def pii_digest(docs: DataFrame) -> DataFrame:
    """The query's columns.  Counts and base_sha256 are of the base spans, ``spans`` has all."""
    found = find_pii(docs.select("doc_id", "text"))
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])

    def many(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(many, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


