import hashlib
import re

import pytest

from tests.llm.common import frame, rows, with_clashes
from tidegrid.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, text):
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        twice = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 16 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(twice)) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def expected(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if good(k, m[0])]


TEXTS = [
    "bob.96@mail8.example.com, a@b@c.d.e and x@y @z.com ..@a.b", "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 and 010.002.3.255 v1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112, 6011000990139424123",
    "+1 (389) 555-5010, +49 30.1234567890123, ++33 1 23 45 67 89 +1 2", "😀 é bob@x.y.z 文字 +4912345678", "", None, "@" * 50, "9" * 500, "1." * 300, "+" + "1 " * 200, "a" * 5000 + "@b.c",
]


def test_base_spans():
    for text in TEXTS:
        assert [s[:3] for s in pii.spans_of(text or "") if s[3]] == expected(text)


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("write to bob [at] mail8 [dot] example [dot] com today", "email", "bob [at] mail8 [dot] example [dot] com"),
        ("write to bob (AT) mail8.example.com today", "email", "bob (AT) mail8.example.com"),
        ("bob at mail dot example dot com", "email", "bob at mail dot example dot com"),
        ("jоhn@mail.com", "email", "jоhn@mail.com"),
        ("bob＠mail．com", "email", "bob＠mail．com"),
        ("call plus one three eight nine five five five five zero one zero now", "phone", "plus one three eight nine five five five five zero one zero"),
        ("null drei null eins zwei drei vier fünf sechs sieben", "phone", "null drei null eins zwei drei vier fünf sechs sieben"),
        ("host one nine two dot one six eight dot zero dot one end", "ip", "one nine two dot one six eight dot zero dot one"),
        ("１９２.168.0.1", "ip", "１９２.168.0.1"),
        ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
        ("j.doe at example.com", "email", "j.doe at example.com"),
        ("bob_at_example.com", "email", "bob_at_example.com"),
        ("bob at mail dot museum", "email", "bob at mail dot museum"),
        ("bob\u2003[\u2003at\u2003]\u2003example.com", "email", "bob\u2003[\u2003at\u2003]\u2003example.com"),
        ("call five five five five one two three four five six", "phone", "five five five five one two three four five six"),
        ("b​ob@mail.com", "email", "b​ob@mail.com"),
    ],
)
def test_disguises(text, kind, found):
    got = [(k, text[a:b]) for k, a, b, base in pii.spans_of(text) if not base]
    assert (kind, found) in got


@pytest.mark.parametrize("text", ["look at the dot product of a and b", "one two three go", "meet me at noon", "at home (at last) I saw [dot] signs", "the two of one hundred and five", "Привет мир", "naïve café", "zero one two three four five six seven eight nine", "null " * 10, "nine eight seven six five four three two one zero", "see you at example.com"])
def test_clean_texts(text):
    assert pii.spans_of(text) == []


def test_what_hides_is_looked_at():
    """The filter that picks texts for Python passes every text in which Python finds something disguised."""
    import pyarrow as pa
    import pyarrow.compute as pc

    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"bob{b}[{b}at{b}]{b}x.example.com" for b in blanks] + [b.join("plus one three eight nine five five five five zero one zero".split()) for b in blanks]
    for text in texts:
        hides = any(pc.match_substring_regex(pa.array([text]), pattern)[0].as_py() for pattern in (pii.DISGUISED, pii.FOLDED))
        assert hides or not pii.disguised(text), text


def test_query(spark):
    data = [(k, t, None, None, None) for k, t in enumerate(TEXTS)] + rows()
    out = pii.pii_digest(with_clashes(frame(spark, data))).collect()
    want = sorted((str(i), *(sum(s[0] == k for s in expected(t)) for k in pii.KINDS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in expected(t)).encode()).hexdigest()) for i, t, *_ in data)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out) == want
    assert pii.pii_digest(frame(spark, [])).collect() == []


def test_mask(spark):
    data = [(1, "mail bob@x.y or +1 (389) 555-5010", None, None, None), (2, None, None, None, None)]
    assert [r.text for r in pii.mask_pii(frame(spark, data)).orderBy("doc_id").collect()] == ["mail <EMAIL> or <PHONE>", None]
