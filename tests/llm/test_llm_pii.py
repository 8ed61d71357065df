"""Personal data against Python's regular expressions, and the kinds that are added."""

import hashlib
import re
import time

import pytest

import cases
from llm import pii


def passes_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


TEXTS = [
    "write to a.b+c@mail.example.com, or x@y or @z.de or a@b.c_d@e.f, a@@b.c, a@b..c a@b.c. é@ü.de q@1-2.3-4",
    "%%a@b.c@d.e @a.b a@b.c.d.e.f ......@x.y -@-.-",
    "at 10.0.0.1 and 256.1.1.1 and 1.2.3.4.5.6.7.8 and 0001.002.000255.0 v1.2.3 1.2.3.4x5.6.7.8 1..2.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111 1111 1111, 378282246310005 6011000990139424",
    "5555555555554444 1 and 55555555555544441, 0000 0000 0000 00, 12-34-56-78-90-12-34",
    "call +1 (974) 555-3436 or +4 or +49.30.1234567- or ++49 30 1234567 +1234567890123456 +1 2 3 4 5 6 7 8 9 0 x",
    "+1 (017) 555-7713+1 (017) 555-7713 💳 4111111111111111 é 10.0.0.1",
    "€ 😀 a@b.cd 😀 +1 (017) 555-7713 😀😀 4111 1111 1111 1111",
    "IBAN DE89 3704 0044 0532 0130 00 IS IT, GB82WEST12345698765432 or DE89370400440532013001, xDE89370400440532013000",
    "phone: 030 1234567, order 030 1234567, it was 030 1234567 in all; my ssn 123-45-6789, 000-12-3456",
    "see 2001:0db8:0000:0000:0000:ff00:0042:8329 and a:b:c",
    "number 123 4111111111111111 77777 here; visa 4222222222222, or 4222222222222 so",
]


def spans_of(spark, texts):
    docs = [(i, t, None, None, None) for i, t in enumerate(texts)]
    return {r.doc_id: r for r in pii.scan(cases.frame(spark, docs)).collect()}


def named(text, row, kind):
    found = [s.split(":") for s in row.spans.split(",") if s]
    return [text[int(a) : int(b)] for k, a, b in found if k == kind]


def test_base_kinds(spark):
    docs = cases.rows() + [(500 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    got = sorted(tuple(r)[:6] for r in pii.scan(cases.frame(spark, docs).fillna(-1, ["doc_id"])).collect())
    want = []
    for d in docs:
        base = brute_base(d[1])
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        counts = [sum(k == i for _, k, _ in base) for i in range(4)]
        want.append((-1 if d[0] is None else d[0], *counts, hashlib.sha256(written.encode()).hexdigest()))
    assert got == sorted(want)
    assert all(sum(w[i] for w in want) for i in range(1, 5))
    assert pii.scan(cases.empty(spark)).collect() == []


def test_added_kinds(spark):
    rows = spans_of(spark, TEXTS)
    assert named(TEXTS[8], rows[8], "iban") == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert named(TEXTS[9], rows[9], "phone_local") == ["030 1234567"]
    assert rows[9].spans.count("phone_local:7:") == 1
    assert named(TEXTS[9], rows[9], "ssn") == ["123-45-6789"]
    assert named(TEXTS[10], rows[10], "ipv6") == ["2001:0db8:0000:0000:0000:ff00:0042:8329"]
    assert named(TEXTS[11], rows[11], "card_beside") == ["4111111111111111"]
    assert named(TEXTS[11], rows[11], "card_short") == ["4222222222222"]


def test_base_spans_stay_and_added_ones_overlap_nothing(spark):
    texts = TEXTS + ["tel " + t for t in TEXTS] + ["phone a@1234567.de +49 30 1234567 1.2.3.4 call 1234567"]
    for i, row in spans_of(spark, texts).items():
        spans = [s.split(":") for s in row.spans.split(",") if s]
        spans = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in spans]
        assert spans == sorted(spans)
        base = brute_base(texts[i])
        assert [s for s in spans if s[1] < 4] == base
        for a, k, b in spans:
            if k >= 4:
                assert not any(x < b and a < y for x, j, y in spans if (x, j, y) != (a, k, b))


def test_redaction(spark):
    docs = cases.rows() + [(500 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    df = cases.frame(spark, docs)
    out = pii.redact(df)
    assert out.columns == df.columns
    spans = {}
    for r in pii.scan(df).collect():
        found = [s.split(":") for s in r.spans.split(",") if s]
        spans[r.doc_id] = sorted((int(a), int(b)) for _, a, b in found)
    texts = {d[0]: d[1] for d in docs}
    for r in out.select("doc_id", "text").collect():
        text, at, want = texts[r.doc_id], 0, ""
        if text is None:
            assert r.text is None
            continue
        for a, b in spans[r.doc_id]:
            if a >= at:
                want += text[at:a] + "[PII]"
            at = max(at, b)
        assert r.text == want + text[at:]


@pytest.mark.parametrize(
    ("text", "counts"),
    [
        ("a." * 400_000, [0, 0, 0, 0]),
        ("7" * 800_000, [0, 0, 0, 0]),
        ("1.1.1." * 150_000, [0, 112_500, 0, 0]),
        ("+1" + " " * 800_000, [0, 0, 0, 0]),
        ("a@b" + ".c" * 400_000, [1, 0, 0, 0]),
        ("1 2-3 " * 130_000, [0, 0, 0, 0]),
        ("tel a@b.de 5551234 " * 20_000, [20_000, 0, 0, 0]),
        ("4111 1111 1111 1111, " * 30_000, [0, 0, 30_000, 0]),
        ("AB12" * 200_000, [0, 0, 0, 0]),
    ],
    ids=["run", "digits", "ips", "plus", "labels", "parted", "many", "cards", "accounts"],
)
def test_very_long_texts(spark, text, counts):
    start = time.time()
    got = pii.scan(cases.frame(spark, [(1, text, None, None, None)])).collect()[0]
    assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == counts
    assert time.time() - start < 60
