import hashlib
import random
import re

from docsheaf.llm import pii


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return 16 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= sum(c.isdigit() for c in v) <= 15),
}


def base_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, (pattern, good) in BASE.items()
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]


def check(df):
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = pii.digest(pii.find_personal_data(df)).collect()
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r.doc_id]
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans)
        assert r.spans.split(",")[: len(spans)] == (spans or [""])[: len(spans)]
    return {r.doc_id: r for r in rows}


def test_random_texts(table):
    rnd = random.Random(5)
    pieces = ["a@b.c", "_", "@", ".", "1.2.3.4", "256", "é", "😀", " ", "-", "+", "(", "4111 1111 1111 1111", "0", "9", "+4912345678", "x"]
    rows = [(k, "".join(rnd.choices(pieces, k=rnd.randint(0, 14)))) for k in range(800)]
    check(table(rows))


def test_known_numbers(table):
    rows = [
        (0, "IBAN: DE89 3704 0044 0532 0130 00."), (1, "DE89 3704 0044 0532 0130 01"),
        (2, "social security 123-45-6789"), (3, "part 123-45-6789"), (4, "pay by card 4111-1111-1111-1111"),
        (5, "the 4111-1111-1111-1111"),
    ]
    found = check(table(rows))
    assert found[0].spans == "iban:6:33" and found[1].spans == ""
    assert found[2].spans == "ssn:16:27" and found[3].spans == ""
    assert float(found[4].scores) > float(found[5].scores)


def test_ibans_before_capitals_and_digits(table):
    number = "GB82 WEST 1234 5698 7654 32"
    after = [" Please pay", " The", " 7 days", " BIC ABCD", " BIC", "\nDE", ".", "", " DE89370400440532013000"]
    rows = [(k, f"IBAN {n}{a}") for k, (n, a) in enumerate((n, a) for n in (number, number.replace(" ", "")) for a in after)]
    found = check(table([*rows, (98, f"{number}X"), (99, "account GB82 WEST 1234 5698 7654 33 The")]))
    for doc, text in rows:
        first, *more = found[doc].spans.split(",")
        assert first == f"iban:5:{5 + len(number if ' WEST' in text else number.replace(' ', ''))}", text
        assert len(more) == ("DE8937" in text)
    assert found[98].spans == found[99].spans == ""


def test_many_matches_in_one_text(table):
    check(table([(0, "a@b.cd " * 3000), (1, "a.a" * 20_000 + "@" + "b.c" * 20_000), (2, "1." * 30_000)]))


def test_odd_rows(odd, odd_extra, empty):
    assert pii.digest(pii.find_personal_data(odd)).count() == 9
    assert pii.digest(pii.find_personal_data(odd_extra)).count() == 9
    assert pii.digest(pii.find_personal_data(empty)).collect() == []
