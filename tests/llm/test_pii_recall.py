import re

import pytest

from trailmix.llm.pii import apply, canonical, detect, render, surrogate

KEY = b"test key"
# Hand-labelled: text, with the entities in it as (kind, spelling).
LABELLED = [
    ("paid with 4111 1111 1111 1111 12/25", [("card", "4111 1111 1111 1111")]),
    ("4111111111111111 123 and 12 4111 1111 1111 1111 CVV", [("card", "4111111111111111"), ("card", "4111 1111 1111 1111")]),
    ("row 5 12 1234 4111-1111-1111-1111 99", [("card", "4111-1111-1111-1111")]),
    ("amex 3782 822463 10005 01 27", [("card", "3782 822463 10005")]),
    ("to ES91 2100 0418 4502 0005 1332 BIC X", [("iban", "ES91 2100 0418 4502 0005 1332")]),
    ("XY12 ABCD DE89 3704 0044 0532 0130 00 COBADEFF", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("NO93 8601 1117 947 THE END", [("iban", "NO93 8601 1117 947")]),
    ("call 555 123 4567 now", [("phone", "555 123 4567")]),
    ("Tel 030 1234567 or (030) 1234567, 06 12 34 56 78", [("phone", "030 1234567"), ("phone", "(030) 1234567"), ("phone", "06 12 34 56 78")]),
    ("0049 30 1234567; 020 7946 0958", [("phone", "0049 30 1234567"), ("phone", "020 7946 0958")]),
    ("from 2001:db8::8a2e:370:7334 and fe80:0:0:0:0:0:0:1.", [("ipv6", "2001:db8::8a2e:370:7334"), ("ipv6", "fe80:0:0:0:0:0:0:1")]),
    ("Prof. Dr. Weiss met Dr. Jones", [("surname_latin", "Weiss"), ("surname_latin", "Jones")]),
    ("Hello, my name is Zorka Blahova", [("surname_latin", "Zorka"), ("surname_latin", "Blahova")]),
    ("Best regards,\nXiu Zhang", [("surname_latin", "Xiu"), ("surname_latin", "Zhang")]),
    ("Emma Stone and Jean-Luc Moreau", [("given_f_latin", "Emma"), ("surname_latin", "Stone"), ("given_", "Jean-Luc"), ("surname_latin", "Moreau")]),
]
CLEAN = ["on 05.06.2024 at 12:30:45", "1234 5678 9012 3456 7890 rows", "std::vector and a::b", "ids 12 345 678 9012 3", "The End of Name", "10 20 30 40 50 60 70"]


@pytest.mark.parametrize("text,want", LABELLED)
def test_found_with_digits_and_capitals_beside(text, want):
    got = [(k, text[a:z]) for a, z, k, _ in detect(text)]
    assert len(got) == len(want) and all(g[0].startswith(w[0]) and g[1] == w[1] for g, w in zip(got, want, strict=True)), got
    for attempt in (0, 5, 9):
        new = {(k, e): surrogate(KEY, k, e, attempt) for *_, k, e in detect(text)}
        assert [x[2] for x in detect(apply(text, new)[0])] == [k for k, _ in got], apply(text, new)


def test_clean_texts_stay():
    for t in CLEAN:
        assert detect(t) == [], (t, detect(t))


def test_spellings_of_new_forms_corefer():
    assert canonical("phone", "0049 30 1234567") == canonical("phone", "+49 30 1234567")
    assert canonical("ipv6", "2001:DB8::1") == canonical("ipv6", "2001:db8:0:0:0:0:0:1")
    e = canonical("phone", "06 12 34 56 78")
    assert re.fullmatch(r"0[1-9]( \d\d){4}", render("phone", "06 12 34 56 78", e, surrogate(KEY, "phone", e, 0)))
