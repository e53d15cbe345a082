"""Operator 2: values next to other groups, in time stamps, and phones of other layouts."""

import re

import pytest

from test_native import luhn, rewrite

IBAN = "BE68 5390 0754 7034"
CARD = "4111 1111 1111 1111"


def test_nothing_stays_readable(spark):
    texts = [f"pay {CARD} 123 now", f"pay 123 {CARD}", f"pay 1234 {CARD} 555-123-4567 x", f"{CARD} 123-45-6789", f"{CARD} {CARD}", f"{CARD} 12ab",
             f"{IBAN} USD", "BE68539007547034 12", f"{IBAN} CALL {IBAN}", f"ID12 3456 7890 {CARD}", f"AB12 3456 7890 {IBAN}",
             "at 2020-05-12T10:00:00Z", "12 2020-05-12 5551234567"]
    old = [CARD, IBAN, IBAN.replace(" ", ""), "2020-05-12", "555-123-4567", "123-45-6789", "5551234567"]
    got = rewrite(spark, texts)
    for text, row in zip(texts, got):
        assert not any(x in row["text"] for x in old), (text, row)
        assert re.sub(r"\d", "0", row["text"]) == re.sub(r"\d", "0", text)
    card = got[0]["text"][4:23]
    assert luhn(card.replace(" ", "")) and got[0]["text"].endswith(" 123 now")
    assert got[1]["text"] == f"pay 123 {card}" and got[4]["text"] == f"{card} {card}" and got[9]["text"] == f"ID12 3456 7890 {card}"
    assert got[2]["text"].startswith(f"pay 1234 {card} ") and (got[2]["n_card"], got[2]["n_phone"]) == (1, 1)
    assert (got[3]["n_card"], got[3]["n_ssn"]) == (1, 1) and (got[12]["n_date"], got[12]["n_phone"]) == (1, 1)
    iban = got[6]["text"][:19]
    assert got[7]["text"] == iban.replace(" ", "") + " 12" and got[8]["text"] == f"{iban} CALL {iban}" and got[10]["text"].endswith(iban)


def test_phones_of_other_layouts(spark):
    texts = ["+15551234567", "5551234567", "555-123-4567", "+49 30 12345678", "+493012345678", "+49 (30) 12345678", f"+33 1 23 45 67 89 {CARD}", "1589284800", "+12 is no phone"]
    got = rewrite(spark, texts)
    digits = [re.sub(r"\D", "", r["text"]) for r in got]
    assert digits[0][1:] == digits[1] == digits[2] != "5551234567" and digits[3] == digits[4] == digits[5] != "493012345678"
    assert all(r["text"].startswith("+49") for r in got[3:6]) and [r["n_phone"] for r in got] == [1] * 7 + [0, 0]
    assert CARD not in got[6]["text"] and got[6]["n_card"] == 1
    assert [r["text"] for r in got[7:]] == texts[7:]


@pytest.mark.parametrize("text", ["7 " * 20_000, "4111 1111 1111 1112 " * 500])
def test_long_runs(spark, text):
    got = rewrite(spark, [text + "a.b@c.de"])[0]
    assert len(got["text"]) == len(text) + 8 and got["n_mail"] == 1
