"""Surrogates of names, numbers and addresses in odd forms."""

import re

import pytest

from plazaworks.llm import surrogates


def replaced(spark, values, key="k"):
    docs = spark.createDataFrame([(i, f"see {v}; end", "x", 1) for i, v in enumerate(values)], "doc_id long, text string, kind string, row int")
    rows = sorted(surrogates.replace_entities(docs, key).collect(), key=lambda r: r["doc_id"])
    return [r["text"][4:-5] for r in rows]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def mod97(number):
    plain = re.sub("[^0-9A-Z]", "", number)
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_names_are_replaced_whole(spark):
    values = ["Mr. John Smith-Jones", "Frau Dr. Muster", "Herr Prof. Dr. Karl Muster", "Mrs Jones", "Mr Smith", "Madame Anne-Marie Jones", "Dr. Muster"]
    got = replaced(spark, values)
    for v, g in zip(values, got, strict=True):
        assert not {w for w in re.findall(r"\w+", v) if w not in ("Mr", "Mrs", "Frau", "Herr", "Dr", "Prof", "Madame")} & set(re.findall(r"\w+", g)), (v, g)
        assert re.sub(r"\w+", "w", v) == re.sub(r"\w+", "w", g)  # titles, dots, hyphens and blanks stay
    surname = lambda i: re.findall(r"\w+", got[i])
    assert surname(0)[-2] == surname(4)[-1] and surname(0)[-1] == surname(3)[-1] == surname(5)[-1]
    assert surname(1)[-1] == surname(2)[-1] == surname(6)[-1]
    assert got[1].startswith("Frau Dr. ") and got[2].startswith("Herr Prof. Dr. ") and surname(5)[1] in surrogates.NAMES["f"]


def test_long_values_keep_their_length(spark):
    host = ".".join(["label" + "x" * 20] * 4)
    values = [f"someone@{host}.com", f"{'long' * 40}@{host}.org", "a1" * 200]
    for v, g in zip(values, replaced(spark, values), strict=True):
        assert len(v) == len(g) and re.sub("[a-z0-9]", "c", v) == re.sub("[a-z0-9]", "c", g) and v != g


def test_check_digits_stay_right(spark):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "4111 1111 1111 1112", "6011000990139424"]
    accounts = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE00 3704 0044 0532 0130 00"]
    got = replaced(spark, cards + accounts)
    assert [luhn(v) for v in cards] == [True, True, False, True]
    assert all(luhn(g) for v, g in zip(cards, got, strict=False) if luhn(v))
    assert all(mod97(g) == 1 and g[:2] == v[:2] for v, g in zip(accounts, got[4:], strict=True) if mod97(v) == 1)
    assert [re.sub("[0-9]", "9", v) for v in cards] == [re.sub("[0-9]", "9", g) for g in got[:4]]
    assert len(set(got)) == 7 and not set(got) & set(cards + accounts)


def test_private_addresses_stay_private(spark):
    values = ["10.1.2.3", "192.168.7.9", "172.20.1.1", "8.8.4.4", "127.0.0.1", "172.40.1.1"]
    got = replaced(spark, values)
    assert got[0].startswith("10.") and got[1].startswith("192.168.") and got[2].startswith("172.20.") and got[4].startswith("127.")
    assert all(g.count(".") == 3 and g != v for v, g in zip(values, got, strict=True)) and len(set(got)) == 6


def test_the_key_decides(spark):
    values = ["Mr John Smith", "a@example.org", "4111 1111 1111 1111"]
    assert replaced(spark, values, "one") == replaced(spark, values, "one") != replaced(spark, values, "two")
    with pytest.raises(TypeError):
        surrogates.replace_entities(spark.createDataFrame([], "doc_id long, text string"))


def test_repeated_rows_and_long_texts(spark):
    long = "word " * 30000 + "Mr John Smith " + "word " * 30000
    rows = [(1, long), (1, long), (1, "Mr Smith"), (None, "a@example.org"), (None, "a@example.org"), (2, None), (3, "")]
    got = surrogates.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    assert len(got) == len(rows) and sum(r["n_entities"] for r in got) == 5
    name = {re.search(r"Mr (?:\w+ )?(\w+)", r["text"]).group(1) for r in got if r["doc_id"] == 1}
    assert len({r["text"].split("Mr ")[1].split()[1] for r in got if r["doc_id"] == 1 and len(r["text"]) > 99} | {r["text"].split()[1] for r in got if r["text"] and r["text"].startswith("Mr")}) == 1
    assert "Smith" not in name and len({r["text"] for r in got if r["doc_id"] is None}) == 1
