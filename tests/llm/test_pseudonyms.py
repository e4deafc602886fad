"""Pseudonyms: bijections, formats, links, and text left alone."""

from llm_tables import docs, odd  # noqa: F401
import datetime
import re

import pytest

from sluice.llm import pseudonyms as P

KEY = b"0123456789abcdef"


def change(text):
    return P.pseudonymise(text, KEY)[0]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 1001])
def test_permutation(size):
    assert sorted(P.permute(v, size, KEY, "t") for v in range(size)) == list(range(size))


def test_keys_and_tweaks_differ():
    one = [P.permute(v, 1000, KEY, "a") for v in range(50)]
    assert one != [P.permute(v, 1000, KEY, "b") for v in range(50)]
    assert one != [P.permute(v, 1000, b"another key here", "a") for v in range(50)]


CASES = {
    "card": ("4111 1111 1111 1111", r"\d{4} \d{4} \d{4} \d{4}"),
    "iban": ("DE89 3704 0044 0532 0130 00", r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d"),
    "phone": ("+1 (743) 555-3824", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}"),
    "ssn": ("123-45-6789", r"\d{3}-\d\d-\d{4}"),
    "ip": ("70.23.22.57", r"\d{1,3}(\.\d{1,3}){3}"),
    "date": ("2021-03-25", r"\d{4}-\d\d-\d\d"),
    "email": ("Anna.B42@mail5.example.com", r"[A-Z][a-z]{3}\.[A-Z]\d\d@[a-z]{4}\d\.[a-z]{7}\.com"),
    "secret": ("24be64439e3e49cf46b2d7c90f3602a3d0b907ff", r"[0-9a-f]{40}"),
}


@pytest.mark.parametrize("kind", CASES)
def test_format_links_and_spans(kind):
    value, pattern = CASES[kind]
    lead = 'token = "' if kind == "secret" else "see "
    text = f"é {lead}{value}\" and {lead}{value}."
    new, spans = P.pseudonymise(text, KEY)
    assert [k for _, _, k in spans] == [kind] * 2 and value not in new
    first, second = (new[a:b] for a, b, _ in spans)
    assert first == second and re.fullmatch(pattern, first), first
    rest = new.replace(first, value)
    assert rest == text


def test_checks_hold_after_the_change():
    for n in range(200):
        body = f"4{n:014d}"
        card = body + str(P.luhn_digit(body))
        new = change(f"pay {card} now")[4:20]
        assert new != card and P.luhn_digit(new[:-1]) == int(new[-1])
    new = change("DE89370400440532013000")
    assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1


def test_one_to_one_per_format():
    cards = [b + str(P.luhn_digit(b)) for b in (f"5{n:014d}" for n in range(300))]
    assert len({change(c) for c in cards}) == 300
    assert len({change(f"10.0.{n // 256}.{n % 256}") for n in range(600)}) == 600


def test_one_day_in_several_formats():
    iso, us, eu = (change(d) for d in ("2021-03-25", "03/25/2021", "2021.03.25"))
    assert datetime.date.fromisoformat(iso) == datetime.date.fromisoformat(eu.replace(".", "-"))
    assert us == f"{iso[5:7]}/{iso[8:]}/{iso[:4]}"
    day_first = change("25/03/2021")
    assert int(day_first[:2]) > 12 and 1 <= int(day_first[3:5]) <= 12


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1112", "1234567890123", "999.1.1.1", "1.2.3", "2021-02-30", "2021-13-01", "000-12-3456",
    "call me at 5", "version 3.14.15", "a@b", "price 1,234.56 + 7", "no digits at all, nor secrets: tokens are words",
    "token = abcdefghijklmno", "DE00 3704 0044 0532 0130 00", "0000000000000000", ""])
def test_what_is_no_valid_value_stays(text):
    assert P.pseudonymise(text, KEY) == (text, [])


@pytest.mark.parametrize("text", ["+1 (043) 555-3824", "+1 (132) 055-1352"])
def test_numbers_with_low_area_codes_change(text):
    new, spans = P.pseudonymise(text, KEY)
    assert new != text and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)
    assert [k for _, _, k in spans] == ["phone"]


def test_values_next_to_each_other():
    new, spans = P.pseudonymise("4111111111111111 5500005555555559 70.23.22.57, 123-45-6789 x+1 (743) 555-3824###", KEY)
    assert [k for _, _, k in spans] == ["card", "card", "ip", "ssn", "phone"] and new.endswith("###")
    new, spans = P.pseudonymise("+1 (988) 555-2485 4111111111111111", KEY)
    assert [k for _, _, k in spans] == ["phone", "card"]


def test_table(spark, odd, docs):
    out = P.with_pseudonyms(odd, KEY)
    rows = out.collect()
    assert out.columns.count("pii") == 1 and len(rows) == 10
    assert {r["doc_id"]: r["text"] for r in rows} == {r["doc_id"]: r["text"] for r in odd.collect()}
    assert P.with_pseudonyms(docs([]), KEY).collect() == []
    got = P.with_pseudonyms(docs([(1, "a 70.23.22.57 b")]), KEY).first()
    assert [(s["start"], s["kind"]) for s in got["pii"]] == [(2, "ip")]
    with pytest.raises(ValueError):
        P.with_pseudonyms(odd, b"short")


def test_every_number_with_a_country_code():
    for value in ("+1 (043) 555-3824", "+1 (743) 055-3824", "+10000000000", "+44 20 7946 0958", "+49 (0)30 1234567",
                  "+353-1-234-5678", "+4915112345678", "+33 1 23 45 67 89"):
        new, spans = P.pseudonymise(f"call {value}, or {value}.", KEY)
        first, second = (new[a:b] for a, b, _ in spans)
        assert first == second != value and re.sub("[0-9]", "9", first) == re.sub("[0-9]", "9", value)
        assert new == f"call {first}, or {first}."
    assert change("+44 20 7946 0958 12 May") == change("+44 20 7946 0958") + " 12 May"
    assert len({change(f"+1 (0{n:02d}) 155-{n:04d}") for n in range(100)}) == 100
    assert "(0)" in change("+49 (0)30 1234567")
    new, spans = P.pseudonymise("+44 20 7946 0958 4111 1111 1111 1111", KEY)
    assert [k for _, _, k in spans] == ["phone", "card"]
    assert change("a+2021 b +50 c") == "a+2021 b +50 c"


IBAN, CARD = "DE89 3704 0044 0532 0130 00", "4111 1111 1111 1111"


@pytest.mark.parametrize("value, text", [(v, t.format(v)) for v, t in [
    (IBAN, "{} BIC COBADEFF"), (IBAN, "{} 12 May"), (IBAN, "AB12 {}"), (IBAN, "IBAN {}, x"), (IBAN.replace(" ", ""), "{} IBAN"),
    (CARD, "order 12 {}"), (CARD, "14-03-2024 {}"), (CARD, "{} 14-03-2024"), (CARD, "12 34 {} 123"),
    (CARD.replace(" ", ""), "qty 3 {}"), ("3714 496353 98431", "7 {} 12")]])
def test_values_between_other_groups(value, text):
    new, spans = P.pseudonymise(text, KEY)
    kind = "iban" if value[0] == "D" else "card"
    start = text.index(value)
    assert (start, start + len(value), kind) in spans
    assert value not in new and new[start:start + len(value)] == change(value)


@pytest.mark.parametrize("text, value", [
    ("token = {} end", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"),
    ("api_key: {}.", "xy1" * 1000), ("secret='{}'", "0f" * 150), ("AWS_SECRET_ACCESS_KEY={}\n", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY1=")])
def test_whole_secrets(text, value):
    new, spans = P.pseudonymise(text.format(value), KEY)
    start = text.index("{}")
    assert spans == [(start, start + len(value), "secret")]
    got = new[start:start + len(value)]
    shape = lambda v: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", v)))
    assert new == text.format(got) and (set(value) == set("0f") or shape(got) == shape(value))
    parts = lambda v: [v[i:i + 12] for i in range(0, len(v) - 11, 12)]
    assert all(a != b for a, b in zip(parts(got), parts(value)))


def test_blocks_of_a_secret_are_permuted_one_to_one(monkeypatch):
    monkeypatch.setattr(P, "SECRET_BLOCK", 3)
    assert len({P._secret(f"{n:04d}", KEY) for n in range(10000)}) == 10000


def test_emails_that_differ_in_case_link():
    one, *others = (change(f"mail {v} now") for v in ("ann.b4@mail.com", "Ann.B4@mail.com", "ANN.B4@MAIL.COM", "ann.b4@mail.COM"))
    assert one != "mail ann.b4@mail.com now" and {o.lower() for o in others} == {one} and len({one, *others}) == 4
    assert len({change(f"{a}{b}@x.org") for a in "abcXYZ" for b in range(10)}) == 60


@pytest.mark.parametrize("lead, value, tail", [
    ("password: ", "hunter2", ""), ("password = ", "correcthorsebattery", "\n"), ("token: ", "ghp_aBcDeFgHiJkLmNoPqRs", "."),
    ("password=", "Tr0ub4dor&3", " x"), ("Authorization: Bearer ", "abc.DEF-123_x", ""), ("passwd='", "a,b;c", "' y"),
    ("?password=", "s3cret", "&user=bob"), ("api_key=", "Qx7", ""), ("secret: (", "z9Z9", ")")])
def test_named_secrets_of_any_length(lead, value, tail):
    new, spans = P.pseudonymise(f"see {lead}{value}{tail}", KEY)
    start = 4 + len(lead)
    assert spans == [(start, start + len(value), "secret")]
    got = new[start:start + len(value)]
    assert got != value and new == f"see {lead}{got}{tail}"


@pytest.mark.parametrize("text", ["max tokens = 4096", "The secret: always be kind", "api key: Required", "bearer bonds of 1990",
                                  "password:", "token = <redacted>", "ab12-cdef-ghij-klmn", "1.234.567.890.123.456"])
def test_prose_and_counts_stay(text):
    assert P.pseudonymise(text, KEY) == (text, [])


@pytest.mark.parametrize("value", ["de89370400440532013000", "DE89-3704-0044-0532-0130-00", "de89 3704 0044 0532 0130 00",
                                   "4111.1111.1111.1111"])
def test_other_spellings_link(value):
    plain = lambda v: re.sub("[ .-]", "", v).upper()
    new, spans = P.pseudonymise(f"pay {value} now", KEY)
    assert spans == [(4, 4 + len(value), "iban" if value[0] in "dD" else "card")]
    got = new[4:4 + len(value)]
    assert re.sub("[0-9]", "9", got) == re.sub("[0-9]", "9", value) and plain(got) == change(plain(value)) != plain(value)


def test_values_of_the_documents(spark):
    """A plain reading of sf0.01: what looks like a number or address there is
    replaced by one other value of its look everywhere, and nothing else changes."""
    looks = {"email": r"[a-z0-9.]+@[a-z0-9.]+[.][a-z]+", "phone": r"[+]1 [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}",
             "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ip": r"[0-9]{1,3}(?:[.][0-9]{1,3}){3}"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = P.with_pseudonyms(docs.withColumn("old", docs.text), KEY).collect()
    assert len(rows) == docs.count()
    links = {}
    for row in rows:
        old, new, at, shift = row["old"], row["text"], 0, 0
        if old is None or not row["pii"]:
            assert old == new
        spots = []
        for kind, look in looks.items():
            spots += [(m.start(), m[0], kind) for m in re.finditer(look, old or "")]
        changed = sum(s["end"] - s["start"] for s in row["pii"])
        kept = list(new or "")
        for s in row["pii"]:
            kept[s["start"]:s["end"]] = [""] * (s["end"] - s["start"])
        assert len("".join(kept)) == len(new or "") - changed
        by_kind = {k: [new[s["start"]:s["end"]] for s in row["pii"] if s["kind"] == k] for k in looks}
        for kind in ("email", "phone"):  # these never hide in another kind's value
            values = [v for _, v, k in spots if k == kind]
            assert len(by_kind[kind]) >= len(values)
            for value in values:
                links.setdefault((kind, value), []).append(set(by_kind[kind]))
    assert len(links) > 20
    for (kind, value), choices in links.items():
        assert set.intersection(*choices) - {value}, (kind, value)
