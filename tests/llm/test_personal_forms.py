"""Personal data in forms written down by hand: none of them comes from the rules that the field is fitted on."""

import pytest

from reachmill.llm import personal_data

FORMS = {
    "email": ["jane.roe AT mail DOT example DOT com", "anna_k(at)web.de", "info [at] firma [dot] de", "max.muster @ gmx.net", "bob at example dot org", "sales(at)shop(dot)co(dot)uk", "jo-ann@ mail.example.fr", "k.lee {at} uni-bonn {dot} de", "p_smith[at]acme.io", "marie AT orange DOT fr", "service <at> bank.com", "lena.b (at) posteo.de", "t.ho@mail[.]ru", "carl at mail.de", "a.b-c @work.net"],
    "ip": ["192.168.1 .77", "10 . 0 . 0 . 1", "172[.]16[.]254[.]1", "8.8. 8.8", "203(.)0(.)113(.)9", "198.51.100[.]7", "127 .0.0.1", "10.1[.]2.3", "192. 0. 2. 44", "255 . 255 . 255 . 0", "1[.]1.1[.]1"],
    "card": ["4111/1111/1111/1111", "5500.0000.0000.0004", "4012  8888  8888  1881", "4242 - 4242 - 4242 - 4242", "5105_1051_0510_5100", "4000, 0566, 5566, 5556", "6011/1111/1111/1117", "5555.5555.5555.4444", "4111 / 1111 / 1111 / 1111", "3530_1113_3330_0000"],
    "phone": ["06 12 34 56 78", "212.555.0199", "0171/1234567", "020 7946 0958", "089-12345678", "(415) 555-2671", "01.42.68.53.00", "0049 30 901820", "1-800-555-0123", "07700 900123", "030/1234567", "(089) 636-48018", "02-2345-6789", "0033 1 42 68 53 00", "06-12-34-56-78", "0151 23456789", "(0171) 5551234", "617-555-0143", "05 61 33 22 11", "0221 / 4710", "0800 123 4567"],
}
CLEAN = [
    "2024-05-06 10:11:12", "21-19, 18-21, 21-15", "06.05.2024 10:30", "10:11:12", "1 234 567,89", "12.345.678", "12,345,678", "1998, 1999, 2000, 2001", "pages 123-145", "ISBN 978-3-16-148410-0", "48.8566, 2.3522", "3.14159265", "version 10.4.21", "look at the dot over the i", "we met at noon dot", "at 12 dot 30", "75001 Paris", "room 12-345", "1914-1918", "2:1, 3:2, 0:0", "6-4 7-5 6-3", "100 000 000", "0.0001234", "12/05/2023", "2023/12/05 08:00", "24.12.2022, 18:00", "4111 1111 1111 1112", "1234-5678-9012-3456", "256.300.400.500", "5, 10, 15, 20, 25", "chapter 3.2.1", "0,5 0,25 0,125", "10-12 2-4 6-8", "A4 210 x 297", "1.000.000,00", "2024-W19-1", "May 6, 2024 10:11", "look at mail", "00:00:00,000", "1e10 2e20",
]
AROUND = [("call ", ", please"), ("Kontakt: ", ""), ("(voir ", ") et"), ("on ", ", then")]


@pytest.fixture(scope="module")
def field(spark):
    return personal_data.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))


@pytest.mark.parametrize("kind", personal_data.KINDS)
def test_forms_that_the_patterns_miss(field, kind):
    found = 0
    for form in FORMS[kind]:
        for before, after in AROUND:
            base, spans = personal_data.find_spans(before + form + after, field)
            whole = (kind, len(before), len(before) + len(form))
            assert whole not in base
            found += whole in spans
    assert found >= 0.9 * len(FORMS[kind]) * len(AROUND)


@pytest.mark.parametrize("text", CLEAN)
def test_what_is_left_alone(field, text):
    for before, after in [*AROUND, ("", "")]:
        base, spans = personal_data.find_spans(before + text + after, field)
        assert spans == base


def test_longer_spans_need_more_tokens(field):
    text = "write to " + ".".join("abcdefghijkl") + " @ " + "a.b.c.d.e.f.org now"
    whole = ("email", 9, len(text) - 4)
    assert whole not in personal_data.find_spans(text, field)[1]
    wide = personal_data.Field(max_tokens=64)
    wide.w = field.w
    assert whole in personal_data.find_spans(text, wide)[1]
