from __future__ import annotations

import pytest

from tidewright.functions.numerals import numeral_to_words, numerals_to_words, spell_out

# Numerals and their words.
WORDS = {
    "0": "nul", "1": "en", "2": "to", "9": "ni", "10": "ti", "13": "tretten", "19": "nitten", "20": "tyve", "21": "enogtyve", "29": "niogtyve", "30": "tredive", "50": "halvtreds", "90": "halvfems",
    "100": "hundrede", "101": "et hundrede og en", "110": "et hundrede og ti", "121": "et hundrede og enogtyve", "200": "to hundrede", "999": "ni hundrede og nioghalvfems",
    "1000": "tusind", "1001": "et tusind og en", "1010": "et tusind og ti", "1100": "et tusind et hundrede", "1121": "et tusind et hundrede og enogtyve", "2000": "to tusind", "10.000": "ti tusind",
    "100.000": "et hundrede tusind", "100000": "et hundrede tusind", "999999": "ni hundrede og nioghalvfems tusind ni hundrede og nioghalvfems",
    "1.000.000": "en million", "1.000000": "1.000000", "1.0.00000": "1.0.00000", "1.000.001": "en million og en", "10.000.000": "ti millioner", "100.000.000": "et hundrede millioner",
    "999.999.999": "ni hundrede og nioghalvfems millioner ni hundrede og nioghalvfems tusind ni hundrede og nioghalvfems",
    "10,123": "ti komma et to tre", "10.102,92": "ti tusind et hundrede og to komma ni to",
}


@pytest.mark.parametrize(("numeral", "words"), WORDS.items())
def test_words(numeral, words):
    assert numeral_to_words(numeral) == words


def test_not_numerals():
    for x in ("007", "x1", "", "1,", "-3"):
        assert numeral_to_words(x) == x
    assert numeral_to_words("1.234.567.890") == "1234567890"


def test_in_text(spark):
    assert spell_out("kl. 21 og 100") == "kl. enogtyve og hundrede"
    rows = spark.createDataFrame([("den 2. maj",), ("ingen",), (None,), ("",)], "t string")
    assert [r[0] for r in rows.select(numerals_to_words(rows.t)).collect()] == ["den to. maj", "ingen", None, ""]
