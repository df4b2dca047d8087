"""Danish numerals as words: whole numbers below 10^9 and decimals, by arithmetic."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The accepted shape and the Danish number words.
NUMERAL = r"\b(0|[1-9]\d{0,2}(?:(?:\.\d{3})*|\d*)(?:,\d+)?)\b"
UNITS = "nul en to tre fire fem seks syv otte ni ti elleve tolv tretten fjorten femten seksten sytten atten nitten".split()
TENS = {2: "tyve", 3: "tredive", 4: "fyrre", 5: "halvtreds", 6: "tres", 7: "halvfjerds", 8: "firs", 9: "halvfems"}

_SHAPE = re.compile(NUMERAL)


def _below_hundred(n: int) -> str:
    if n < 20:
        return UNITS[n]
    ten, unit = divmod(n, 10)
    return f"{UNITS[unit]}og{TENS[ten]}" if unit else TENS[ten]


def _below_thousand(n: int) -> str:
    hundreds, rest = divmod(n, 100)
    if not hundreds:
        return _below_hundred(rest)
    head = f"{'et' if hundreds == 1 else UNITS[hundreds]} hundrede"
    return f"{head} og {_below_hundred(rest)}" if rest else head


def _counted(n: int) -> str:
    """The words of 1 <= n < 10^9; a group joins the next by "og" only if that has two digits at most."""
    millions, rest = divmod(n, 1_000_000)
    thousands, ones = divmod(rest, 1000)
    out = []
    if millions:
        out.append("en million" if millions == 1 else f"{_below_thousand(millions)} millioner")
    if thousands:
        words = "et" if thousands == 1 else _below_thousand(thousands)
        out.append(f"{words} tusind")
    if ones:
        out.append(f"og {_below_hundred(ones)}" if out and ones < 100 else _below_thousand(ones))
    return " ".join(out)


def numeral_to_words(numeral: str) -> str:
    """The words of a numeral; other strings are returned as they are.

    Points group thousands and a comma starts the decimals, which are read digit by
    digit. 100 and 1000 alone lose their "et". Ten digits or more are returned
    without points.
    """
    if _SHAPE.fullmatch(numeral) is None:
        return numeral
    whole, _, decimals = numeral.replace(".", "").partition(",")
    if decimals:
        digits = " ".join("et" if d == "1" else UNITS[int(d)] for d in decimals)
        return f"{numeral_to_words(whole)} komma {digits}"
    if len(whole) >= 10:
        return whole
    n = int(whole)
    if n == 0:
        return UNITS[0]
    return {100: "hundrede", 1000: "tusind"}.get(n) or _counted(n)


def spell_out(text: str) -> str:
    """text with every numeral in it as words."""
    return _SHAPE.sub(lambda m: numeral_to_words(m[0]), text)


@F.pandas_udf(StringType())
def _spelled(texts: pd.Series) -> pd.Series:
    return texts.map(spell_out, na_action="ignore")


def numerals_to_words(text: Column) -> Column:
    """Numerals in text as words; for texts without a digit Python sees a null."""
    return F.coalesce(_spelled(F.when(text.rlike(r"\d"), text)), text)
