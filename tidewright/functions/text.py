"""Transcript cleaning, caption markup and small string rules, as Columns.

The order of the cleaning steps is part of their meaning: numerals, case, fillers,
compatibility normalisation, replacements, characters to keep, runs of spaces,
lines. Only NFKC (no built-in exists) and HTML entities go through Python; a text
that can't change is sent there as null.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .numerals import numerals_to_words

# Replacements in order; each sees the result of those before it.
REPLACEMENTS = {
    "aa": "å", "ğ": "g", "ñ": "n", "ń": "n", "è": "e", "kg": " kilo ", "μg": " mikrogram ", "hhv": "henholdsvis", "fx": "for eksempel", "f.eks.": "for eksempel",
    "-": " minus ", "+": " plus ", "μ": " mikro ", "§": " paragraf ", "%": " procent ", "‰": " promille ", "ú": "u", "ş": "s", "ê": "e", "ã": "a", "ë": "e", "ć": "c",
    "ä": "æ", "í": "i", "š": "s", "î": "i", "ě": "e", "ð": "d", "á": "a", "ó": "o", "þ": "th", "ı": "i", "ö": "ø", "ç": "c", "ș": "s", "́": " ", "​": " ",
}
# Fixed value: hesitation sounds.
FILLERS = r"(eh+m*|øh+m*|h+m+|m+h+)"
# A time within a caption, any other markup of a caption.
INLINE_TIME = r"<(?:(?:\d{2}:)?\d{2}:\d{2}[.,]\d{3})>"
MARKUP = r"<[^>]*>"
# Fixed value: white space as Python strips it.
BLANK = r"[\s\x1c-\x1f\x85]"


def strip(c: Column) -> Column:
    """Without white space at both ends, in the sense of Unicode and of Python."""
    return F.regexp_replace(c, rf"(?U)^{BLANK}+|{BLANK}+\z", "")


def is_blank(c: Column) -> Column:
    """Whether nothing but white space is there; true for null."""
    return F.coalesce(c.rlike(rf"(?U)^{BLANK}*\z"), F.lit(True))


def remove_fillers(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?iuU)\b{FILLERS}\b", "")


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Compatibility normalisation; for texts of ASCII alone Python sees a null."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def replace_all(c: Column, table: Mapping[str, str]) -> Column:
    """The replacements one after the other; neighbours of one character each go in one pass, where none makes what a later one looks for."""
    run: dict[str, str] = {}
    for a, b in [*table.items(), ("", "")]:
        if len(a) == len(b) == 1 and a not in run and a not in run.values():
            run[a] = b
            continue
        if run:
            c, run = F.translate(c, "".join(run), "".join(run.values())), {}
        if len(a) == len(b) == 1:
            run[a] = b
        elif a:
            c = F.replace(c, F.lit(a), F.lit(b))
    return c


def keep_characters(c: Column, keep: Iterable[str]) -> Column:
    """Strip; then a space for each character that is not kept, in either case. Space and | are always kept."""
    allowed = "".join(f"\\x{{{ord(x):x}}}" for x in sorted({*keep, " ", "|"}))
    return F.regexp_replace(strip(c), f"(?iu)[^{allowed}]", " ")


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, " +", " ")


def strip_lines(c: Column) -> Column:
    """Each line stripped; newlines at both ends go."""
    lines = F.array_join(F.transform(F.split(c, "\n"), strip), "\n")
    return F.regexp_replace(lines, r"^\n+|\n+\z", "")


def clean_transcript(c: Column, lower_case: bool = True, keep: Iterable[str] | None = None, numerals: bool = False, replacements: Mapping[str, str] = REPLACEMENTS) -> Column:
    """The whole chain. Null stays null."""
    if numerals:
        c = numerals_to_words(c)
    if lower_case:
        c = F.lower(c)
    c = replace_all(nfkc(remove_fillers(c)), replacements)
    if keep is not None:
        c = keep_characters(c, keep)
    return strip_lines(collapse_spaces(c))


@F.pandas_udf(StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def clean_caption(c: Column) -> Column:
    """Caption text: inline times go, other tags become a space, entities characters, white space one space."""
    c = F.regexp_replace(F.regexp_replace(c, INLINE_TIME, ""), MARKUP, " ")
    c = F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)
    return strip(F.regexp_replace(c, rf"(?U){BLANK}+", " "))


def normalise_for_scoring(c: Column) -> Column:
    return strip(F.lower(c))


def sanitise_url(c: Column) -> Column:
    """Scheme, host, port and path of a URL; no user, query or fragment. "<invalid URL>" if it has no scheme or host."""
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*\z", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/]*)", 1), r"^.*@", "")
    path = F.regexp_extract(rest, r"^[^/]*(.*)\z", 1)
    return F.when(c.isNull(), None).when((scheme == "") | (host == ""), "<invalid URL>").otherwise(F.concat(scheme, F.lit("://"), host, path))


def is_revision(c: Column) -> Column:
    """Whether it is a full commit: 40 hexadecimals."""
    return c.rlike(r"^[0-9a-fA-F]{40}\z")


def split_name(dataset_id: Column, subset: Column) -> Column:
    """val_<last part of the id>[_<subset>], in lower case, with underscores."""
    tail = F.substring_index(dataset_id, "/", -1)
    return F.replace(F.lower(F.concat_ws("_", F.lit("val"), tail, subset)), F.lit("-"), F.lit("_"))


def score_file_name(model_id: str, dataset_id: str, with_lm: bool = True) -> str:
    """<model>[-no-lm].<dataset>.csv, safe as a file name."""
    safe = [re.sub(r"::|\.", "-", x.replace("/", "--")) for x in (model_id, dataset_id)]
    return f"{safe[0]}{'' if with_lm else '-no-lm'}.{safe[1]}.csv"
