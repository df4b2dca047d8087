from __future__ import annotations

import unicodedata

import pytest

from tidewright.functions import text as T

SAMPLE = "This is a (test) [sentence]́ with \n{aa} and ğ. "
ALL = set(SAMPLE) | {"å", "g", " "}
NONE = {"!": "!"}
MARKS = {"aa": "å", "ğ": "g"}
ACCENT = {"́": " "}


def clean(spark, value, **options):
    from pyspark.sql import functions as F

    return spark.createDataFrame([(value,)], "t string").select(T.clean_transcript(F.col("t"), **options)).first()[0]


@pytest.mark.parametrize(
    ("keep", "table", "lower", "expected"),
    [
        (ALL, NONE, True, "this is a (test) [sentence]́ with\n{aa} and ğ."),
        (ALL, NONE, False, "This is a (test) [sentence]́ with\n{aa} and ğ."),
        (None, NONE, True, "this is a (test) [sentence]́ with\n{aa} and ğ."),
        (ALL, MARKS, True, "this is a (test) [sentence]́ with\n{å} and g."),
        (ALL, ACCENT, True, "this is a (test) [sentence] with\n{aa} and ğ."),
        (ALL - set("()[]{}"), NONE, True, "this is a test sentence ́ with\naa and ğ."),
        (ALL - set("()[]{}"), MARKS, True, "this is a test sentence ́ with\nå and g."),
        (ALL - set("\n"), NONE, True, "this is a (test) [sentence]́ with {aa} and ğ."),
        (ALL - set("\n"), ACCENT, True, "this is a (test) [sentence] with {aa} and ğ."),
    ],
)
def test_clean(spark, keep, table, lower, expected):
    assert clean(spark, SAMPLE, keep=keep, replacements=table, lower_case=lower) == expected


def test_fillers_and_case(spark):
    assert clean(spark, "Øhm ja EH mmh hmm nej øhmagtig", replacements={}) == "ja nej øhmagtig"
    assert clean(spark, None) is None
    assert clean(spark, "") == ""


def test_default_table(spark):
    assert clean(spark, "5 kg á 10% — ö") == "5 kilo a 10 procent — ø"


def test_strip_is_pythons(spark):
    from pyspark.sql import functions as F

    values = [" x ", " x\x1f", "\x85x\x1c", "x", "", " \n\t"]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    got = rows.select(T.strip(F.col("t")).alias("s"), T.is_blank(F.col("t")).alias("b")).collect()
    assert [r.s for r in got] == [v.strip() for v in values]
    assert [r.b for r in got] == [not v.strip() for v in values]


def test_nfkc(spark):
    from pyspark.sql import functions as F

    values = ["ﬁ", "½", "µg", "plain", None, "é"]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in rows.select(T.nfkc(F.col("t"))).collect()] == [v and unicodedata.normalize("NFKC", v) for v in values]


def test_caption(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("<v Bob>a<00:01.000>b</v> &amp;  c",)], "t string")
    assert rows.select(T.clean_caption(F.col("t"))).first()[0] == "ab & c"
    odd = spark.createDataFrame([("a<>b",), ("a<00:75:10.000>b",), ("a<1:00:10.000>b",), ("x &lt;i&gt; y",), (None,)], "t string")
    assert [r[0] for r in odd.select(T.clean_caption(F.col("t"))).collect()] == ["a b", "ab", "a b", "x <i> y", None]


def test_replacements_are_those_one_after_the_other(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(5)
    for _ in range(20):
        table = {"".join(rng.choice("abcd") for _ in range(rng.choice((1, 1, 1, 2)))): "".join(rng.choice("abcde") for _ in range(rng.choice((0, 1, 1, 1, 2)))) for _ in range(6)}
        texts = ["".join(rng.choice("abcdef") for _ in range(12)) for _ in range(10)]
        want = []
        for t in texts:
            for a, b in table.items():
                t = t.replace(a, b)
            want.append(t)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r[0] for r in df.select(T.replace_all(F.col("t"), table)).collect()] == want


def test_urls_and_names(spark):
    from pyspark.sql import functions as F

    values = ["https://u:p@Host.org:8/a/b?x=1#y", "nothing", "ftp:///x", None]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    assert [r[0] for r in rows.select(T.sanitise_url(F.col("t"))).collect()] == ["https://Host.org:8/a/b", "<invalid URL>", "<invalid URL>", None]
    assert T.score_file_name("org/model.v1", "org/set::sub", with_lm=False) == "org--model-v1-no-lm.org--set-sub.csv"
    assert rows.limit(1).select(T.split_name(F.lit("org/My-Set"), F.lit("Sub"))).first()[0] == "val_my_set_sub"
    assert [r[0] for r in spark.createDataFrame([("a" * 40,), ("a" * 40 + "\n",), ("a" * 39,)], "t string").select(T.is_revision(F.col("t"))).collect()] == [True, False, False]
