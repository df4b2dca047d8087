"""Language identification, quality, mixing, personal data."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewright.llm import langid, pii, quality
from tidewright.llm.mixing import mixed, pareto_mix

SF = "/root/testdata/sf0.01"


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right / n > 0.98


def test_language_cases(spark):
    docs = [(i, "the cat and the dog", "en", 1) for i in range(8)] + [(i, "der Hund und die Katze", "de", 1) for i in range(8, 16)]
    docs += [(20, None, "en", 1), (21, "", None, 1), (22, "123 !!", "de", 1), (None, "the dog", "en", 1), (23, "und die Katze " * 30000, None, 1), (23, "the", None, 1)]
    out = langid.language_id(spark.createDataFrame(docs, "doc_id long, text string, lang string, score int")).collect()
    assert len(out) == len(docs)
    got = {(r.doc_id, r.lang_pred) for r in out}
    assert {(20, "und"), (21, "und"), (22, "und"), (None, "en"), (23, "de"), (23, "en")} <= got
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    none = langid.language_id(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.language_id(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []


def test_ngram_counts_are_exact():
    import pyarrow as pa

    texts = ["ab c", "", None, "Éa", "1a2"]
    buckets, ends, letters = langid.ngrams(pa.array(texts))
    assert letters.tolist() == [3, 0, 0, 2, 1]
    # "ab c": letters a, b, c; ab, "b ", " c"; "ab ", "b c". "1a2" is " a "
    assert [[e[i + 1] - e[i] for e in ends] for i in range(5)] == [[3, 3, 2], [0, 0, 0], [0, 0, 0], [2, 1, 0], [1, 2, 1]]


def test_quality_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    rows = out.select("quality", "score", "predicted").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad) > 0.97
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "!!! ### !!!"), (3, None), (4, ""), (None, "good"), (5, "x" * 300000), (5, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (99, 1), (4, None)], "doc_id long, quality int")
    out = quality.quality(docs, labels).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out)
    nothing = quality.quality(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.quality(docs.limit(0), labels).collect() == []
    kept = quality.good_documents(docs.withColumn("score", F.lit("clash")), labels)
    assert kept.columns == ["doc_id", "text", "score"]


@pytest.mark.parametrize("weighted", [False, True])
def test_mixing(spark, weighted):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randint(1, 400)), rng.choice(["b", "a", None, "c", "é"]), float(rng.randint(1, 9))) for i in range(600)]
    rows += [(1000, None, "a", None), (1001, "", "zero", 1.0), (1002, " x ", "tiny", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    out = pareto_mix(df, weight="w" if weighted else None).collect()
    assert out and sorted(map(tuple, out), key=repr) == sorted(map(tuple, pareto_mix(df.repartition(7), weight="w" if weighted else None).collect()), key=repr)
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    total = {}
    for i, _, s, _ in rows:
        total[s] = total.get(s, 0) + size[i]
    names = sorted([s for s in total if s is not None]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(total.values()))
    while True:
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > 3 * total[s]]
        if not over:
            target |= {s: rest * weight[s] / w for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            free.remove(s)
            rest -= target[s]
    taken = {}
    for r in out:
        assert r.size == size[r.doc_id] and r.source_size == total[r.source] and r.target == pytest.approx(target[r.source]) and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= max(3, 0.002 * target[s]) for s in ("a", "b", "c", None, "é"))
    if weighted:
        # of sources that are not taken whole, the copies of a document grow with its weight
        by = {i: w for i, *_, w in rows}
        some = [r for r in out if r.source in ("a", None) and r.size and r.target < 2 * r.source_size]
        light, heavy = ([r.copies for r in some if lo <= (by[r.doc_id] or 1) <= hi] for lo, hi in ((1, 3), (7, 9)))
        assert not some or sum(heavy) / len(heavy) > 1.5 * sum(light) / len(light)


def test_mixing_of_null_and_repeated_rows(spark, tmp_path):
    """The query against its SQL, where ids are null or repeated and a third of all rows are copies of one; targets are met all the same."""
    import duckdb

    from tidewright.llm import queries

    rng = random.Random(9)
    rows = [(None, " ".join(["w"] * 100), "a") for _ in range(300)] + [(None, " ".join(["w"] * rng.randint(1, 200)), "b") for _ in range(150)]
    rows += [(7, " ".join(["v"] * 50), "c")] * 120 + [(rng.randint(1, 40), " ".join(["z"] * rng.randint(0, 300)), rng.choice("abc")) for _ in range(200)]
    rows += [(1, None, "a"), (1, "w " * 200_000, "d"), (2, "", None), (3, "x", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op5_pareto_mixing(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.OP5_SQL)
    assert sorted(map(repr, map(tuple, out.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
    per = pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()
    assert all(abs(r.t - r.target) <= max(100, 0.01 * r.target) for r in per if r.source in ("a", "b", "c"))


def test_mixed_rows_keep_their_columns(spark):
    names = ["copies", "id_", "words_", "n_", "mix_k", "mixed_w", "a.b", "Size"]
    rows = [(i, "w " * (i % 9 + 1), "ab"[i % 2], *range(8)) for i in range(60)] + [(None, "w w", "a", *range(8))] * 20
    df = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, source string", *[f"`{n}` int" for n in names]]))
    out = mixed(df)
    assert out.columns == df.columns
    taken = pareto_mix(df.select("doc_id", "text", "source"))
    assert out.count() == taken.agg(F.sum("copies")).first()[0] and {tuple(r[3:]) for r in out.collect()} == {tuple(range(8))}
    assert mixed(df.limit(0)).collect() == []


def test_mixing_of_nothing(spark):
    assert pareto_mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    blank = pareto_mix(spark.createDataFrame([(1, None, None), (None, "", "a")], "doc_id long, text string, source string")).collect()
    assert [r.taken for r in blank] == [0, 0]


def replaced(spark, *texts):
    """Columns that a careless implementation would use itself are in the way."""
    names = ["key_", "new_", "pii_key", "n_entities", "a.b", "KEY"]
    schema = ", ".join(["doc_id long, text string", *[f"`{n}` string" for n in names]])
    df = pii.replace_pii(spark.createDataFrame([(i, t, *names) for i, t in enumerate(texts)], schema), "k")
    assert df.columns == ["doc_id", "text", *names, "n_entities_"]
    out = df.orderBy("doc_id").collect()
    assert all(list(r[2:-1]) == names for r in out)
    return [r.text for r in out], [r.n_entities_ for r in out]


def test_pii_is_replaced_in_format(spark):
    texts, n = replaced(spark, "to hein.19@mail5.example.com, +1 (743) 555-3824.", "HEIN.19@MAIL5.EXAMPLE.COM or +1-743-555-3824", "4111 1111 1111 1111 and 4111111111111111", "at 10.20.30.40!!", None, "", "clean 2020 v3.0 1,234")
    assert n == [2, 2, 2, 1, 0, 0, 0] and texts[4:] == [None, "", "clean 2020 v3.0 1,234"]
    a = re.fullmatch(r"to (\S+@\S+\.com), (\+1 \(\d{3}\) \d{3}-\d{4})\.", texts[0])
    b = re.fullmatch(r"([A-Z.0-9]+@\S+) or (\+1-\d{3}-\d{3}-\d{4})", texts[1])
    assert a[1].upper() == b[1] and re.sub(r"\D", "", a[2]) == re.sub(r"\D", "", b[2])
    assert "hein" not in texts[0] and "743" not in a[2]
    card = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) and (\d{16})", texts[2])
    digits = [int(c) for c in card[2]]
    assert card[1].replace(" ", "") == card[2] != "4111111111111111" and sum(sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(digits)) % 10 == 0
    assert re.fullmatch(r"at (\d{1,3}\.){3}\d{1,3}!!", texts[3]) and "10.20.30.40" not in texts[3]


def test_names_keep_gender_script_and_coreference(spark):
    texts, _ = replaced(spark, "Mr. John Smith met Mrs. Anna Smith.", "Dr. Smith spoke.", "Госпожа Анна Петрова")
    a = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+)\.", texts[0])
    assert a[2] == a[4] and texts[1] == f"Dr. {a[2]} spoke." and a[1].endswith(tuple(pii.ENDINGS["latin", "m"])) and a[3].endswith(tuple(pii.ENDINGS["latin", "f"]))
    assert re.fullmatch(r"Госпожа [А-Я][а-я]+ [А-Я][а-я]+", texts[2]) and "Петрова" not in texts[2]


def test_a_person_is_one_identity(spark):
    texts, n = replaced(spark, "Dr. Maria Lopez and Mrs. Maria Lopez", "Mr. John Smith came. Smith said so, and John's friend Smithson, too. smith", "A Smith elsewhere")
    a = re.fullmatch(r"Dr\. (\w+) (\w+) and Mrs\. (\w+) (\w+)", texts[0])
    assert a[1] == a[3] and a[2] == a[4] and a[1].endswith(tuple(pii.ENDINGS["latin", "f"]))
    b = re.fullmatch(r"Mr\. (\w+) (\w+) came\. (\w+) said so, and (\w+)'s friend Smithson, too\. smith", texts[1])
    assert b[2] == b[3] != "Smith" and n == [2, 3, 0] and texts[2] == "A Smith elsewhere" and b[4] == b[1] != "John"
    assert replaced(spark, "Mr. Smith's and Mr. O'Brien-Jones’s")[0][0].endswith("’s") and "'s and" in replaced(spark, "Mr. Smith's and x")[0][0]
    later, n = replaced(spark, "Mr. John Smith came. John left. Smith, Ann-Smith")
    c = re.fullmatch(r"Mr\. (\w+) (\w+) came\. (\w+) left\. (\w+), Ann-Smith", later[0])
    assert (c[1], c[2]) == (c[3], c[4]) and n == [3]


def test_ranges_countries_and_domains_stay(spark):
    texts, _ = replaced(spark, "192.168.1.1 10.1.2.3 172.20.0.1 127.0.0.1 8.8.8.8", "x@y.de and a@b.co.uk", "+49 30 1234567, +358 40 123 4567, +1 212 555 0101")
    assert re.fullmatch(r"192\.168\.\d+\.\d+ 10\.\d+\.\d+\.\d+ 172\.(1[6-9]|2\d|3[01])\.\d+\.\d+ 127\.\d+\.\d+\.\d+ \d+\.\d+\.\d+\.\d+", texts[0])
    assert int(texts[0].split()[-1].split(".")[0]) in pii.PUBLIC
    assert re.fullmatch(r"\w+@\w+\.example\.de and \w+@\w+\.example\.co\.uk", texts[1])
    assert re.fullmatch(r"\+49 \d\d \d{7}, \+358 \d\d \d{3} \d{4}, \+1 \d{3} \d{3} \d{4}", texts[2]) and "1234567" not in texts[2]


def test_crowded_forms_grow_and_stay_distinct(spark):
    """More names and secrets than the first forms hold at the least draw: all draws end, none is shared, none is a real one."""
    real = [f"password={i:06d}" for i in range(0, 3000)]
    texts, _ = replaced(spark, *real, *[f"192.168.{i // 250}.{i % 250}" for i in range(2500)])
    assert len(set(texts)) == len(texts) and not set(texts) & set(real)


def test_detection_against_brute_force(spark):
    """Every match of the pattern, found by another engine, is replaced, and nothing else is; the tokens' map is one to one."""
    import regex

    pattern = regex.compile(pii.PATTERN.replace("\\p{IsCyrillic}", "\\p{Cyrillic}"))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6, None), (10**6, ""), (None, "x " * 300_000 + "call +1 212 555 0101"), (None, "a@b.de"), (7, docs[0][1]), (7, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {(r.doc_id, r.text_): (r.text, r.n_entities) for r in pii.replace_pii(df.withColumn("text_", F.col("text")), "k").collect()}
    mails, some = {}, 0
    for i, t in docs:
        new, n = out[i, t]
        assert t is None and new is None or regex.search(pii.HINT, t) or not pattern.search(t)
        matches = [] if t is None else [m[0] for m in pattern.finditer(t)]
        names = {w for m in matches if regex.fullmatch(pii.NAME, m) for w in m.split(" ")[1:] if len(w) >= pii.SHORTEST}
        if names:
            rest = "|".join(sorted(names, key=lambda w: (-len(w), w)))
            again = regex.compile(f"{pattern.pattern}|{pii._BEFORE}(?:{rest}){pii._AFTER}")
            matches = [m[0] for m in again.finditer(t)]
            pieces = again.split(t)
        else:
            pieces = [t] if not matches else pattern.split(t)
        assert n == len(matches), (i, matches)
        if matches:
            some += 1
            found = regex.fullmatch("(.*?)".join(map(regex.escape, pieces)), new, regex.DOTALL) if len(pieces) < 40 else True
            assert found and new != t
            for old, now in zip(matches, found.groups() if found is not True else [], strict=False):
                if regex.fullmatch(pii.EMAIL, old):
                    assert mails.setdefault(old.lower(), now.lower()) == now.lower()
    assert some > 50 and len(set(mails.values())) == len(mails)


def test_surrogates_are_distinct(spark):
    texts, _ = replaced(spark, *[f"{i % 10}@b{i}.org 10.0.{i // 250}.{i % 250}" for i in range(800)])
    for part in (0, 1):
        assert len({t.split()[part] for t in texts}) == 800
    names, _ = replaced(spark, *[f"Mr. A{'bcdefghijk'[i % 10]}{'lmnopqrstu'[i // 10 % 10]}{'vwxyza'[i // 100]}" for i in range(600)])
    assert len(set(names)) == 600


def test_pii_of_nothing(spark):
    assert pii.replace_pii(spark.createDataFrame([], "text string"), "k").collect() == []
