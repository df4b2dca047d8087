"""Personal data: detection, and surrogates in place of what is found.

DataFrame functions only. Texts with an entity are cut into pieces and matches by
one expression; matches become tokens (a name has one for each word, an e-mail
address one for the local part and one for the domain), and each distinct token of
a type gets one surrogate, from a keyed SHA-256 of its normal form. So the same
person, number or address has the same surrogate wherever it stands, and in
whatever case or punctuation. A word of a name is one identity: whether it is a
given name or a surname, and of which gender, is decided by all its mentions in the
corpus. In a text that names a person with a title, later (and earlier) mentions of
these words without the title are replaced alike.

Surrogates keep type and format: digits for digits with separators in place, the
card's check digit, the whole country code, the top-level domain, private addresses
private in their range, letters of the token's case, the name's title, gender ending
and script.

Collision checks: among all distinct tokens of the corpus, a surrogate that two
tokens of a type share, or that is itself a token of the corpus, is drawn again
for all but the first, until none is left. Forms grow as draws go on, by a syllable,
a letter or a digit, so that there are always more of them than tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import col, forget, free_name, written

# Titles by gender.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Mme", "Mlle", "Madame", "Госпожа")
NEUTRAL = ("Dr", "Prof")
# Syllables and endings that surrogate names are made of.
LATIN = "ba be bo da de di do fa fe ga go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi".split()
CYRILLIC = "ба бе бо да де ди до га го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе по ра ре ри ро са се си со та те ти то ва ве ви".split()
ENDINGS = {("latin", "m"): ["n", "rd", "s", "lf"], ("latin", "f"): ["na", "ra", "sa", "lia"], ("latin", "n"): ["r", "l", "m", "x"], ("latin", "s"): ["man", "ber", "ton", "well"]}
ENDINGS |= {("cyrillic", "m"): ["н", "р", "с", "л"], ("cyrillic", "f"): ["на", "ра", "са", "лия"], ("cyrillic", "n"): ["й", "ль", "м", "т"], ("cyrillic", "s"): ["енко", "ский", "ич", "юк"]}

_TITLE = "|".join(MALE + FEMALE + NEUTRAL)
#: A word of a name; a possessive 's is not part of it.
_WORD = r"\p{Lu}(?:\p{L}|['’-](?=\p{L}{2}))++"
#: What stands before and after a mention without a title.
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}'’-])", r"(?![\p{L}\p{N}]|['’-]\p{L}{2})"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}"
IP = r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\d|\.\d)"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w.,-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d|[.,-]\d)"
SECRET = r"(?=A)(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])|(?<=[=\"])(?:(?<=password=)|(?<=token = \"))[^\s\"]{6,}+"
NAME = rf"(?<![\p{{L}}.])(?:{_TITLE})\.? {_WORD}(?: {_WORD}){{0,2}}"
#: What titles begin with: a look at one character spares the rest of an alternative at most places.
_FIRST = f"(?=[{''.join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL}))}])"
PATTERN = "|".join((EMAIL, rf"(?=[\d+(])(?:{IP}|{PHONE}|{SSN}|{CARD})", SECRET, f"{_FIRST}{NAME}"))
#: What any match has: a quick first look.
HINT = rf"[@\d]|AKIA|password=|token = \"|{_FIRST}(?:{_TITLE})\.? \p{{Lu}}"
#: Words of a name that are this short are replaced with the title only.
SHORTEST = 3
# Country calling codes of one and two digits; all others have three.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# Second-level names under which others register, as in .co.uk.
SECOND = "ac co com edu gov net org".split()
#: First numbers of public addresses: none that begins a private, shared, local or multicast range.
PUBLIC = [x for x in range(1, 224) if x not in (10, 100, 127, 169, 172, 192, 198, 203)]
#: Draws after which numbers and secrets get one character more, and small private ranges give way to 10.0.0.0/8.
WIDER = 8
#: Draws after which an address may be of any range.
ANYWHERE = 64


def hinted(text: Column) -> Column:
    """Whether a text has what HINT looks for; false for null. Fixed words are searched for as such."""
    some = text.rlike(r"[@\d]") | text.contains("AKIA") | text.contains("password=") | text.contains('token = "') | text.rlike(rf"{_FIRST}(?:{_TITLE})\.? \p{{Lu}}")
    return F.coalesce(some, F.lit(False))


def _kind(m: Column) -> Column:
    return (
        F.when(m.rlike(r"^[^\s@\"]+@[A-Za-z0-9.-]+$") & m.rlike(rf"^(?:{EMAIL})$"), "email")
        .when(m.rlike(rf"^(?:{IP})$"), "ip")
        .when(m.rlike(rf"^(?:{NAME})$"), "name")
        .when(m.rlike(rf"^(?:{PHONE})$"), "phone")
        .when(m.rlike(rf"^(?:{SSN})$"), "ssn")
        .when(m.rlike(rf"^(?:{CARD})$"), "card")
        .otherwise("secret")
    )


def _token(kind: Column | str, raw: Column, lead: Column | str, norm: Column, says: Column | str = "") -> Column:
    kind, lead, says = (F.lit(x) if isinstance(x, str) else x for x in (kind, lead, says))
    return F.struct(kind.alias("kind"), raw.alias("raw"), lead.alias("lead"), norm.alias("norm"), says.alias("says"))


def _tokens(m: Column, known: Column) -> Column:
    """The tokens of a match: (kind, raw, text before it, normal form, says); kind "keep" is left as it is.

    says, of a word of a name: m, f or n, a given name after a title of that gender; s, a
    surname; b, one without a title, which ``known`` lists.
    """
    words = F.split(m, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("n")
    n = F.size(words)
    name = F.transform(words, lambda w, i: F.when(i == 0, _token("keep", w, "", w)).when(i == n - 1, _token("name", w, " ", F.lower(w), "s")).otherwise(_token("name", w, " ", F.lower(w), gender)))
    low = F.lower(m)
    local = F.regexp_extract(m, r"^([^@]+)@", 1)
    domain = F.regexp_extract(m, r"@(.+)$", 1)
    email = F.array(_token("email", local, "", low), _token("domain", domain, "@", F.lower(domain)))
    kind = _kind(m)
    one = F.array(_token(kind, m, "", F.when(kind == "secret", m).when(kind == "ip", m).otherwise(F.regexp_replace(m, r"[^+\d]", ""))))
    return F.when(F.array_contains(known, m), F.array(_token("name", m, "", low, "b"))).when(kind == "name", name).when(kind == "email", email).otherwise(one)


def _byte(digest: Column, i: Column | int) -> Column:
    """Byte i, modulo 32, of a SHA-256 in hexadecimals."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(items: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (at % len(items) + 1).cast("int"))


def _made_name(digest: Column, role: str, script: str, attempt: Column) -> Column:
    """Three syllables, one more with each second draw, and an ending."""
    base = CYRILLIC if script == "cyrillic" else LATIN
    syllables = F.transform(F.sequence(F.lit(0), 2 + F.floor(attempt / 2).cast("int")), lambda i: _pick(base, _byte(digest, 2 * i) * 256 + _byte(digest, 2 * i + 1)))
    return F.initcap(F.concat(F.array_join(syllables, ""), _pick(ENDINGS[script, role], _byte(digest, 31))))


def _redrawn(norm: Column, digest: Column) -> Column:
    """Letters for letters and digits for digits, in the case they have."""
    chars = F.split(norm, "")

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i) + F.floor(i / 32).cast("int")
        return F.when(c.rlike(r"^\d$"), (b % 10).cast("string")).when(c.rlike("^[a-z]$"), F.char(b % 26 + 97)).when(c.rlike("^[A-Z]$"), F.char(b % 26 + 65)).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


def _luhn(digits: Column) -> Column:
    """The sum of the check digit's rule over all digits; 0 modulo 10 for a valid number."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x)


def _address(norm: Column, digest: Column, attempt: Column) -> Column:
    """An address of the same range: public, or one of the private and local ranges."""
    octet = [(_byte(digest, 2 * i) * 256 + _byte(digest, 2 * i + 1)) for i in range(5)]
    of = lambda *parts: F.concat_ws(".", *[F.lit(str(p)) if isinstance(p, int) else p.cast("string") for p in parts])
    a, b, c, d = ((x % 254 + 1) for x in octet[:4])
    second = F.regexp_extract(norm, r"^\d+\.(\d+)", 1).cast("int")
    wide = attempt >= WIDER
    return (
        F.when(attempt >= ANYWHERE, of(a, b, c, d))
        .when(norm.startswith("10."), of(10, b, c, d))
        .when(norm.startswith("127."), of(127, b, c, d))
        .when(norm.startswith("192.168."), F.when(wide, of(10, b, c, d)).otherwise(of(192, 168, c, d)))
        .when(norm.startswith("169.254."), F.when(wide, of(10, b, c, d)).otherwise(of(169, 254, c, d)))
        .when(norm.startswith("172.") & second.between(16, 31), F.when(wide, of(10, b, c, d)).otherwise(of(F.lit(172), octet[1] % 16 + 16, c, d)))
        .otherwise(of(F.element_at(F.array(*map(F.lit, PUBLIC)), (octet[4] % len(PUBLIC) + 1).cast("int")), b, c, d))
    )


def _surrogate(key: str) -> Column:
    """The core of the surrogate of (kind, norm, role) at an attempt."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, norm, attempt.cast("string")), 256)
    more = F.floor(attempt / WIDER).cast("int")
    drawn = _redrawn(F.when(kind.isin("email", "domain"), norm).otherwise(F.concat(norm, F.repeat(F.lit("0"), more))), digest)
    body = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(_luhn(norm) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(drawn)
    country = F.regexp_extract(norm, COUNTRY, 0)
    phone = F.concat(country, F.substr(drawn, F.length(country) + 1))
    local = F.regexp_extract(drawn, r"^([^@]+)@", 1)
    # a short local part has too few forms
    letters = lambda n, at: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.char(_byte(digest, i + at) % 26 + 97)), "")
    local = F.when((F.length(local) < 8) | (more > 0), F.concat(local, letters(6 + more, 24))).otherwise(local)
    top = F.regexp_extract(norm, rf"\.((?:(?:{'|'.join(SECOND)})\.)?[a-z0-9-]+)$", 1)
    domain = F.concat(letters(9 + more, 0), F.lit(".example."), F.when(top == "", F.lit("org")).otherwise(top))
    cyrillic = norm.rlike(r"\p{IsCyrillic}")
    secret = F.when(norm.startswith("AKIA"), F.concat(F.lit("AKIA"), F.substr(drawn, F.lit(5)))).otherwise(drawn)
    out = F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", drawn).when(kind == "ip", _address(norm, digest, attempt)).when(kind == "email", local).when(kind == "domain", domain)
    for role in "mfns":
        made = F.when(cyrillic, _made_name(digest, role, "cyrillic", attempt)).otherwise(_made_name(digest, role, "latin", attempt))
        out = out.when((kind == "name") & (F.col("role") == role), made)
    return out.otherwise(secret)


def _formatted(kind: Column, raw: Column, core: Column) -> Column:
    """The core in the format of the raw token: separators in place, letters in its case; characters that the core has more come last."""
    place = lambda i: F.length(F.regexp_replace(F.substr(raw, F.lit(1), i + 1), r"[^+\d]", ""))
    digits = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c.rlike(r"^[+\d]$"), F.substr(core, place(i), F.lit(1))).otherwise(c)), "")
    digits = F.concat(digits, F.substr(core, F.length(F.regexp_replace(raw, r"[^+\d]", "")) + 1))
    cased = F.when((F.upper(raw) == raw) & (F.lower(raw) != raw) & (F.length(raw) > 1), F.upper(core)).otherwise(core)
    return F.when(kind == "keep", raw).when(kind.isin("phone", "card", "ssn"), digits).when(kind.isin("ip", "secret"), core).otherwise(cased)


def _roles(tokens: DataFrame) -> DataFrame:
    """Distinct tokens (kind, norm, role); a word of a name is m, f or n as a given name, or s, by all its mentions."""
    votes = {x: F.count_if(F.col("says") == x) for x in "mfns"}
    given = votes["m"] + votes["f"] + votes["n"]
    role = F.when((given > 0) & (given >= votes["s"]), F.when(votes["m"] > votes["f"], "m").when(votes["f"] > votes["m"], "f").otherwise("n")).otherwise("s")
    return tokens.groupBy("kind", "norm").agg(role.alias("role"))


def _distinct_surrogates(tokens: DataFrame, key: str) -> DataFrame:
    """tokens (kind, norm, role), distinct -> (kind, norm, core), no two alike of a kind and none a token of the corpus."""
    now = written(tokens.withColumn("attempt", F.lit(0)).withColumn("core", _surrogate(key)), "pii-surrogates")
    real = now.select("kind", F.when(F.col("kind") == "email", F.regexp_extract("norm", r"^([^@]+)@", 1)).otherwise(F.col("norm")).alias("shown")).distinct().withColumn("taken", F.lit(True))
    real = written(real, "pii-real")
    while True:
        shown = now.withColumn("shown", F.when(F.col("kind") == "secret", F.col("core")).otherwise(F.lower("core")))
        first = shown.groupBy("kind", "shown").agg(F.min("norm").alias("first"))
        marked = shown.join(first, ["kind", "shown"]).join(real, ["kind", "shown"], "left")
        again = F.coalesce("taken", F.lit(False)) | (F.col("norm") != F.col("first"))
        marked = marked.select("kind", "norm", "role", (F.col("attempt") + again.cast("int")).alias("attempt"), "core", again.alias("again"))
        if not marked.where("again").limit(1).count():
            forget(real)
            return now.select("kind", "norm", "core")
        then = written(marked.withColumn("core", F.when(F.col("again"), _surrogate(key)).otherwise(F.col("core"))).drop("again"), "pii-surrogates")
        forget(now)
        now = then


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """docs with text_col replaced, and as its last column (long) the number of matches in it.

    All columns are kept, whatever their names; the last one is called count_col,
    with underscores after it if docs has such a column. A null text stays null, with 0 entities; a
    text without entities stays as it is. Equal texts get equal results, so rows of
    null or repeated ids need no care. Texts of any length are taken whole. An
    empty table gives an empty result.
    """
    names, last = {}, free_name(count_col, docs.columns)
    for x in ("key", "pieces", "matches", "known", "pattern", "new"):
        names[x] = free_name(f"pii_{x}", [*docs.columns, last, *names.values()])
    at = {k: col(v) for k, v in names.items()}
    own, text = [col(c) for c in docs.columns], col(text_col)
    hint = hinted(text)
    # a generator's output is made once, however often it is looked at
    looked = docs.select(*own, F.explode_outer(F.array(F.when(hint, F.split(text, PATTERN, -1)))).alias(names["pieces"])).where(F.size(at["pieces"]) > 1)
    hits = looked.withColumn(names["key"], F.md5(text.cast("binary"))).withColumn(names["matches"], F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    named = F.filter(at["matches"], lambda m: m.rlike(rf"^(?:{NAME})$"))
    words = F.flatten(F.transform(named, lambda m: F.slice(F.split(m, " "), F.lit(2), F.size(F.split(m, " ")))))
    hits = hits.withColumn(names["known"], F.array_distinct(F.filter(words, lambda w: F.length(w) >= SHORTEST)))
    # longer words first, so that none is cut short
    long = F.array_sort(F.transform(at["known"], lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    bare = F.concat(F.lit(f"{PATTERN}|{_BEFORE}(?:"), F.array_join(F.transform(long, lambda x: x["w"]), "|"), F.lit(f"){_AFTER}"))
    hits = hits.withColumn(names["pattern"], F.when(F.size(at["known"]) > 0, bare))
    again = at["pattern"].isNotNull()
    hits = hits.withColumn(names["pieces"], F.when(again, F.split(text, at["pattern"], -1)).otherwise(at["pieces"])).withColumn(names["matches"], F.when(again, F.regexp_extract_all(text, at["pattern"], F.lit(0))).otherwise(at["matches"]))
    hits = written(hits.drop(names["pattern"]), "pii-hits")

    found = hits.select(at["key"].alias("key"), at["matches"].alias("matches"), at["known"].alias("known")).dropDuplicates(["key"])
    found = found.select("key", "known", F.posexplode("matches").alias("pos", "m"))
    tokens = written(found.select("key", "pos", F.posexplode(_tokens(F.col("m"), F.col("known"))).alias("sub", "t")).select("key", "pos", "sub", "t.*"), "pii-tokens")
    cores = _distinct_surrogates(_roles(tokens.where("kind <> 'keep'")), key)
    made = tokens.join(cores, ["kind", "norm"], "left").select("key", "pos", "sub", F.concat("lead", _formatted(F.col("kind"), F.col("raw"), F.col("core"))).alias("s"))
    of_match = made.groupBy("key", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "s"))), lambda x: x["s"]), "").alias("s"))
    lists = of_match.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]).alias("new"))
    lists = lists.select(F.col("key").alias(names["key"]), F.col("new").alias(names["new"]))
    joined = F.array_join(F.transform(at["pieces"], lambda p, i: F.concat(p, F.coalesce(F.get(at["new"], i), F.lit("")))), "")
    replaced = hits.join(lists, names["key"], "left")
    out = replaced.select(*[(joined if c == text_col else col(c)).alias(c) for c in docs.columns], F.size(at["matches"]).cast("long").alias(last))
    clean = docs.where(~(hint & F.coalesce(text.rlike(PATTERN), F.lit(False))))
    return clean.select(*own, F.lit(0).cast("long").alias(last)).unionByName(out)
