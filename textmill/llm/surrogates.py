"""Surrogates for personal data: detected entities get keyed, type-consistent replacements.

Patterns find e-mail addresses, telephone, social security and card numbers, IP addresses, access keys, secrets
that follow a name such as ``password=`` (behind ``:`` only those with a digit among their first letters), and up to four capitalised words behind
a title. A telephone number of North America is one unit with and without its ``+1``. A mention is one or more units (an
address, the digits of a number, each word of a name); a unit gets one surrogate everywhere, however
it is written, so coreference stays. A surrogate is made from SHA-256 of a secret key and the unit:
digits for digits, letters for letters of the same case, hexadecimal for hexadecimal, card numbers
with a right check digit, names in the script of the name and, behind a title that tells it, with an
ending of the same gender. It is then written in the format of each mention.

Surrogates of different units differ, and none is a unit of the input: both are checked by joins over
all units, and a unit that fails gets its next candidate (longer ones after some attempts).

DataFrame functions only. Text is read twice, the second time joined with the surrogates of its mentions.
Defined results: a null text stays null, a text without mentions stays as it is; repeated rows get equal texts. Columns
other than doc_id and text take no part. A unit or a document may have any share of all mentions:
units are joined, never gathered. A mention of any length takes time in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .sizes import sent_if_small

_BYTE = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_FEMALE, _MALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra", "Mr|Herr|Monsieur|Señor|Sr"  # the longer of two comes first
_NAME = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)*+"
_TITLE = rf"(?:{_FEMALE}|{_MALE}|Dr|Prof)\.?"
_SECRET_NAME = r"(?:[Pp]assword|PASSWORD|[Pp]asswd|PASSWD|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Aa]pi_?[Kk]ey|API_?KEY)[ \t]*+"
_SECRET = _SECRET_NAME + r"[=:][ \t]*+[\"']?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",  # possessive: the JVM would recurse
    "secret": rf"(?<![A-Za-z]){_SECRET_NAME}(?:=[ \t]*+[\"']?|:[ \t]*+[\"']?(?=[A-Za-z_/+-]{{0,64}}[0-9]))[A-Za-z0-9_/+-]{{8,}}+",
    "aws": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{_BYTE}\.){{3}}{_BYTE}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
             r"|\+[0-9]{1,3}[ .-]\(?[0-9]{1,3}\)?(?:[ .-][0-9]{2}){3,5}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "person": rf"(?<![\p{{L}}]){_TITLE} {_NAME}(?: {_NAME}){{0,3}}+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
NUMBERS = ("ssn", "phone", "card")
LONGER_AFTER = 4
MOST_ATTEMPTS = 40
SYLLABLES = {  # consonants, vowels, masculine endings, feminine endings
    "latin": ("bdfgklmnprstv", "aeiou", "nrsko", "a"),
    "greek": ("βγδκλμνπρστ", "αεο", "ς", "α"),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", "нвр", "а"),
}


def _kind(value: Column) -> Column:
    kind = F.lit("person")
    for name in reversed(PATTERNS):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _with_country(value: Column, kind: Column) -> Column:
    return (kind == "phone") & value.startswith("+1") & (F.length(_digits(value)) == 11)


def mentions(keyed: DataFrame) -> DataFrame:
    """(key, at, value, kind, part, type, unit) of all mentions in (key, text), one row per unit."""
    found = keyed.where(F.col("text").rlike("[0-9@=]|AKIA|" + _TITLE)).select(
        "key", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), 0)).alias("at", "value")).distinct()
    found = found.withColumn("kind", _kind(F.col("value")))
    value, kind = F.col("value"), F.col("kind")
    title = F.regexp_extract(value, f"^({_TITLE})", 1)
    names = F.split(F.regexp_replace(value, f"^{_TITLE} ", ""), " ")
    gender = F.when(title.rlike(rf"^(?:{_FEMALE})\.?$"), "f").when(title.rlike(rf"^(?:{_MALE})\.?$"), "m").otherwise("n")
    script = lambda w: F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    person = F.transform(names, lambda w, i: F.struct(
        F.concat_ws("_", F.lit("name"), script(w), F.when((i == 0) & (F.size(names) > 1), gender).otherwise("s")).alias("type"), w.alias("unit")))
    unit = (
        F.when(kind == "email", F.lower(value)).when(kind == "secret", F.regexp_replace(value, "^" + _SECRET, ""))
        .when(_with_country(value, kind), F.expr("substring(regexp_replace(value, '[^0-9]', ''), 2)"))
        .when(kind.isin(*NUMBERS), _digits(value)).otherwise(value)
    )
    parts = F.when(kind == "person", person).otherwise(F.array(F.struct(kind.alias("type"), unit.alias("unit"))))
    return found.select("key", "at", "value", "kind", F.posexplode(parts).alias("part", "u")).select(
        "key", "at", "value", "kind", "part", "u.type", "u.unit")


def _drawn(seed: Column, i: Column | int, size) -> Column:
    """A number in [0, size) from the seed and a place."""
    i = F.lit(i) if isinstance(i, int) else i
    part = F.substring(F.sha2(F.concat_ws(":", seed, i.cast("string")), 256), 1, 8)
    return F.pmod(F.conv(part, 16, 10).cast("long"), size if isinstance(size, Column) else F.lit(size)).cast("int")


def _letter(alphabet: str, at: Column) -> Column:
    return F.lit(alphabet).substr(at + 1, F.lit(1))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, not once for each element of an array below."""
    return F.transform(F.array(value), use)[0]


def _alike(text: Column, seed: Column) -> Column:
    """Each digit and letter replaced by one of its class; the rest stays."""
    def of(letters: int):
        def one(c: Column, i: Column) -> Column:
            return (
                F.when(c.rlike("[0-9]"), _letter("0123456789", _drawn(seed, i + 1, 10)))
                .when(c.rlike("[a-z]"), _letter("abcdefghijklmnopqrstuvwxyz", _drawn(seed, i + 1, letters)))
                .when(c.rlike("[A-Z]"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _drawn(seed, i + 1, letters)))
                .otherwise(c)
            )

        return one

    characters = F.split(text, "")
    hexadecimal = text.rlike("^(?:[0-9a-f]++|[0-9A-F]++)$")
    return F.array_join(F.when(hexadecimal, F.transform(characters, of(6))).otherwise(F.transform(characters, of(26))), "")


def _with_check_digit(digits: Column) -> Column:
    """``digits`` and the digit that makes their Luhn sum a multiple of ten."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(n - i, F.lit(2)) == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.concat(digits, F.pmod(-total, F.lit(10)).cast("string"))


def _syllables(seed: Column, consonants: str, vowels: str, n: Column) -> Column:
    def one(i: Column) -> Column:
        return F.concat(_letter(consonants, _drawn(seed, 2 * i, len(consonants))), _letter(vowels, _drawn(seed, 2 * i + 1, len(vowels))))

    return F.array_join(F.transform(F.sequence(F.lit(1), n), one), "")


def _name(type_: Column, seed: Column, longer: Column) -> Column:
    out = F.lit(None).cast("string")
    for script, (consonants, vowels, male, female) in SYLLABLES.items():
        body = _syllables(seed, consonants, vowels, 2 + _drawn(seed, 0, 2) + longer)
        last = _letter(consonants, _drawn(seed, 99, len(consonants)))
        ending = F.when(type_.endswith("_f"), F.concat(last, F.lit(female))).when(
            type_.endswith("_m"), _letter(male, _drawn(seed, 98, len(male)))).otherwise(last)
        out = F.when(type_.startswith(f"name_{script}"), F.initcap(F.concat(body, ending))).otherwise(out)
    return out


def candidate(type_: Column, unit: Column, attempt: int, key: str) -> Column:
    seed = F.sha2(F.concat_ws("|", F.lit(key), type_, unit, F.lit(str(attempt))), 256)
    return _once(seed, lambda s: _candidate(type_, unit, s, max(0, attempt - LONGER_AFTER), key))


def _candidate(type_: Column, unit: Column, seed: Column, longer: int, key: str) -> Column:
    more = F.array_join(F.array(*(_drawn(seed, 1000 + i, 10).cast("string") for i in range(longer))), "") if longer else F.lit("")
    local, domain = F.substring_index(unit, "@", 1), F.substring_index(unit, "@", -1)
    named = F.regexp_replace(domain, r"\.[^.]*$", "")
    host = _once(F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), named), 256), lambda s: _alike(named, s))
    first, rest = unit.substr(F.lit(1), F.lit(1)), F.expr("substring(unit, 2)")
    numbers = [1 + _drawn(seed, 1, 223), _drawn(seed, 2, 256), _drawn(seed, 3, 256), 1 + _drawn(seed, 4, 254)]
    return (
        F.when(type_ == "email", F.concat(_alike(local, seed), more, F.lit("@"), host, F.lit("."), F.substring_index(domain, ".", -1)))
        .when(type_ == "ip", F.concat_ws(".", *(n.cast("string") for n in numbers)))
        .when(type_ == "aws", F.concat(F.lit("AKIA"), _alike(F.expr("substring(unit, 5)"), seed), more))
        .when(type_ == "card", _with_check_digit(F.concat(first, _alike(F.expr("substring(unit, 2, length(unit) - 2)"), seed), more)))
        .when(type_ == "phone", F.concat(first, _alike(rest, seed), more))
        .when(type_.startswith("name"), _name(type_, seed, F.lit(longer)))
        .otherwise(F.concat(_alike(unit, seed), more))
    )


def surrogates(units: DataFrame, key: str, make=candidate) -> DataFrame:
    """(type, unit, surrogate) for distinct (type, unit): all surrogates of a type differ and none is a unit."""
    units = stage(units.select("type", "unit").distinct(), "units")
    taken = units.select("type", F.col("unit").alias("surrogate"))
    left, done = units, []
    for attempt in range(MOST_ATTEMPTS):
        tried = left.withColumn("surrogate", make(F.col("type"), F.col("unit"), attempt, key))
        tried = stage(tried.join(taken, ["type", "surrogate"], "left_anti"), "candidates")
        first = tried.groupBy("type", "surrogate").agg(F.min("unit").alias("unit"))
        first = stage(first.select("type", "unit", "surrogate"), "surrogates")
        done.append(first)
        left = stage(left.join(first, ["type", "unit"], "left_anti"), "colliding")
        if not left.limit(1).count():
            break
        taken = taken.unionByName(first.select("type", "surrogate"))
    else:
        raise ValueError("no distinct surrogates found")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _written(value: Column, kind: Column, new: Column) -> Column:
    """The surrogates (array of parts) in the format of the mention."""
    one = F.when(_with_country(value, kind), F.concat(F.lit("1"), new[0])).otherwise(new[0])

    def digit(i: Column) -> Column:
        c = value.substr(i, F.lit(1))
        return F.when(c.rlike("[0-9]"), one.substr(F.length(_digits(value.substr(F.lit(1), i))), F.lit(1))).otherwise(c)

    number = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), digit), ""),
                      one.substr(F.length(_digits(value)) + 1, F.length(one)))
    return (
        F.when(kind.isin(*NUMBERS), number)
        .when(kind == "secret", F.concat(F.regexp_extract(value, f"^({_SECRET})", 1), one))
        .when(kind == "person", F.concat_ws(" ", F.regexp_extract(value, f"^({_TITLE})", 1), F.array_join(new, " ")))
        .when((kind == "email") & (F.upper(value) == value), F.upper(one))
        .otherwise(one)
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_entities, text."""
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    found = stage(mentions(keyed.select("key", "text")), "mentions")
    new = surrogates(found, key)
    parts = found.join(new, ["type", "unit"]).groupBy("key", "at", "value", "kind").agg(
        F.array_sort(F.collect_list(F.struct("part", "surrogate")))["surrogate"].alias("new"))
    written = parts.select("key", "at", _written(F.col("value"), F.col("kind"), F.col("new")).alias("new"))
    written = stage(written.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "new")))["new"].alias("_new")), "written")
    rows = keyed.join(sent_if_small(written, F.aggregate("_new", F.lit(64), lambda n, x: n + F.length(x) + 32)), "key", "left")
    between = F.split("text", ANY, -1)
    after = F.concat(F.col("_new"), F.array(F.lit("")))
    changed = F.array_join(F.zip_with(between, after, lambda a, b: F.concat(a, b)), "")
    return rows.select("doc_id", F.coalesce(F.size("_new"), F.lit(0)).cast("long").alias("n_entities"),
                       F.when(F.col("_new").isNull(), F.col("text")).otherwise(changed).alias("text"))
