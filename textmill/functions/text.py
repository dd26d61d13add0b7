"""Column expressions on text: cleaning, field choice, sizes, Unicode and token splits."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The code points Python's str.strip() removes.
SPACES = "".join(
    chr(c)
    for first, last in (
        (0x0009, 0x000D), (0x001C, 0x0020), (0x0085, 0x0085), (0x00A0, 0x00A0),
        (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
        (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for c in range(first, last + 1)
)

# Record fields that hold a document by themselves, best first.
TEXT_FIELDS = ("text", "content", "data", "正文")
# Record fields that are put together when none of the above is usable.
COMBINE_FIELDS = ("title", "desc", "answer", "chinese", "question", "instruction", "input", "output")
RECORD_FIELDS = TEXT_FIELDS + COMBINE_FIELDS

# Fixed value: the byte-level split of a text into pre-tokens.
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
    r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
)

# A text made only of these characters is its own NFKC form: each is unchanged by NFKC and
# never joins with a neighbour. With U+0000-009F it covers ASCII, Latin letters and Han, so most
# rows stay in the JVM. Runs are taken possessively: one cheap range test per ASCII character.
NFKC_STABLE = (
    r"¡-§©«-®°±¶·»¿-ı"
    r"Ĵ-ľŁ-ňŊ-ž‐‒-‖‘-•"
    r"、-〩㐀-䶿一-鿿"
)
NFKC_STABLE_TEXT = rf"\A[\x00-\x9F]*+(?:[{NFKC_STABLE}]++[\x00-\x9F]*+)*+\z"

# Size suffixes and their factors.
SIZE_UNITS = {"K": 1024, "KB": 1024, "M": 1024**2, "MB": 1024**2, "G": 1024**3, "GB": 1024**3}


def strip(text: Column) -> Column:
    """Python's ``str.strip()``. Looks only at the ends of the text."""
    return F.btrim(text, F.lit(SPACES))


def clean_text(text: Column) -> Column:
    """Unify line ends, strip every line, drop the empty ones."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.filter(F.transform(F.split(unix, "\n", -1), strip), lambda line: line != "")
    return F.array_join(lines, "\n")


def choose_text(field: Callable[[str], Column], bare: Column | None = None) -> Column:
    """The document in a record.

    ``field(name)`` is the string value of a field, NULL when it is absent or no string.
    ``bare`` is the record itself when it is a string.
    """
    def usable(names, change=lambda x: x):
        return F.filter(F.array(*[change(field(n)) for n in names]), lambda x: strip(x) != "")

    first = F.get(usable(TEXT_FIELDS), F.lit(0))
    joined = F.nullif(F.array_join(usable(COMBINE_FIELDS, strip), "\n"), F.lit(""))
    return F.coalesce(first, joined, *([] if bare is None else [bare]), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it.

    ``body`` must not use the variable of a ``let`` around it: Spark does not find such an
    expression again when it is the argument of a Python function.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def variant_field(record: Column, name: str) -> Column:
    """A field as a variant: SQL NULL when absent, a variant null for JSON null."""
    return F.try_variant_get(record, f"$['{name}']", "variant")


def variant_string(value: Column) -> Column:
    """The value when it is a JSON string, else NULL (a plain cast would take numbers too)."""
    return let(value, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))


def record_text(record: Column) -> Column:
    """``choose_text`` on a variant record of any shape."""
    return choose_text(lambda n: variant_string(variant_field(record, n)), variant_string(record))


def float_repr(number: Column) -> Column:
    """A double as Python prints it, from the digits and exponent of Spark's own text."""
    pattern = r"^-?(\d+)\.(\d+)E(-?\d+)$"

    def from_exponent(p: Column) -> Column:
        head, tail, shift = p["head"], p["tail"], p["shift"]
        digits = F.concat(head, tail)
        point = F.char_length(head) + shift  # digits before the decimal point
        exponent = F.abs(shift).cast("string")
        science = F.concat(
            head, F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)),
            F.when(shift < 0, "e-").otherwise("e+"),
            F.lpad(exponent, F.greatest(F.lit(2), F.char_length(exponent)), F.lit("0")),
        )
        padded = F.rpad(digits, F.greatest(point, F.char_length(digits)), F.lit("0"))
        fraction = F.substr(padded, point + 1)
        return (
            F.when((shift < -4) | (shift >= 16), science)
            .when(shift < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .otherwise(F.concat(F.substr(padded, F.lit(1), point), F.lit("."),
                                F.when(fraction == "", "0").otherwise(fraction)))
        )

    def from_text(text: Column) -> Column:
        parts = F.struct(
            F.regexp_extract(text, pattern, 1).alias("head"),
            F.regexp_replace(F.regexp_extract(text, pattern, 2), "^0$", "").alias("tail"),
            F.regexp_extract(text, pattern, 3).cast("int").alias("shift"),
        )
        return (
            F.when(text == "NaN", "nan")
            .when(text.endswith("Infinity"), F.replace(text, F.lit("Infinity"), F.lit("inf")))
            .when(text.contains("E"), F.concat(F.regexp_extract(text, "^-?", 0), let(parts, from_exponent)))
            .otherwise(text)
        )

    return let(number.cast("string"), from_text)


def python_str(value: Column) -> Column:
    """Python's ``str()`` of a JSON value held as a variant; an absent field gives ``""``.

    Nested values come out as JSON text, not as Python prints them.
    """
    def of(p: Column) -> Column:
        v, kind = p["value"], p["kind"]
        # 1.0 is kept as a decimal of scale 0; only integers too wide for a long are, too.
        wide_integer = kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
        return (
            F.when(v.isNull(), "")
            .when(F.is_variant_null(v), "None")
            .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
            .when((kind.startswith("DECIMAL") & ~wide_integer) | (kind == "DOUBLE"),
                  float_repr(F.try_variant_get(v, "$", "double")))
            .otherwise(F.try_variant_get(v, "$", "string"))
        )

    return let(F.struct(value.alias("value"), F.schema_of_variant(value).alias("kind")), of)


def char_length(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text)


def json_row(text: Column) -> Column:
    """The output line of a document, with a blank after the colon, without newline."""
    return F.concat(F.lit('{"text": '), F.substr(F.to_json(F.struct(text.alias("text"))), F.lit(9)))


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the output line; 2 = the blank after the colon and the newline."""
    return (F.octet_length(F.to_json(F.struct(text.alias("text")))) + 2).cast("long")


def size_bytes(text: Column) -> Column:
    """A size such as ``5GB`` in bytes; empty means 0, anything else unreadable is an error."""
    upper = F.upper(strip(text))
    number = strip(F.regexp_extract(upper, r"^(.*?)([KMG]B?)?$", 1))
    unit = F.regexp_extract(upper, r"^(.*?)([KMG]B?)?$", 2)
    factor = F.element_at(F.create_map(*[F.lit(x) for pair in SIZE_UNITS.items() for x in pair]), unit)
    scaled = F.floor(F.abs(number.try_cast("double") * factor)).cast("long") * F.signum(number.try_cast("double")).cast("long")
    value = F.when(unit == "", number.try_cast("long")).otherwise(scaled)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0).cast("long")).otherwise(
        F.coalesce(value, F.raise_error(F.concat(F.lit("not a size: "), text)).cast("long"))
    )


def parse_size(text: str | int | None) -> int:
    """``size_bytes`` for an option value."""
    if not text:
        return 0
    match = re.fullmatch(r"\s*([^KMGkmg]*?)\s*([KMGkmg][Bb]?)?\s*", str(text))
    if match is None:
        raise ValueError(f"not a size: {text!r}")
    number, unit = match.groups()
    return int(float(number) * SIZE_UNITS[unit.upper()]) if unit else int(number)


@F.arrow_udf(StringType())
def _nfkc(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array(
            [None if t is None else unicodedata.normalize("NFKC", t) for t in batch.to_pylist()], pa.string()
        )


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Rows that cannot change are sent to Python as NULL."""
    needed = F.when(~text.rlike(NFKC_STABLE_TEXT), text)
    return F.coalesce(_nfkc(needed), text)


def pretokens(text: Column) -> Column:
    """The pre-tokens of a normalised text, in order; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))
