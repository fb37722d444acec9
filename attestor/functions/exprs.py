"""Scalar expressions: text normalisers and parsers of printed values.

All are compositions of built-in functions, so they stay in generated code and push down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as the record format defines them.
SPACE = r"[\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# Spellings of yes and of review verdicts.
TRUE_WORDS = ("yes", "true", "y", "1", "priority")
CORRECT_WORDS = ("1", "true", "yes", "y", "correct", "t")
INCORRECT_WORDS = ("0", "false", "no", "n", "incorrect", "f")
# Measure stewards by what their printed name contains, first match wins.
STEWARDS = (
    ("hedis", "HEDIS"),
    ("ncqa", "HEDIS"),
    ("adult core", "Medicaid Adult Core Set"),
    ("child core", "Medicaid Child Core Set"),
    ("cahps", "CAHPS"),
    ("state", "State-defined"),
)
OTHER_STEWARD, UNKNOWN_STEWARD = "Other", "Unknown"
RATE_UNITS = ("percent", "per_1000", "per_100000", "ratio", "count", "other")
NUMBER = r"-?\d+(?:\.\d+)?"
PLAIN_FLOAT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def blank_to_null(x: Column) -> Column:
    """Null for an empty string: what counts as missing when alternatives follow."""
    return F.nullif(x, F.lit(""))


def first_of(*xs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(x) for x in xs])


def to_double(x: Column) -> Column:
    """A whole text that is a plain decimal number; else null (also for NaN and infinities)."""
    t = strip(F.replace(x, F.lit(","), F.lit("")))
    return F.when(t.rlike(PLAIN_FLOAT), t.try_cast("double"))


def to_int(x: Column) -> Column:
    """A printed integer, thousands separators allowed, fractions rounded half to even; else null."""
    return F.bround(to_double(x), 0).try_cast("int")


def to_float(x: Column) -> Column:
    """The first number within a text."""
    return F.regexp_extract(F.replace(x, F.lit(","), F.lit("")), NUMBER, 0).try_cast("double")


def rate_value(x: Column) -> Column:
    """The number of a printed rate such as ``58.2%``."""
    return to_float(F.lower(x))


def rate_unit(x: Column) -> Column:
    """``per_100000``, ``per_1000`` or else ``percent``, as a printed rate says."""
    t = F.replace(F.lower(strip(x)), F.lit(","), F.lit(""))
    return (
        F.when(F.contains(t, F.lit("per 100000")), "per_100000")
        .when(F.contains(t, F.lit("per 1000")), "per_1000")
        .otherwise("percent")
    )


def to_bool(x: Column) -> Column:
    """Whether a text means yes; null for none."""
    return F.when(blank_to_null(x).isNotNull(), F.lower(strip(x)).isin(*TRUE_WORDS))


def steward(x: Column) -> Column:
    """The steward that a printed name stands for."""
    low = F.lower(strip(x))
    out = F.when(blank_to_null(x).isNull(), UNKNOWN_STEWARD)
    for part, name in STEWARDS:
        out = out.when(F.contains(low, F.lit(part)), name)
    return out.otherwise(OTHER_STEWARD)


def parse_correct(x: Column) -> Column:
    """A reviewer's verdict: true, false, or null where it can't be read."""
    low = F.lower(strip(x))
    return F.when(low.isin(*CORRECT_WORDS), True).when(low.isin(*INCORRECT_WORDS), False)


def row_uid(columns: Sequence[str]) -> Column:
    """16 hex digits that identify a row by the texts of its identity columns."""
    parts = [F.coalesce(F.lower(strip(F.col(c).cast("string"))), F.lit("")) for c in columns]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def normal_text(x: Column) -> Column:
    """Lower case, no commas, single spaces: the form in which spans are compared."""
    return F.lower(strip(F.regexp_replace(F.replace(x, F.lit(","), F.lit("")), rf"(?U){SPACE}+", " ")))


def alnum(x: Column) -> Column:
    """Letters and digits alone, lower-cased."""
    return F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]", "")


def short_number(x: Column) -> Column:
    """A number in at most six significant digits, without trailing zeros, as ``%g`` prints it."""
    v = x.cast("double")
    exact = F.substring_index(F.format_string("%.17e", F.abs(v)), "e", -1).try_cast("int")
    scaled = F.when(exact > 5, F.abs(v) / F.pow(F.lit(10.0), exact - 5)).otherwise(F.abs(v) * F.pow(F.lit(10.0), 5 - exact))
    six = F.bround(scaled, 0).cast("long")  # ties go to even digits
    power = F.when(six >= 1_000_000, exact + 1).otherwise(exact)
    d = F.substring(six.cast("string"), 1, 6)
    bare = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    sign = F.when(power < 0, "-").otherwise("+")
    first = F.concat(F.substring(d, 1, 1), F.lit("."), F.substring(d, 2, 5))
    scientific = F.concat(bare(first), F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    large = F.concat(F.substring(d, F.lit(1), power + 1), F.lit("."), F.substring(d, power + 2, F.lit(6)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), d)
    plain = bare(F.when(power >= 0, large).otherwise(small))
    text = F.when((power < -4) | (power >= 6), scientific).otherwise(plain)
    return F.when(v == 0, "0").otherwise(F.concat(F.when(v < 0, "-").otherwise(""), text))


def agree(a: Column, b: Column, numeric: bool, tolerance: float = 0.01) -> Column:
    """Whether two extractions of a field agree: numbers within a relative tolerance, texts but for case."""
    if numeric:
        far = F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))
        same = far <= tolerance
    else:
        a, b = a.cast("string"), b.cast("string")
        same = F.when(a == b, True).otherwise(F.lower(strip(a)) == F.lower(strip(b)))  # most are equal as they are
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(same)


def all_same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Whether all are equal, nulls to nulls; a condition of a join, but none of its keys."""
    out = F.lit(True)
    for x, y in zip(a, b, strict=True):
        out = out & F.coalesce(x == y, x.isNull() & y.isNull())
    return out


def bump_patch(version: Column) -> Column:
    """The next patch version; ``0.4.1`` where the version is not of the form a.b.c."""
    v = F.regexp_extract_all(version, F.lit(r"^v?(\d+)\.(\d+)\.(\d+)$"), F.lit(0))
    part = lambda i: F.regexp_extract(version, r"^v?(\d+)\.(\d+)\.(\d+)$", i)
    return F.when(F.size(v) > 0, F.concat_ws(".", part(1), part(2), (part(3).try_cast("int") + 1).cast("string"))).otherwise("0.4.1")


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval of k out of n, in [0, 1]; (0, 1) for n = 0."""
    p, zz = k / n, z * z
    centre = (p + zz / (2 * n)) / (1 + zz / n)
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    low = F.when(n > 0, F.greatest(F.lit(0.0), centre - half)).otherwise(0.0)
    return low, F.when(n > 0, F.least(F.lit(1.0), centre + half)).otherwise(1.0)


def hoeffding(errors: Column, n: Column, delta: float) -> Column:
    """Upper confidence bound of an error rate; 1 for no observation."""
    return F.when(n > 0, F.least(F.lit(1.0), errors / n + F.sqrt(F.ln(F.lit(1 / delta)) / (2 * n)))).otherwise(1.0)
