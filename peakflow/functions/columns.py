"""Column expressions shared by the operators. All are compositions of Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peakflow.params import REFERENCE, is_corrected

# Patterns of the replicate-name grammar <date>_<type>_<sample>_<replicate>.
RUN_TYPE = "(?<=_)[^_]+(?=_)"
SAMPLE_OR_POOL = "Smp|Poo"
SAMPLE_OR_POOL_ANY_CASE = "(?i)Smp|Poo"
STANDARD_ANY_CASE = "(?i)Std"
BLANK_ANY_CASE = "(?i)Blk"
BLANK_OR_STANDARD = "Blk|Std"

#: The tokens of that pattern, for a plain search.
_BLANK_OR_STANDARD = BLANK_OR_STANDARD.split("|")

#: Text that counts as a number; anything else becomes NULL (infinities and NaN included).
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(col(a), col(b))


def finite(c: Column | str) -> Column:
    """NULL for NaN and the infinities."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def to_number(c: Column | str) -> Column:
    """Text to double; text that is no finite decimal number becomes NULL."""
    c = col(c).cast("string")
    return F.when(c.rlike(_NUMBER), finite(F.trim(c).try_cast("double")))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def trim_whitespace(c: Column | str) -> Column:
    """Cut blanks, tabs and line ends on both sides (`trim` cuts blanks only)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def run_type(replicate: Column | str) -> Column:
    """Lower-cased first token between two underscores; NULL without one.

    The pattern is asked only where the second of at least three parts is empty or there are fewer."""
    name = col(replicate)
    two = F.substring_index(name, "_", 2)
    second = F.substring_index(two, "_", -1)
    return F.lower(F.when((two != name) & (second != ""), second).otherwise(F.regexp_substr(name, F.lit(RUN_TYPE))))


def is_blank_or_standard(replicate: Column | str) -> Column:
    """The same rows as `rlike(BLANK_OR_STANDARD)`, without a regular expression."""
    blank, standard = (col(replicate).contains(token) for token in _BLANK_OR_STANDARD)
    return blank | standard


def replicate_part(replicate: Column | str, index: int) -> Column:
    return F.get(F.split(col(replicate), "_"), F.lit(index))


def parse_replicate(replicate: Column | str) -> dict[str, Column]:
    """The four name parts; surplus parts are dropped, missing ones are NULL."""
    return {
        name: replicate_part(replicate, i)
        for i, name in enumerate(("run_date", "type", "samp_id", "replicate"))
    }


def join_parts(*parts: Column | str) -> Column:
    """Underscore-joined text in which a missing part reads NA."""
    return F.concat_ws("_", *[F.coalesce(col(p), F.lit("NA")) for p in parts])


def fix_replicate_dash(replicate: Column | str) -> Column:
    """The first dash becomes a dot."""
    name = col(replicate)
    return F.when(name.contains("-"), F.regexp_replace(name, r"^([^-]*)-", "$1.")).otherwise(name)


def flag(condition: Column, label: str) -> Column:
    return F.when(condition, F.lit(label))


def area_with_qc(area: Column | str, area_min: float) -> Column:
    """The area unless it is below the minimum (a missing area stays missing)."""
    return F.when(col(area) < area_min, None).otherwise(col(area))


def outside(value: Column | str, low: Column | str, high: Column | str, flex: float) -> Column:
    """At or beyond the widened range; NULL without a range."""
    return (col(value) >= col(high) + flex) | (col(value) <= col(low) - flex)


def _spelled_out(flags: list[Column | str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(col(f), F.lit("NA")) for f in flags])


def msdial_flag_text(flags: list[Column | str], mode: str = REFERENCE) -> Column:
    """All set flags as one text, NULL when none is set.

    Reference text keeps the separator of the last set flag when later ones are absent."""
    if is_corrected(mode):
        return blank_to_null(F.concat_ws(", ", *[col(f) for f in flags]))
    # fixed values: the clean-up patterns here and in the next function
    text = F.replace(_spelled_out(flags), F.lit("NA, "), F.lit(""))
    return blank_to_null(F.replace(text, F.lit("NA"), F.lit("")))


def skyline_flag_text(flags: list[Column | str], mode: str = REFERENCE) -> Column:
    """As above for long exports, whose reference text keeps runs of inner blanks."""
    if is_corrected(mode):
        return msdial_flag_text(flags, mode)
    text = trim_whitespace(F.regexp_replace(_spelled_out(flags), "NA,|NA", ""))
    return blank_to_null(F.regexp_replace(text, "^,|,$", ""))


def strict_min(c: Column | str) -> Column:
    """Aggregate minimum that is NULL as soon as one value is."""
    return F.when(F.count(F.lit(1)) == F.count(col(c)), F.min(col(c)))


def strict_max(c: Column | str) -> Column:
    return F.when(F.count(F.lit(1)) == F.count(col(c)), F.max(col(c)))


def open_min(c: Column | str, mode: str = REFERENCE) -> Column:
    """Aggregate minimum; over nothing it is +Infinity in reference mode, else NULL."""
    low = F.min(col(c))
    return low if is_corrected(mode) else F.coalesce(low, F.lit(float("inf")))


def open_max(c: Column | str, mode: str = REFERENCE) -> Column:
    high = F.max(col(c))
    return high if is_corrected(mode) else F.coalesce(high, F.lit(float("-inf")))


def formula_atoms(formula: Column | str, mode: str = REFERENCE) -> tuple[Column, Column]:
    """Carbon and nitrogen atoms of an empirical formula.

    Reference: at most two leading carbon digits; one nitrogen before any non-digit, else one digit.
    Corrected: every occurrence counts, a symbol without digits is one atom, no symbol is zero."""
    formula = col(formula)
    if is_corrected(mode):
        return _all_atoms(formula, "C"), _all_atoms(formula, "N")
    # fixed values: the patterns
    carbon = F.regexp_substr(formula, F.lit(r"^C\d\d?"))
    nitrogen = F.regexp_substr(formula, F.lit(r"N\d"))
    return (
        F.substring(carbon, 2, 2).try_cast("double"),
        F.when(formula.rlike(r"N\D"), F.lit(1.0)).otherwise(F.substring(nitrogen, 2, 1).try_cast("double")),
    )


def _all_atoms(formula: Column, symbol: str) -> Column:
    counts = F.regexp_extract_all(formula, F.lit(symbol + r"(?![a-z])(\d*)"), F.lit(1))
    return F.aggregate(
        counts, F.lit(0.0), lambda total, n: total + F.when(n == "", F.lit(1.0)).otherwise(n.cast("double"))
    )


def core_name(name: Column | str) -> Column:
    """Name a labelled standard shares with its compound: the text before a comma,
    and of that the second dash-separated token if there is one."""
    before_comma = F.get(F.split(col(name), ","), F.lit(0))
    return F.when(
        before_comma.contains("-"), F.get(F.split(before_comma, "-"), F.lit(1))
    ).otherwise(before_comma)
