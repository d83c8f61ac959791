"""Text parsing helpers with the JVM string semantics the reference relies on.

All helpers return native Column expressions (codegen, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from autopulse.functions._cols import to_col

# Java's `\s` (ASCII only, includes vertical tab); Spark's split uses Java regex.
JAVA_WHITESPACE = r"[ \t\n\x0B\f\r]+"
# Every char String.trim removes: U+0000 .. U+0020.
_JVM_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def jvm_trim(c) -> Column:
    """String.trim of the JVM: strip every char <= U+0020 at both ends (Spark's trim strips spaces only)."""
    return F.trim(to_col(c), F.lit(_JVM_TRIM_CHARS))


def non_blank(c) -> Column:
    """NOT NULL and non-empty after trimming spaces (`length(trim(c)) > 0`)."""
    c = to_col(c)
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def jvm_split_fields(c, sep: str = ",") -> Column:
    """JVM ``line.split(sep).map(_.trim)``: trailing empty fields are dropped before the trim (T5).

    Patterns end in ``\\z``: in Java regex ``$`` also matches before a final line break.

    ``sep`` is a literal single character.
    """
    c = to_col(c)
    esc = "\\" + sep if sep in r".^$|?*+()[]{}\\" else sep
    stripped = F.regexp_replace(c, f"(?:{esc})+\\z", "")
    # The JVM splits "" into one empty field, and a line of separators only into none.
    parts = (F.when(c == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(F.split(stripped, esc, -1)))
    return F.transform(parts, lambda p: jvm_trim(p))


def safe_double(c) -> Column:
    """``Try(s.toDouble)`` of the JVM: NULL when not a Java double literal.

    Spark's try_cast additionally accepts `inf`/`nan`/`infinity` in any case; the JVM
    parser only `NaN` and `Infinity` (optionally signed).  Everything else (exponents,
    hex floats, `d`/`f` suffixes) is the same parser.
    """
    c = to_col(c)
    lowered_special = F.lower(c).rlike(r"^[+-]?(inf|infinity|nan)\z")
    java_special = c.rlike(r"^[+-]?(NaN|Infinity)\z")
    return F.when(lowered_special & ~java_special, F.lit(None).cast("double")).otherwise(c.try_cast("double"))


def legacy_int(c) -> Column:
    """String -> INT as a non-ANSI cast does (T3): '12.7' -> 12, '-0.9' -> 0, '.' -> 0,
    '1e2' / 'NaN' / overflow -> NULL.  Ends are stripped of whitespace and control chars (incl. DEL)."""
    t = F.trim(to_col(c), F.lit(_JVM_TRIM_CHARS + "\x7f"))
    shape = t.rlike(r"^[+-]?[0-9]*\.?[0-9]*\z") & ~t.isin("", "+", "-")
    return F.when(shape, F.when(t.rlike("[0-9]"), t.try_cast("decimal(38,18)").try_cast("int")).otherwise(F.lit(0)))


def words(c) -> Column:
    """``line.trim.split("\\s+").filter(_.nonEmpty)`` as an array column."""
    return F.filter(F.split(jvm_trim(c), JAVA_WHITESPACE, -1), lambda w: w != "")


def numeric_tokens(c) -> Column:
    """Whitespace tokens of a line that parse as Java doubles, as array<double> (non-numbers dropped)."""
    return F.filter(F.transform(words(c), lambda w: safe_double(w)), lambda v: v.isNotNull())
