"""Row-local expressions: they take and return ``Column`` and stay inside code generation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

Col = Column | str

# White space as text trimming sees it, the signs with the Unicode property and the four ASCII separators.
_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def as_col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ticked(name: str) -> str:
    """A column name in SQL text; safe for names with spaces, dots and hyphens."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col(ticked(name))


def family_names(template: str, regions: Sequence[str], classes: Sequence[str] = ("",)) -> list[str]:
    """Column names of a class x region family, class by class."""
    return [template.format(cls=c, region=r) for c in classes for r in regions]


# --- text ---------------------------------------------------------------------------------------------------


def literal_replace(c: Col, text: str, by: str = "") -> Column:
    return F.replace(as_col(c), F.lit(text), F.lit(by))


def strip_whitespace(c: Col) -> Column:
    """Trim all white space at both ends; ``F.trim`` would only take blanks."""
    return F.btrim(as_col(c), F.lit(_SPACE))


def after_first(c: Col, mark: str) -> Column:
    """The text behind the first ``mark``, or the whole text if it has none."""
    place = F.instr(as_col(c), mark)
    return F.when(place > 0, F.substring(as_col(c), place + len(mark), F.length(as_col(c)))).otherwise(as_col(c))


def normalize_accession(c: Col, mode: str = "plain") -> Column:
    """Clean an accession number to its comparable core. Null stays null.

    All modes drop ``*`` first and trim last. Between these
    ``plain`` drops every ``CT``;
    ``dated`` cuts the text up to the first ``CT20``, then drops every ``CT``;
    ``manifest`` cuts up to the first ``CT20``, then up to the next ``CT``;
    ``fallback`` cuts up to the first ``CT20``, then drops every ``CT`` with a 1 before it, if there is one.
    """
    no_star = literal_replace(c, "*")
    core = after_first(no_star, "CT20")
    steps = {
        "plain": lambda: literal_replace(no_star, "CT"),
        "dated": lambda: literal_replace(core, "CT"),
        "manifest": lambda: after_first(core, "CT"),
        # The mark keeps the two ends of a cut "1CT" from making a new "CT".
        "fallback": lambda: literal_replace(literal_replace(literal_replace(core, "1CT", "\0"), "CT"), "\0"),
    }
    if mode not in steps:
        raise ValueError(f"mode must be one of {sorted(steps)}, not {mode!r}")
    return strip_whitespace(steps[mode]())


def report_number(c: Col) -> Column:
    """The text from its last ``CT`` on; text without ``CT`` stays as it is."""
    return F.regexp_replace(as_col(c), r".*CT", "CT")


def split_part(c: Col, *steps: tuple[str, int]) -> Column:
    """Part ``n`` (from 0) of a split on literal text, repeated for each (separator, n).

    A missing part gives null, to be reported by a null count, instead of an error.
    """
    out = as_col(c)
    for separator, n in steps:
        out = F.get(F.split(out, re.escape(separator)), F.lit(n))
    return out


def hex_code(c: Col) -> Column:
    """Upper-case hexadecimal, at least four digits."""
    digits = F.hex(as_col(c))
    return F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)


def first_of_list_literal(c: Col) -> Column:
    """First number of text that is a plain number or a list such as ``[40, 80]``; null for other text."""
    number = F.regexp_extract(as_col(c).cast("string"), r"^\s*[\[(]?\s*([-+]?[0-9][0-9.eE+-]*|[-+]?\.[0-9]+)", 1)
    return number.try_cast("double")


# --- dates and times ----------------------------------------------------------------------------------------


def parse_int_date(c: Col) -> Column:
    """A ``yyyymmdd`` number as a date."""
    return F.to_date(as_col(c).cast("string"), "yyyyMMdd")


def parse_timestamp(c: Col) -> Column:
    """Text as a timestamp without time zone; unreadable text gives null."""
    return as_col(c).try_cast("timestamp_ntz")


def elapsed_hours(start: Col, end: Col) -> Column:
    """Hours from start to end, rounded half to even: 71.5 and 72.5 hours both give 72.

    Taken from the interval between the two, which does not depend on the time zone of the session.
    """
    gap = as_col(end) - as_col(start)
    day, hour, minute, second = (F.extract(F.lit(p), gap) for p in ("DAY", "HOUR", "MINUTE", "SECOND"))
    seconds = day.cast("long") * 86_400 + hour * 3_600 + minute * 60 + second
    return F.bround(seconds.cast("double") / 3_600)


# --- numbers and flags --------------------------------------------------------------------------------------


def row_sum(*cols: Col) -> Column:
    """Sum across columns in the given order; null counts as 0, so all null gives 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c), F.lit(0.0)) for c in cols])


def fill_null(c: Col, value: object) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def percent(part: Col, whole: Col, digits: int = 1) -> Column:
    """Share in percent, rounded half to even."""
    return F.bround(as_col(part) / as_col(whole) * 100, digits)


def null_indicator(c: Col) -> Column:
    """1 if a value is present, else 0."""
    return as_col(c).isNotNull().cast("int")


def flag_combine(a: Col, b: Col) -> Column:
    """1 if either flag is 1, else the first flag."""
    return F.when((as_col(a) == 1) | (as_col(b) == 1), F.lit(1)).otherwise(as_col(a))


def case_label(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    out = F
    for condition, label in rules:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def outcome_flag(changes: Sequence[Col], cut: float, censored: Col) -> Column:
    """1 if any change reaches the cut and the row is not censored, else 0; null change counts as not reached.

    ``censored`` null means not censored.
    """
    reached = reduce(lambda a, b: a | b, [as_col(c) >= cut for c in changes])
    return F.when((fill_null(censored, 0) == 0) & reached, F.lit(1)).otherwise(F.lit(0))


# --- arrays -------------------------------------------------------------------------------------------------


def array_rescale_clip(arr: Col, slope: Col, inter: Col, centre: Col, width: Col) -> Column:
    """``x * slope + inter`` for each element, clipped to centre +- width // 2. Null slope is 1, null inter is 0."""
    slope, inter = F.coalesce(as_col(slope), F.lit(1.0)), F.coalesce(as_col(inter), F.lit(0.0))
    half = F.floor(as_col(width) / 2)
    low, high = as_col(centre) - half, as_col(centre) + half
    return F.transform(as_col(arr), lambda x: F.greatest(F.least(x.cast("double") * slope + inter, high), low))


def shape_rank(shape: Col) -> Column:
    """Number of dimensions of a shape array."""
    return F.size(as_col(shape))


def shape_depth(shape: Col) -> Column:
    """Third dimension of a shape array, the number of slices; null if there is none."""
    return F.get(as_col(shape), F.lit(2))


# --- ordering -----------------------------------------------------------------------------------------------


def order_key(*cols: Col) -> Column:
    """Comparable struct of the columns with null last in each; never null itself."""
    parts = []
    for i, c in enumerate(cols):
        parts += [as_col(c).isNull().alias(f"n{i}"), as_col(c).alias(f"v{i}")]
    return F.struct(*parts)


def ascending(*cols: Col) -> list[Column]:
    """Sort order of ``order_key``: up, null last."""
    return [as_col(c).asc_nulls_last() for c in cols]
