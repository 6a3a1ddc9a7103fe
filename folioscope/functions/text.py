"""Text expressions. Patterns follow Unicode classes and Unix line ends throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Prefixes of patterns: Unicode classes, only \n ends a line; and the same without regard to case.
EXACT, LOOSE = "(?Ud)", "(?iuUd)"
#: White space that Unicode strips from the ends of a text, with the separators U+001C-U+001F.
BLANK = r"[\s\x1c-\x1f]"
CJK = r"[一-鿿]"


def strip(text: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"{EXACT}^{BLANK}+|{BLANK}+\z", "")


def squeeze(text: Column | str) -> Column:
    """Runs of white space as one space, ends stripped."""
    return F.trim(F.regexp_replace(text, rf"{EXACT}{BLANK}+", " "))


def ellipsis(text: Column, limit: int) -> Column:
    """Squeezed; if longer than ``limit``, its first limit - 1 characters and an ellipsis."""
    short = squeeze(text)
    return F.when(F.length(short) > limit, F.concat(F.left(short, F.lit(limit - 1)), F.lit("…"))).otherwise(short)


def has(text: Column | str, pattern: str, flags: str = LOOSE) -> Column:
    """Whether a pattern is found anywhere."""
    return F.col(text).rlike(flags + pattern) if isinstance(text, str) else text.rlike(flags + pattern)


def first(text: Column | str, pattern: str, group: int = 0, flags: str = LOOSE) -> Column:
    """The first match's group; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, flags + pattern, group), F.lit(""))


def every(text: Column | str, pattern: str, group: int = 0, flags: str = LOOSE) -> Column:
    """That group of all matches, in order."""
    return F.regexp_extract_all(text, F.lit(flags + pattern), F.lit(group))


def occurrences(text: Column, token: str) -> Column:
    """How often a fixed text occurs, without overlaps."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(token), F.lit("")))) / len(token)).cast("long")


def token_score(text: Column, tokens: list[str]) -> Column:
    """The sum of the counts of fixed texts, each counted on its own."""
    return sum((occurrences(text, t) for t in tokens[1:]), occurrences(text, tokens[0]))


def count(text: Column | str, pattern: str, flags: str = EXACT) -> Column:
    return F.regexp_count(text, F.lit(flags + pattern)).cast("long")


def cjk(text: Column | str) -> Column:
    """Number of CJK unified ideographs."""
    return count(text, CJK)


def has_cjk(text: Column) -> Column:
    return has(text, CJK, EXACT)


def language(text: Column) -> Column:
    """zh if ideographs are over 20 and a third of the Latin letters at least; else en if Latin letters are over 20; else null."""
    chinese, latin = cjk(text), count(text, r"[A-Za-z]", "")
    return F.when((chinese > 20) & (chinese >= latin / 3), "zh").when(latin > 20, "en")


def present(*pairs: tuple[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in pairs]))


def leading(rows: DataFrame, by: list[str], value: str, n: int) -> DataFrame:
    """(by, listed): the first ``n`` values of each group in order; others are dropped before they meet in a row."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(value))
    return rows.withColumn("__rank", rank).filter(F.col("__rank") <= n).groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("listed"))


def recorded(value: Column) -> Column:
    """A value, or a note that there is none."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("Not recorded"))


def bullets(values: Column) -> Column:
    """One line for each entry, or a note that there is none."""
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, F.array_join(F.transform(values, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise("- None recorded")
