"""Column expressions over titles, genre strings and years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The title pattern, era bounds and HTML entities.
YEAR_PATTERN = r"\((\d{4})\)$"
YEAR_SUFFIX = r"\s*\(\d{4}\)$"
ERAS = ((1960, "Classic"), (1980, "Retro"), (1990, "Eighties"), (2000, "Nineties"))
LAST_ERA = "Modern"
DOUBLE_QUOTE = "&quot;"
SINGLE_QUOTE = "&#39;"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def release_year(title: Column) -> Column:
    return F.regexp_extract(title, YEAR_PATTERN, 1).try_cast("int")


def clean_title(title: Column) -> Column:
    return strip(F.regexp_replace(title, YEAR_SUFFIX, ""))


def genre_list(genres: Column) -> Column:
    parts = F.transform(F.split(genres, r"\|"), strip)
    return F.coalesce(parts, F.array().cast("array<string>"))


def web_title(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit('"'), F.lit(DOUBLE_QUOTE)), F.lit("'"), F.lit(SINGLE_QUOTE))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def era(year: Column) -> Column:
    label = F.lit(LAST_ERA)
    for bound, name in reversed(ERAS):
        label = F.when(year < bound, name).otherwise(label)
    return label


def title_length(title: Column) -> Column:
    return F.char_length(title)


def word_count(title: Column) -> Column:
    words = F.split(strip(title), r"\s+")
    return F.when(strip(title) == "", 0).otherwise(F.size(words))


def match_key(title: Column, year: Column) -> Column:
    return F.concat_ws("_", strip(F.lower(title)), year.cast("string"))


def search_title(title: Column) -> Column:
    bare = strip(title)
    bare = F.when(F.startswith(F.lower(bare), F.lit("the ")), F.substr(bare, F.lit(5))).otherwise(bare)
    return strip(F.replace(F.replace(bare, F.lit(":"), F.lit("")), F.lit("&"), F.lit("and")))


def blurb(year: Column, genres: Column) -> Column:
    """One sentence from the year and the first two genres."""
    return F.concat(F.lit("A "), year.cast("string"), F.lit(" "), F.array_join(F.slice(genres, 1, 2), ", "), F.lit(" film."))


def names_text(names: Column) -> Column:
    """``A`` / ``A and B`` / ``A, B, and C`` from an array of up to three names."""
    n = F.size(names)
    return (
        F.when(n == 1, F.get(names, F.lit(0)))
        .when(n == 2, F.array_join(names, " and "))
        .otherwise(F.concat(F.array_join(F.slice(names, F.lit(1), n - 1), ", "), F.lit(", and "), F.get(names, n - 1)))
    )
