"""Scalar cleaning rules as column expressions; all stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortgraph import schemas as S

SNAPSHOT_DATE = "2025-10-06"


# every character that counts as white space at the ends of a text
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


def strip(c: Column) -> Column:
    """Trim every kind of whitespace, not only blanks. No pattern matching, as it runs on every cell."""
    return F.btrim(c, F.lit(_BLANKS))


def norm_str(c: Column) -> Column:
    """Trimmed text; null tokens become NULL; case is kept."""
    s = strip(c)
    return F.when(~F.lower(s).isin(*S.NULL_TOKENS), s)


def skill_id(c: Column) -> Column:
    """Lower-case identifier with underscores: ``Data Analysis`` -> ``data_analysis``."""
    kept = F.regexp_replace(F.lower(c), r"(?U)[^\w\s-]", "")
    joined = F.regexp_replace(kept, r"(?U)[\s_-]+", "_")
    return F.regexp_replace(joined, r"^_+|_+$", "")


def city_id(city: Column, country_code: Column, parity: bool = False) -> Column:
    """``CC-`` and the city's name in upper case; NULL unless both are known.

    ``parity`` keeps three letters only, as the original does: cities with the same prefix fall together.
    """
    name = norm_str(city)
    return F.concat(F.upper(country_code), F.lit("-"), F.upper(F.substring(name, 1, 3) if parity else name))


#: Years of usable dates in the original model.
YEARS = (1970, 2030)


def parse_date(c: Column, years: tuple[int, int] | None = YEARS) -> Column:
    """Date of ``Y-m-d`` or ISO date-time text; sentinels, junk and out-of-window years are NULL.

    A four-digit year sorts as text, so the window is checked before anything is parsed. The
    common ten-character form needs neither a pattern nor a formatter.
    """
    low, high = years or (1, 9999)
    iso_time = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?$"
    in_window = c.between(f"{low:04d}", f"{high:04d}~") & ~c.isin(*S.INVALID_DATES)
    dashed = F.substring(c, 5, 1) == "-"
    plain = dashed & F.length(c).between(8, 10) & ~c.contains(" ") & ~c.contains("T")
    return F.when(
        in_window,
        F.when(plain, c.try_cast("date"))
        .when(dashed, F.when(c.rlike(iso_time), F.substring(c, 1, 10).try_cast("date")))
        .when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd")),
    )


def parse_num(c: Column) -> Column:
    """Double; text that is no number and the missing-value marker become NULL.

    The cast itself ignores blanks and turns null tokens into NULL; each value is read once.
    """
    return F.nullif(c.try_cast("double"), F.lit(-99.0))


def parse_int(c: Column, keep_missing: bool = False) -> Column:
    """Integer part of a number. The -99 marker becomes NULL unless ``keep_missing``."""
    value = c.try_cast("double") if keep_missing else parse_num(c)
    return value.try_cast("bigint")


def _flag(c: Column, yes: tuple[str, ...], no: tuple[str, ...]) -> Column:
    s = F.lower(strip(c.cast("string")))
    return F.when(s.isin(*yes), F.lit(True)).when(s.isin(*no), F.lit(False))


def parse_bool(c: Column) -> Column:
    """1/true/yes/y and 0/false/no/n; anything else is NULL."""
    return _flag(c, S.TRUE_TOKENS, S.FALSE_TOKENS)


def parse_rural(c: Column) -> Column:
    """Boolean tokens plus ``rural`` and ``urban``."""
    return _flag(c, ("1", "true", "yes", "rural"), ("0", "false", "no", "urban"))


def norm_gender(c: Column) -> Column:
    s = F.lower(strip(c))
    return F.when(s.isin("male", "female"), s).when(s.isin(*S.OTHER_GENDER_TOKENS), F.lit(S.OTHER_GENDER))


def norm_education(c: Column) -> Column:
    """Case-insensitive match to the known levels, else NULL."""
    levels = F.create_map(*[F.lit(v) for level in S.EDUCATION_LEVELS for v in (level.lower(), level)])
    return F.element_at(levels, F.lower(norm_str(c)))


def hash_id(c: Column, digits: int = 16) -> Column:
    """First hex digits of SHA-256 of the text as it is: 16 (64 bits) serve up to some 10^8 names, 64 is the whole digest."""
    return F.substring(F.sha2(c, 256), 1, digits)


def safe_double(c: Column) -> Column:
    return F.when(~c.isin("-99", "", "n/a"), c.try_cast("double"))


def safe_int(c: Column) -> Column:
    """Whole number, decimals rounded half away from zero; a type suffix is no number."""
    number = F.when(~c.rlike(r"[dDfF]\s*$"), c.try_cast("double"))
    return F.when(~c.isin("-99", "", "n/a"), F.coalesce(c.try_cast("int"), F.round(number).try_cast("int")))


def safe_date(c: Column) -> Column:
    """Date of ``Y-m-d`` or ``Y/m/d`` text, with or without a time; a bare year is not a date."""
    plain = (F.substring(c, 5, 1) == "-") & F.length(c).between(8, 10)
    day = F.regexp_extract(c, r"^\s*(\d{4}[-/]\d{1,2}[-/]\d{1,2})([ T]\d{1,2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$", 1)
    return F.when(~c.isin("1970-01-01", "", "n/a"), F.when(plain, c.try_cast("date")).otherwise(F.translate(day, "/", "-").try_cast("date")))


def contains_term(c: Column, term: str) -> Column:
    """Case-insensitive containment."""
    return F.lower(c).contains(term.lower())


def valid_company(c: Column) -> Column:
    return c.isNotNull() & ~F.lower(c).isin(*S.NO_COMPANY_TOKENS)


def _any_of(terms: tuple[str, ...]) -> str:
    return "|".join(re.escape(t) for t in terms)


def skill_category(c: Column) -> Column:
    """First keyword bucket whose term occurs anywhere in the name."""
    s = F.lower(c)
    return (
        F.when(s.rlike(_any_of(S.TECHNICAL_TERMS)), "Technical")
        .when(s.rlike(_any_of(S.BUSINESS_TERMS)), "Business")
        .when(s.rlike(_any_of(S.SOFT_TERMS)), "Soft Skill")
        .otherwise("Other")
    )


def employment_class(title: Column, organization: Column, venture_placement: Column | None = None) -> Column:
    """Entrepreneur, Freelancer or Wage Employed from keywords in title or organization."""
    text = F.lower(F.concat_ws("\n", title, organization))
    venture = text.rlike(_any_of(S.VENTURE_TERMS))
    if venture_placement is not None:
        venture = venture | F.coalesce(venture_placement, F.lit(False))
    return (
        F.when(venture, "Entrepreneur")
        .when(text.rlike(_any_of(S.FREELANCE_TERMS)), "Freelancer")
        .otherwise("Wage Employed")
    )


def is_current_by_date(end: Column, snapshot: str = SNAPSHOT_DATE) -> Column:
    """Open, unreadable or future end text means the job is current at the snapshot date."""
    plain = (F.substring(end, 5, 1) == "-") & F.length(end).between(8, 10) & ~end.contains(" ") & ~end.contains("T")
    past = F.when(plain, end.try_cast("date") < F.lit(snapshot).cast("date"))
    return ~F.coalesce(past, F.lit(False))


def is_set(c: Column) -> Column:
    """Flag text or number equal to one. Text ``0`` is false."""
    return F.coalesce(parse_int(c) == 1, F.lit(False))
