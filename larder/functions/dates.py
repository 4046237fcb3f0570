"""ISO 8601 dates and durations as Column expressions.

Free text is read by a bounded grammar: what it does not cover, and phrases that
depend on the day of the run ("yesterday", "2 months"), give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_col, let, strip_edges

# First letters of the twelve months, and the words cut before parsing.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_WORD = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
WEEKDAY = r"\b(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b"

# The ISO 8601 date forms.
ISO_CALENDAR = r"^\d{4}-\d{2}-\d{2}$"
ISO_COMPACT = r"^\d{8}$"
ISO_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"
ISO_ORDINAL = r"^(\d{4})-?(\d{3})$"
ISO_MONTH = r"^\d{4}-\d{2}$"
ISO_YEAR = r"^\d{4}$"
ISO_CENTURY = r"^\d{2}$"
# What all of them have in common.
ISO_SHAPE = r"^\d[\dW-]+$"

# The ISO 8601 duration form and the seconds of one text unit.
_NUM = r"(\d+(?:[.,]\d+)?)"
ISO_DURATION = (
    rf"^([+-])?P(?=\w)(?:{_NUM}Y)?(?:{_NUM}M)?(?:{_NUM}W)?(?:{_NUM}D)?"
    rf"(?:T(?:{_NUM}H)?(?:{_NUM}M)?(?:{_NUM}S)?)?$"
)
UNIT_SECONDS = {
    "fortnight": 1209600,
    "week": 604800,
    "day": 86400,
    "hour": 3600,
    "min(?:ute)?": 60,
    "sec(?:ond)?": 1,
}
_UNIT = "(?:" + "|".join(UNIT_SECONDS) + ")s?"
TEXT_DURATION = rf"(?i)^\+?\d{{1,9}}\s*{_UNIT}(?:[\s,]+\+?\d{{1,9}}\s*{_UNIT})*$"


YMD = r"^\d{4}-\d{1,2}-\d{1,2}$"


def _pick(col: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def _long(col: Column) -> Column:
    return col.cast("long")


def _iso_week_date(c: Column) -> Column:
    """Monday of ISO week 1 holds 4 January; add weeks and days to it."""
    year, week = _pick(c, ISO_WEEK, 1), _pick(c, ISO_WEEK, 2).cast("int")
    day = F.coalesce(_pick(c, ISO_WEEK, 3).cast("int"), F.lit(1))
    jan4 = F.try_to_date(F.concat(year, F.lit("-01-04")), "yyyy-MM-dd")
    dec28 = F.try_to_date(F.concat(year, F.lit("-12-28")), "yyyy-MM-dd")
    monday = F.date_sub(jan4, F.weekday(jan4))
    return F.when(
        (week >= 1) & (week <= F.weekofyear(dec28)), F.date_add(monday, (week - 1) * 7 + day - 1)
    )


def _ordinal_date(c: Column) -> Column:
    year, day = _pick(c, ISO_ORDINAL, 1), _pick(c, ISO_ORDINAL, 2).cast("int")
    jan1 = F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd")
    dec31 = F.try_to_date(F.concat(year, F.lit("-12-31")), "yyyy-MM-dd")
    return F.when((day >= 1) & (day <= F.dayofyear(dec31)), F.date_add(jan1, day - 1))


def parse_iso_date(col: Column | str) -> Column:
    """ISO 8601 date string -> DATE, NULL when it is not one."""
    return let(as_col(col), _parse_iso)


def _calendar_date(c: Column) -> Column:
    """DATE of a text of the form year-month-day, NULL for a day that does not exist."""
    return F.when(~c.startswith("0000"), c.try_cast("date"))


def _parse_iso(c: Column) -> Column:
    calendar = F.when(c.rlike(ISO_CALENDAR), _calendar_date(c))
    rarer = (
        F.when(c.rlike(ISO_COMPACT), F.try_to_date(c, "yyyyMMdd"))
        .when(c.rlike(ISO_WEEK), _iso_week_date(c))
        .when(c.rlike(ISO_ORDINAL), _ordinal_date(c))
        .when(c.rlike(ISO_MONTH), _calendar_date(F.concat(c, F.lit("-01"))))
        .when(c.rlike(ISO_YEAR), _calendar_date(F.concat(c, F.lit("-01-01"))))
        .when(c.rlike(ISO_CENTURY), _calendar_date(F.concat(c, F.lit("00-01-01"))))
    )
    return F.when(c.rlike(ISO_SHAPE), F.coalesce(calendar, rarer))


# Date layouts rewritten to year-month-day; "#n" stands for a month name.
LAYOUTS = [
    (r"^#(\d+) (\d{1,2}) (\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[ -]#(\d+)[ -](\d{4})$", "$3-$2-$1"),
    (r"^#(\d+) (\d{4})$", "$2-$1-1"),
    (r"^(\d{4}-\d{2}-\d{2})T\d{2}:?\d{2}.*$", "$1"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[.-](\d{1,2})[.-](\d{4})$", "$3-$2-$1"),
]
# Words around a date that carry no information.
NOISE = [
    (rf"(?i){WEEKDAY}\.?", " "),
    (r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1"),
    (r"(?i),|\bof\b|\bthe\b", " "),
    (r"(?i)(?:\bat\b)?\s*\b\d{1,2}:\d{2}(?::\d{2})?(?:\s*[ap]\.?m\.?)?\s*$", ""),
    (r"\s+", " "),
]


# The usual layouts in one expression; what they do not cover goes through NOISE and LAYOUTS, which give the same.
_DAY, _WORD = r"(\d{1,2})(?:st|nd|rd|th)?", MONTH_WORD + r"\.?"
USUAL = (
    rf"(?i)^\s*(?:{WEEKDAY}\.?,?\s+)?(?:{_WORD}\s+{_DAY},?\s+(\d{{4}})|{_DAY}[ -]{_WORD}(?:,? +|-)(\d{{4}})|{_WORD},?\s+(\d{{4}})"
    r"|(\d{4})-(\d{2})-(\d{2})T\d{2}:?\d{2}.*|(\d{4})[/.](\d{1,2})[/.](\d{1,2})|(\d{1,2})/(\d{1,2})/(\d{4})"
    r"|(\d{1,2})[.-](\d{1,2})[.-](\d{4}))\s*$"
)
READ = "\u0001"
USUAL_PARTS = f"{READ}$3$6$8$9$12$17$20{READ}$1$5$7$10$13$15$19{READ}$2$4$11$14$16$18{READ}"


def _month_number(word: Column) -> Column:
    """A month's number from its name or number, as text."""
    letters = F.substring(F.lower(word), 1, 3)
    return F.when(word.rlike("^[0-9]"), word).otherwise(
        F.floor((F.instr(F.lit(" " + " ".join(MONTHS)), letters) + 2) / 4).cast("string")
    )


def _usual_date(parts: Column) -> Column:
    """DATE from year, month and day between the marks."""
    piece = lambda i: F.substring_index(F.substring_index(parts, READ, i + 1), READ, -1)
    day = F.when(piece(3) == "", "1").otherwise(piece(3))
    return _calendar_date(F.concat_ws("-", piece(1), _month_number(piece(2)), day))


def _other_date(c: Column) -> Column:
    """Rewrite the known layouts to one form, which a single parse then validates."""
    for pattern, to in NOISE:
        c = F.regexp_replace(c, pattern, to)

    def named(c: Column) -> Column:
        word = F.regexp_extract(c, rf"(?i)\b{MONTH_WORD}\b", 1)
        number = F.when(word == "", "0").otherwise(_month_number(word))
        return F.regexp_replace(c, F.lit(rf"(?i)\b{MONTH_WORD}\b\.?"), F.concat(F.lit("#"), number))

    def laid_out(s: Column) -> Column:
        for pattern, to in LAYOUTS:
            s = F.regexp_replace(s, pattern, to)
        # anything else left over does not parse
        return let(s, lambda d: F.when(d.rlike(YMD), _calendar_date(d)))

    return let(strip_edges(let(c, named)), laid_out)


def _text_date(c: Column) -> Column:
    read = let(
        F.regexp_replace(c, USUAL, USUAL_PARTS),
        lambda p: F.when(p.startswith(READ), _usual_date(p)).when(p.rlike(r"[^\d-]"), _other_date(p)),
    )
    return F.when(c.rlike(r"\d{4}"), read.cast("string"))  # every layout has a year


def iso_date(col: Column | str) -> Column:
    """A valid ISO date as it stands, else a free-text date as yyyy-MM-dd, else NULL."""
    return let(
        as_col(col), lambda c: F.when(_parse_iso(c).isNotNull(), c).otherwise(_text_date(c))
    )


def _duration_seconds(c: Column) -> Column:
    """Sum over the "number unit" pairs of a text."""

    def seconds(pair: Column) -> Column:
        def factor(unit: Column) -> Column:
            out = F
            for name, value in UNIT_SECONDS.items():
                out = out.when(unit.rlike(f"^{name}s?$"), F.lit(value))
            return out

        unit = F.lower(F.regexp_extract(pair, "[A-Za-z]+", 0))
        return F.regexp_extract(pair, r"\d+", 0).cast("long") * let(unit, factor)

    pairs = F.regexp_extract_all(c, F.lit(r"\d{1,9}\s*[A-Za-z]+"), F.lit(0))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, x: acc + seconds(x))


def format_seconds(seconds: Column) -> Column:
    """Seconds -> canonical ISO duration, ``P0D`` for zero."""

    def part(value: Column, unit: str) -> Column:
        return F.when(value > 0, F.concat(value.cast("string"), F.lit(unit))).otherwise("")

    days, rest = F.floor(seconds / 86400), seconds % 86400
    time = F.concat(
        part(F.floor(rest / 3600), "H"),
        part(F.floor(rest % 3600 / 60), "M"),
        part(rest % 60, "S"),
    )
    body = F.concat(part(days, "D"), F.when(time != "", F.concat(F.lit("T"), time)).otherwise(""))
    return F.when(seconds == 0, "P0D").otherwise(F.concat(F.lit("P"), body))


def iso_duration(col: Column | str) -> Column:
    """A valid ISO duration as it stands, else "1 hour 30 minutes" as PT1H30M, else NULL."""

    def from_text(text: Column) -> Column:
        return F.when(
            text.rlike(TEXT_DURATION), let(_duration_seconds(text), format_seconds)
        )

    return let(
        as_col(col),
        lambda c: F.when(c.rlike(ISO_DURATION), c).otherwise(let(strip_edges(c), from_text)),
    )


def parse_iso_duration(col: Column | str) -> Column:
    """ISO duration -> INTERVAL DAY TO SECOND; NULL when invalid or with years or months,
    whose length in days is not fixed."""
    return let(as_col(col), _interval)


def _interval(c: Column) -> Column:
    def num(group: int) -> Column:
        text = F.replace(_pick(c, ISO_DURATION, group), F.lit(","), F.lit("."))
        return F.coalesce(text.cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))

    seconds = num(4) * 604800 + num(5) * 86400 + num(6) * 3600 + num(7) * 60 + num(8)
    signed = F.when(_pick(c, ISO_DURATION, 1) == "-", -seconds).otherwise(seconds)
    fixed = c.rlike(ISO_DURATION) & _pick(c, ISO_DURATION, 2).isNull() & _pick(c, ISO_DURATION, 3).isNull()
    zero = F.lit(0)
    return F.when(fixed, F.make_dt_interval(zero, zero, zero, signed.cast("decimal(18,6)")))
