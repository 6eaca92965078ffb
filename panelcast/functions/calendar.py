"""Calendar arithmetic on regular grids.

A grid of any frequency is handled through one integer, the *ordinal* of a
grid date.  Steps, gaps, lags and future dates are then integer arithmetic,
so no date table has to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Days after 1970-01-01 (a Thursday) of the first such weekday.
WEEK_ANCHOR = {"MON": 4, "TUE": 5, "WED": 6, "THU": 0, "FRI": 1, "SAT": 2, "SUN": 3}

# Lag lists by frequency, season lengths by frequency type.
LAG_PERIODS = {
    "D": [1, 2, 3, 4, 5, 6, 7, 30, 365],
    "W": [1, 2, 3, 4, 52],
    "M": [1, 2, 3, 12],
    "Q": [1, 2, 4],
    "Y": [1, 2, 3],
}
LAG_FALLBACK = [1, 2, 3, 4, 5]
SEASON_PERIODS = {
    "day": [7, 30, 120, 365],
    "week": [4, 12, 52],
    "month": [3, 12],
    "quarter": [4],
    "year": [1],
}
FREQ_TYPE = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
BAYES_SEASON = {"D": 365, "W": 52, "M": 12}
BAYES_SEASON_FALLBACK = 52


def base_freq(freq: str) -> str:
    """``W-MON``, ``w-sun`` and ``W`` are all weekly."""
    return freq.upper().split("-")[0]


def _anchor(freq: str) -> int:
    parts = freq.upper().split("-")
    return WEEK_ANCHOR[parts[1] if len(parts) > 1 else "SUN"]


def ordinal(ds: Column, freq: str) -> Column:
    """Number of the last grid point at or before ``ds``."""
    base = base_freq(freq)
    if base == "H":
        return F.datediff(ds.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ds)
    days = F.datediff(ds, F.lit("1970-01-01").cast("date"))
    if base == "D":
        return days
    if base == "W":
        return F.floor((days - _anchor(freq)) / 7).cast("int")
    months = F.year(ds) * 12 + F.month(ds) - 1
    complete = F.when(ds == F.last_day(ds), months).otherwise(months - 1)
    if base == "M":
        return complete
    if base == "Q":
        return F.floor((complete + 1) / 3).cast("int") - 1
    if base == "Y":
        return F.floor((complete + 1) / 12).cast("int") - 1
    raise ValueError(f"unknown frequency {freq!r}")


def grid_date(number: Column, freq: str) -> Column:
    """Date of a grid point; the inverse of :func:`ordinal` on the grid."""
    base = base_freq(freq)
    if base == "H":
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return start + F.make_dt_interval(F.lit(0), number.cast("int"))
    if base == "D":
        return F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int"))
    if base == "W":
        return F.date_add(F.lit("1970-01-01").cast("date"), (number * 7 + _anchor(freq)).cast("int"))
    width = {"M": 1, "Q": 3, "Y": 12}[base]
    months = number * width + (width - 1)
    return F.last_day(F.make_date(F.floor(months / 12).cast("int"),
                                  (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1)))


def ordinal_at_or_after(ds: Column, freq: str) -> Column:
    number = ordinal(ds, freq)
    return F.when(grid_date(number, freq) == ds, number).otherwise(number + 1)


def future_array(last: Column, steps: int | Column, freq: str) -> Column:
    """Array of the ``steps`` grid dates after ``last``."""
    start = ordinal(last, freq)
    steps = F.lit(steps) if isinstance(steps, int) else steps
    return F.transform(F.sequence(start + 1, start + steps), lambda n: grid_date(n, freq))


def bucket(ts: Column, freq: str) -> Column:
    """Grid label of the period a fact belongs to.

    Weeks and days are labelled by their start, longer periods by their end.
    """
    base = base_freq(freq)
    if base == "W":
        day = ts.cast("date")
        since = F.datediff(day, F.lit("1970-01-01").cast("date")) - _anchor(freq)
        return F.date_sub(day, F.pmod(since, F.lit(7)))
    if base in ("H", "D"):
        return grid_date(ordinal(ts if base == "H" else ts.cast("date"), freq), freq)
    return grid_date(ordinal_at_or_after(ts.cast("date"), freq), freq)


def calendar_columns(ds: Column) -> dict[str, Column]:
    """Month, weekday (Monday is 0), day of month, weekend flag."""
    day_of_week = F.weekday(ds)
    return {
        "month": F.month(ds).cast("int"),
        "day_of_week": day_of_week.cast("int"),
        "day_of_month": F.dayofmonth(ds).cast("int"),
        "is_weekend": (day_of_week >= 5).cast("int"),
    }


def lags_of(freq: str) -> list[int]:
    return LAG_PERIODS.get(base_freq(freq), LAG_FALLBACK)


def season_periods_of(freq: str) -> list[int]:
    return SEASON_PERIODS[FREQ_TYPE[base_freq(freq)]]


def _literal_map(values: dict) -> Column:
    pairs = []
    for key, value in values.items():
        pairs += [F.lit(key), F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)]
    return F.create_map(*pairs)


def _base_freq_column(freq: Column) -> Column:
    return F.element_at(F.split(F.upper(freq), "-"), 1)


def season_periods(freq_type: Column) -> Column:
    """Candidate season lengths of a frequency type."""
    return F.element_at(_literal_map(SEASON_PERIODS), freq_type)


def lag_periods(freq: Column) -> Column:
    """Lag list of a frequency, 1..5 where it is unknown."""
    return F.coalesce(F.element_at(_literal_map(LAG_PERIODS), _base_freq_column(freq)),
                      F.array(*[F.lit(v) for v in LAG_FALLBACK]))


def bayes_season_length(freq: Column) -> Column:
    return F.coalesce(F.element_at(_literal_map(BAYES_SEASON), _base_freq_column(freq)),
                      F.lit(BAYES_SEASON_FALLBACK))


# Strftime codes and the matching Spark pattern letters.
STRFTIME_TO_SPARK = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%p": "a", "%I": "hh",
}


def spark_pattern(strftime_format: str) -> str:
    """Spark datetime pattern of a strftime format."""
    out, i = "", 0
    while i < len(strftime_format):
        code = strftime_format[i:i + 2]
        if code in STRFTIME_TO_SPARK:
            out += STRFTIME_TO_SPARK[code]
            i += 2
            continue
        char = strftime_format[i]
        out += f"'{char}'" if char.isalpha() else char
        i += 1
    return out
