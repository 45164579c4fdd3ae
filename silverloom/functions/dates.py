"""Date and time expressions: tolerant parsing, month arithmetic, contract roll-forward."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date formats in the order in which they are tried.
FORMATS = ["yyyy-M-d", "d/M/yyyy", "d.M.yyyy", "d/M/yy", "d.M.yy"]
#: Steps of the notice roll-forward at most.
STEPS = 120


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 with or without offset, at least a whole date; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def parse_date(text: Column) -> Column:
    """A date in one of FORMATS, cut at ',', ';' or ' then'; impossible days are clamped to the month's end.

    What fits no format is a date only if it is three whole numbers between '/', '.' or '-'. Years
    of two digits are 1969 to 2068 in a format, 2000 to 2099 where a day is clamped.
    """

    def whole(x: Column) -> Column:
        """The date of three numbers, its day clamped."""
        year_first = x["a"] > 31
        y, m, d = F.when(year_first, x["a"]).otherwise(x["c"]), x["b"], F.when(year_first, x["c"]).otherwise(x["a"])
        return _bound(clamped, y=F.when(y < 100, y + 2000).otherwise(y), m=m, d=d)

    def clamped(x: Column) -> Column:
        fits = x["m"].between(1, 12) & (x["y"] > 1900) & (x["y"] < 10000) & (x["d"] >= 1)
        first = F.make_date(F.when(fits, x["y"]), F.when(fits, x["m"]), F.lit(1))
        return F.date_add(first, F.least(x["d"], F.day(F.last_day(first))) - 1)

    def of(x: Column) -> Column:
        head = x["head"]
        exact = [F.try_to_timestamp(head, F.lit(f)).cast("date") for f in FORMATS]
        exact = F.coalesce(*[F.when(F.year(e) >= 2069, F.add_months(e, -1200)).otherwise(e) if f.endswith("/yy") or f.endswith(".yy") else e for e, f in zip(exact, FORMATS)])
        parts = F.split(head, r"[/.\-]")
        a, b, c = (F.when(F.size(parts) == 3, F.trim(F.get(parts, F.lit(i)))).try_cast("int") for i in range(3))
        return F.when(head.rlike(r"\d"), F.coalesce(exact, _bound(whole, a=a, b=b, c=c)))

    return _bound(of, head=F.trim(F.regexp_replace(text, r"(?s)([,;]|\s+then\b).*$", "")))


def month_boundaries(a: Column, b: Column) -> Column:
    """Calendar month boundaries between two dates."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def complete_months(a: Column, b: Column) -> Column:
    """Whole calendar months from a to b, negative if b is before a."""
    m = month_boundaries(a, b)
    forward = m - F.when(F.add_months(a, m) > b, 1).otherwise(0)
    back = m + F.when(F.add_months(a, m) < b, 1).otherwise(0)
    return F.when(b >= a, forward).otherwise(back)


def renewal_delta(start: Column, end: Column, category: Column) -> tuple[Column, Column]:
    """(months, days) by which a contract renews: one month, or its own duration."""
    months = complete_months(start, end)
    days = F.datediff(end, F.add_months(start, months))
    monthly = category == "monthly"
    return F.when(monthly, 1).otherwise(months), F.when(monthly, 0).otherwise(days)


def moved(end: Column, months: Column, k: Column) -> Column:
    """end moved on k times by so many months, clamped to month ends on the way.

    A day up to the 28th stays; a later one falls to the least last day of the months that are met,
    which is found within 48 moves, since months and leap years repeat after them (dates from 1901 to 2099).
    """
    first = F.trunc(end, "MM")
    last = F.transform(F.sequence(F.lit(1), F.least(k, F.lit(48))), lambda i: F.day(F.last_day(F.add_months(first, (months * i).cast("int")))))
    kept = F.when(F.day(end) <= 28, F.day(end)).otherwise(F.least(F.day(end), F.array_min(last)))
    return F.when(k <= 0, end).otherwise(F.date_add(F.add_months(first, (months * k).cast("int")), kept - 1))


def jumped(end: Column, months: Column, days: Column, until: Column, most: Column | None = None) -> Column:
    """As rolled() with enough steps, or `most` of them, where either months or days is 0: by arithmetic, however far."""
    limit = (lambda k: k) if most is None else (lambda k: F.least(k, most))
    by_days = F.date_add(end, (days * limit(F.ceil(F.greatest(F.lit(0), F.datediff(until, end)) / F.greatest(days, F.lit(1))))).cast("int"))
    whole = F.greatest(F.lit(0), F.ceil(month_boundaries(end, until) / F.greatest(months, F.lit(1)))).cast("int")
    need = F.when(end >= until, 0).when(moved(end, months, whole) >= until, whole).otherwise(whole + 1)  # month `whole` is until's or later
    return F.when(months == 0, by_days).otherwise(moved(end, months, limit(need)))


def rolled(end: Column, months: Column, days: Column, until: Column, steps: Column) -> Column:
    """end moved on step by step, clamped to month ends on the way, while before `until`."""
    move = lambda e, _: F.when(e < until, F.date_add(F.add_months(e, months), days)).otherwise(e)
    return F.aggregate(F.sequence(F.lit(1), steps), end, move)


def roll_forward(end: Column, months: Column, days: Column, as_of: Column) -> Column:
    """The first end on or after as_of; null if the delta isn't positive.

    Terms of whole months or of days alone are moved by arithmetic; those of both change the day
    with each step, and are stepped through: a step is a month or more.
    """

    def of(x: Column) -> Column:
        pace = 28 * x["months"] + x["days"]
        need = F.greatest(F.lit(0), F.datediff(x["until"], x["end"]))
        steps = 1 + F.ceil(need / F.greatest(F.lit(1), pace)).cast("int")
        own = x["end"], x["months"], x["days"], x["until"]
        return F.when(pace > 0, F.when(_plain(*own[1:3]), jumped(*own)).otherwise(rolled(*own, steps)))

    return _bound(of, end=end, months=months, days=days, until=as_of)


def _bound(of: Callable[[Column], Column], **values: Column) -> Column:
    """of() a struct of the values, each of which is computed once and named, so that expressions made of expressions stay small."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), of), F.lit(0))


def _plain(months: Column, days: Column) -> Column:
    return ((months == 0) & (days > 0)) | ((months > 0) & (days == 0))


def notice_end(end: Column, months: Column, days: Column, as_of: Column, notice: Column) -> Column:
    """The rolled end that leaves `notice` months from as_of, after STEPS steps at most."""

    def of(x: Column) -> Column:
        own = x["end"], x["months"], x["days"], x["until"]
        return F.when(_plain(*own[1:3]), jumped(*own, F.lit(STEPS))).otherwise(rolled(*own, F.lit(STEPS)))

    return _bound(of, end=end, months=months, days=days, until=F.add_months(as_of, notice))


def created_on(text: Column) -> Column:
    """'/Date(ms)/' or ISO; anything else is the earliest time."""
    ms = F.regexp_extract(text, r"/Date\((-?\d+)", 1)
    return F.coalesce(F.timestamp_millis(F.nullif(ms, F.lit("")).try_cast("bigint")), parse_timestamp(text), F.lit("0001-01-01").cast("timestamp"))
