"""Column functions over dates, numbers and arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["domingo", "segunda", "terça", "quarta", "quinta", "sexta", "sábado"]
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]


def age_by_months(birth: Column, day: Column) -> Column:
    """Full years between two dates; where both are the last of their month a year is full, so the 29th of February turns on the 28th of a common year."""
    return F.floor(F.months_between(day, birth) / 12).cast("int")


def age_by_days(birth: Column, day: Column) -> Column:
    """Days over 365.25, rounded down."""
    return F.floor(F.datediff(day, birth) / 365.25).cast("int")


def latest_past(run_date: Column, *dates: Column) -> Column:
    """The greatest of the dates that don't lie after the run date; nulls are passed over."""
    return F.greatest(*(F.when(d <= run_date, d) for d in dates), F.lit(None).cast("date"))


def parse_date(c: Column, formats: tuple[str, ...] = ("yyyyMMdd", "ddMMyyyy", "yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "dd.MM.yyyy")) -> Column:
    """The first of several formats that fits; null for none."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats)).cast("date")


def weekday_name(c: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in WEEKDAYS)), F.dayofweek(c))


def month_name(c: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in MONTHS)), F.month(c))


def week_of_year(c: Column) -> Column:
    """Weeks of seven days counted from the first of January."""
    return F.floor((F.dayofyear(c) - 1) / 7).cast("int") + 1


def local_time(c: Column, zone: str = "America/Sao_Paulo") -> Column:
    """A UTC moment as wall-clock time of a zone, without zone."""
    return F.from_utc_timestamp(c, zone).cast("timestamp_ntz")


def clearance(creatinine: Column, age: Column, female: Column) -> Column:
    """Creatinine clearance; -2 where creatinine or age is missing or creatinine not positive; a null sex counts as not female."""
    a, female = age.cast("int"), F.coalesce(female, F.lit(False))
    base = 142 * F.when(female, F.pow(creatinine / 0.7, F.lit(-1.2))).otherwise(F.pow(creatinine / 0.9, F.lit(-1.2))) * F.pow(F.lit(0.9938), a)
    return F.when((creatinine <= 0) | creatinine.isNull() | a.isNull(), F.lit(-2.0)).otherwise(F.when(female, base * 1.012).otherwise(base))


def cockcroft_gault(creatinine: Column, age: Column, weight: Column, female: Column, height: Column) -> Column:
    """Over 16 years by weight, else by height."""
    adult = (140 - age) * weight / (72 * creatinine)
    return F.when(creatinine <= 0, None).when(age > 16, F.when(female, adult * 0.8).otherwise(adult)).otherwise(0.55 * height / creatinine)


def repaired_weight(w: Column) -> Column:
    """Weights typed without their point: between 10,000 and 100,000 by a thousand, above by ten thousand, other ones over 250 (100,000 itself too) by ten."""
    return F.when((w > 10_000) & (w < 100_000), w / 1000).when(w > 100_000, w / 10_000).when(w > 250, w / 10).otherwise(w)


def in_range(c: Column, low: float, high: float) -> Column:
    """Within limits after rounding to whole numbers, as a cast to ``numeric`` does."""
    return c.cast("decimal(10,0)").between(low, high)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one is all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def audit(*checks: tuple[Column, str]) -> Column:
    """The messages of the conditions that hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks)))


def first_of_type(items: Column, kind: str, value: str = "value", type_field: str = "type") -> Column:
    """The value of the first struct of a type; null for none."""
    return F.get(F.filter(items, lambda x: x[type_field] == kind), 0)[value]


def masked(c: Column, keys: list[str]) -> Column:
    """Values of the given keys in a JSON-like text are left out."""
    return F.regexp_replace(c, '(?i)("?(?:' + "|".join(keys) + ')"?\\s*[:=]\\s*)("[^"]*"|[^,;}\\s]+)', "$1[OMITIDO]")
