"""Column expressions: predicates, samples, ID handling and array scores."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
GRID = 10_000


def _day(text: str) -> date:
    return date.fromisoformat(text)


def period(start: str, end: str) -> Column:
    """Partition predicate of one period: whole months, the last one up to its day. Keys are zero-padded strings."""
    a, b = _day(start), _day(end)
    if a.year != b.year or a.day != 1 or b < a:
        raise ValueError(f"a period starts on the 1st and ends later in its year: {start}:{end}")
    whole = [f"{m:02d}" for m in range(a.month, b.month)]
    last = (F.col("month") == f"{b.month:02d}") & (F.col("day").cast("int") <= b.day)
    return (F.col("year") == str(a.year)) & (F.col("month").isin(whole) | last if whole else last)


def periods(spans: list[tuple[str, str]]) -> Column:
    return reduce(or_, (period(a, b) for a, b in spans))


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Closed intervals of ISO dates that share a day."""
    return (start_a <= end_b) & (start_b <= end_a)


def period_key(spans: list[tuple[str, str]]) -> str:
    return "+".join(f"{a}_{b}" for a, b in sorted(spans))


def not_blank(c: Column) -> Column:
    """Neither null nor white space alone, tabs included."""
    return c.isNotNull() & c.cast("string").rlike("\\S")


def is_uuid(c: Column) -> Column:
    return c.rlike(UUID)


def in_region(c: Column, region: str) -> Column:
    if not re.fullmatch("[A-Z]{2}", region):
        raise ValueError(f"a region is two capital letters: {region}")
    return c.startswith(region)


def is_android(c: Column) -> Column:
    """A purely numeric OS version."""
    return c.rlike("^[0-9]+$")


def allowed(consent: Column, limited: Column) -> Column:
    """Consent given, and tracking not limited (null: not limited)."""
    return (consent.cast("string") == "1") & (limited.isNull() | (limited.cast("string") != "1"))


def hash_sample(c: Column, percent: float, salt: str = "") -> Column:
    """A stable share of IDs on a 0.01 % grid. crc32 is unsigned, so the remainder is never negative."""
    if not 0 < percent <= 100 or not re.fullmatch("[A-Za-z0-9_-]*", salt):
        raise ValueError("0 < percent <= 100, and a plain salt")
    key = F.concat(c, F.lit(f":{salt}")) if salt else c
    return F.pmod(F.crc32(key.cast("binary")), F.lit(GRID)) < round(percent * 100)


def gender_score(ids: Column, weights: dict[str, float]) -> Column:
    """The mean weight of the IDs that have one; 0 without any, null for null."""
    pairs = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    known = F.filter(F.transform(ids, lambda x: pairs[x]), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(known) == 0, 0.0).otherwise(total / F.size(known))


def first_id(joined: Column) -> Column:
    """The first of ``;``-joined IDs; null for blank or null."""
    first = F.get(F.split(joined, ";"), F.lit(0))
    return F.when(F.trim(first) != "", F.trim(first))


def last_items(a: Column, most: int) -> Column:
    """The last ``most`` items of an array."""
    return F.slice(a, F.greatest(F.lit(1), F.size(a) - most + 1), F.lit(most))


def plain_number(c: Column) -> Column:
    """A number as text, whole ones without a fraction; NaN is null."""
    return F.when(F.isnan(c), None).when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def path_text(*parts: Column, separator: str = ">") -> Column:
    """Parts joined without blank ones."""
    return F.concat_ws(separator, *[F.when(F.trim(p) != "", F.trim(p)) for p in parts])


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
