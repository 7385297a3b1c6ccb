"""Grading rules of the question format: exact, set, numeric, expression, rubric."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.text import compact, trim_u


def normalized(c: Column, trim: bool = True, case_sensitive: bool = True, collapse: bool = False) -> Column:
    out = trim_u(c) if trim else c
    out = compact(out) if collapse else out
    return out if case_sensitive else F.lower(out)


def exact(answer: Column, accepted: Column, **how) -> Column:
    """Whether any accepted value equals the answer."""
    return F.coalesce(F.array_contains(F.transform(accepted, lambda x: normalized(x, **how)), normalized(answer, **how)), F.lit(False))


def set_score(answer: Column, expected: Column, points: float = 1.0, partial: bool = True) -> Column:
    """All of the set, or the share of right ones less wrong ones."""
    a, e = F.array_distinct(answer), F.array_distinct(expected)
    right, wrong = F.size(F.array_intersect(a, e)), F.size(F.array_except(a, e))
    whole = (right == F.size(e)) & (wrong == 0)
    share = F.least(F.greatest((right - wrong) / F.greatest(F.size(e), F.lit(1)), F.lit(0.0)), F.lit(1.0))
    return share * points if partial else F.when(whole, F.lit(points)).otherwise(F.lit(0.0))


def numeric(answer: Column, expected: Column, absolute: float = 0.0, relative: float = 0.0) -> Column:
    """Within either tolerance; what is no number is wrong."""
    a = answer.try_cast("double")
    off = F.abs(a - expected)
    return F.coalesce((off <= absolute) | (off <= relative * F.abs(expected)), F.lit(False))


def expression(answer: Column, expected: Column) -> Column:
    """Equal text without white space; null where a computer algebra service must decide."""
    same = F.regexp_replace(answer, r"(?U)\s+", "") == F.regexp_replace(expected, r"(?U)\s+", "")
    return F.when(same, F.lit(True))


def rubric(awarded: Column, maxima: Column) -> Column:
    """Points of the criteria, each within its own bounds."""
    own = F.zip_with(awarded, maxima, lambda a, m: F.least(F.greatest(F.coalesce(a, F.lit(0.0)), F.lit(0.0)), m))
    return F.aggregate(own, F.lit(0.0), lambda n, x: n + x)


def delivered(columns: list[str]) -> list[str]:
    """What a learner may see: all but the key."""
    return [c for c in columns if c not in ("answer_key", "answerKey")]
