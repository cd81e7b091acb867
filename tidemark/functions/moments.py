"""Statistics rebuilt from sums that merge in any order.

A measure ``m`` travels as ``m_n`` rows with a value, ``m_s`` sum, ``m_lo`` and ``m_hi``
bounds, ``m_w`` recency-weighted sum (and ``m_wn``, the weights themselves, where means are
normalised by them) and, for the deviation, ``m_d`` and ``m_q``: the sums of the differences from
a centre and of their squares. Rows first give the squares about their own mean; ``centred``
moves them to a centre that all parts of a user share, so tight values far from zero keep
their digits.
Sums of these over event groups, age bands or salted parts of a user give the same
statistic, so no step needs all rows of a group at once.

Wide aggregate lists are written as SQL text, one expression per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("n", "s", "q", "d", "lo", "hi", "w")
_MERGE = {"lo": "min", "hi": "max"}


def quoted(name: str) -> str:
    return f"`{name}`"


def first_parts(name: str, value: str | None = None) -> list[Column]:
    """Parts of plain rows; the weighted sum comes later, when the age is known."""
    v = value or quoted(name)
    return [
        F.expr(f"count({v}) AS `{name}_n`"),
        F.expr(f"sum({v}) AS `{name}_s`"),
        F.expr(f"var_pop({v}) * count({v}) AS `{name}_q`"),
        F.expr(f"min({v}) AS `{name}_lo`"),
        F.expr(f"max({v}) AS `{name}_hi`"),
    ]


def centred(name: str, centre: str) -> dict[str, Column]:
    """``d`` and ``q`` about ``centre``, from the sum and the squares about the own mean."""
    n, s, q = (f"`{name}_{p}`" for p in "nsq")
    gap = f"({s} - {n} * {centre})"
    return {f"{name}_d": F.expr(gap), f"{name}_q": F.expr(f"{q} + try_divide({gap} * {gap}, {n})")}


def merged_parts(name: str, parts=PARTS) -> list[Column]:
    return [F.expr(f"{_MERGE.get(p, 'sum')}(`{name}_{p}`) AS `{name}_{p}`") for p in parts]


def whole(name: str) -> bool:
    """Whether a measure is a count."""
    return name.endswith(("active_days", "watch_nums", "g_vid"))


def whole_sum(value: str, times: str) -> str:
    """SQL of the exact sum of products of counts, which may pass what a long holds.

    High and low bits of the value are summed as longs and joined once per group: decimals only there.
    """
    high, low = f"sum(shiftright({value}, 20) * {times})", f"sum(({value} & 1048575L) * {times})"
    return f"(CAST({high} AS DECIMAL(19,0)) * 1048576 + CAST({low} AS DECIMAL(19,0)))"


def repeated_parts(name: str, value: str, times: str, weight: str, parts, centre: str = "0") -> list[Column]:
    """Parts of a value that stands for ``times`` rows of total weight ``weight``; squares are about ``centre``."""
    ways = {
        "n": f"sum(if({value} IS NOT NULL, {times}, NULL))",
        "s": whole_sum(value, times) if whole(name) else f"sum({value} * {times})",
        "q": f"sum(1.0D * ({value} - {centre}) * ({value} - {centre}) * {times})",
        "d": f"sum(1.0D * ({value} - {centre}) * {times})",
        "lo": f"min({value})",
        "hi": f"max({value})",
        "w": f"sum({value} * {weight})",
        "wn": f"sum(if({value} IS NOT NULL, {weight}, NULL))",
    }
    return [F.expr(f"{ways[p]} AS `{name}_{p}`") for p in parts]


# what each statistic is rebuilt from
NEEDS = {
    "mean": {"n", "s"}, "std": {"n", "q", "d", "lo", "hi"}, "min": {"lo"}, "max": {"hi"},
    "sum": {"s"}, "w95": {"n", "w"},
}


def needed(stats, normalized: bool = False) -> list[str]:
    used = set().union(*(NEEDS[s] for s in stats))
    if normalized and "w" in used:
        used.add("wn")
    return [p for p in (*PARTS, "wn") if p in used]


def statistic(stat: str, name: str, normalized: bool = False) -> str:
    """SQL of one statistic over merged parts."""
    n, s, q, d, lo, hi, w, wn = (f"`{name}_{p}`" for p in (*PARTS, "wn"))
    if stat == "std":
        # equal bounds mean equal values: the deviation is zero without rounding noise
        spread = f"greatest({q} - {d} * {d} / {n}, 0D) / ({n} - 1)"
        return f"CASE WHEN {n} > 1 THEN if({lo} = {hi}, 0D, sqrt({spread})) END"
    return {
        "mean": f"try_divide(CAST({s} AS DOUBLE), {n})",
        "w95": f"try_divide({w}, {wn if normalized else n})",
        "min": lo, "max": hi, "sum": f"CAST({s} AS BIGINT)" if whole(name) else s,
    }[stat]


def distinct_with_null(value: Column) -> Column:
    """Exact distinct count in which NULL is one more value."""
    return F.count_distinct(value) + F.max(value.isNull().cast("int"))
