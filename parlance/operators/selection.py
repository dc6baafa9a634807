"""Order statistics by refining histograms: exact ranks of many columns at once, without a sort.

Every wanted rank has an interval of values that is known to hold it, at first from the smallest to the largest
value. One pass cuts all intervals of all columns into equal parts, and counts for each part its rows
and its own smallest and largest value; the part in which a rank falls is its next interval. Parts
need not be cut exactly, only in order, so their number is computed in doubles, while bounds and comparisons
stay in the column's own type: 64-bit integers and decimals of 38 digits are exact. The ends of an
interval are parts of their own, so every pass makes progress; some thousand parts a pass find one row
among billions in three or four.

Whatever the table's size, a pass shuffles at most ``PARTS`` counts per task and brings as many to the driver. A value
that a third of the rows hold is one count per task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from decimal import Context, Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.session import freeze

PARTS = 1 << 14
STALLED = 16  # a part that keeps more than one row in so many is cut differently the next time
_PREFIX = 6  # bytes of a text that one pass tells apart
_HUGE = 1e307
EXACT = Context(prec=80)  # sums and halves of two decimals of 38 digits


def ordinal(df: DataFrame, name: str) -> Column:
    """The column as a number or text of the same order; NULL and NaN as NULL."""
    col, kind = F.col("`" + name.replace("`", "``") + "`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col.cast("double"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return col.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, (T.DecimalType, T.StringType)):
        return col
    raise TypeError(f"{name}: no order statistics of {kind.simpleString()}")


@dataclass
class Interval:
    """Values from ``low`` to ``high`` of a column, ``n`` rows; ``rank`` counts from the first of them."""

    column: str
    rank: int
    n: int
    low: Any
    high: Any
    spread: bool = False  # cut by sign or by magnitude this time

    @property
    def found(self) -> Any:
        """The value at the rank, if it is settled."""
        if self.low == self.high or self.rank == 0:
            return self.low
        return self.high if self.rank == self.n - 1 else None


def _share(of: Column, whole: float, parts: int) -> Column:
    return F.least(F.lit(parts - 1), F.greatest(F.lit(0), F.floor(of / F.lit(whole) * F.lit(float(parts))).cast("int")))


def _sign_part(x: Column, zero: Column) -> Column:
    return F.when(x < zero, 0).when(x == zero, 1).otherwise(2)


def _text_place(x: Column, shared: int) -> Column:
    """The bytes behind the first ``shared`` ones as a number that keeps their order; an end comes before every byte."""
    rest = F.substring(x.cast("binary"), shared + 1, _PREFIX)
    return F.conv(F.rpad(F.hex(rest), 2 * _PREFIX, "0"), 16, 10).cast("double") * F.lit(_PREFIX + 1.0) + F.octet_length(rest)


def _text_number(x: str, shared: int) -> float:
    rest = x.encode()[shared : shared + _PREFIX]
    return int.from_bytes(rest.ljust(_PREFIX, b"\0"), "big") * float(_PREFIX + 1) + len(rest)


def _part(x: Column, at: Interval, parts: int) -> Column:
    """The number of the part that a value of the interval lies in; the two ends are parts of their own."""
    return F.when(x == F.lit(at.low), -1).when(x == F.lit(at.high), parts).otherwise(_inner_part(x, at, parts))


def _inner_part(x: Column, at: Interval, parts: int) -> Column:
    low, high = at.low, at.high
    if isinstance(low, str):
        a, b = low.encode(), high.encode()
        shared = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        first = _text_number(low, shared)
        return _share(_text_place(x, shared) - F.lit(first), _text_number(high, shared) - first, parts)
    if isinstance(low, float):
        if math.isinf(low) or math.isinf(high):
            return F.lit(0)
        if at.spread and low < 0 < high:
            return _sign_part(x, F.lit(0.0))
        if at.spread and low > 0 and math.log(high) > math.log(low):
            return _share(F.ln(x) - F.lit(math.log(low)), math.log(high) - math.log(low), parts)
        if at.spread and high < 0 and math.log(-low) > math.log(-high):
            return _share(F.lit(math.log(-low)) - F.ln(-x), math.log(-low) - math.log(-high), parts)
        return _linear(x, at, parts)
    span = EXACT.subtract(Decimal(high), Decimal(low))
    if isinstance(low, Decimal):
        if low < 0 < high and EXACT.scaleb(span, -low.as_tuple().exponent) >= Decimal(10) ** 38:
            return _sign_part(x, F.lit(0))  # the difference might not fit 38 digits
        return _share((x - F.lit(low)).cast("double"), float(span), parts)
    wide = x.cast("decimal(38,0)") if span >= 1 << 62 else x
    return _share((wide - F.lit(low)).cast("double"), float(span), parts)


def _linear(x: Column, at: Interval, parts: int) -> Column:
    scale = 0.5 if max(abs(at.low), abs(at.high)) > _HUGE else 1.0
    return _share(x * F.lit(scale) - F.lit(at.low * scale), at.high * scale - at.low * scale, parts)


def _pass(values: DataFrame, open_: list[Interval]) -> dict[int, list]:
    """Rows (part, n, low, high) of every open interval, in order."""
    parts = max(16, PARTS // len(open_))
    kinds = {f.name: f.dataType for f in values.schema}
    held = sorted({kinds[i.column].simpleString() for i in open_})
    entries = []
    for k, at in enumerate(open_):
        x = F.col(f"`{at.column}`")
        inside = x.between(F.lit(at.low), F.lit(at.high))
        own = kinds[at.column].simpleString()
        entries.append(F.struct(
            F.lit(k).alias("k"), F.when(inside, _part(x, at, parts)).alias("part"),
            *[(x if kind == own else F.lit(None).cast(kind)).alias(f"v{j}") for j, kind in enumerate(held)]))
    rows = values.select(F.inline(F.filter(F.array(*entries), lambda e: e["part"].isNotNull())))
    bounds = [f(f"v{j}").alias(f"{name}{j}") for j in range(len(held)) for name, f in (("low", F.min), ("high", F.max))]
    found: dict[int, list] = {}
    for row in rows.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n"), *bounds).collect():
        j = held.index(kinds[open_[row["k"]].column].simpleString())
        found.setdefault(row["k"], []).append((row["part"], row["n"], row[f"low{j}"], row[f"high{j}"]))
    return {k: sorted(rows, key=lambda r: r[0]) for k, rows in found.items()}


def _refined(at: Interval, parts: list) -> Interval:
    rank = at.rank
    for _, n, low, high in parts:
        if rank < n:
            return replace(at, rank=rank, n=n, low=low, high=high, spread=not at.spread and n * STALLED > at.n)
        rank -= n
    raise RuntimeError(f"{at.column}: the table changed while its ranks were sought")


def select_ranks(df: DataFrame, columns: dict[str, Column], wanted: Callable[[str, int, int], list[int]]) -> dict[str, list]:
    """Column to its values at the wanted 0-based ranks, in ascending order of its present values.

    ``wanted`` is given a column's name, its present values and all rows, and answers with ranks; ranks that no value has give
    None. All columns are refined in the same passes over ``df``, which is read once for the bounds and some two or
    three times more; hand it over written if it is expensive.
    """
    names = {name: f"c{i}" for i, name in enumerate(columns)}
    values = df.select(*[columns[name].alias(c) for name, c in names.items()])
    if not names:
        return {}
    facts = values.agg(F.count(F.lit(1)).alias("rows"), *[
        f(c).alias(f"{at}_{c}") for c in names.values() for at, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    answers: dict[str, list] = {}
    open_: dict[tuple[str, int], Interval] = {}
    for name, c in names.items():
        n, low, high = facts[f"n_{c}"], facts[f"low_{c}"], facts[f"high_{c}"]
        ranks = wanted(name, n, facts["rows"])
        answers[name] = [None] * len(ranks)
        for i, rank in enumerate(ranks):
            if 0 <= rank < n:
                open_[name, i] = Interval(c, rank, n, low, high)
    while True:
        for key in [key for key, at in open_.items() if at.found is not None]:
            at = open_.pop(key)
            answers[key[0]][key[1]] = at.found
        if not open_:
            return answers
        # Ranks that lie in one interval share its histogram.
        shared: dict[tuple, list] = {}
        for key, at in open_.items():
            shared.setdefault((at.column, at.low, at.high, at.spread), []).append(key)
        parts = _pass(values, [open_[keys[0]] for keys in shared.values()])
        for k, keys in enumerate(shared.values()):
            for key in keys:
                open_[key] = _refined(open_[key], parts[k])


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | Decimal | None]:
    """Exact medians of numeric columns, all in the same passes; None without a value.

    The mean of the two middle values is a double for doubles and floats, and exact otherwise, as a Decimal.
    """
    middle = lambda name, n, rows: [(n - 1) // 2, n // 2]
    found = select_ranks(df, {c: ordinal(df, c) for c in columns}, middle)
    return {c: None if low is None else _mean(low, high) for c, (low, high) in found.items()}


def _mean(low: Any, high: Any) -> float | Decimal:
    if isinstance(low, float):
        large = max(abs(low), abs(high)) > _HUGE
        return low if low == high else low / 2 + high / 2 if large else (low + high) / 2
    return EXACT.divide(EXACT.add(Decimal(low), Decimal(high)), Decimal(2))


MISSING = None


def cut_off(df: DataFrame, order: list[tuple[str, bool]], size: Callable[[int], int]) -> list[Any] | bool:
    """The last row, by its ordinals, among the first ``size(rows)`` in a given order; missing values come last.

    One column after the other: a value is found by its rank, and only if the rows that share it are not all
    inside, they are ranked by the next column. The list may so be shorter than the order: rows equal in it
    are inside. True if all rows are inside, False if none is. A MISSING entry stands for rows without a value.
    The ordinals alone are written once, so that no pass computes the table again.
    """
    rows = df.select(*[ordinal(df, c).alias(f"o{i}") for i, (c, _) in enumerate(order)])
    rows = freeze(rows)
    found: list[Any] = []
    left: int | None = None
    for i, (_, ascending) in enumerate(order):
        known: list[int] = []

        def wanted(_: str, present: int, total: int) -> list[int]:
            need = max(0, min(total, size(total))) if left is None else left
            known[:] = [present, total, need]
            return [] if need in (0, total) or need > present else [need - 1 if ascending else present - need]

        value = select_ranks(rows, {f"o{i}": F.col(f"o{i}")}, wanted)[f"o{i}"]
        present, total, left = known
        if left == total:
            return found or True
        if left == 0:
            return False
        if value:
            x = F.col(f"o{i}")
            before, equal = rows.agg(F.count_if(x < F.lit(value[0]) if ascending else x > F.lit(value[0])), F.count_if(x == F.lit(value[0]))).first()
            found.append(value[0])
            left -= before
            if left == equal:
                return found
            rows = rows.where(x == F.lit(value[0]))
        else:
            found.append(MISSING)
            left -= present
            rows = rows.where(F.col(f"o{i}").isNull())
    return found


def inside(df: DataFrame, order: list[tuple[str, bool]], last: list[Any] | bool) -> Column:
    """Whether a row comes no later than the cut-off row that was found."""
    if isinstance(last, bool):
        return F.lit(last)
    within = F.lit(True)
    for (name, ascending), value in reversed(list(zip(order, last))):
        x = ordinal(df, name)
        if value is MISSING:
            within = x.isNotNull() | within
        else:
            within = F.coalesce(x < F.lit(value) if ascending else x > F.lit(value), F.lit(False)) | (x.eqNullSafe(F.lit(value)) & within)
    return within
