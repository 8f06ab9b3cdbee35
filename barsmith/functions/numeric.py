"""Return / growth column expressions.

Division happens only behind a positive-denominator guard: with ANSI mode on a
zero denominator raises instead of giving NULL."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_change(start: Column, end: Column) -> Column:
    return (end - start) / start


def percent(ratio: Column, digits: int = 4) -> Column:
    return F.round(ratio * 100, digits)


#: 2 ** 27 + 1 splits a double into two of 26 bits
SPLIT = 134217729.0


def _halves(a: Column) -> tuple[Column, Column]:
    high = SPLIT * a - (SPLIT * a - a)
    return high, a - high


def _times(a: Column, b: Column) -> tuple[Column, Column]:
    """``a * b`` as a rounded product and what rounding took, without error."""
    (a1, a2), (b1, b2), p = _halves(a), _halves(b), a * b
    return p, ((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2


def refined_root(x: Column, start: Column, n: int) -> Column:
    """The double nearest to the n-th root of ``x``, from a ``start`` that is a
    few units in the last place off at most.

    One Newton step whose remainder ``x - start ** n`` is carried in two doubles
    (some 100 bits), so that only the last addition rounds.  Only sums, products
    and one quotient of doubles are used, which every IEEE machine computes
    alike: the result does not hang on a platform's ``pow``."""

    def root(s: Column) -> Column:
        v, y = s["x"], s["y"]

        def times_y(acc: Column, _: Column) -> Column:
            # bound to names, or the expression would double with every use
            p, e = _times(acc["hi"], y)
            return F.transform(F.array(F.struct(p.alias("p"), (e + acc["lo"] * y).alias("e"))),
                               lambda t: F.struct((t["p"] + t["e"]).alias("hi"), (t["e"] - ((t["p"] + t["e"]) - t["p"])).alias("lo")))[0]

        one = F.struct(y.alias("hi"), F.lit(0.0).alias("lo"))
        power = F.aggregate(F.sequence(F.lit(2), F.lit(n)), one, times_y) if n > 1 else one
        slope = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), F.lit(float(n)), lambda acc, _: acc * y) if n > 1 else F.lit(1.0)
        return F.transform(F.array(power), lambda q: y + ((v - q["hi"]) - q["lo"]) / slope)[0]

    bound = F.transform(F.array(F.struct(x.cast("double").alias("x"), start.cast("double").alias("y"))), root)[0]
    # beyond these a product of halves could leave the range of doubles
    return F.when(x.between(1e-250, 1e250), bound).otherwise(start)


def nth_root(x: Column, n: int) -> Column:
    return refined_root(x, F.pow(x, F.lit(1.0 / n)), n)


def compound_growth(start: Column, end: Column, periods: int) -> Column:
    """Per-period compound growth ``(end/start)^(1/periods) - 1``, the root
    correctly rounded."""
    return nth_root(end / start, periods) - F.lit(1.0)
