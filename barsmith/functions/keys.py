"""Order-preserving keys of fixed width.

``min_by`` over a struct can't aggregate by hash: Spark updates a hash
aggregate's buffer in place, and a struct has no fixed place there.  A
DECIMAL(38,0) has one and holds 126 bits, so several non-negative integers
packed side by side order like the struct of them and stay in a hash aggregate.
"""
from __future__ import annotations

from collections.abc import Sequence

KEY_BITS = 126


def packed_key(fields: Sequence[tuple[str, int]]) -> str:
    """SQL text of one DECIMAL(38,0) that orders like the struct of ``fields``,
    which are (SQL text of an integer, its bits), the most significant first.

    A field that is negative or wider than its bits stops the query rather than
    order wrongly.  NULL in a field gives a NULL key, which ``min_by`` ignores."""
    if sum(bits for _, bits in fields) > KEY_BITS:
        raise ValueError(f"the fields take more than {KEY_BITS} bits")
    # two longs of at most 63 bits each keep the work on decimals to one step
    halves: list[list[tuple[str, int]]] = [[]]
    for sql, bits in fields:
        if sum(b for _, b in halves[-1]) + bits > 63:
            halves.append([])
        halves[-1].append((sql, bits))

    def as_long(part: list[tuple[str, int]]) -> str:
        out = ""
        for sql, bits in part:
            out = f"({out} * {1 << bits}L + {sql})" if out else f"cast({sql} as bigint)"
        return out

    key = f"cast({as_long(halves[0])} as decimal(38,0))"
    for part in halves[1:]:
        key = f"cast({key} * {1 << sum(b for _, b in part)} + {as_long(part)} as decimal(38,0))"
    fits = " and ".join(f"{sql} >= 0 and {sql} < {1 << bits}L" for sql, bits in fields if bits < 63)
    return f"case when {fits} then {key} when not ({fits}) then raise_error('a field does not fit its part of the key') end"
