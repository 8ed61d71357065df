"""SQL over arrays without appending to one: running sums and extremes in rounds of doubling distance."""

from __future__ import annotations


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(values: str, pick: str, at: str, within: str) -> str:
    """An array whose items are joined with all before (or behind) them."""
    return f"""aggregate(sequence(0, int(ceil(log2(greatest(size({values}), 1))))), {values},
        (acc, k) -> transform(acc, (v, i) -> CASE WHEN {within} THEN {pick.format(f'acc[{at}]')} ELSE v END))"""


def sums(values: str) -> str:
    return _running(values, "v + {}", "i - shiftleft(1, k)", "i >= shiftleft(1, k)")


def highest(values: str) -> str:
    return _running(values, "greatest(v, {})", "i - shiftleft(1, k)", "i >= shiftleft(1, k)")


def lowest_behind(values: str) -> str:
    return _running(values, "least(v, {})", "i + shiftleft(1, k)", "i + shiftleft(1, k) < size(acc)")


def below(values: str, limit: str) -> str:
    """How many items of a sorted array are less than the limit, by halving."""
    return f"""aggregate(sequence(0, int(ceil(log2(size({values}) + 1)))), struct(0 AS a, size({values}) AS b),
        (acc, k) -> CASE WHEN acc.a >= acc.b THEN acc
          WHEN {values}[int((acc.a + acc.b) div 2)] < {limit} THEN struct(int((acc.a + acc.b) div 2) + 1 AS a, acc.b AS b)
          ELSE struct(acc.a AS a, int((acc.a + acc.b) div 2) AS b) END,
        acc -> acc.a)"""


def matches(text: str, pattern: str, item: str) -> str:
    """An array of the item for all matches of a quoted pattern, which names m, the match, ends[i], where it ends
    in code points, and x.g[i] and x.g[i + 1], the texts between it and its neighbours.

    The gaps come from splitting at the same matches.
    """
    steps = "transform(x.m, (m, i) -> length(x.g[i]) + length(m))"
    return f"""
        transform(array(struct(split({text}, {pattern}, -1) AS g, regexp_extract_all({text}, {pattern}, 0) AS m)), x ->
          transform(array({sums(steps)}), ends -> transform(x.m, (m, i) -> {item}))[0])[0]"""
