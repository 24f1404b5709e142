"""Small helpers that write DuckDB expressions and chain named subqueries."""

from __future__ import annotations

import re


class Chain:
    """Named subqueries; a statement gets exactly those it mentions, in order of definition."""

    def __init__(self) -> None:
        self.parts: dict[str, str] = {}

    def add(self, name: str, text: str) -> None:
        self.parts[name] = text

    def statement(self, body: str) -> str:
        needed: set[str] = set()
        pending = [body]
        while pending:
            words = set(re.findall(r"\w+", pending.pop()))
            for name in words & self.parts.keys() - needed:
                needed.add(name)
                pending.append(self.parts[name])
        chain = ", ".join(f"{n} AS ({self.parts[n]})" for n in self.parts if n in needed)
        return f"WITH {chain} {body}" if chain else body


def units(num: str, den: str, scale: int, up: int = 1, down: int = 1) -> str:
    """num/den * up/down, half away from zero, in whole units of 10^-scale."""
    n, d = f"(({num})::HUGEINT * {up})", f"(NULLIF(({den}), 0)::HUGEINT * {down})"
    return f"(sign({n})::HUGEINT * ((abs({n}) * {2 * 10**scale} + {d}) // (2 * {d})))"


def scaled(expr: str, scale: int) -> str:
    return f"(({expr})::DOUBLE / {10**scale}.0)"


def ratio(num: str, den: str, scale: int) -> str:
    return scaled(units(num, den, scale), scale)


def monthly_units(num: str, den: str) -> str:
    return units(num, den, 0, 152, 5)


def sorted_list(expr: str) -> str:
    """Ascending list of the known values of a group."""
    return f"list_sort(list({expr}) FILTER (({expr}) IS NOT NULL))"


def pct_units(values: str, p: int, scale: int, digits: int) -> str:
    """Interpolated percentile of a sorted list of whole numbers (units of 10^-scale), half up."""
    n = f"len({values})"
    spot = f"({p} * ({n} - 1))"
    low = f"{values}[{spot} // 100 + 1]"
    high = f"{values}[least({spot} // 100 + 2, {n})]"
    exact = f"({low}::HUGEINT * 100 + ({high} - {low})::HUGEINT * ({spot} % 100))"
    drop = scale + 2 - digits
    if drop <= 0:
        got = f"({exact} * {10**-drop})"
    else:
        got = f"(sign({exact})::HUGEINT * ((abs({exact}) + {10**drop // 2}) // {10**drop}))"
    return f"(CASE WHEN {n} > 0 THEN {got} END)"


def pct(values: str, p: int, scale: int, digits: int) -> str:
    return scaled(pct_units(values, p, scale, digits), digits)


def upper(values: str) -> str:
    return f"{values}[len({values}) // 2 + 1]"
