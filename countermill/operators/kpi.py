"""KPIs: ratios and other arithmetic of counter sums per grouping elements and period."""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from countermill.functions.times import period_start

# One operand: <scheme>://<table>.<counter>
OPERAND = re.compile(r"\w+://(\w+)\.(\w+)")

PERIOD_COLUMN = "ropendtime"

MAX_DEFINITIONS = 10_000


@dataclass(frozen=True)
class Kpi:
    """One definition: ``numerator / denominator``, or a plain sum without denominator."""

    name: str
    numerator: tuple[str, str]
    denominator: tuple[str, str] | None
    elements: tuple[str, ...]
    period_minutes: int = 1440
    alias: str = ""

    @property
    def operands(self) -> list[tuple[str, str]]:
        return [o for o in (self.numerator, self.denominator) if o is not None]


@dataclass(frozen=True)
class Formula:
    """One definition of any arithmetic: ``text`` is an expression in which ``_<i>`` stands for operand i."""

    name: str
    text: str
    operands: tuple[tuple[str, str], ...]
    elements: tuple[str, ...]
    period_minutes: int = 1440
    alias: str = ""

    def column(self, operands: Sequence[Column]) -> Column:
        """The expression over operand columns, NULL where a divisor is zero or an operand missing."""
        return _arithmetic(ast.parse(self.text, mode="eval").body, operands)


def _arithmetic(node: ast.expr, operands: Sequence[Column]) -> Column:
    """Column of an expression tree of operands, numbers, brackets and the four operations."""
    match node:
        case ast.BinOp(left, ast.Add(), right):
            return _arithmetic(left, operands) + _arithmetic(right, operands)
        case ast.BinOp(left, ast.Sub(), right):
            return _arithmetic(left, operands) - _arithmetic(right, operands)
        case ast.BinOp(left, ast.Mult(), right):
            return _arithmetic(left, operands) * _arithmetic(right, operands)
        case ast.BinOp(left, ast.Div(), right):
            return F.try_divide(_arithmetic(left, operands), _arithmetic(right, operands))
        case ast.UnaryOp(ast.USub(), inner):
            return -_arithmetic(inner, operands)
        case ast.Constant(value) if type(value) in (int, float):
            return F.lit(float(value))
        case ast.Name(name) if re.fullmatch(r"_\d+", name) and int(name[1:]) < len(operands):
            return operands[int(name[1:])]
    raise ValueError(f"cannot read {ast.unparse(node)!r}")


def parse_formula(
    name: str,
    expression: str,
    elements: Sequence[str],
    period_minutes: int = 1440,
    aggregation: str = "SUM",
    alias: str = "",
) -> Formula:
    """A definition from an expression of operands, numbers, ``+ - * /`` and brackets."""
    if aggregation != "SUM":
        raise ValueError(f"{name}: aggregation {aggregation} is not supported")
    operands = tuple(dict.fromkeys(OPERAND.findall(expression)))
    text = OPERAND.sub(lambda m: f" _{operands.index((m.group(1), m.group(2)))} ", expression).strip()
    formula = Formula(name, text, operands, tuple(elements), period_minutes, alias)
    try:
        formula.column([F.lit(1.0)] * len(operands))
    except (SyntaxError, ValueError) as error:
        raise ValueError(f"{name}: cannot read expression {expression!r}") from error
    if not operands:
        raise ValueError(f"{name}: {expression!r} names no counter")
    return formula


def parse_kpi(
    name: str,
    expression: str,
    elements: Sequence[str],
    period_minutes: int = 1440,
    aggregation: str = "SUM",
    alias: str = "",
) -> Kpi:
    """A definition from its expression text ``operand`` or ``operand / operand``."""
    if aggregation != "SUM":
        raise ValueError(f"{name}: aggregation {aggregation} is not supported")
    operands = [OPERAND.fullmatch(part.strip()) for part in re.split(r"\s+/\s+", expression.strip())]
    if len(operands) > 2 or None in operands:
        raise ValueError(f"{name}: cannot read expression {expression!r}")
    numerator, *rest = [(m.group(1), m.group(2)) for m in operands]
    return Kpi(name, numerator, rest[0] if rest else None, tuple(elements), period_minutes, alias)


def read_kpis(definitions: DataFrame, most: int = MAX_DEFINITIONS) -> list[Kpi | Formula]:
    """Definitions of documents; they are hand-written, so more than ``most`` are an error.

    A sum or a ratio of two sums is a :class:`Kpi`, anything else a :class:`Formula`.
    """
    rows = definitions.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} KPI definitions")

    def parsed(row: Row) -> Kpi | Formula:
        operands = re.split(r"\s+/\s+", (row["expression"] or "").strip())
        simple = len(operands) <= 2 and all(OPERAND.fullmatch(o) for o in operands)
        return (parse_kpi if simple else parse_formula)(
            row["name"],
            row["expression"] or "",
            row["aggregation_elements"],
            row["aggregation_period"],
            row["aggregation_type"],
            row["alias"] or "",
        )

    return [parsed(row) for row in rows]


def _element(name: str, period_minutes: int) -> Column:
    if name == PERIOD_COLUMN:
        return period_start(name, period_minutes).alias(name)
    return F.col(name)


def kpi_table(tables: Mapping[str, DataFrame], kpis: Sequence[Kpi | Formula]) -> DataFrame:
    """One row per group with one column per KPI; all share elements and period.

    Each operand is summed first, then divided or put into its formula: NULL when a divisor is
    zero or an operand missing. Tables are unioned and aggregated once, so operands of different
    tables need no join; ``ropendtime`` among the elements is cut to its period.
    """
    elements, period = kpis[0].elements, kpis[0].period_minutes
    if any((k.elements, k.period_minutes) != (elements, period) for k in kpis):
        raise ValueError("KPIs of one table must share elements and period")
    operands = dict.fromkeys(o for k in kpis for o in k.operands)
    column = {operand: f"_operand{i}" for i, operand in enumerate(operands)}

    def part(table: str) -> DataFrame:
        mine = [(o, c) for o, c in column.items() if o[0] == table]
        return tables[table].select(
            *[_element(e, period) for e in elements], *[F.col(o[1]).alias(c) for o, c in mine]
        )

    names = dict.fromkeys(table for table, _ in operands)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [part(t) for t in names])
    sums = rows.groupBy(*elements).agg(*[F.sum(c).alias(c) for c in column.values()])

    def value(kpi: Kpi | Formula) -> Column:
        if isinstance(kpi, Formula):
            return kpi.column([F.col(column[o]).cast("double") for o in kpi.operands]).alias(kpi.name)
        top = F.col(column[kpi.numerator]).cast("double")
        if kpi.denominator is None:
            return top.alias(kpi.name)
        return F.try_divide(top, F.col(column[kpi.denominator]).cast("double")).alias(kpi.name)

    return sums.select(*elements, *[value(k) for k in kpis])


def kpi_tables(tables: Mapping[str, DataFrame], kpis: Sequence[Kpi | Formula]) -> dict[tuple, DataFrame]:
    """KPI tables by (alias, elements, period): one aggregation each."""
    groups: dict[tuple, list[Kpi | Formula]] = {}
    for kpi in kpis:
        groups.setdefault((kpi.alias, kpi.elements, kpi.period_minutes), []).append(kpi)
    return {key: kpi_table(tables, group) for key, group in groups.items()}
