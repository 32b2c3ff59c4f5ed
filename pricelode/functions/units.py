"""Units of measure as a graph of affine conversions."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

# Spellings of units, folded to lower case without a closing point. The first of each line is the unit.
SPELLINGS = {
    "mg": ["mg"],
    "g": ["g", "gr", "gram", "grams", "gramm", "gramů", "gramu", "gramov"],
    "dkg": ["dkg", "dag", "deka"],
    "kg": ["kg", "kilo", "kilogram"],
    "ml": ["ml", "mililitr", "mililiter", "milliliter"],
    "cl": ["cl"],
    "dl": ["dl"],
    "l": ["l", "ltr", "liter", "litr", "litre", "litrů", "litru"],
    "ks": ["ks", "kus", "kusy", "kusů", "kusu", "kusov", "szt", "sztuk", "sztuka", "sztuki", "stk", "st", "stück", "stuck", "pcs", "pc"],
}

# Conversions as edges (from, to, factor, offset): to = from * factor + offset.
EDGES = [
    ("kg", "g", 1000, 0),
    ("kg", "dkg", 100, 0),
    ("dkg", "g", 10, 0),
    ("g", "mg", 1000, 0),
    ("l", "dl", 10, 0),
    ("l", "ml", 1000, 0),
    ("dl", "cl", 10, 0),
    ("cl", "ml", 10, 0),
]

TARGETS = ("g", "ml", "ks")


@dataclass(frozen=True)
class Affine:
    """x -> x * factor + offset, exactly."""

    factor: Fraction
    offset: Fraction

    def then(self, other: Affine) -> Affine:
        return Affine(self.factor * other.factor, self.offset * other.factor + other.offset)

    def inverse(self) -> Affine:
        return Affine(1 / self.factor, -self.offset / self.factor)


IDENTITY = Affine(Fraction(1), Fraction(0))


class UnitGraph:
    """Conversions between units; raises ValueError where two ways round a cycle disagree."""

    def __init__(self, edges: list[tuple] = EDGES) -> None:
        self.next: dict[str, dict[str, Affine]] = {}
        for a, b, factor, offset in edges:
            step = Affine(Fraction(factor), Fraction(offset))
            for x, y, own in ((a, b, step), (b, a, step.inverse())):
                known = self.next.setdefault(x, {}).setdefault(y, own)
                if known != own:
                    raise ValueError(f"two conversions from {x} to {y} disagree")
        for unit in self.next:
            self._paths(unit)

    def _paths(self, source: str) -> dict[str, Affine]:
        """Compositions along the fewest edges; each edge that closes a cycle must agree with them."""
        found = {source: IDENTITY}
        queue = deque([source])
        while queue:
            at = queue.popleft()
            for to, step in self.next.get(at, {}).items():
                way = found[at].then(step)
                if to not in found:
                    found[to] = way
                    queue.append(to)
                elif found[to] != way:
                    raise ValueError(f"conversions from {source} to {to} disagree around a cycle")
        return found

    def to_targets(self, targets: tuple[str, ...] = TARGETS) -> list[tuple[str, str, Affine]]:
        """(unit, target, conversion) of each unit that a target can be reached from."""
        out = [(t, t, IDENTITY) for t in targets]
        for unit in self.next:
            paths = self._paths(unit)
            out += [(unit, t, paths[t]) for t in targets if t in paths and t != unit]
        return out


def conversion_table(spark: SparkSession, graph: UnitGraph | None = None, spellings: dict[str, list[str]] = SPELLINGS, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """spelling, base_unit, factor, offset: one row per spelling of a unit. Its size is that of the unit lists, not of any data."""
    rows = [
        (spelling, target, float(way.factor), float(way.offset))
        for unit, target, way in (graph or UnitGraph()).to_targets(targets) for spelling in spellings.get(unit, [unit])
    ]
    return spark.createDataFrame(rows, "spelling string, base_unit string, factor double, offset double")
