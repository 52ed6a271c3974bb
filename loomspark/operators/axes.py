"""Deriving axes: propose, tag a sample, measure how much each pair of axes says the same, revise the worst pair, repeat."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .measure import mutual_information


@dataclass(frozen=True)
class Overlap:
    """Normalised mutual information of two axes over the records that have both."""

    a: str
    b: str
    n: int
    nmi: float


@dataclass(frozen=True)
class Round:
    axes: list[str]
    pairs: list[Overlap]

    @property
    def worst(self) -> Overlap | None:
        return max(self.pairs, key=lambda p: p.nmi, default=None)


def overlaps(tags: DataFrame, axes: list[str]) -> list[Overlap]:
    """All pairs of axes; one row each comes to the driver, so the number of axes bounds it. Axes without common records overlap by 0."""
    tags, found = cut(tags), []
    for a, b in combinations(axes, 2):
        row = mutual_information(tags, a, b).first()
        found.append(Overlap(a, b, row["n"] or 0, row["nmi"] or 0.0))
    return found


def derive_axes(
    findings: DataFrame,
    id: str,
    propose: Callable[[DataFrame], list[str]],
    tag: Callable[[DataFrame, list[str]], DataFrame],
    revise: Callable[[Round], list[str]],
    most: float = 0.15,
    rounds: int = 4,
    sample: int = 200,
    seed: int = 42,
) -> tuple[list[str], list[Round]]:
    """Axes no two of which have more than ``most`` normalised mutual information, or those of the last round, and the rounds' measures.

    The sample is the feature (what a model is asked to tag): ``sample`` rows by hash of id and seed. ``tag`` gives it a column an axis. Defined cases:
    no findings or fewer than two axes end the loop after one round."""
    rows = cut(findings.orderBy(F.xxhash64(F.col(id).cast("string"), F.lit(seed)), id).limit(sample))
    axes, history = propose(findings), []
    for r in range(rounds):
        now = Round(axes, overlaps(tag(rows, axes), axes))
        history.append(now)
        if now.worst is None or now.worst.nmi <= most or r == rounds - 1:
            break
        axes = revise(now)
    return axes, history
