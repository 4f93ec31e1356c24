"""Fitted models as one column expression each: linear ones and tree ensembles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import to_digits
from tidemark.schemas import FEATURES


@dataclass(frozen=True)
class LinearScorer:
    """Logistic model ``1 / (1 + exp(-(intercept + sum(weight * feature))))``.

    Probabilities are rounded only if ``digits`` is given.
    """

    name: str
    intercept: float
    weights: Mapping[str, float]
    digits: int | None = None

    def probability(self, value: Callable[[str], Column]) -> Column:
        """Probability of class 1; ``value(name)`` gives the scaled feature."""
        total = F.lit(float(self.intercept))
        for name in FEATURES:
            if name in self.weights:
                total = total + F.lit(float(self.weights[name])) * value(name)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
        return p if self.digits is None else to_digits(p, self.digits)

    def on_scaled(self) -> Column:
        return self.probability(lambda name: F.col(f"{name}_scaled"))


@dataclass(frozen=True)
class TreeScorer:
    """A boosted model or forest as flat arrays that one fold walks.

    Node ``n`` sends a row to ``left[n]`` if the value of ``feature[n]`` is at most ``threshold[n]``, to
    ``right[n]`` otherwise; leaves have feature -1. ``roots`` starts each tree, ``depth`` is the longest way
    down. ``value`` is what a leaf adds: the weighted step of a boosted tree, whose sum goes through the
    logistic curve of twice the margin, or the share of class 1, of which a forest takes the mean.
    """

    name: str
    roots: tuple[int, ...]
    depth: int
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    boosted: bool
    digits: int | None = None

    def probability(self, value: Callable[[str], Column]) -> Column:
        """Probability of class 1; ``value(name)`` gives the scaled feature."""
        row = F.array(*(value(name).cast("double") for name in FEATURES))
        # A bound variable, so that the features are gathered once.
        return F.transform(F.array(row), self._of)[0]

    def _of(self, row: Column) -> Column:
        feature, left, right = (_constant(a, "int") for a in (self.feature, self.left, self.right))
        threshold, leaf = _constant(self.threshold, "double"), _constant(self.value, "double")

        def step(node: Column, _: Column) -> Column:
            return (
                F.when(F.get(feature, node) < 0, node)
                .when(F.get(row, F.get(feature, node)) <= F.get(threshold, node), F.get(left, node))
                .otherwise(F.get(right, node))
            )

        ways = _constant(range(self.depth), "int")

        def add(total: Column, root: Column) -> Column:
            return total + F.get(leaf, F.aggregate(ways, root, step))

        total = F.aggregate(_constant(self.roots, "int"), F.lit(0.0), add)
        if self.boosted:
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))
        else:
            p = total / F.lit(float(len(self.roots)))
        return p if self.digits is None else to_digits(p, self.digits)

    def on_scaled(self) -> Column:
        return self.probability(lambda name: F.col(f"{name}_scaled"))


Scorer = LinearScorer | TreeScorer


def _constant(values: Iterable[float], kind: str) -> Column:
    """An array that the optimizer folds into one constant; the text of a double is exact."""
    text = ",".join(map(repr, values))
    if not text:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def hard_class(p: Column) -> Column:
    return F.when(p > 0.5, 1).otherwise(0)
