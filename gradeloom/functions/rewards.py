"""Rewards of graded rows and the per-row losses documented for logged log-probabilities."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BETA = 0.1  # fixed value: default temperature of the preference loss


def reward_accuracy(correct: Column) -> Column:
    """1.0 for a right answer, 0.0 for a wrong one."""
    return correct.cast("double")


class RewardRegistry:
    """Reward expressions by name, combined as a weighted sum of columns.

    A reward is a function from a column lookup to a Column, so a custom one is an ordinary Spark
    expression that Catalyst sees through. ``register_python`` takes what no expression can state: a function from Arrow arrays, one per
    named column, to as many numbers. All such rewards of one ``select`` run in one Python stage.
    """

    def __init__(self) -> None:
        self._rewards: dict[str, Callable[[Callable[[str], Column]], Column]] = {
            "accuracy": lambda col: reward_accuracy(col("correct")),
        }

    def register(self, name: str, reward: Callable[[Callable[[str], Column]], Column]) -> None:
        self._rewards[name] = reward

    def register_python(self, name: str, reward: Callable[..., Sequence[float]], columns: Sequence[str]) -> None:
        def run(*arrays: pa.Array) -> pa.Array:
            values = reward(*arrays)
            out = values.cast(pa.float64()) if isinstance(values, pa.Array) else pa.array(values, pa.float64())
            if len(out) != len(arrays[0]):
                raise ValueError(f"reward {name!r} gave {len(out)} values for {len(arrays[0])} rows")
            return out

        run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
        self._rewards[name] = lambda col: F.arrow_udf(run, "double")(*[col(c) for c in columns])

    def names(self) -> list[str]:
        return sorted(self._rewards)

    def column(self, name: str, col: Callable[[str], Column] = F.col) -> Column:
        if name not in self._rewards:
            raise KeyError(f"unknown reward {name!r}; registered: {', '.join(self.names())}")
        return self._rewards[name](col).cast("double")

    def total(self, weights: Mapping[str, float], col: Callable[[str], Column] = F.col) -> Column:
        total = F.lit(0.0)
        for name, weight in weights.items():
            total = total + F.lit(float(weight)) * self.column(name, col)
        return total


def sft_nll(logp: Column) -> Column:
    """Negative log-likelihood of the right answer given its input."""
    return -logp


def dpo_margin(logp_chosen: Column, logp_rejected: Column, ref_chosen: Column | None = None,
               ref_rejected: Column | None = None) -> Column:
    """How much likelier the chosen answer is; with both reference log-probabilities, how much more so than under the reference."""
    if (ref_chosen is None) != (ref_rejected is None):
        raise ValueError("give both reference log-probabilities or none")
    margin = logp_chosen - logp_rejected
    return margin if ref_chosen is None else margin - (ref_chosen - ref_rejected)


def dpo_loss(logp_chosen: Column, logp_rejected: Column, beta: float = DEFAULT_BETA, ref_chosen: Column | None = None,
             ref_rejected: Column | None = None) -> Column:
    """``-log(sigmoid(beta * margin))`` in a form that cannot overflow."""
    margin = F.lit(float(beta)) * dpo_margin(logp_chosen, logp_rejected, ref_chosen, ref_rejected)
    return F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))


def preference_accuracy(margin: Column) -> Column:
    """Share of pairs whose chosen answer is the likelier one, an aggregate; pairs without a margin do not count."""
    return F.avg((margin > 0).cast("double"))
