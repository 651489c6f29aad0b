"""Quality rules as data, compiled to columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.functions.nulls import significant


@dataclass(frozen=True)
class Rule:
    """``name`` is a metric's column, or of the form in ``derived``.  Bounds are inclusive; None: no bound."""

    name: str
    low: float | None = None
    high: float | None = None
    derived: Column | None = None

    def failed(self) -> Column:
        """The reason, or null."""
        x = (self.derived if self.derived is not None else F.col(self.name)).cast("double")
        good = F.lit(True)
        if self.low is not None:
            good = good & (x >= self.low)
        if self.high is not None:
            good = good & (x <= self.high)
        return F.when(x.isNull() | F.isnan(x), F.lit(f"{self.name}=nan")).when(~good, F.concat(F.lit(f"{self.name}="), significant(x)))


def run_rules() -> list[Rule]:
    """The bounds for a run, in the order of the reasons."""
    return [
        Rule("clock_resid_p95", high=0.025),
        Rule("clock_coverage", low=0.6),
        Rule("bib_agree", low=0.8),
        Rule("panel_min_corr", low=0.85),
        Rule("max_cut", high=0.35),
        Rule("turf_min", low=0.18),
        Rule("turf_median", low=0.4),
        Rule("lane_frac", low=0.9),
        Rule("track_frac", low=0.9),
        Rule("start_support", low=5),
        Rule("x_at_stop_err", high=1.5, derived=F.abs(F.col("x_at_stop") - 40.0)),
        Rule("x_at_zero", low=-2.2, high=0.1),
        Rule("max_step_yd", high=0.8),
    ]


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether all rules hold, and the reasons of those that don't, joined by semicolons."""
    reasons = F.concat_ws(";", *(r.failed() for r in rules))
    return reasons == "", reasons
