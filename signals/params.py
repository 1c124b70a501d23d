"""Business parameters, passed explicitly to every job that needs them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The agreed split of the test budget.
DECIDED_BUDGET = {
    "Meta": 5_500_000.0,
    "TikTok": 3_000_000.0,
    "Radio": 2_000_000.0,
    "Google": 2_000_000.0,
    "Influenceurs": 1_500_000.0,
    "Activation terrain": 1_000_000.0,
}


@dataclass(frozen=True)
class Params:
    eur_rate: float = 655.0
    max_plausible_amount: float = 100_000.0
    total_test_budget: float = 15_000_000.0
    budget_floor: float = 1_000_000.0
    budget_rounding: float = 50_000.0
    decided_budget: Mapping[str, float] = field(default_factory=lambda: dict(DECIDED_BUDGET))
    classifier_version: str = "rules-1"
