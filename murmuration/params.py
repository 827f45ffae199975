"""Parameters of the analyses."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

# The ten people for whom suggestions are made by default.
SELECTED_PEOPLE = (38, 543, 941, 347, 303, 977, 495, 75, 884, 540)

# Weight of one unit of each affinity feature.
STATIC_WEIGHTS = {
    "sameForumMember": "1",
    "sameForumModerator": "1",
    "sameForumMemberModerator": "0.5",
    "sameAge": "1",
    "sameBrowser": "0.2",
    "sameInterestTag": "1",
    "sameLanguage": "1",
}
WINDOW_WEIGHTS = {
    "likedTheSame": "20",
    "postedSameForum": "20",
    "commentedSamePost": "20",
    "commentedSameComment": "20",
    "active": "10",
    "authorActive": "10",
}

# Names of the three activity metrics.
COMMENT, REPLY, ENGAGEMENT = "comment", "reply", "userEngagement"

# Kinds of engagement events.
KIND_REPLY, KIND_COMMENT, KIND_LIKE = 0, 1, 2

def _decimals(weights: dict[str, str]) -> dict[str, Decimal]:
    return {name: Decimal(w) for name, w in weights.items()}


@dataclass(frozen=True)
class Params:
    """Everything the analyses can be tuned with."""

    tick_ms: int = 30 * MINUTE_MS
    active_ms: int = 12 * HOUR_MS
    window_ms: int = 4 * HOUR_MS
    slide_ms: int = HOUR_MS
    min_delay_s: int = 300
    max_delay_s: int = 3000
    n_sigma: float = 3.0
    top_k: int = 5
    age_range: int = 5
    digest_page: int = 100
    selected: tuple = SELECTED_PEOPLE
    weights: dict[str, Decimal] = field(
        default_factory=lambda: _decimals(STATIC_WEIGHTS | WINDOW_WEIGHTS)
    )

    def __post_init__(self):
        if not self.selected:
            raise ValueError("somebody must be selected")
        if any(w < 0 for w in self.weights.values()):
            # The exact pruning of suggestion candidates relies on it.
            raise ValueError("weights must not be negative")
        if any(w * 10_000 % 1 for w in self.weights.values()):
            raise ValueError("weights may have at most four decimals")
        if self.window_ms % self.slide_ms:
            raise ValueError("the window length must be a multiple of the slide")

    @classmethod
    def from_properties(cls, props: dict[str, str], **overrides) -> "Params":
        """Build from the keys of a properties file (friendId0.., weight names, delays)."""
        selected = tuple(
            int(props[k]) if props[k].strip().isdigit() else props[k].strip()
            for k in sorted((k for k in props if k.startswith("friendId")), key=lambda k: int(k[8:]))
        )
        weights = _decimals(STATIC_WEIGHTS | WINDOW_WEIGHTS)
        weights.update({k: Decimal(props[k].strip()) for k in weights if k in props})
        if "active" in props and "authorActive" not in props:
            weights["authorActive"] = weights["active"]
        values = {"selected": selected or SELECTED_PEOPLE, "weights": weights}
        for key, name in (("minDelayInSec", "min_delay_s"), ("maxDelayInSec", "max_delay_s"),
                          ("sameAgeRange", "age_range")):
            if key in props:
                values[name] = int(props[key])
        return cls(**(values | overrides))
