"""Quality signals read from a model's answer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.numbers import clamp

# Phrases counted in an answer, matched without regard to case.
POSITIVE_PATTERNS = (
    r"\b(detailed|comprehensive|clear|specific|actionable|rich)\b",
    r"\b(consistent|reliable|accurate|informative)\b",
)
CONCERN_PATTERNS = (
    r"\b(no data|no information|data is missing|data quality|empty response)\b",
    r"\b(could not analyze|unable to analyze|insufficient data)\b",
)
OLDER_CONCERN_PATTERNS = (
    r"\b(insufficient|incomplete|missing|unclear|ambiguous|low quality)\b",
    r"\b(too short|very brief|no data|no information)\b",
    r"\b(spam|irrelevant|off[-\s]?topic)\b",
)


@dataclass(frozen=True)
class Profile:
    """Weights, patterns and bound of one scorer version."""

    positive_weight: float
    concern_weight: float
    concern_patterns: tuple[str, ...]
    bound: float | None


PROFILES = {
    "current": Profile(1.0, 3.0, CONCERN_PATTERNS, 10.0),
    # The shipped sample reports come from an older, unbounded scorer.
    "golden": Profile(2.0, 5.0, OLDER_CONCERN_PATTERNS, None),
}


def _hits(text: Column, patterns: tuple[str, ...]) -> Column:
    total = F.lit(0)
    for pattern in patterns:
        total = total + F.regexp_count(text, F.lit("(?i)" + pattern))
    return total


def positive_hits(text: Column) -> Column:
    return _hits(F.coalesce(text, F.lit("")), POSITIVE_PATTERNS)


def concern_hits(text: Column, profile: str = "current") -> Column:
    return _hits(F.coalesce(text, F.lit("")), PROFILES[profile].concern_patterns)


def concern_signals(text: Column, profile: str = "current") -> Column:
    """One message per matching pattern, quoting its first match as written."""
    text = F.coalesce(text, F.lit(""))
    messages = []
    for pattern in PROFILES[profile].concern_patterns:
        first = F.regexp_extract(text, "(?i)" + pattern, 1)
        messages.append(F.when(first != "", F.concat(F.lit("Model identified: "), first)))
    return F.array_compact(F.array(*messages))


def adjustment(positive: Column, concern: Column, profile: str = "current") -> Column:
    p = PROFILES[profile]
    raw = positive * p.positive_weight - concern * p.concern_weight
    return raw if p.bound is None else clamp(raw, -p.bound, p.bound)


def richness_boost(entities: Column, phrases: Column) -> Column:
    """Half a point per entity, 0.3 per phrase, ten at most."""
    raw = F.coalesce(entities, F.lit(0)) * 0.5 + F.coalesce(phrases, F.lit(0)) * 0.3
    return F.least(F.lit(10.0), raw)


def final_score(base: Column, boost: Column, adjust: Column) -> Column:
    """Clamped to 0..100; a missing base counts as 50."""
    return F.round(clamp(F.coalesce(base, F.lit(50.0)) + boost + adjust, 0.0, 100.0), 2)
