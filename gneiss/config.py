"""Settings of entity resolution and ingestion; environment variables override them."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from datetime import datetime


@dataclass(frozen=True)
class Settings:
    """Weights, thresholds and caps. Each can be overridden by an upper-case variable with the prefix ER_."""

    auto_match_threshold: float = 0.90
    review_threshold: float = 0.75
    weight_street: float = 0.55
    weight_zip: float = 0.15
    weight_geo: float = 0.15
    weight_suffix: float = 0.15
    geo_full_credit_m: float = 30.0
    geo_zero_credit_m: float = 250.0
    name_auto_threshold: float = 0.95
    name_review_threshold: float = 0.85
    phone_threshold: float = 0.80
    max_phone_group: int = 10
    max_block_size: int = 200
    corp_fanout: int = 200
    mailing_fanout: int = 100

    def __post_init__(self) -> None:
        for auto, review in (("auto_match_threshold", "review_threshold"), ("name_auto_threshold", "name_review_threshold")):
            if getattr(self, auto) <= getattr(self, review):
                raise ValueError(f"{auto} must exceed {review}, else the review band would match by itself")
        total = self.weight_street + self.weight_zip + self.weight_geo + self.weight_suffix
        if abs(total - 1) > 1e-6:
            raise ValueError(f"the weights of the pair score sum to {total}, not 1")

    @classmethod
    def from_env(cls, **given) -> Settings:
        found = {f.name: (int if f.type == "int" else float)(os.environ[k]) for f in fields(cls) if (k := f"ER_{f.name.upper()}") in os.environ}
        return cls(**found | given)


@dataclass(frozen=True)
class IngestSettings:
    """Limits of API pulls."""

    max_records: int = 50_000
    page_size: int = 10_000
    timeout_s: float = 60.0
    max_retries: int = 5
    backoff_base_s: float = 2.0
    backoff_cap_s: float = 60.0


@dataclass(frozen=True)
class Clock:
    """The moment that look-backs count from; models never read the wall clock."""

    as_of: datetime
