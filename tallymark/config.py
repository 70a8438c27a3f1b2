"""Settings of one run. "Now" is a value here and is never read inside an operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Settings:
    company_id: str = "company"
    company_name: str = "Company"
    as_of: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    policy: str = "max"  # or "new"
    profile: str = "export"  # or "manual", the older rules
    day_first: bool = False
    missing_date: str = "null"  # or "now"
    tz_offset_hours: float = 0
    header: str = "auto"  # "first", "score", "indicators", "named" or "two_names"
    drop_empty_columns: bool = False
    drop_notes: bool = False
    demographic_as_rate: bool = False
    key_buckets: int = 64
    by_export_time: bool = False  # the newest export wins, in whatever order the exports arrive

    def __post_init__(self):
        for name, allowed in {
            "policy": ("max", "new"),
            "profile": ("export", "manual"),
            "missing_date": ("null", "now"),
            "header": ("auto", "first", "score", "indicators", "named", "two_names"),
        }.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")

    @property
    def manual(self) -> bool:
        return self.profile == "manual"

    @property
    def unknown_followers(self) -> int:
        return 1000 if self.manual else 0

    @property
    def rate_scale(self) -> int:
        return 2 if self.manual else 4

    @property
    def now(self) -> Column:
        """``as_of`` (UTC) as a timestamp literal."""
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.lit(self.as_of.date().isoformat()).cast("date")

    @property
    def midnight(self) -> Column:
        """The day key of ``as_of``: midnight UTC."""
        return F.lit(self.as_of.date().isoformat()).cast("timestamp")

    def at(self, as_of: datetime) -> "Settings":
        return replace(self, as_of=as_of)
