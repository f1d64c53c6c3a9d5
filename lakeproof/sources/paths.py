"""Layer locations under one lake base, each overridable per call."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from lakeproof.contract import DEFAULT_SOURCE_CSV, LAYER_FOLDERS, REPORTS_FOLDER


@dataclass(frozen=True)
class LakePaths:
    """Where each layer lives. ``overrides`` maps a layer name to its own path."""

    base: str
    source_csv: str | None = None
    overrides: dict[str, str] = field(default_factory=dict)

    def layer(self, name: str) -> str:
        if name in self.overrides:
            return self.overrides[name]
        return os.path.join(self.base, LAYER_FOLDERS[name])

    @property
    def bronze(self) -> str:
        return self.layer("Bronze (Raw)")

    @property
    def silver(self) -> str:
        return self.layer("Silver (Clean)")

    @property
    def quarantine(self) -> str:
        return self.layer("Silver (Quarentena)")

    @property
    def region_risk(self) -> str:
        return self.layer("Gold (Region Risk)")

    @property
    def top_sales(self) -> str:
        return self.layer("Gold (Top Sales)")

    @property
    def reports(self) -> str:
        return self.overrides.get("reports", os.path.join(self.base, REPORTS_FOLDER))

    @property
    def profiles(self) -> str:
        return self.overrides.get("profiles", os.path.join(self.base, "silver", "dq_profiles"))

    @property
    def source(self) -> str:
        return self.source_csv or os.path.join(self.base, DEFAULT_SOURCE_CSV)
