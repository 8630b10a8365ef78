"""Where a warehouse keeps its folders."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Layout:
    """``run`` names the generation of the silver layer.

    A rebuild from bronze takes a new name: new tables go with new checkpoints, so all of bronze
    is read again. ``feed`` is the root of another layout whose landing folders feed this one too.
    """

    root: str
    run: str = "r0"
    feed: str | None = None

    def next_run(self) -> Layout:
        """The layout of the generation after this one: r0, r1 and so on."""
        name, number = re.fullmatch(r"(.*?)(\d*)", self.run).groups()
        return replace(self, run=f"{name}{int(number or 0) + 1}")

    def landing(self, name: str) -> str:
        return f"{self.feed or self.root}/landing/{name}"

    def marks(self) -> str:
        return f"{self.root}/state/marks"

    def schema(self, name: str) -> str:
        return f"{self.root}/state/schema/{name}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{self.run}/{name}"

    def quarantine(self) -> str:
        return f"{self.root}/silver/{self.run}/dqm_log"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def kpi_state(self) -> str:
        return f"{self.root}/state/kpi/{self.run}"

    def checkpoint(self, layer: str, name: str) -> str:
        run = f"/{self.run}" if layer == "silver" else ""
        return f"{self.root}/checkpoints/{layer}{run}/{name}"
