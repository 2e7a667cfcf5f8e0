"""How long the steps of runs take: least, most, mean and number of each."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field


@dataclass
class Step:
    """Seconds of one step, however often it ran."""

    least: float = float("inf")
    most: float = 0.0
    total: float = 0.0
    count: int = 0

    def add(self, seconds: float) -> None:
        self.least, self.most = min(self.least, seconds), max(self.most, seconds)
        self.total += seconds
        self.count += 1

    @property
    def mean(self) -> float:
        return self.total / self.count if self.count else 0.0


@dataclass
class Timings:
    """Steps by name. A step that fails is counted as well."""

    steps: dict[str, Step] = field(default_factory=dict)

    @contextmanager
    def of(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.steps.setdefault(name, Step()).add(time.perf_counter() - began)

    def rows(self) -> list[tuple[str, int, float, float, float]]:
        """(name, count, least, mean, most) in the order in which steps first ended."""
        return [(n, s.count, s.least, s.mean, s.most) for n, s in self.steps.items()]
