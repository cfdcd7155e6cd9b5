"""Identity of a run: an initial timestamp, an incremental one and a suffix, joined by underscores."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass


def _now() -> str:
    return str(int(time.time()))


@dataclass(frozen=True)
class RunId:
    """A run. Its schema keeps the initial timestamp; its name also holds the incremental one."""

    initial: str
    incremental: str | None = None
    suffix: str | None = None

    @classmethod
    def parse(cls, text: str | None, generate: bool = True, now: Callable[[], str] = _now) -> RunId:
        """Read up to two numbers and a suffix, in this order. Without an initial timestamp one is generated (or, unless
        `generate`, an error raised); with one, so is a missing incremental timestamp."""
        numbers: list[str] = []
        suffix = None
        parts = [p for p in (text or "").strip().strip("_").split("_") if p]
        for place, part in enumerate(parts):
            if not part.isalnum():
                raise ValueError(f"invalid part {part!r}")
            if part.isnumeric() and len(numbers) < 2 and suffix is None and place < 2:
                numbers.append(part)
            elif suffix is None:
                suffix = part
            else:
                raise ValueError(f"more parts than a run has: {text!r}")
        if not numbers and not generate:
            raise ValueError("the initial timestamp is missing")
        initial = numbers[0] if numbers else now()
        incremental = numbers[1] if len(numbers) > 1 else now() if numbers and generate else None
        return cls(initial, incremental, suffix)

    @property
    def schema_suffix(self) -> str:
        """What the names of the run's schemas end in."""
        return "_" + "_".join(filter(None, (self.initial, self.suffix)))

    @property
    def name(self) -> str:
        """The run's name."""
        return "_".join(filter(None, (self.initial, self.incremental, self.suffix)))
