"""A run of named stages over the player tables: from any stage on, each behind its gates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.quality import Gate, at_least, coverage, require, unique
from kinweave.sources.sinks import Versions


@dataclass
class Stage:
    """What a stage reads (earlier stages' names), does, and promises."""

    name: str
    reads: tuple[str, ...]
    run: Callable[..., DataFrame]
    gates: list[Gate] = field(default_factory=list)
    strict: bool = True


@dataclass
class Run:
    """Stages in order. Every stage's result is a published version, so a run can start at any stage and read what the
    ones before it left."""

    stages: list[Stage]
    store: Callable[[str], Versions]

    def execute(self, start: str | None = None) -> dict[str, list[str]]:
        names = [s.name for s in self.stages]
        if start is not None and start not in names:
            raise ValueError(f"no stage {start}")
        failed = {}
        for s in self.stages[names.index(start) if start else 0 :]:
            store = self.store(s.name)
            store.publish(s.run(*[self.store(r).read() for r in s.reads]))
            failed[s.name] = require(store.read(), s.gates, s.strict)
        return failed


def player_gates() -> list[Gate]:
    return [at_least("rows", 1), unique("ids", F.col("id")), coverage("nationality", F.col("nationality"), 80.0)]
