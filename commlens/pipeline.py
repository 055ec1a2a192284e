"""Composition of DataFrame-to-DataFrame steps between a source and a sink; the plan stays one until the sink acts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


class Pipeline:
    """``run`` reads, applies the steps in order and hands the result to the sink (or returns it)."""

    def __init__(self, source: Callable[[], DataFrame], steps: Sequence[Step], sink: Callable[[DataFrame], object] | None = None):
        self.source, self.steps, self.sink = source, list(steps), sink
        self.validate()

    def validate(self) -> None:
        if not callable(self.source) or not all(map(callable, self.steps)) or not (self.sink is None or callable(self.sink)):
            raise TypeError("source, steps and sink are callables")

    def frame(self) -> DataFrame:
        df = self.source()
        for step in self.steps:
            df = df.transform(step)
        return df

    def run(self):
        return self.frame() if self.sink is None else self.sink(self.frame())


def staged(stages: Sequence[tuple[str, Step]], read: Callable[[str], DataFrame], write: Callable[[DataFrame, str], object], only: Sequence[str] | None = None, first: DataFrame | None = None) -> None:
    """Runs the chosen stages; each reads what the stage before it has written, so that a run can start at any stage."""
    before = None
    for name, step in stages:
        if only is None or name in only:
            df = first if before is None else read(before)
            if df is None:
                raise ValueError(f"stage {name} has no input")
            write(step(df), name)
        before = name
