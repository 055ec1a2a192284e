"""Typed configuration: defaults, overridden by an ini file, overridden by keyword arguments.

Values get the type of their default; ``true/false/yes/no/1/0`` in any case are booleans, lists are comma- or
line-separated, and ``${section:option}`` refers to another option.
"""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Config:
    time_min: str = "1990-01-01 00:00:00"
    time_max: str = "2040-01-01 00:00:00"
    rows_per_request: int = 1000
    bucket: str = "month"
    topics: int = 25
    topic_alpha: float = 0.1
    topic_beta: float = 0.1
    topic_min_probability: float = 0.02
    topic_terms: int = 10
    df_min: int = 3
    df_max_fraction: float = 0.1
    phrase_chunk_chars: int = 10_000
    phrase_count: int = 100
    phrase_window: int = 1000
    phrase_lengths: list[int] = field(default_factory=lambda: [2, 3, 4, 5, 6])
    response_days: int = 3
    no_response_seconds: float = 432_000.0
    free_mail_providers: list[str] = field(default_factory=lambda: ["aol", "gmail", "gmx", "hotmail", "yahoo", "msn", "web"])
    overwrite: bool = False


def _typed(kind: str, text: str):
    if kind == "bool":
        return configparser.ConfigParser.BOOLEAN_STATES[text.strip().lower()]
    if kind.startswith("list"):
        items = [x.strip() for x in text.replace("\n", ",").split(",") if x.strip()]
        return [int(x) for x in items] if "int" in kind else items
    return {"int": int, "float": float}.get(kind, str)(text)


def load(path: str | None = None, section: str = "commlens", **override) -> Config:
    """Raises on an option that does not exist or a value of another type."""
    kinds = {f.name: f.type for f in fields(Config)}
    got: dict = {}
    if path:
        ini = configparser.ConfigParser(interpolation=configparser.ExtendedInterpolation())
        with open(path) as f:
            ini.read_file(f)
        for k, v in ini[section].items() if ini.has_section(section) else ():
            if k not in kinds:
                raise KeyError(f"unknown option {k}")
            got[k] = _typed(kinds[k], v)
    return replace(Config(), **(got | override))


def exports(config: Config, prefix: str = "COMMLENS") -> str:
    """All options as lines ``PREFIX_OPTION="value"`` that a shell can source; lists are joined by commas, quotes are escaped."""

    def shown(x) -> str:
        text = ",".join(map(str, x)) if isinstance(x, list) else "" if x is None else str(x)
        return "".join("\\" + c if c in '"\\$`' else c for c in text)

    return "".join(f'{prefix}_{f.name.upper()}="{shown(getattr(config, f.name))}"\n' for f in fields(config))
