"""Settings from the environment; secrets from it or from the file that it names."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path


def secret(name: str, environment: dict[str, str] | None = None) -> str | None:
    """``name`` from the environment, or the stripped text of the file that ``<name>_FILE`` names; None if
    neither is set. A file that cannot be read is an error."""
    env = os.environ if environment is None else environment
    if env.get(name):
        return env[name]
    return Path(env[f"{name}_FILE"]).read_text(encoding="utf-8").strip() if env.get(f"{name}_FILE") else None


@dataclass(frozen=True)
class Config:
    root: str = "graphloom-data"
    source: str = "galleryhub"
    listing_rate: float = 1.5
    file_rate: float = 5.0
    credential: str | None = None

    @classmethod
    def from_env(cls, environment: dict[str, str] | None = None) -> Config:
        env = os.environ if environment is None else environment
        return cls(
            env.get("GRAPHLOOM_ROOT", cls.root), env.get("GRAPHLOOM_SOURCE", cls.source), float(env.get("GRAPHLOOM_LISTING_RATE", cls.listing_rate)),
            float(env.get("GRAPHLOOM_FILE_RATE", cls.file_rate)), secret("GRAPHLOOM_CREDENTIAL", env),
        )
