"""All registered queries; importing the modules registers them."""

from __future__ import annotations

from verdigris.suite import corners, inputs, landing, models, operators, streams, web  # noqa: F401
from verdigris.suite.registry import QUERIES, oracle, run

__all__ = ["names", "oracle", "run"]


def names() -> list[str]:
    return list(QUERIES)
