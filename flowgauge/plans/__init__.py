"""Named queries over the domain frames, by family."""

from __future__ import annotations

import importlib

FAMILIES = ("scope", "delivery", "activity", "assist", "quality", "flow", "profile")


def load_all():
    from flowgauge.plans.registry import QUERIES

    for family in FAMILIES:
        importlib.import_module(f"flowgauge.plans.{family}")
    return QUERIES
