"""All registered queries and their check SQL, gathered from the plan modules."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "grounding_plans",
    "rule_plans",
    "claim_plans",
    "stream_plans",
    "session_plans",
    "privacy_plans",
    "learned_plans",
)


def gather(kind: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"plumbline.plans.{name}"), kind)
    return found
