"""What a Python worker keeps between tasks.

Task functions travel with the job and bring fresh copies of module variables,
so anything costly to build is kept here instead, by name, in the worker.
"""

from __future__ import annotations

import sys
import types

_NAME = "_vecspark_worker"


def kept(name, build):
    """The worker's value of ``name``, built on first use."""
    held = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__
    if name not in held:
        held[name] = build()
    return held[name]


def forget(prefix: str) -> None:
    """Drop the values whose names start with ``prefix``."""
    held = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__
    for name in [n for n in held if isinstance(n, str) and n.startswith(prefix)]:
        del held[name]
