"""Values that a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

HOLDER = "_shiftwell_worker_values"


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The value made by the first call with this key in this process.

    Functions travel to workers by value, and their module's globals with them, anew
    for each task. What is dear to make is therefore held by a module of the process.
    """
    holder = sys.modules.setdefault(HOLDER, types.ModuleType(HOLDER))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]
