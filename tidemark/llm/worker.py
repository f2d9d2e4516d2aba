"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa

_kept: dict[Any, Any] = {}


def lasting_things() -> dict[Any, Any]:
    """What outlives a task. This library is shipped with every task by value, and so are its
    globals; what lies in a module that is not part of it stays."""
    return vars(sys.modules.setdefault("_tidemark_kept", ModuleType("_tidemark_kept"))).setdefault("things", {})


def kept(key: Any, make: Callable[[], Any], lasting: bool = False) -> Any:
    """The thing of this name, made when it is first asked for in a task, or, if it is a lasting
    one, in a worker. A worker serves the tasks of one operator after another; asking for
    another operator's thing drops the one before, so that their vocabularies and memos do not
    add up."""
    things = lasting_things() if lasting else _kept
    if key not in things:
        _kept.clear()
        lasting_things().clear()
        gc.collect()  # a memo and the encoder whose method it calls hold each other
        things[key] = make()
    return things[key]


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 2_500) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` some at a time, so that a worker holds the texts and the results of
    few rows and not those of a whole Arrow batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
