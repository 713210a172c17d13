"""What Python workers keep between tasks."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager


def held_by_worker(kind: type, path: str):
    """One tokenizer of a kind per Python worker, with what it remembers, while tasks come and go.

    It is kept with the imported library: the modules of this subpackage travel by value, so their own names are
    new in every task.
    """
    import tokenizers

    held = vars(tokenizers).setdefault("_held_by_workers", {})
    key = kind.__name__, path
    if key not in held:
        held[key] = kind(path)
    return held[key]


@contextmanager
def no_collection() -> Iterator[None]:
    """No search for cycles meanwhile: work on many short-lived lists without any would only be interrupted by it."""
    usual = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if usual:
            gc.enable()
