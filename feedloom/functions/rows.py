"""A mark on transforms that look at each row by itself, so that rows stay in the task that read them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import TypeVar

_Transform = TypeVar("_Transform", bound=Callable)


def row_by_row(transform: _Transform) -> _Transform:
    """Mark a transform of a DataFrame that needs no shuffle: what it writes lies as what it read."""
    transform.row_by_row = True
    return transform


def is_row_by_row(transform: Callable) -> bool:
    """Whether a transform, or the function a partial one is made of, is marked."""
    while isinstance(transform, partial):
        transform = transform.func
    return getattr(transform, "row_by_row", False)
