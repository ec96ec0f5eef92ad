"""Asking again after waits."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


class Busy(Exception):
    """The service asks to come back, in so many seconds if it says."""

    def __init__(self, wait: float | None = None):
        super().__init__("busy")
        self.wait = wait


def patiently(ask: Callable[[], T], tries: int, pause: Callable[[float], None], again: tuple[type[Exception], ...] = (Busy, OSError)) -> T | None:
    """What ask gives, after waits that double from 4 to 60 seconds where it fails in a way that is tried again; None after so many tries."""
    for k in range(tries):
        try:
            return ask()
        except again as e:
            wait = getattr(e, "wait", None)
            if k + 1 < tries:
                pause(min(60, 2 ** (k + 2)) if wait is None else wait)
    return None
