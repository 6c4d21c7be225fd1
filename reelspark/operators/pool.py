"""Calls of outside tools, several at once in a task, in the order of their rows."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

Item, Found = TypeVar("Item"), TypeVar("Found")
#: Calls that may wait behind a slow one, as a multiple of those that run at once.
AHEAD = 4


class CallTimeout(RuntimeError):
    """A call that hasn't ended within its time."""


class _Call(threading.Thread):
    """One call in a thread that doesn't keep the process alive; it takes a slot while it runs."""

    def __init__(self, call: Callable, item, slots: threading.Semaphore):
        super().__init__(daemon=True)
        self.call, self.item, self.slots = call, item, slots
        self.done, self.began = threading.Event(), threading.Event()
        self.found = self.failure = self.since = None
        self.lock, self.held = threading.Lock(), True

    def run(self) -> None:
        self.since = time.monotonic()
        self.began.set()
        try:
            self.found = self.call(self.item)
        except Exception as e:
            self.failure = e
        self.release()
        self.done.set()

    def release(self) -> None:
        """Gives the slot back, once."""
        with self.lock:
            if self.held:
                self.held = False
                self.slots.release()


def in_order(items: Iterable[Item], call: Callable[[Item], Found], failed: Callable[[Item, Exception], Found], *, workers: int, seconds: float | None = None) -> Iterator[Found]:
    """call(item) of every item, in their order, workers at once.

    An exception becomes failed(item, exception), a value like the others; so does a
    call that takes more than seconds (CallTimeout): its slot goes to the next call, and
    what it still does is left alone. At most AHEAD * workers items are held.
    """
    slots, waiting = threading.Semaphore(workers), deque()

    def ended(one: _Call) -> Found:
        one.began.wait()
        left = None if seconds is None else max(0.0, one.since + seconds - time.monotonic())
        if not one.done.wait(left):
            one.release()
            return failed(one.item, CallTimeout(f"no end within {seconds} s"))
        return failed(one.item, one.failure) if one.failure is not None else one.found

    def take() -> None:
        """A slot, after the time of calls that hang if there is no other way."""
        while not slots.acquire(timeout=0.05):
            now = time.monotonic()
            for one in waiting:
                if seconds is not None and one.since is not None and not one.done.is_set() and now - one.since > seconds:
                    one.release()

    for item in items:
        if len(waiting) >= AHEAD * workers:
            yield ended(waiting.popleft())
        take()
        one = _Call(call, item, slots)
        waiting.append(one)
        one.start()
    while waiting:
        yield ended(waiting.popleft())
