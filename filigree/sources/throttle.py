"""Rate limits and retries for sources behind a network, per task: give each partition its share of the rate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

T = TypeVar("T")
R = TypeVar("R")


class Bucket:
    """Tokens flow in at a rate up to a burst; the rate halves when told to slow down and recovers by a tenth at each success."""

    def __init__(self, per_second: float, burst: int = 1, least: float = 0.1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.full = self.rate = per_second
        self.burst, self.least = burst, least
        self._clock, self._sleep = clock, sleep
        self._tokens, self._at = float(burst), clock()

    def take(self) -> float:
        """Wait for a token; the seconds waited."""
        now = self._clock()
        self._tokens = min(self.burst, self._tokens + (now - self._at) * self.rate)
        self._at = now
        wait = max(0.0, (1 - self._tokens) / self.rate)
        if wait:
            self._sleep(wait)
            self._at += wait
        self._tokens += wait * self.rate - 1
        return wait

    def slow_down(self, retry_after: float | None = None) -> None:
        self.rate = max(self.least, self.rate / 2)
        if retry_after:
            self._sleep(retry_after)

    def succeeded(self) -> None:
        self.rate = min(self.full, self.rate * 1.1)


def retried(call: Callable[[], R], times: int = 3, delay: float = 1.0, on: tuple[type[Exception], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep) -> R:
    """The call's result; after a failure of the given kinds again, waiting twice as long each time."""
    for n in range(times):
        try:
            return call()
        except on:
            if n == times - 1:
                raise
            sleep(delay * 2**n)
    raise ValueError("times must be positive")


def throttled(items: Iterable[T], fetch: Callable[[T], R], per_second: float, partitions: int, burst: int = 1) -> Iterator[R]:
    """For use in ``mapPartitions``: fetch every item at this partition's share of the whole rate."""
    bucket = Bucket(per_second / max(1, partitions), burst)
    for item in items:
        bucket.take()
        yield retried(lambda item=item: fetch(item))
        bucket.succeeded()
