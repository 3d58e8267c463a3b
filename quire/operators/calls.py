"""Model calls inside one task.

Rows wait in a queue ordered by the time they are due. A few threads take the
row that is due first, call the responder, and put the row back with a later
time when the call failed in a way that is worth another try. So a row that
waits for its next try holds no thread, and a slow one holds nobody but itself:
rows that came after it, those of later Arrow batches too, are answered
meanwhile.
"""

from __future__ import annotations

import heapq
import random
import threading
import time
from collections.abc import Callable
from typing import NamedTuple


class ModelDown(BaseException):
    """A responder raises this when it cannot go on at all (no quota, no
    credentials): the task fails instead of recording a failure per row. Rows
    that the task has finished are kept by its ledger, if it has one."""


class Answer(NamedTuple):
    ref: object
    reply: str | None
    error: str | None
    attempts: int
    elapsed_s: float


class TokenBucket:
    """At most ``rate`` takes a second, evenly spaced (None: no limit)."""

    def __init__(self, rate: float | None):
        self.rate = rate
        self.lock = threading.Lock()
        self.next_at = time.monotonic()

    def take(self) -> None:
        if not self.rate:
            return
        with self.lock:
            now = time.monotonic()
            wait = self.next_at - now
            self.next_at = max(now, self.next_at) + 1.0 / self.rate
        if wait > 0:
            time.sleep(wait)


class Calls:
    """``respond(*args)`` for every row put in, ``threads`` at a time.

    ``retry_in(message, failures)`` is the delay before a row's next try, or None
    when there is none; elapsed times count from a row's first call.
    """

    def __init__(self, respond: Callable[..., str], threads: int,
                 retry_in: Callable[[str, int], float | None], rate: float | None = None):
        self.respond, self.retry_in, self.bucket = respond, retry_in, TokenBucket(rate)
        self.changed = threading.Condition()
        #: (due, order, ref, args, attempts, begun)
        self.queue: list[tuple] = []
        self.answers: list[Answer] = []
        self.open, self.order, self.closed = 0, 0, False
        self.broken: BaseException | None = None
        self.threads = [threading.Thread(target=self._work, daemon=True)
                        for _ in range(max(1, threads))]
        for t in self.threads:
            t.start()

    def put(self, ref, args: tuple) -> None:
        with self.changed:
            self.open += 1
            self._push(time.monotonic(), ref, args, 0, None)

    def _push(self, due: float, ref, args: tuple, attempts: int, begun: float | None) -> None:
        self.order += 1
        heapq.heappush(self.queue, (due, self.order, ref, args, attempts, begun))
        self.changed.notify_all()

    def _next(self):
        with self.changed:
            while not self.closed:
                wait = self.queue[0][0] - time.monotonic() if self.queue else None
                if wait is not None and wait <= 0:
                    return heapq.heappop(self.queue)
                self.changed.wait(wait)
        return None

    def _work(self) -> None:
        while (item := self._next()) is not None:
            _, _, ref, args, attempts, begun = item
            begun = time.monotonic() if begun is None else begun
            reply = error = delay = None
            try:
                self.bucket.take()
                reply = self.respond(*args)
                reply = None if reply is None else str(reply)
            except Exception as exc:  # the row records the failure
                error = f"{type(exc).__name__}: {exc}"
                delay = self.retry_in(error, attempts + 1)
            except BaseException as exc:
                with self.changed:
                    self.broken, self.closed = exc, True
                    self.changed.notify_all()
                return
            with self.changed:
                if delay is not None:
                    self._push(time.monotonic() + delay, ref, args, attempts + 1, begun)
                    continue
                self.open -= 1
                self.answers.append(Answer(ref, reply, error, attempts + 1,
                                           time.monotonic() - begun))
                self.changed.notify_all()

    def take(self, rows: int, below: int, seconds: float) -> list[Answer]:
        """The finished rows, once there are ``rows`` of them, fewer than ``below``
        are open, or some are finished and ``seconds`` have passed."""
        until = time.monotonic() + seconds
        with self.changed:
            while not (self.broken or len(self.answers) >= rows or self.open < below
                       or not self.open):
                wait = until - time.monotonic()
                if wait <= 0 and self.answers:
                    break
                self.changed.wait(wait if wait > 0 else None)
            if self.broken:
                raise self.broken
            out, self.answers = self.answers, []
        return out

    def close(self) -> None:
        """No further call begins; those running end."""
        with self.changed:
            self.closed = True
            self.changed.notify_all()
        for t in self.threads:
            t.join()


def retry_schedule(classify: Callable[[str], str], max_retries: int, initial: float,
                   jitter: float, retry_other: bool) -> Callable[[str, int], float | None]:
    """Delays that double from ``initial``, for failures worth a retry."""
    def retry_in(message: str, failures: int) -> float | None:
        kind = classify(message)
        if failures > max_retries or not (kind == "retryable" or retry_other and kind == "other"):
            return None
        return initial * 2.0 ** (failures - 1) + (random.uniform(0, jitter) if jitter else 0.0)

    return retry_in
