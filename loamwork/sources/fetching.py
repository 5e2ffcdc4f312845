"""Polite fetching: a schedule over hosts, with pauses, retries and refusals.

How a request is sent, what time it is and how to wait are given from outside, so that nothing here
opens a connection. fetch() can run inside mapInPandas over requests that are partitioned by host, so
that a host's requests meet in one task.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from loamwork.sources.providers import seconds_of

#: Seconds between two requests to a host, and before the first repetition; each one doubles it.
DELAY = 2.0
PAUSE = 4.0
RETRIES = 2


@dataclass
class Response:
    status: int | None
    text: str = ""
    retry_after: str | None = None


@dataclass
class _Host:
    due: float = 0.0
    refused: bool = False


def outcome(response: Response, repeated: int, now: float, retries: int = RETRIES) -> tuple[str, float]:
    """What becomes of a request and, if it is sent again, after how many seconds.

    403 is a refusal of the whole host. 429, errors of the server and lost connections may pass; other
    errors do not.
    """
    status = response.status
    if status is not None and status < 400:
        return "done", 0.0
    if status == 403:
        return "refused", 0.0
    if status is not None and status != 429 and status < 500:
        return "failed", 0.0
    if repeated >= retries:
        return "failed", 0.0
    asked = seconds_of(response.retry_after, now)
    return "again", PAUSE * 2**repeated if asked is None else asked


def fetch(
    urls: list[str], send: Callable[[str], Response], allowed: Callable[[str], bool] = lambda url: True,
    clock: Callable[[], float] = time.time, wait: Callable[[float], None] = time.sleep, delay: float = DELAY, retries: int = RETRIES,
) -> Iterator[tuple[str, Response | None, str]]:
    """(url, response, outcome) of each url: done, failed, refused or disallowed. Other hosts go on while one is waited for."""
    hosts: dict[str, _Host] = {}
    queue = [(0.0, k, 0) for k in range(len(urls))]
    while queue:
        due, k, repeated = heapq.heappop(queue)
        url = urls[k]
        host = hosts.setdefault(urlsplit(url).netloc, _Host())
        if host.refused or not allowed(url):
            yield url, None, "refused" if host.refused else "disallowed"
            continue
        if host.due > due:
            heapq.heappush(queue, (host.due, k, repeated))
            continue
        if due > (now := clock()):
            wait(due - now)
        response = send(url)
        now = clock()
        what, pause = outcome(response, repeated, now, retries)
        host.due = now + max(delay, pause)
        host.refused = what == "refused"
        if what == "again":
            heapq.heappush(queue, (host.due, k, repeated + 1))
        else:
            yield url, response, what
