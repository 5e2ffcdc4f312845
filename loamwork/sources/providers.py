"""Choosing a provider for a request: roles, budgets, rotation and waiting.

A pool runs inside a provider function (see labels.annotate). How a request is sent, what time it is
and how to wait are given from outside, so that the pool itself needs no network.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from math import ceil, inf

DAY = 86_400.0
TICK = 1e-3
#: Seconds for which a provider that failed once is left alone, and at most.
BACKOFF = 2.0
LONGEST = 120.0


class RateLimited(Exception):
    """The provider refused for now; retry_after is the header of that name, if it sent one."""

    def __init__(self, message: str = "", retry_after: str | None = None):
        super().__init__(message)
        self.retry_after = retry_after


class ProviderError(Exception):
    """The provider failed."""


class QuotaExhausted(Exception):
    """No provider of these roles will answer soon."""


@dataclass
class Slot:
    """A provider's limits and what it has been asked: times of sent requests and of answers."""

    name: str
    role: str = "primary"
    rpd: float = 1e9
    rpm: float = 1e9
    margin: float = 0.85
    disabled: bool = False
    available_after: float = 0.0
    answered: list[float] = field(default_factory=list)
    sent: list[float] = field(default_factory=list)
    failed: int = 0
    in_a_row: int = 0

    def ready_at(self, now: float) -> float:
        """The first moment from `now` on at which a request fits all limits; infinite for a disabled slot.

        A day's share frees a place as the answers of its last 24 hours age; a minute's share is that of
        the calendar minute; and a provider that has refused is left alone until available_after.
        """
        daily, minutely = (ceil(x * self.margin) for x in (self.rpd, self.rpm))
        if self.disabled or daily <= 0 or minutely <= 0:
            return inf
        recent = [t for t in self.answered if t >= now - DAY]
        aged = recent[len(recent) - daily] + DAY + TICK if len(recent) >= daily else now
        full = sum(t // 60 == now // 60 for t in self.sent) >= minutely
        return max(now, self.available_after, aged, (now // 60 + 1) * 60 if full else now)

    def note(self, now: float, answered: bool, pause: float | None = None, disable: bool = False) -> None:
        """Take down a request's outcome. Failures in a row double the time for which the slot is left alone."""
        self.sent = [*(t for t in self.sent if t // 60 == now // 60), now]
        if answered:
            self.answered = [*(t for t in self.answered if t >= now - DAY), now]
            self.in_a_row = 0
            return
        self.failed += 1
        self.in_a_row += 1
        self.disabled = self.disabled or disable
        self.available_after = now + (min(LONGEST, BACKOFF * 2 ** (self.in_a_row - 1)) if pause is None else pause)


def choose(slots: list[Slot], roles: tuple[str, ...], now: float) -> tuple[float, Slot | None]:
    """The slot of these roles that is ready first, the earlier in the list of equals, and when that is."""
    moments = [(s.ready_at(now), k) for k, s in enumerate(slots) if s.role in roles]
    when, k = min(moments, default=(inf, -1))
    return (when, slots[k]) if when < inf else (inf, None)


def seconds_of(header: str | None, now: float) -> float | None:
    """A Retry-After header, which holds seconds or a date, in seconds from now."""
    if not header:
        return None
    if header.strip().isdigit():
        return float(header)
    try:
        return max(0.0, parsedate_to_datetime(header).timestamp() - now)
    except ValueError:
        return None


def configured(specs: list[dict], environment: dict[str, str]) -> list[dict]:
    """Specs whose key, model and, but for the one kind with a fixed endpoint, endpoint are known."""
    found = []
    for spec in specs:
        whole = spec | {"model": spec.get("model") or environment.get(spec.get("model_env", ""), ""), "base_url": spec.get("base_url") or environment.get(spec.get("base_url_env", ""), "")}
        if environment.get(spec["api_key_env"]) and whole["model"] and (whole["base_url"] or spec["kind"] == "gemini"):
            found.append(whole)
    return found


@dataclass
class Pool:
    slots: list[Slot]
    send: Callable[[Slot, object], str]
    clock: Callable[[], float] = time.time
    wait: Callable[[float], None] = time.sleep
    patience: float = 300.0

    def call(self, request: object, roles: tuple[str, ...] = ("primary",)) -> tuple[Slot, str]:
        """Who answered, and what. Waits for the slot that is ready first, up to `patience` seconds in all."""
        end = self.clock() + self.patience
        while (found := choose(self.slots, roles, now := self.clock()))[0] <= end:
            when, slot = found
            if when > now:
                self.wait(when - now)
            elif (text := self._ask(slot, request, now)) is not None:
                return slot, text
        raise QuotaExhausted(f"no provider for {roles}")

    def _ask(self, slot: Slot, request: object, now: float) -> str | None:
        try:
            text = self.send(slot, request)
        except RateLimited as e:
            return slot.note(now, False, seconds_of(e.retry_after, now))
        except ProviderError as e:
            return slot.note(now, False, disable="insufficient balance" in str(e).lower())
        slot.note(now, True)
        return text
