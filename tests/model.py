"""The uplink rules as definitions over whole traces, for tests only.

Nothing here is replayed: every value is looked up in the list of steps by the
property that defines it. Steps are ``("s", sub_fn, sys_fn, level)`` for samples and
``("r", time, first)`` for reports; rows are numbered from 1.
"""

from __future__ import annotations

from types import SimpleNamespace

PERIOD = 10240


def span(a, b):
    """Rule "circular difference": subframes from a to b; one more, or a period on a wrap."""
    return b - a + (PERIOD if b < a else 1)


def replay(steps):
    numbers = range(1, len(steps) + 1)
    step = dict(zip(numbers, steps))
    samples = [n for n in numbers if step[n][0] == "s"]
    reports = [n for n in numbers if step[n][0] == "r"]

    # Rule "clock": the last valid reading plus the samples since, -11 before the first.
    readings = {
        n: step[n][2] * 10 + step[n][1] for n in samples if step[n][1] < 10 and step[n][2] is not None
    }

    def clock(n):
        known = [m for m in readings if m <= n]
        if not known:
            return -11
        return (readings[known[-1]] + sum(known[-1] < m <= n for m in samples)) % PERIOD

    # Rule "buffer delta": against the level read before, 0 at the start.
    levels = [(0, 0)] + [(n, step[n][3]) for n in samples if step[n][3] is not None]
    delta = {n: now - old for (_, old), (n, now) in zip(levels, levels[1:])}

    # Rule "first in, first out": the queue as a line of bytes, each tagged with its packet.
    line = [n for n in delta for _ in range(max(delta[n], 0))]
    begin = {n: line.index(n) for n in delta if delta[n] > 0}
    drains = [n for n in delta if delta[n] < 0]
    arrived = {n: sum(max(delta[m], 0) for m in delta if m <= n) for n in numbers}
    drained = {n: sum(max(-delta[m], 0) for m in delta if m <= n) for n in numbers}

    def drain_reaching(packet, count):
        """First drain after the packet came that has taken so many bytes off the line."""
        return next((n for n in drains if n > packet and drained[n] >= count), None)

    completed = []
    for packet, at in begin.items():
        # Rule "completion": its last byte has gone.
        done = drain_reaching(packet, at + line.count(packet))
        # Rule "first byte": all bytes before it have gone, though none of its own need have.
        first = drain_reaching(packet, at)
        if done:
            completed.append(
                (packet, delta[packet], clock(packet), clock(first), clock(done), done)
            )

    # Rule "report times": negative ones are a wrapped frame counter.
    time = {n: step[n][1] + 1024 * (step[n][1] < 0) for n in reports if step[n][1] is not None}

    def release(slot, since):
        """Rule "release": the first later report above the slot, or past the wrap of both."""
        return next(
            (n for n in time if n > since and (slot < time[n] or (slot > 1000 and time[n] < 20))),
            None,
        )

    # Rule "last per slot": of the packets that one report releases from a slot the last stays.
    results = {}
    for packet, _, t_in, t_first, slot, done in completed:
        at = release(slot, done)
        if at:
            results[slot, at] = (span(t_in, t_first), span(t_in, slot))

    released = []
    for (slot, at), (waiting, tx) in results.items():
        # Rule "retransmission": a repeat for the slot since the release before this one.
        before = max([r for s, r in results if s == slot and r < at], default=0)
        repeats = [n for n in time if time[n] == slot and not step[n][2] and before < n <= at]
        released.append((slot, waiting, tx, 8 if repeats else 0))

    return SimpleNamespace(
        rows=[(clock(n), delta.get(n), arrived[n], drained[n]) for n in numbers],
        completed=completed,
        released=released,
    )
