"""Plain-Python models of the label semantics, to check the operators against."""

from collections import defaultdict, deque

FIVE = ["terminal", "broadband", "package", "number", "family"]
SIX = FIVE + ["xiaomi"]
DAY = 86_400_000
HOUR = 3_600_000


def two_day_counts(events):
    """events: (uid, channel, biz, ts, id). Returns id -> {(channel, biz): count}."""
    counts, out = defaultdict(int), {}
    for uid, channel, biz, ts, eid in sorted(events, key=lambda e: (e[3], e[4])):
        day = (ts + 8 * HOUR) // DAY
        counts[uid, day, channel, biz] += 1
        out[eid] = {
            (c, b): counts[uid, day, c, b] + counts[uid, day - 1, c, b] for c in ("click", "search") for b in FIVE
        }
    return out


def queues(events, gap_ms, length=12):
    """events: (uid, biz, ts, id). Returns id -> queue, and uid -> number of queue starts."""
    queue, last, out, starts = defaultdict(deque), {}, {}, defaultdict(int)
    for uid, biz, ts, eid in sorted(events, key=lambda e: (e[2], e[3])):
        if uid not in last or ts - last[uid] >= gap_ms:
            queue[uid].clear()
            starts[uid] += 1
        last[uid] = ts
        queue[uid].append(biz)
        if len(queue[uid]) > length:
            queue[uid].popleft()
        out[eid] = list(queue[uid])
    return out, dict(starts)


def exposure_texts(queue, pad_below=5):
    """(least two, history) of a queue, by building the table of counts slot by slot.

    Fixed values: the slot of each business. Two businesses share slot 1; a counted one is put at
    the front of its slot, a padded one at the back.
    """
    slot = {"number": 1, "xiaomi": 1, "package": 3, "broadband": 6, "terminal": 11, "family": 12}
    slots, counts = defaultdict(list), defaultdict(int)
    for biz in queue:
        if biz not in counts:
            slots[slot[biz]].insert(0, biz)
        counts[biz] += 1
    if len(counts) < pad_below:
        for biz in SIX:
            if biz not in counts:
                slots[slot[biz]].append(biz)
                counts[biz] = 0
    order = [b for s in sorted(slots) for b in slots[s]]
    least = sorted(order, key=lambda b: counts[b])[:2]
    return ",".join(least), ",".join(f"{b}:{counts[b]}" for b in order)
