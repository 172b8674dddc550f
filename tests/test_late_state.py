"""The state of late-event balances, on a state store that counts its calls."""

import random

import pytest

from ledgerlake.streaming import late


class Store:
    """State of one key, and the number of calls made to it."""

    def __init__(self):
        self.calls, self.maps, self.values, self.timers = 0, {}, {}, []

    def getMapState(self, name, *_):
        return MapOf(self, self.maps.setdefault(name, {}))

    def getValueState(self, name, *_):
        return ValueOf(self, name)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, t):
        self.timers = [x for x in self.timers if x != t]

    def registerTimer(self, t):
        self.timers = [*self.timers, t]

    def getCurrentProcessingTimeInMs(self):
        return 0


class MapOf:
    def __init__(self, store, held):
        self.store, self.held = store, held

    def _called(self, result=None):
        self.store.calls += 1
        return result

    def exists(self):
        return self._called(bool(self.held))

    def getValue(self, k):
        return self._called(self.held.get(k))

    def updateValue(self, k, v):
        self._called(self.held.__setitem__(k, v))

    def removeKey(self, k):
        self._called(self.held.pop(k, None))

    def iterator(self):
        return self._called(iter(list(self.held.items())))


class ValueOf:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def get(self):
        self.store.calls += 1
        return self.store.values.get(self.name)

    def update(self, v):
        self.store.calls += 1
        self.store.values[self.name] = v

    def clear(self):
        self.store.calls += 1
        self.store.values.pop(self.name, None)


def some_rows(n, slots, rnd):
    rows = [{"slot": s, "at": s * 100 + rnd.randint(0, 9), "id": i, "amount": rnd.randint(-9, 9)} for i in range(n) for s in [rnd.randrange(slots)]]
    return rows + [{"slot": 0, "at": None, "id": n, "amount": 3}, {"slot": 0, "at": 4, "id": None, "amount": 2}]


def test_a_small_bucket_is_read_and_written_once_a_batch():
    """30 slots of an account: a few calls to the state store, not some for each slot."""
    store, rnd = Store(), random.Random(3)
    p = late.SlotBalances("bigint", None)
    p.init(store)
    for _ in range(2):
        before = store.calls
        list(p.handleInputRows(("A", 0), iter(some_rows(60, 30, rnd)), store))
        assert store.calls - before <= 4


@pytest.mark.parametrize("packed", [0, 40, 10_000])
@pytest.mark.parametrize("settle_ms", [None, 5])
def test_buckets_small_and_outgrown_give_the_same(monkeypatch, packed, settle_ms):
    """Batches of a bucket, quiet in between if there is a settle time: the newest
    running sums and totals, with an entry a slot from the start, after a while, or never."""
    monkeypatch.setattr(late, "PACKED", packed)
    store, rnd = Store(), random.Random(5)
    p = late.SlotBalances("bigint", settle_ms)
    p.init(store)
    seen, running, totals, closed = [], {}, {}, set()
    for batch in range(4):
        rows = [r | {"id": r["id"] and r["id"] + 1000 * batch} for r in some_rows(25, 3 + batch, rnd)]
        rows = [r for r in rows if r["id"] is not None or batch == 0]
        seen += rows
        for c in p.handleInputRows(("A", 0), iter(rows), store):
            if c.total is not None:
                totals[c.slot] = c.total
            else:
                running[c.slot, c.at, c.id] = c.running
                assert (c.running is None) == (c.slot in closed)
        if settle_ms and batch == 1:
            assert list(p.handleExpiredTimer(("A", 0), store, None)) == [] and not store.values and not store.maps["open"]
            closed = {r["slot"] for r in seen}
    for slot in {r["slot"] for r in seen}:
        mine = sorted((r for r in seen if r["slot"] == slot), key=lambda r: late.SlotBalances.place((r["at"], r["id"], 0)))
        assert totals[slot] == sum(r["amount"] for r in mine)
        total = 0
        for r in mine if slot not in closed else ():
            total += r["amount"]
            assert running[slot, r["at"], r["id"]] == total
