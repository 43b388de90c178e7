"""State of the ordered streams: a page is one message to the state store, whatever rows it serves;
the number of micro-batches of a replay is bounded."""

from martlake.sources import replay
from martlake.streaming.ordered import PAGES, Pages


class Store:
    """A map state that counts its messages."""

    def __init__(self):
        self.entries, self.messages = {}, 0

    def getValue(self, key):
        self.messages += 1
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.messages += 1
        self.entries[key] = value


def test_messages_are_bounded_by_pages():
    store = Store()
    for _ in range(2):
        held = Pages(store)
        for k in range(20_000):
            held.put((k % 25, k), ((held.get((k % 25, k)) or (0,))[0] + 1,))
        held.write()
    assert store.messages <= 4 * PAGES
    held = Pages(store)
    assert all(held.get((k % 25, k)) == (2,) for k in range(20_000)) and held.get((0, -1)) is None
    held.write()
    assert store.messages <= 5 * PAGES  # nothing changed, nothing written


def test_a_larger_replay_has_larger_batches(monkeypatch):
    for files in (0, 5, 300, 3000):
        monkeypatch.setattr(replay, "_files", lambda _: [str(k) for k in range(files)])
        monkeypatch.setattr(replay, "_position", lambda _: None)
        step = replay._Reader(None, {"path": "x", "files": "8"}).step
        assert step >= 8 and -(-files // step) <= replay.BATCHES
