"""One run at a time, and a record of the layers that it has finished."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

from sedimenta.sinks.files import Store

LEASE = "lease.json"


class RunInProgress(RuntimeError):
    """Another run holds the lease."""


class LeaseLost(RuntimeError):
    """The lease expired and another run took it."""


class Lease:
    """An exclusive marker that expires unless it is renewed."""

    def __init__(self, store: Store, seconds: float):
        self.store, self.seconds, self.run = store, seconds, uuid.uuid4().hex
        self._guard = threading.Lock()

    def _marker(self) -> dict:
        return {"run": self.run, "expires": time.time() + self.seconds}

    def acquire(self) -> None:
        if self.store.create(LEASE, self._marker()):
            return
        # A marker that its run died on while writing it counts from when it was begun.
        held = self.store.read(LEASE)
        shown = held or {"run": "unknown", "expires": self.store.modified(LEASE) + self.seconds}
        if shown["expires"] > time.time():
            raise RunInProgress(f"{self.store.root}/{LEASE} is held by run {shown['run']}")
        # Of several runs that see an expired lease, the one that makes the next claim takes it.
        for n in count():
            claim = f"claim-{shown['run']}-{n}.json"
            before = self.store.read(claim)
            if before is not None and before["expires"] <= time.time():
                continue
            if before is not None or not self.store.create(claim, self._marker()):
                raise RunInProgress(f"{self.store.root}/{LEASE} is being taken over")
            break
        if self.store.read(LEASE) == held:
            self.store.replace(LEASE, self._marker())
        self.renew()

    def renew(self) -> None:
        """Extend the lease; fails if another run has it."""
        with self._guard:
            held = self.store.read(LEASE)
            if held is None or held["run"] != self.run:
                raise LeaseLost(f"{self.store.root}/{LEASE} is held by run {held and held['run']}")
            self.store.replace(LEASE, self._marker())

    def release(self) -> None:
        with self._guard:
            held = self.store.read(LEASE)
            if held is not None and held["run"] == self.run:
                self.store.remove(LEASE)
                for name in self.store.names():
                    if name.startswith("claim-"):
                        self.store.remove(name)


@contextmanager
def leased(store: Store, seconds: float) -> Iterator[Lease]:
    """Hold the lease of a store, renewed from a thread while the block runs."""
    lease, done = Lease(store, seconds), threading.Event()
    lease.acquire()

    def beat() -> None:
        while not done.wait(seconds / 3):
            try:
                lease.renew()
            except Exception:  # noqa: BLE001 - the run finds out at its next step
                return

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield lease
    finally:
        done.set()
        thread.join()
        lease.release()


class Record:
    """What a run of one date has finished. It goes when all is done, so the next run starts anew."""

    def __init__(self, store: Store, kind: str, as_of: str, stamp: str):
        self.store, self.kind = store, f"run_{kind}"
        found = store.latest(self.kind)
        self.resumed = found is not None and found["as_of"] == as_of
        self.value = found if self.resumed else {"as_of": as_of, "stamp": stamp, "done": []}
        if not self.resumed:
            store.put(self.kind, self.value)

    @property
    def stamp(self) -> str:
        return self.value["stamp"]

    @property
    def done(self) -> list[str]:
        return self.value["done"]

    def finish(self, step: str) -> None:
        self.value = {**self.value, "done": [*self.done, step]}
        self.store.put(self.kind, self.value)

    def close(self) -> None:
        for name in self.store.names():
            if name.startswith(f"{self.kind}-"):
                self.store.remove(name)
