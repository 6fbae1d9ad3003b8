"""A cuckoo filter over digests, with the keys it stands for stored beside it."""

from __future__ import annotations

import random

SLOTS = 4
MAX_KICKS = 200
MASK = (1 << 64) - 1


class CuckooIndex:
    """Set of live 32-byte digests: a cuckoo filter in front of bucketed stored keys.

    The filter keeps a 16-bit fingerprint of each digest in one of two buckets. A miss in it is
    certain; a hit is checked against the stored keys of the bucket pair, so an answer is never
    wrong. Removing a digest takes its fingerprint out again. Where an insertion finds no place
    within ``MAX_KICKS`` moves, the filter doubles and is filled anew from the stored keys.
    """

    def __init__(self, capacity: int = 1024) -> None:
        self.buckets = 1
        while self.buckets * SLOTS * 0.9 < capacity:
            self.buckets *= 2
        self.keys: dict[int, dict[bytes, object]] = {}
        self.size = 0
        self.resizes = 0
        self._clear()

    def _clear(self) -> None:
        self.table = bytearray(2 * SLOTS * self.buckets)
        self.kick = random.Random(7)

    def _places(self, digest: bytes) -> tuple[int, int, bytes]:
        mark = digest[8:10] if digest[8:10] != b"\0\0" else b"\0\1"
        one = int.from_bytes(digest[:8], "little") & (self.buckets - 1)
        return one, self._other(one, mark), mark

    def _other(self, bucket: int, mark: bytes) -> int:
        spread = (int.from_bytes(mark, "little") * 0x9E3779B97F4A7C15 & MASK) >> 20
        return (bucket ^ spread) & (self.buckets - 1)

    def _find(self, bucket: int, mark: bytes) -> int:
        """Offset of the slot that holds ``mark``, or -1."""
        at = 2 * SLOTS * bucket
        for slot in range(at, at + 2 * SLOTS, 2):
            if self.table[slot:slot + 2] == mark:
                return slot
        return -1

    def _place(self, digest: bytes) -> bool:
        one, two, mark = self._places(digest)
        for bucket in (one, two):
            if (slot := self._find(bucket, b"\0\0")) >= 0:
                self.table[slot:slot + 2] = mark
                return True
        bucket = one
        for _ in range(MAX_KICKS):
            slot = 2 * (SLOTS * bucket + self.kick.randrange(SLOTS))
            mark, self.table[slot:slot + 2] = bytes(self.table[slot:slot + 2]), mark
            bucket = self._other(bucket, mark)
            if (slot := self._find(bucket, b"\0\0")) >= 0:
                self.table[slot:slot + 2] = mark
                return True
        return False

    def _grow(self) -> None:
        stored = [d for bucket in self.keys.values() for d in bucket]
        while True:
            self.buckets *= 2
            self.resizes += 1
            self._clear()
            if all(self._place(d) for d in stored):
                return

    @staticmethod
    def _home(digest: bytes) -> int:
        return int.from_bytes(digest[10:14], "little")

    def may_hold(self, digest: bytes) -> bool:
        """What the filter alone says: no for certain, or perhaps."""
        one, two, mark = self._places(digest)
        return self._find(one, mark) >= 0 or self._find(two, mark) >= 0

    def get(self, digest: bytes):
        """The value stored with a live digest, else None. Hits are checked against the keys."""
        if not self.may_hold(digest):
            return None
        return self.keys.get(self._home(digest), {}).get(digest)

    def put(self, digest: bytes, value) -> None:
        """Store a value with a digest, which becomes live if it was not."""
        bucket = self.keys.setdefault(self._home(digest), {})
        fresh = digest not in bucket
        bucket[digest] = value
        if fresh:
            self.size += 1
            if not self._place(digest):
                self._grow()

    def remove(self, digest: bytes) -> bool:
        """Take a digest out; False if it was not live."""
        if self.get(digest) is None:
            return False
        one, two, mark = self._places(digest)
        slot = self._find(one, mark)
        if slot < 0:
            slot = self._find(two, mark)
        self.table[slot:slot + 2] = b"\0\0"
        home = self._home(digest)
        del self.keys[home][digest]
        if not self.keys[home]:
            del self.keys[home]
        self.size -= 1
        return True

    def __len__(self) -> int:
        return self.size
