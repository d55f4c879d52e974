"""Token ids of whole texts by a public byte-level BPE tokenizer, each distinct piece of text encoded once.

The tokenizer cuts a text by its pattern before it merges bytes, so a text may be cut beforehand at
places where the pattern always ends a match: before a blank followed by a byte that starts no white
space, and between an ASCII or Latin-1 letter and ASCII punctuation. The segments repeat a lot;
a worker keeps the ids of those it has met in a table of bounded size.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import hash_spans, slices

CACHE_SEGMENTS = 700_000  # kept by a worker; beyond it, the table starts anew

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_SOLID = ~_SPACE  # bytes that surely start no white space
_SOLID[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def segment_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places to cut, among them every start of a non-empty row."""
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    if len(buf) > 1:
        cut[:-2] |= (buf[:-1] == 32) & _SOLID[buf[1:]]
        letter = _LETTER[buf]
        latin = (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        letter[1:] |= latin
        cut[1:-1] |= letter[:-1] & _MARK[buf[1:]]
    cut[len(buf)] = False
    return np.flatnonzero(cut)


class SegmentEncoder:
    """Ids of byte segments. Known ones are found by their hash: in a table slot, or, where an earlier
    segment holds the slot, in a dictionary."""

    SLOT_BITS = 22

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(1 << self.SLOT_BITS, np.int32)  # 0: free
        self.displaced: dict[int, int] = {}
        self.known = 1
        self.hashes = np.zeros(1 << 16, np.uint64)
        self.at = np.zeros(1 << 16, np.int64)  # where each segment's ids begin
        self.ids = np.zeros(1 << 18, np.uint32)

    def add(self, hashes: np.ndarray, segments: list[str]) -> None:
        """``hashes`` distinct and not yet known."""
        found = []
        for lo in range(0, len(segments), 4096):  # the library's results are much larger than their ids
            found += [e.ids for e in self.tokenizer.encode_batch_fast(segments[lo : lo + 4096], add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        base, n, used = self.known, len(hashes), int(self.at[self.known])
        end = used + int(count.sum())
        if base + n + 1 > len(self.hashes):
            grow = max(len(self.hashes), n + 1)
            self.hashes = np.concatenate([self.hashes, np.zeros(grow, np.uint64)])
            self.at = np.concatenate([self.at, np.zeros(grow, np.int64)])
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), end - used), np.uint32)])
        self.ids[used:end] = np.fromiter((i for ids in found for i in ids), np.uint32, end - used)
        self.hashes[base : base + n] = hashes
        self.at[base + 1 : base + n + 1] = used + np.cumsum(count)
        self.known += n
        place = (hashes >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        index = np.arange(base, base + n)
        free = self.slots[place] == 0
        self.slots[place[free][::-1]] = index[free][::-1]
        lost = self.slots[place] != index
        self.displaced.update(zip(hashes[lost].tolist(), index[lost].tolist()))

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each segment, 0 where unknown."""
        index = self.slots[(hashes >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)]
        other = np.flatnonzero((self.hashes[index] != hashes) | (index == 0))
        if len(other):
            index[other] = [self.displaced.get(h, 0) for h in hashes[other].tolist()]
        return index

    def slice_ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the rows' offsets in them."""
        starts = segment_starts(buf, offsets)
        ends = np.append(starts[1:], len(buf))
        hashes = hash_spans(buf, starts, ends)
        index = self.look_up(hashes)
        new = np.flatnonzero(index == 0)
        if len(new):
            if self.known > CACHE_SEGMENTS:
                self.clear()
                new = np.arange(len(hashes))
            distinct, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            raw = buf.tobytes()
            self.add(distinct, [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            index[new] = self.look_up(hashes[new])
        begin = self.at[index]
        total = np.concatenate([[0], np.cumsum(self.at[index + 1] - begin)])
        take = np.arange(total[-1]) + np.repeat(begin - total[:-1], np.diff(total))
        return self.ids[take], total[np.searchsorted(starts, offsets)]


@functools.cache
def encoder(path: str) -> SegmentEncoder:
    return SegmentEncoder(path)


def column_ids(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its ids as uint32) of a text column, in order; null counts as the empty text."""
    tool = encoder(path)
    for lo, hi, buf, offsets in slices(column):
        ids, at = tool.slice_ids(buf, offsets)
        raw = buf.tobytes()
        special = any(mark in raw for mark in tool.special)
        for k in range(hi - lo):
            if special and any(mark in raw[offsets[k] : offsets[k + 1]] for mark in tool.special):
                text = raw[offsets[k] : offsets[k + 1]].decode()
                yield lo + k, np.array(tool.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                yield lo + k, ids[at[k] : at[k + 1]]
