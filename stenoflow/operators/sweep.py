"""Edit distances of a text to many windows of another one in a single sweep.

Myers' bit vectors hold the vertical differences of a column of the distance table.  Windows
lie side by side in one long integer, a lane each with a guard bit, so a step costs a few operations
on integers however many windows there are.  In a band, windows that begin at different places
read the same character at the same time; a lane is set back where its window begins.  A
distance is read at a window's end: the characters taken in, and the ones of the lane's positive
vector less those of its negative one.

The best window near a place needs few of these: one lane over the text, free in its start, gives for
each end the least distance that any start can have, and one lane back from an end gives the distances of all starts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property
from itertools import accumulate

import numpy as np

#: Ends that are swept back one by one; where more can be the best, all windows are swept at once.
FEW_ENDS = 12
#: Parts of a text that are swept side by side, and their characters, at most and at least.
PARTS, PART, LEAST_PART = 64, 1_024, 256


class Pattern:
    """A text to be compared, with the places of its characters as bit masks."""

    def __init__(self, text: str):
        self.text, self.size = text, len(text)
        self.bytes = self.size // 8 + 1  # of a lane: a bit for each character, and a guard
        self.bits = 8 * self.bytes
        self.full = (1 << self.size) - 1
        self.at: dict[str, int] = {}
        for i, c in enumerate(text):
            self.at[c] = self.at.get(c, 0) | 1 << i

    @cached_property
    def back(self) -> Pattern:
        """The text from its end on."""
        return Pattern(self.text[::-1])

    @cached_property
    def _lanes(self) -> tuple[np.ndarray, np.ndarray]:
        """A row of bytes for each character's lane, the first one for all others, and the row of each code point."""
        masks = [0, *self.at.values()]
        rows = np.frombuffer(b"".join(m.to_bytes(self.bytes, "little") for m in masks), np.uint8).reshape(len(masks), self.bytes)
        codes = [ord(c) for c in self.at]
        place = np.zeros(max(codes, default=0) + 2, np.intp)
        place[codes] = range(1, len(masks))
        return rows, place

    def ones(self, lanes: int) -> int:
        """The lowest bit of each lane."""
        return int.from_bytes((b"\1" + bytes(self.bytes - 1)) * lanes, "little")

    def windows(self, texts: Sequence[str]) -> list[int]:
        """Distances to texts."""
        if not self.size:
            return [len(t) for t in texts]
        out = [self.size] * len(texts)
        ends: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            if t:
                ends.setdefault(len(t), []).append(k)
        low = self.ones(len(texts))
        mask = low * self.full
        vp, vn = mask, 0
        rows, place = self._lanes
        most = max(ends, default=0)
        codes = np.frombuffer("".join([t.ljust(most, "\0") for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
        columns = place[np.minimum(codes, len(place) - 1)].reshape(len(texts), most).T
        for j, column in enumerate(columns, 1):
            x = int.from_bytes(rows[column].tobytes(), "little") | vn
            d = (((x & vp) + vp) ^ vp) | x
            hp, hn = vn | (mask & ~(d | vp)), vp & d
            hp = (hp << 1 | low) & mask
            vp = (hn << 1 | ~(d | hp)) & mask
            vn = hp & d
            for k in ends.get(j, ()):
                at = k * self.bits
                out[k] = j + (vp >> at & self.full).bit_count() - (vn >> at & self.full).bit_count()
        return out

    def band(self, text: str, starts: Sequence[int], ends: Sequence[Sequence[int]]) -> list[list[int]]:
        """Distances to text[starts[k]:e] for each e of ends[k]; starts ascend, ends are not before their start."""
        if not self.size:
            return [[e - s for e in es] for s, es in zip(starts, ends, strict=True)]
        out = [[self.size] * len(es) for es in ends]
        wanted: dict[int, list[tuple[int, int]]] = {}
        for k, es in enumerate(ends):
            for i, e in enumerate(es):
                if e > starts[k]:
                    wanted.setdefault(e, []).append((k, i))
        if not wanted:
            return out
        low = self.ones(len(starts))
        mask = low * self.full
        spread: dict[str, int] = {c: low * m for c, m in self.at.items()}
        vp, vn, opened = 0, 0, 0
        first, last = starts[0], max(wanted)
        for j in range(first, last):
            while opened < len(starts) and starts[opened] == j:
                fresh = self.full << opened * self.bits
                vp, vn = vp | fresh, vn & ~fresh
                opened += 1
            x = spread.get(text[j], 0) | vn
            d = (((x & vp) + vp) ^ vp) | x
            hp, hn = vn | (mask & ~(d | vp)), vp & d
            hp = (hp << 1 | low) & mask
            vp = (hn << 1 | ~(d | hp)) & mask
            vn = hp & d
            for k, i in wanted.get(j + 1, ()):
                at = k * self.bits
                out[k][i] = j + 1 - starts[k] + (vp >> at & self.full).bit_count() - (vn >> at & self.full).bit_count()
        return out

    def to_ends(self, text: str, ends: Sequence[int], free: bool = False) -> list[int]:
        """Distances to text[:e] for each e of ends, which ascend; if free, the least one to text[s:e] for any s."""
        if not self.size:
            return [0 if free else e for e in ends]
        full, top, first, get = self.full, 1 << self.size - 1, int(not free), self.at.get
        vp, vn, score, at, out = full, 0, self.size, 0, []
        for e in ends:
            for c in text[at:e]:
                x = get(c, 0) | vn
                d = ((((x & vp) + vp) ^ vp) | x) & full
                hp, hn = vn | ((d | vp) ^ full), vp & d
                if hp & top:
                    score += 1
                elif hn & top:
                    score -= 1
                hp = hp << 1 & full | first
                vp = hn << 1 | ((d | hp) ^ full)
                vn = hp & d
            at = max(at, e)
            out.append(score)
        return out

    def nearest(
        self, text: str, places: Sequence[int], starts: range, spans: Sequence[range], limit: int, all_to: int = -1, bounds: Sequence[int] | None = None,
    ) -> list[tuple[int, int, int]] | None:
        """(distance, start, end) of windows of tokens: all at the least distance, if within the limit, and all within all_to.

        Token i begins at places[i]; spans are the ends of each start's windows.  Windows at other distances may be
        among them.  bounds: distances of all ends, in order, that no window goes below, where they are at hand.  None where so many ends can have them that a band of all windows is the shorter way.
        """
        least, most = spans[0][0], max(s[-1] for s in spans)
        zero = places[starts[0]]
        ends = range(least, most + 1)
        if bounds is None:
            bounds = self.to_ends(text[zero : max(places[most] - 1, zero)], [max(places[e] - 1 - zero, 0) for e in ends], free=True)
        found: list[tuple[int, int, int]] = []
        for n, (bound, e) in enumerate(sorted(zip(bounds, ends, strict=True))):
            if bound > max(limit, all_to):
                break
            if n == FEW_ENDS:
                return None
            mine = [s for s, span in zip(reversed(starts), reversed(spans), strict=True) if e in span]
            if not mine:
                continue
            last = max(places[e] - 1, places[mine[-1]])
            row = self.back.to_ends(text[places[mine[-1]] : last][::-1], [max(last - places[s], 0) for s in mine])
            found += [(d, s, e) for d, s in zip(row, mine, strict=True)]
            limit = min(limit, *row)
        return found


class Patterns:
    """Several texts sought together in one sweep over a longer one, wherever they begin in it."""

    def __init__(self, texts: Sequence[str]):
        self.sizes = [len(t) for t in texts]
        self.at, offset = [], 0
        self.low, self.mask = 0, 0
        masks: dict[str, int] = {}
        for t in texts:
            self.at.append(offset)
            self.mask |= ((1 << len(t)) - 1) << offset
            own: dict[str, int] = {}
            for i, c in enumerate(t):
                own[c] = own.get(c, 0) | 1 << i
            for c, m in own.items():
                masks[c] = masks.get(c, 0) | m << offset
            offset += len(t) + 1
        self.masks = masks

    def ends(self, text: str, limits: Sequence[int]) -> list[list[int]]:
        """For each pattern, the places of text at which some part of it ends that is within the pattern's limit.

        A distance changes by one a character at most, so a pattern is looked at again only when it can have come
        within its limit.
        """
        out: list[list[int]] = [[] for _ in self.sizes]
        due: dict[int, list[int]] = {}
        for k, (size, limit) in enumerate(zip(self.sizes, limits, strict=True)):
            if size <= limit:
                out[k] = [0]
            due.setdefault(max(size - limit, 1), []).append(k)
        mask = self.mask
        vp, vn, get = mask, 0, self.masks.get
        for j, c in enumerate(text, 1):
            x = get(c, 0) | vn
            d = (((x & vp) + vp) ^ vp) | x
            hp, hn = vn | (mask & ~(d | vp)), vp & d
            hp = hp << 1 & mask
            vp = (hn << 1 | ~(d | hp)) & mask
            vn = hp & d
            for k in due.pop(j, ()):
                full = (1 << self.sizes[k]) - 1
                left = (vp >> self.at[k] & full).bit_count() - (vn >> self.at[k] & full).bit_count() - limits[k]
                if left <= 0:
                    out[k].append(j)
                due.setdefault(j + max(left, 1), []).append(k)
        return out


def least(patterns: Sequence[Pattern], text: str) -> list[np.ndarray]:
    """For each pattern with a text, the least distance to text[s:e] for any s, for each e from 0 to the text's length.

    Parts of the text lie side by side as lanes.  Each is begun twice the longest pattern before its place: a longer
    window is further off than the empty one, so its start does not matter.
    """
    before, width = 2 * max(p.size for p in patterns), sum(p.bytes for p in patterns)
    offsets = list(accumulate((p.bytes for p in patterns), initial=0))
    chars = list(dict.fromkeys(c for p in patterns for c in p.at))
    lane = lambda masks: b"".join(m.to_bytes(p.bytes, "little") for p, m in zip(patterns, masks, strict=True))
    rows = np.frombuffer(lane([0] * len(patterns)) + b"".join(lane([p.at.get(c, 0) for p in patterns]) for c in chars), np.uint8).reshape(-1, width)
    place = np.zeros(max(map(ord, chars)) + 2, np.intp)
    place[[ord(c) for c in chars]] = range(1, len(chars) + 1)
    codes = place[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), len(place) - 1)]
    out = [[np.array([p.size], np.int32)] for p in patterns]
    for zero in range(0, len(text), PARTS * PART):
        size = min(len(text) - zero, PARTS * PART)
        parts = min(PARTS, -(-size // LEAST_PART))
        part = -(-size // parts)
        padded = np.concatenate([np.zeros(max(before - zero, 0), np.intp), codes[max(zero - before, 0) : zero + size], np.zeros(parts * part - size, np.intp)])
        columns = padded[np.arange(before + part)[:, None] + np.arange(parts) * part]
        data, step = rows[columns].tobytes(), parts * width
        full = int.from_bytes(lane([p.full for p in patterns]) * parts, "little")
        top = int.from_bytes(lane([1 << p.size - 1 for p in patterns]) * parts, "little")
        vp, vn, up, down = full, 0, [], []
        for j in range(0, len(data), step):
            x = int.from_bytes(data[j : j + step], "little") | vn
            d = ((((x & vp) + vp) ^ vp) | x) & full
            hp, hn = vn | ((d | vp) & full ^ full), vp & d
            up.append((hp & top).to_bytes(step, "little"))
            down.append((hn & top).to_bytes(step, "little"))
            hp = hp << 1 & full
            vp = (hn << 1 | ((d | hp) ^ full)) & full
            vn = hp & d
        ups, downs = (np.frombuffer(b"".join(b), np.uint8).reshape(-1, parts, width) for b in (up, down))
        for p, at, found in zip(patterns, offsets, out, strict=False):
            k = at + (p.size - 1) // 8
            change = (ups[:, :, k] != 0).astype(np.int32) - (downs[:, :, k] != 0)
            found.append((p.size + change.cumsum(axis=0))[before:].T.reshape(-1)[:size])
    return [np.concatenate(f) for f in out]
