"""Sequential alignment of a recording's segments, with a cursor.

Each segment is sought from where the last one ended: windows forward and, five to one,
backward; the best regions are refined; a poor result is sought again from the start; the
last resort is the best text at the cursor.  Where too few tokens are left for any text, the
segment has no match (nulls) and the cursor stays.  The order makes this one task per transcript;
the set-based operators are the default.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from stenoflow.operators.alignment import parts
from stenoflow.operators.sweep import Pattern, least

SCHEMA = "video string, transcript string, seg_idx int, start_idx int, end_idx int, cer double, human string, error string"


#: Windows that are compared at a time, at first and at most; a good one ends the search.  Segments of a sweep for bounds.
FEW, MANY, TOGETHER = 6, 384, 5


def distances(asr: str, human: str, cuts: list[int]) -> list[int]:
    """Edit distances of asr to the prefixes of human with the given lengths."""
    return Pattern(asr).band(human, [0], [cuts])[0]


def within(cer: float, size: int) -> int:
    """The greatest distance whose rate is within cer."""
    return max((d for d in range(int(cer * size) - 1, int(cer * size) + 2) if d / size <= cer), default=-1)


@dataclass
class Aligner:
    tokens: list[str]
    region_cer: float = 0.3
    global_cer: float = 0.45
    fine_cer: float = 0.05
    back: int = 250
    forward_turns: int = 5
    top: int = 3
    margin: int = 15
    #: Segments that are likely to be sought next; a sweep for bounds takes them along.
    coming: Sequence[str] = ()

    def __post_init__(self) -> None:
        self.known: dict[str, np.ndarray] = {}
        self.text = " ".join(self.tokens)
        self.places = list(accumulate((len(t) + 1 for t in self.tokens), initial=0))

    def end(self, start: int, length: int) -> int:
        """Place in the text where so many tokens from start on end."""
        return max(self.places[min(start + length, len(self.tokens))] - 1, self.places[start])

    def ahead(self, width: int, cursor: int) -> Iterator[int]:
        """Window starts from the cursor on; the last window is moved back to end with the transcript."""
        n, step = len(self.tokens), max(width // 2, 1)
        for pos in range(cursor, n, step):
            if pos + width >= n:
                yield max(n - width, 0) if pos + width > n else pos
                if pos + width > n:
                    return
            else:
                yield pos

    def behind(self, width: int, cursor: int) -> Iterator[int]:
        """Window starts before the cursor; the last one is at the limit."""
        limit, step = max(cursor - self.back, 0), max(width // 2, 1)
        while cursor > limit:
            cursor = max(cursor - step, limit)
            yield cursor

    def order(self, width: int, cursor: int) -> Iterator[int]:
        """Window starts as they are tried: turns forward, one turn back."""
        ahead, behind = self.ahead(width, cursor), self.behind(width, cursor)
        while turn := [*islice(ahead, self.forward_turns), *islice(behind, 1)]:
            yield from turn

    def bounds(self, asr: Pattern) -> np.ndarray:
        """For each number of tokens, a distance that no text that ends there goes below; some segments share a sweep."""
        if asr.text not in self.known:
            some = list(dict.fromkeys([asr.text, *filter(None, self.coming)]))
            ends = np.maximum(np.array(self.places) - 1, 0)
            self.known = {a: row[ends] for a, row in zip(some, least([Pattern(a) for a in some], self.text), strict=True)}
        return self.known[asr.text]

    def compare(self, asr: Pattern, width: int, at: Sequence[int], done: dict[int, int]) -> list[int]:
        """Distances of the windows at these places; those compared before are in done."""
        new = [p for p in dict.fromkeys(at) if p not in done]
        for i in range(0, len(new), MANY):
            some = new[i : i + MANY]
            done.update(zip(some, asr.windows([self.text[self.places[p] : self.end(p, width)] for p in some]), strict=True))
        return [done[p] for p in at]

    def search(self, asr: Pattern, width: int, cursor: int, limit: float, done: dict[int, int]) -> tuple[float, int, int] | None:
        """The best text within the limit near the first window that is good enough, or near the best ones of all windows.

        Only windows are compared that the bounds of their ends leave in question: those that can be good enough, those
        near a text within the limit, and those that can be better than one of these.
        """
        order, good = self.order(width, cursor), within(self.region_cer, asr.size)
        at = list(islice(order, FEW))
        first = next((p for p, d in zip(at, self.compare(asr, width, at, done), strict=True) if d <= good), None)
        if first is not None:
            return self.refine(asr, width, first, limit)
        bounds, n, few = self.bounds(asr), len(self.tokens), max(0, width - self.margin)
        hits = np.flatnonzero(bounds <= within(limit, asr.size))
        if not len(hits):
            return None
        pos = np.array(at + list(order), dtype=np.int64)
        bound = bounds[np.minimum(pos + width, n)]
        some = pos[bound <= good].tolist()
        for i in range(0, len(some), FEW):
            turn = some[i : i + FEW]
            first = next((p for p, d in zip(turn, self.compare(asr, width, turn, done), strict=True) if d <= good), None)
            if first is not None:
                return self.refine(asr, width, first, limit, bounds)
        low = np.maximum(pos - self.margin, 0) + few  # ends of the texts near a window
        high = np.minimum(np.minimum(pos + self.margin, n - few) + width + self.margin, n)
        near = np.searchsorted(hits, low) < np.searchsorted(hits, high, "right")
        lower = {int(p): int(bounds[a : b + 1].min()) for p, a, b in zip(pos[near], low[near], high[near], strict=True)}
        ranked, best = pos[near].tolist(), None
        ranked = sorted(zip(self.compare(asr, width, ranked, done), ranked, strict=True))
        for rank, (d, p) in enumerate(ranked[: self.top]):
            if best is not None and lower[p] / asr.size >= best[0]:
                continue
            others = pos[~near & (bound <= d)].tolist()
            if rank + sum(o < (d, p) for o in zip(self.compare(asr, width, others, done), others, strict=True)) >= self.top:
                break
            found = self.refine(asr, width, p, limit, bounds)
            if found is not None and (best is None or found[0] < best[0]):
                best = found
        return best

    def refine(self, asr: Pattern, width: int, region: int, limit: float | None = None, bounds: np.ndarray | None = None) -> tuple[float, int, int] | None:
        """(cer, start, end) of the best text near a region; None where too few tokens are left for the least length.

        With a limit, None also where no text is within it; few windows are compared then.  Otherwise all starts and
        lengths come from one sweep over the text around the region.
        """
        n, few = len(self.tokens), max(0, width - self.margin)
        starts = range(max(0, region - self.margin), min(region + self.margin, n - few) + 1)
        if not starts:
            return None
        lengths = [range(few, min(width + self.margin, n - s) + 1) for s in starts]
        if limit is not None and asr.size:
            spans = [range(s + ks[0], s + ks[-1] + 1) for s, ks in zip(starts, lengths, strict=True)]
            below = None if bounds is None else bounds[spans[0][0] : max(ks[-1] for ks in spans) + 1].tolist()
            found = asr.nearest(self.text, self.places, starts, spans, within(limit, asr.size), within(self.fine_cer, asr.size), below)
            if found is not None:
                return self.first_best(found, asr.size, limit)
        if asr.size:
            ends = [[self.end(s, k) for k in ks] for s, ks in zip(starts, lengths, strict=True)]
            table = [[d / asr.size for d in row] for row in asr.band(self.text, [self.places[s] for s in starts], ends)]
        else:
            table = [[1.0] * len(ks) for ks in lengths]
        best, good = None, False
        for start, ks, row in zip(starts, lengths, table, strict=True):
            c = min(row)
            if best is None or c < best[0]:
                best = (c, start, start + ks[row.index(c)])
            good = good or best[0] <= self.fine_cer
            if good and c > self.fine_cer:
                break
        return best if limit is None or best[0] <= limit else None

    def first_best(self, found: list[tuple[int, int, int]], size: int, limit: float) -> tuple[float, int, int] | None:
        """As refine chooses, from all windows at the least distance within the limit and all within fine_cer."""
        rows: dict[int, tuple[int, int]] = {}
        for d, s, e in found:
            rows[s] = min(rows.get(s, (d, e)), (d, e))
        fine = sorted(s for s, (d, _) in rows.items() if d / size <= self.fine_cer)
        run = [s for i, s in enumerate(fine) if s == fine[0] + i]
        d, s, e = min(((*rows[s][:1], s, rows[s][1]) for s in run or rows), default=(size, 0, 0))
        return (d / size, s, e) if rows and d / size <= limit else None

    def find(self, asr: str, cursor: int) -> tuple[float, int, int] | None:
        width, pattern, done = max(len(asr.split()), 1), Pattern(asr), {}
        for start, limit in ((cursor, self.region_cer), (0, self.global_cer)) if asr else ():
            found = self.search(pattern, width, start, limit, done)
            if found:
                return found
        return self.refine(pattern, width, cursor)


def _align(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("seg_idx")
    video, transcript = part["video"].iloc[0], part["transcript"].iloc[0]
    rows, cursor, i = [], 0, None
    try:
        aligner = Aligner((part["text"].iloc[0] or "").split())
        heard = [a or "" for a in part["asr"]]
        for k, (i, asr) in enumerate(zip(part["seg_idx"], heard, strict=True)):
            aligner.coming = heard[k + 1 : k + TOGETHER]
            match = aligner.find(asr, cursor)
            if match is None:
                rows.append((video, transcript, int(i), None, None, None, None, None))
                continue
            c, a, cursor = match
            rows.append((video, transcript, int(i), a, cursor, float(c), " ".join(aligner.tokens[a:cursor]), None))
    except Exception as e:  # a pair that fails is reported with the segment where it did; what was done and the other pairs stay
        rows.append((video, transcript, None if i is None else int(i), None, None, None, None, repr(e)[:500]))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"seg_idx": "Int32", "start_idx": "Int32", "end_idx": "Int32", "cer": "Float64"})


def align(segments: DataFrame) -> DataFrame:
    """Rows (video, transcript, seg_idx, asr, text) to matches; text is the whole transcript, read on the first segment alone."""
    dealt = segments.repartition(parts(segments), "video", "transcript")
    return dealt.groupBy("video", "transcript").applyInPandas(_align, SCHEMA)
