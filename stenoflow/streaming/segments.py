"""Segmentation of recordings whose silences and speakers arrive as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stenoflow.operators.segmenting import OUT, Rules, fold


class Segments(StatefulProcessor):
    """State of a recording: cursor, number of segments, and the silences and labels that may still matter.

    Rows are (video, start, end, label), of silences without a label and of speech with one, in time
    order between batches; a row whose start is null closes the recording at `end`.
    """

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", T.StructType().add("cur", T.DoubleType()).add("n", T.IntegerType()))
        self.spans = handle.getListState(
            "spans", T.StructType().add("start", T.DoubleType()).add("end", T.DoubleType()).add("label", T.StringType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        cur, n = self.cursor.get() if self.cursor.exists() else (0.0, 0)
        held = [tuple(s) for s in self.spans.get()] if self.spans.exists() else []
        closed, known = False, 0.0
        for part in rows:
            for r in part.itertuples():
                if pd.isna(r.start):
                    closed, known = True, float(r.end)
                elif r.end > r.start:
                    held.append((float(r.start), float(r.end), None if pd.isna(r.label) else r.label))
        if not closed:
            known = max((s[0] for s in held), default=0.0)
        silences = sorted({s[:2] for s in held if s[2] is None})
        labels = sorted({s for s in held if s[2] is not None})
        made, cur = fold(cur, known, closed, silences, labels, self.rules)
        if closed:
            self.cursor.clear()
            self.spans.clear()
        else:
            self.cursor.update((cur, n + len(made)))
            self.spans.put([s for s in held if s[1] > cur] or [(-1.0, 0.0, None)])
        if made:
            yield pd.DataFrame({"video": key[0], "seg_idx": range(n, n + len(made)), "start": [a for a, _ in made], "end": [b for _, b in made]})

    def close(self) -> None:
        pass


def segment_stream(spans: DataFrame, *, rules: Rules = Rules()) -> DataFrame:
    """Twin of `operators.segmenting.segment` over a stream of (video, start, end, label)."""
    return spans.groupBy("video").transformWithStateInPandas(Segments(rules), OUT, "Append", "none")


def greedy_stream(silences: DataFrame, *, least: float = 10.0, most: float = 20.0) -> DataFrame:
    """Twin of `operators.timeline.greedy_segments` over a stream of (video, start, end)."""
    return segment_stream(silences.withColumn("label", F.lit(None).cast("string")), rules=Rules(least, most, inside=False))
