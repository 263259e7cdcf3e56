"""Which stored rows of a row-based window change when some days of its source change, and what must be read for them.

A frame of ``reach`` rows (the row itself and the ``reach - 1`` rows before it) changes only where it holds a
changed row, so a changed day touches its entity's next ``reach - 1`` rows. Their frames begin ``reach - 1`` rows
before the change. Both are counted in rows, not days; the range of days that holds them is found by widening it
until every touched entity has enough rows on either side, reading two narrow columns of that range only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Span:
    """Days to read, both ends included, and the changed days among them."""

    first: date
    last: date
    changed: tuple[date, ...]

    def holds(self, at: str):
        return F.col(at).between(F.lit(self.first), F.lit(self.last))

    def is_changed(self, at: str):
        return F.col(at).isin(list(self.changed))


def _merged(spans: Sequence[Span]) -> list[Span]:
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: s.first):
        if out and s.first <= out[-1].last:
            t = out.pop()
            s = Span(t.first, max(t.last, s.last), tuple(sorted({*t.changed, *s.changed})))
        out.append(s)
    return out


def _widened(timeline: DataFrame, days: Sequence[date], span: Span, by: str, at: str, reach: int) -> Span:
    """The span, widened until the entities of its changed days have ``reach - 1`` rows on both sides, or no more days."""
    low, high = days.index(span.first), days.index(span.last)
    first, last = min(span.changed), max(span.changed)
    width_low, width_high = max(1, days.index(first) - low), max(1, high - days.index(last))
    while True:
        span = Span(days[low], days[high], span.changed)
        part = timeline.filter(span.holds(at))
        touched = part.filter(span.is_changed(at)).select(by).distinct()
        sides = part.join(touched, by, "left_semi").groupBy(by).agg(
            F.count_if(F.col(at) < F.lit(first)).alias("before"), F.count_if(F.col(at) > F.lit(last)).alias("after")
        )
        least = sides.agg(F.min("before").alias("before"), F.min("after").alias("after")).first()
        enough = (least["before"] is None or least["before"] >= reach - 1 or low == 0,
                  least["after"] is None or least["after"] >= reach - 1 or high == len(days) - 1)
        if all(enough):
            return span
        if not enough[0]:
            width_low *= 2
            low = max(0, days.index(first) - width_low)
        if not enough[1]:
            width_high *= 2
            high = min(len(days) - 1, days.index(last) + width_high)


def spans_to_read(timeline: DataFrame, days: Sequence[date], changed: Sequence[date], by: str, at: str, reach: int) -> list[Span]:
    """Disjoint spans that hold every touched row with its whole frame.

    ``timeline`` has the columns ``by`` and ``at`` and is partitioned by ``at``; ``days`` are its partitions.
    """
    days = sorted(days)
    place = {d: i for i, d in enumerate(days)}
    wide = [
        Span(days[max(0, place[d] - reach + 1)], days[min(len(days) - 1, place[d] + reach - 1)], (d,))
        for d in sorted(set(changed)) if d in place
    ]
    return _merged([_widened(timeline, days, s, by, at, reach) for s in _merged(wide)])


def touched_rows(timeline: DataFrame, span: Span, by: str, at: str, reach: int) -> DataFrame:
    """(by, at) of the rows whose frames hold a changed day."""
    frame = Window.partitionBy(by).orderBy(at).rowsBetween(1 - reach, 0)
    rows = timeline.filter(span.holds(at)).select(by, at)
    marked = rows.withColumn("_touched", F.max(span.is_changed(at)).over(frame))
    return marked.filter("_touched").select(by, at).distinct()
