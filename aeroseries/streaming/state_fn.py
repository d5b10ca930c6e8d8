"""Per-site state updates of the stateful streams (K4).

Kept in its own small module of NumPy / pandas code; ``stream.py`` registers
it to be pickled by value, so executors can run it without this package.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState


def running_update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One site's new days: running GDD per calendar year and rows since the
    last rain, continued from the state left by earlier micro-batches."""
    year0, cum0, since0, last0 = state.get if state.exists else (None, 0.0, -1, None)
    pdf = pd.concat(list(batches), ignore_index=True).sort_values("date", kind="stable").reset_index(drop=True)
    day = np.array([d.toordinal() for d in pdf["date"]], dtype=np.int64)
    # Late: at or before the last day in state, or a repeated day.
    late = np.concatenate(([False], day[1:] == day[:-1])) if len(day) else np.zeros(0, bool)
    if last0 is not None:
        late |= day <= last0
    if late.any():
        out = pdf[late]
        yield pd.DataFrame({"site_id": out["site_id"].astype("int32"), "date": out["date"], "GDD_cumsum": np.nan,
                            "Days_Since_Rain": pd.array([None] * len(out), dtype="Int32"), "is_late": True})
        pdf, day = pdf[~late].reset_index(drop=True), day[~late]
    if not len(pdf):
        return
    years = np.array([d.year for d in pdf["date"]], dtype=np.int64)
    tavg = pdf["TAVG"].to_numpy(dtype=float)
    prcp = pdf["PRCP"].to_numpy(dtype=float)
    gdd = np.where(np.isnan(tavg), 0.0, np.maximum(tavg - 5.0, 0.0))
    cum = np.empty(len(pdf))
    cum_end = cum0
    for y in np.unique(years):  # a batch spans few calendar years
        m = years == y
        start = cum0 if (year0 is not None and y == year0) else 0.0
        # sequential sum from the carried value: same order as the batch running sum
        run = np.cumsum(np.concatenate(([start], gdd[m])))[1:]
        cum[m] = run
        cum_end = run[-1]
    idx = np.arange(len(pdf))
    last_rain = np.maximum.accumulate(np.where(prcp > 0, idx, -1))
    since = np.where(last_rain >= 0, idx - last_rain, since0 + 1 + idx)
    state.update((int(years[-1]), float(cum_end), int(since[-1]), int(day[-1])))
    yield pd.DataFrame({"site_id": pdf["site_id"].astype("int32"), "date": pdf["date"],
                        "GDD_cumsum": np.where(np.isnan(tavg), np.nan, cum),
                        "Days_Since_Rain": since.astype("int32"), "is_late": False})


DAY_MS = 86_400_000
EPOCH = dt.date(1970, 1, 1).toordinal()


class OrderedDays(StatefulProcessor):
    """Days in the order of the calendar, whatever the order of their arrival.

    A day is held in state until the watermark has passed its end; one timer a
    site waits for the earliest held day.  Then all days that are due come out
    in order, each with the running GDD of its year (base 5) and the rows since
    the last rain.  Batches are put in state as they come, so a site's share of
    a trigger is never in memory together.  A day that comes after its site
    went past it, and a second row of a held day, come out at once as late.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "day int", "TAVG double, PRCP double")
        self.run = handle.getValueState("run", "year int, gdd double, since int, last int")
        self.timer = handle.getValueState("timer", "day int")

    def _wait_for(self, day: int | None) -> None:
        """Leave one timer: at the end of ``day``."""
        now = self.timer.get()[0] if self.timer.exists() else None
        if now == day:
            return
        if now is not None:
            self.handle.deleteTimer((now + 1) * DAY_MS)
        if day is None:
            self.timer.clear()
        else:
            self.timer.update((day,))
            self.handle.registerTimer((day + 1) * DAY_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.run.get()[3] if self.run.exists() else None
        first = self.timer.get()[0] if self.timer.exists() else None
        for pdf in rows:
            late = []
            for date, tavg, prcp in zip(pdf["date"], pdf["TAVG"], pdf["PRCP"]):
                day = date.toordinal() - EPOCH
                if (last is not None and day <= last) or self.held.containsKey((day,)):
                    late.append(date)
                    continue
                self.held.updateValue((day,), (None if pd.isna(tavg) else float(tavg), None if pd.isna(prcp) else float(prcp)))
                first = day if first is None else min(first, day)
            if late:
                yield pd.DataFrame({"site_id": np.full(len(late), key[0], np.int32), "date": late, "GDD_cumsum": np.nan,
                                    "Days_Since_Rain": pd.array([None] * len(late), dtype="Int32"), "is_late": True})
        self._wait_for(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self.timer.clear()
        held = sorted((k[0], v) for k, v in self.held.iterator())
        due = [(d, v) for d, v in held if (d + 1) * DAY_MS <= passed]
        year, gdd, since, last = self.run.get() if self.run.exists() else (None, 0.0, -1, None)
        out = []
        for day, (tavg, prcp) in due:
            date = dt.date.fromordinal(day + EPOCH)
            if date.year != year:
                year, gdd = date.year, 0.0
            gdd += max(tavg - 5.0, 0.0) if tavg is not None else 0.0
            since, last = 0 if prcp is not None and prcp > 0 else since + 1, day
            out.append((int(key[0]), date, gdd if tavg is not None else np.nan, since, False))
            self.held.removeKey((day,))
        if out:
            self.run.update((year, gdd, since, last))
            frame = pd.DataFrame(out, columns=["site_id", "date", "GDD_cumsum", "Days_Since_Rain", "is_late"])
            yield frame.astype({"site_id": "int32", "Days_Since_Rain": "int32"})
        rest = held[len(due):]
        self._wait_for(rest[0][0] if rest else None)

    def close(self) -> None:
        pass
