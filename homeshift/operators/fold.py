"""The rules of one user's days in plain Python: the step that the stream's state processor runs.

A batch run and the daily job take the same step as Spark expressions (``user_state``); a stream keeps a user's
state in Python objects between two store accesses, so it needs the step here.  The tests hold the two versions
against each other.

Rules of one sighting (day d, zip z), in the reference's order within a day:
1. pool age: if the user was in the pool and ``d - first > age_limit``, it was
   evicted at the end of day ``first + age_limit``;
2. route: pool member -> mover; at the reference zip -> home; else -> mover;
3. home: counted in the reference history, nothing else;
4. mover: no streak or another zip -> new streak and a week-0 pool row;
   same zip -> count the day and move the week number;
5. on an exact 7-day anniversary of a continued streak that passes the weekly
   test: reference zip -> return home (evicted when presence <= return_limit),
   other zip -> pool row of that week;
6. end of day: presence > age_limit -> evicted.
At the end of the run the pool age is checked once more on the horizon day.
"""

from __future__ import annotations

import datetime as _dt

from homeshift.config import Thresholds
from homeshift.schemas import FOLD_OUTPUT

EPOCH = _dt.date(1970, 1, 1)
FOLD_COLUMNS = [f.name for f in FOLD_OUTPUT.fields]


def _share(x: int, total: int) -> float:
    return 0.0 if total == 0 else x / total


def week_passes(we: int, sem: int, th: Thresholds) -> bool:
    # one streak row per user: the week totals are the row's own counters
    return (
        we >= th.week_min_weekend
        and sem >= th.week_min_weekday
        and _share(we, we) >= th.week_share_weekend
        and _share(sem, sem) >= th.week_share_weekday
    )


def _date(n: int) -> _dt.date:
    return EPOCH + _dt.timedelta(days=int(n))


class UserState:
    """State of one user over the whole run.  Days are epoch-day ints."""

    __slots__ = ("user_id", "ref_zip", "ref_day", "th", "learn", "streak", "pool", "first", "fed", "fed_days", "out")

    def __init__(self, user_id: int, ref_zip: str | None, ref_day: int | None, th: Thresholds, learn: bool = False):
        """``learn``: find the reference day on the fly (streaming) instead of taking it from the windows."""
        self.user_id, self.ref_zip, self.ref_day, self.th, self.learn = user_id, ref_zip, ref_day, th, learn
        self.streak = None  # [zip, start, weekend_days, weekday_days, week_no]
        self.pool: dict[tuple[str, int], int] = {}  # (zip, week) -> since
        self.first = None  # earliest pool date, None when not in the pool
        self.fed: dict[str, list[int]] = {}  # reference history: zip -> [weekend days, weekday days]
        self.fed_days = [None, None, None]  # first, last and previous day that fed the history
        self.out: list[tuple] = []

    # ---------------------------------------------------------------- rows
    def _row(self, kind, **kw):
        self.out.append((self.user_id, kind) + tuple(kw.get(c) for c in FOLD_COLUMNS[2:]))

    def _evict_aged(self, day: int) -> None:
        dmax = max(self.pool.values())
        presence = day - self.first + 1
        for (z, wk), since in self.pool.items():
            self._row("aged", day=_date(day), zipcode=z, week=wk, since=_date(since), date_min=_date(self.first),
                      date_max=_date(dmax), presence_days=presence)
        self._clear()

    def _clear(self) -> None:
        self.streak, self.pool, self.first = None, {}, None

    def _feed(self, day: int, zipcode: str, weekend: bool) -> None:
        c = self.fed.setdefault(zipcode, [0, 0])
        c[0 if weekend else 1] += 1
        first, last, _ = self.fed_days
        self.fed_days = [day if first is None else first, day, last]

    def _fix_reference(self, day: int, zipcode: str) -> None:
        """Incremental reference test: only the zip seen today can newly qualify."""
        c = sum(self.fed[zipcode])
        tenure = day - self.fed_days[0] + 1
        if c >= self.th.min_days and c / (tenure * 1.0) >= self.th.min_share:
            self.ref_zip, self.ref_day = zipcode, day

    def snapshot(self) -> list[tuple]:
        """Rows emitted so far (audits) plus the current pool, streak and reference; clears the emitted rows."""
        emitted, self.out = self.out, []
        for (z, wk), since in sorted(self.pool.items()):
            self._row("pool", zipcode=z, week=wk, since=_date(since))
        if self.streak is not None:
            z, start, we, sem, wk = self.streak
            self._row("streak", zipcode=z, week=wk, streak_start=_date(start), weekend_days=we, weekday_days=sem)
        if self.ref_day is not None:
            self._row("reference", zipcode=self.ref_zip, day=_date(self.ref_day))
        rows, self.out = emitted + self.out, []
        return rows

    def expire(self, day: int) -> None:
        """Pool-age check without a sighting (streaming timer): evict if presence on ``day`` is over the limit."""
        if self.first is not None and day - self.first + 1 > self.th.age_limit:
            self._evict_aged(self.first + self.th.age_limit)

    # ---------------------------------------------------------------- step
    def observe(self, day: int, zipcode: str, weekend: bool) -> None:
        """One sighting (the user's home zip of that day), days in increasing order."""
        if self.ref_day is None or day <= self.ref_day:
            self._feed(day, zipcode, weekend)
            if self.learn and self.ref_day is None:
                self._fix_reference(day, zipcode)
            return
        th = self.th
        if self.first is not None and day - self.first > th.age_limit:
            self._evict_aged(self.first + th.age_limit)
        if self.first is None and zipcode == self.ref_zip:
            self._feed(day, zipcode, weekend)
            return
        s = self.streak
        confirmed_week = None
        if s is None or s[0] != zipcode:
            self.streak = [zipcode, day, int(weekend), int(not weekend), 0]
            key = (zipcode, 0)
            self.pool[key] = min(self.pool.get(key, day), day)
            if self.first is None:
                self.first = day
        else:
            s[2] += int(weekend)
            s[3] += int(not weekend)
            age = day - s[1] + 1
            s[4] = age // 7
            if age >= 7 and age % 7 == 0 and week_passes(s[2], s[3], th):
                confirmed_week = age // 7
        presence = day - self.first + 1
        returned = False
        if confirmed_week is not None and zipcode == self.ref_zip and presence <= th.return_limit:
            returned = True
            self._row("returned", day=_date(day), zipcode=zipcode, week=confirmed_week, date_min=_date(self.first),
                      date_max=_date(max(self.pool.values())), presence_days=presence)
        if presence > th.age_limit:
            self._evict_aged(day)
            return
        if returned:
            self._clear()
            return
        if confirmed_week is not None and zipcode != self.ref_zip:
            key = (zipcode, confirmed_week)
            self.pool[key] = min(self.pool.get(key, day), day)

    def close(self, horizon: int) -> list[tuple]:
        """Last age check on the horizon day, then the final rows of every table."""
        if self.first is not None and horizon - self.first + 1 > self.th.age_limit:
            self._evict_aged(self.first + self.th.age_limit)
        if self.ref_day is not None:
            self._row("reference", zipcode=self.ref_zip, day=_date(self.ref_day))
        for z, (we, sem) in self.fed.items():
            self._row("history", zipcode=z, weekend_days=we, weekday_days=sem)
        first, last, prev = self.fed_days
        if first is not None:
            before = last if last < horizon else prev
            gap = 1 if before is None else horizon - before + 1
            self._row("registry", first_seen=_date(first), last_seen=_date(last), gap_days=gap,
                      tenure_days=horizon - first + 1)
        for (z, wk), since in sorted(self.pool.items()):
            self._row("pool", zipcode=z, week=wk, since=_date(since))
        if self.streak is not None:
            z, start, we, sem, wk = self.streak
            self._row("streak", zipcode=z, week=wk, streak_start=_date(start), weekend_days=we, weekday_days=sem)
        return self.out
