"""The state that screening keeps for each user: whether listed, and the clicks per day and ad.

A call into the state and a pandas step cost about as much for one entry or row as for a thousand, and a stream has very many
users with a few clicks each.  So :func:`screen_users` takes the users of a bucket together, and what a user clicked in a
period of days is one value; :func:`screen_user` is the same rule for one user, with a value per entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall import schemas
from footfall.operators import ads
from footfall.runtime import need_map_state

# ``listed`` marks the click that put its user on the blacklist; ``kept`` the clicks that count, where all are returned.
KEPT_CLICK = T.StructType([*schemas.AD_CLICK, T.StructField("listed", T.BooleanType())])
ALL_CLICKS = T.StructType([*KEPT_CLICK, T.StructField("kept", T.BooleanType())])
MANY = 100_000   # rows of one group to gather before those that cannot pass are dropped
# The state of a query is by these two, so a checkpoint goes on with the numbers it began with.
BUCKETS = 1024   # groups of users that are screened together
PERIOD = 28      # days of which a user's clicks are one value in the state


def first_clicks(threshold: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Drop clicks that cannot pass, before the shuffle.

    A click with ``threshold`` earlier ones of the same day, user and ad comes after the user's
    cutoff in any case.  What is left of a very busy user no longer grows with the clicks.
    """
    keys = list(ads.USER_KEYS)   # workers get values only, and need not have this package

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows[rows.groupby(keys)["ts"].rank(method="min") <= threshold]
    return keep


def screen_user(threshold: int, keep_days: int | None, exact: bool = True, everything: bool = False) -> StatefulProcessor:
    """The state of a user: whether listed, the clicks per day and ad, and the newest day if days are to be forgotten.

    Of a listed user only the mark remains.  With ``exact`` clicks stop right after the one that reaches the threshold,
    otherwise with the next batch.  With ``everything`` the clicks that do not count are returned as well.
    """
    columns, keys, many = list((ALL_CLICKS if everything else KEPT_CLICK).names), ["date", "adid"], MANY
    first = iter if everything else first_clicks(threshold)

    def gathered(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """The clicks that may pass, in order; what is held grows with the days and ads of the batch only."""
        held, rows = [], 0
        for part in parts:
            held.append(part)
            rows += len(part)
            if rows > many:
                held = list(first(iter([pd.concat(held)])))
                rows = 0
        return pd.concat(held).sort_values("ts", kind="stable", ignore_index=True)

    class Screen(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.listed = handle.getValueState("listed", "listed boolean")
            self.clicks = handle.getMapState("clicks", "date string, adid bigint", "clicks bigint")
            self.newest = handle.getValueState("newest", "date string")

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            if self.listed.exists():
                if everything:
                    yield from (part.assign(listed=False, kept=False)[columns] for part in rows)
                return
            if not exact:
                yield from self.whole_batch(rows)
                return
            rows = gathered(rows)
            groups = rows.groupby(keys, sort=False)
            number = groups.ngroup()
            seen = [(str(date), int(ad)) for date, ad in rows[keys][~number.duplicated()].itertuples(index=False, name=None)]
            earlier = [(self.clicks.getValue(k) or (0,))[0] for k in seen]
            nth = groups.cumcount() + 1 + pd.Series(earlier, dtype="int64").reindex(number).set_axis(rows.index)
            reached = rows["ts"][nth >= threshold]
            if reached.empty:
                self.put(dict(zip(seen, nth.groupby(number).max().tolist())))
                yield rows.assign(listed=False, kept=True)[columns]
            else:
                self.list_user()
                passed = rows["ts"] <= reached.min()
                rows = rows.assign(listed=rows.index == passed[::-1].idxmax(), kept=passed)
                yield (rows if everything else rows[passed])[columns]

        def whole_batch(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """All clicks of the batch pass; the last one has the mark if the user is on the list from now on."""
            counts, held = {}, None
            for part in parts:
                for k, n in part.groupby(keys, sort=False).size().items():
                    counts[str(k[0]), int(k[1])] = counts.get((str(k[0]), int(k[1])), 0) + n
                if held is not None:
                    yield held.assign(listed=False, kept=True)[columns]
                held = part
            counts = {k: n + (self.clicks.getValue(k) or (0,))[0] for k, n in counts.items()}
            reached = max(counts.values()) >= threshold
            if reached:
                self.list_user()
            else:
                self.put(counts)
            yield held.assign(listed=[False] * (len(held) - 1) + [reached], kept=True)[columns]

        def list_user(self) -> None:
            self.listed.update((True,))
            self.clicks.clear()
            self.newest.clear()

        def put(self, counts: dict[tuple[str, int], int]) -> None:
            oldest = self.forget(max(date for date, _ in counts))
            for k, n in counts.items():
                if k[0] > oldest:
                    self.clicks.updateValue(k, (int(n),))

        def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
            """What an earlier run has counted."""
            counts = initialState[initialState["date"].notna()]
            if len(counts) < len(initialState):
                self.listed.update((True,))
            elif len(counts):
                self.put({(str(d), int(a)): int(n) for d, a, n in counts[[*keys, "click_count"]].itertuples(index=False, name=None)})

        def forget(self, newest: str) -> str:
            """When a new day begins, drop the days that are too old; the last day that is not kept."""
            if keep_days is None:
                return ""
            known = (self.newest.get() or ("",))[0] if self.newest.exists() else ""
            newest = max(newest, known)
            oldest = str((pd.Timestamp(newest) - pd.Timedelta(days=keep_days)).date())
            if newest > known:
                self.newest.update((newest,))
                for k in [k for k in self.clicks.keys() if k[0] <= oldest] if known else []:
                    self.clicks.removeKey(tuple(k))
            return oldest

        def close(self) -> None:
            pass

    return Screen()


def screen_users(threshold: int, keep_days: int | None, exact: bool = True, everything: bool = False) -> StatefulProcessor:
    """:func:`screen_user` for a bucket of users at once; ``date`` is the number of days since 1970.

    A batch reads and writes, of each user it has clicks for, one value that says whether the user is listed and which
    periods there are, and one with the clicks per day and ad of each period that it touches.
    """
    columns, many, period = list((ALL_CLICKS if everything else KEPT_CLICK).names), MANY, PERIOD
    first = iter if everything else first_clicks(threshold)
    unknown = (False, None, [])

    def gathered(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
        """The clicks that may pass; what is held grows with the users, days and ads of the batch only."""
        held, rows, most = [], 0, many
        for part in parts:
            held.append(part)
            rows += len(part)
            if rows > most:
                held = list(first(iter([pd.concat(held)])))
                rows, most = 0, max(many, len(held[0]))
        return held[0] if len(held) == 1 else pd.concat(held)

    def numbers(rows: pd.DataFrame) -> np.ndarray:
        return np.column_stack([rows[name].to_numpy("int64") for name in ("userid", "date", "adid")])

    def grouped(*by: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order by the columns ``by``, the group of each row in it, and where the groups start."""
        order = np.lexsort(by[::-1])
        new = np.zeros(len(order), "bool")
        for column in by:
            column = column[order]
            new[1:] |= column[1:] != column[:-1]
        return order, np.cumsum(new), np.flatnonzero(np.r_[len(order) > 0, new[1:]])

    def summed(cells: np.ndarray) -> np.ndarray:
        """Rows ``user, day, ad, clicks`` added up, in order."""
        order, _, starts = grouped(*cells[:, :3].T)
        return np.column_stack([cells[order[starts], :3], np.add.reduceat(cells[order, 3], starts)])

    def counted(rows: np.ndarray) -> np.ndarray:
        return summed(np.column_stack([rows, np.ones(len(rows), "int64")]))

    class Screen(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.users = handle.getMapState("users", "userid bigint", "listed boolean, newest int, periods array<int>")
            self.clicks = handle.getMapState("clicks", "userid bigint, period int", "cells binary")

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            if not exact:
                yield from self.whole_batch(rows)
                return
            rows = gathered(rows)
            at = numbers(rows)
            known = self.known(at)
            new = self.not_listed(at, known)
            kept, listed = np.zeros(len(rows), "bool"), np.zeros(len(rows), "bool")
            if new.any():
                kept[new], listed[new] = self.passing(at[new], rows["ts"].to_numpy()[new], known)
            rows = rows.assign(listed=listed, kept=kept)
            yield (rows if everything else rows[kept])[columns]

        def passing(self, at: np.ndarray, ts: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
            """Which clicks pass, and which put their user on the list; the state follows."""
            order = np.lexsort((ts, *at.T[::-1]))
            _, cell, starts = grouped(*at[order].T)   # in order already, and the sort keeps it
            cells = np.column_stack([at[order[starts]], np.diff(np.r_[starts, len(at)])])
            earlier, now = self.with_earlier(cells, known)
            nth = np.arange(len(at)) - starts[cell] + 1 + earlier[cell]
            users, user = np.unique(at[order, 0], return_inverse=True)
            time = np.unique(ts, return_inverse=True)[1]
            cutoff = np.full(len(users), len(at))
            reached = nth >= threshold
            np.minimum.at(cutoff, user[reached], time[order][reached])
            passed = time[order] <= cutoff[user]
            last = np.full(len(users), -1)
            at_cutoff = time[order] == cutoff[user]
            np.maximum.at(last, user[at_cutoff], order[at_cutoff])
            kept, listed = np.empty(len(at), "bool"), np.zeros(len(at), "bool")
            kept[order], listed[last[last >= 0]] = passed, True
            self.put(cells, now, set(users[last >= 0].tolist()), known)
            return kept, listed

        def whole_batch(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """All clicks of the batch pass; a user's last one has the mark if the user is on the list from now on.

            Only the last click of each user and the counts are held.
            """
            known, cells, held = {}, [], None
            for part in parts:
                at = numbers(part)
                known.update(self.known(at, known))
                new = self.not_listed(at, known)
                if everything and not new.all():
                    yield part[~new].assign(listed=False, kept=False)[columns]
                if not new.any():
                    continue
                cells.append(counted(at[new]))
                if sum(map(len, cells[1:])) > max(many, len(cells[0])):
                    cells = [summed(np.concatenate(cells))]
                part = part[new] if held is None else pd.concat([held, part[new]])
                again = part["userid"].duplicated(keep="last").to_numpy()
                held = part[~again]
                if again.any():
                    yield part[again].assign(listed=False, kept=True)[columns]
            if held is None:
                return
            cells = summed(np.concatenate(cells))
            earlier, now = self.with_earlier(cells, known)
            reached = set(cells[cells[:, 3] + earlier >= threshold, 0].tolist())
            self.put(cells, now, reached, known)
            yield held.assign(listed=held["userid"].isin(reached).to_numpy(), kept=True)[columns]

        def known(self, at: np.ndarray, before: Any = ()) -> dict[int, tuple[bool, int | None, list[int]]]:
            """What the state says of users: whether listed, their newest day, their periods."""
            return {u: tuple(self.users.getValue((u,)) or unknown) for u in np.unique(at[:, 0]).tolist() if u not in before}

        def not_listed(self, at: np.ndarray, known: dict) -> np.ndarray:
            listed = [u for u, told in known.items() if told[0]]
            return ~np.isin(at[:, 0], np.array(listed, "int64"))

        def oldest(self, newest: int | None) -> int:
            """The last day that is not kept."""
            return -(1 << 31) if keep_days is None or newest is None else newest - keep_days

        def still_kept(self, cells: np.ndarray, newest: dict) -> np.ndarray:
            if keep_days is None:
                return cells
            users, user = np.unique(cells[:, 0], return_inverse=True)
            return cells[cells[:, 1] > np.array([self.oldest(newest[u]) for u in users.tolist()], "int64")[user]]

        def with_earlier(self, cells: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
            """What the state has for each of ``cells``, and all cells of the periods they are in, with these added."""
            found = [cells]
            periods = np.column_stack([cells[:, 0], cells[:, 1] // period])
            for u, p in periods[grouped(*periods.T)[2]].tolist():   # cells are in order
                if p in known[u][2]:
                    stored = np.frombuffer(self.clicks.getValue((u, p))[0], "<i8").reshape(-1, 3)
                    found.append(np.column_stack([np.full(len(stored), u), stored]))
            stored = np.concatenate(found[1:] or [cells[:0]])
            both = np.concatenate([cells, self.still_kept(stored, {u: told[1] for u, told in known.items()})])
            order, at, starts = grouped(*both[:, :3].T)
            sums = np.add.reduceat(both[order, 3], starts)
            group = np.empty(len(both), "int64")
            group[order] = at
            return sums[group[:len(cells)]] - cells[:, 3], np.column_stack([both[order[starts], :3], sums])

        def put(self, cells: np.ndarray, now: np.ndarray, reached: set[int], known: dict) -> None:
            """Keep the clicks ``now``, after a batch with ``cells``; of users that ``reached`` the threshold the mark remains."""
            users, starts = np.unique(cells[:, 0], return_index=True)
            days = np.maximum.reduceat(cells[:, 1], starts).tolist()
            newest = {u: day if known[u][1] is None else max(day, known[u][1]) for u, day in zip(users.tolist(), days)}
            now = self.still_kept(now[~np.isin(now[:, 0], np.array(list(reached), "int64"))], newest)
            touched, written = cells[:, 1] // period, {}
            if len(now):
                _, _, at = grouped(now[:, 0], now[:, 1] // period)   # these are in order
                for start, end in zip(at.tolist(), [*at[1:].tolist(), len(now)]):
                    u, p = int(now[start, 0]), int(now[start, 1] // period)
                    self.clicks.updateValue((u, p), (now[start:end, 1:].astype("<i8").tobytes(),))
                    written.setdefault(u, set()).add(p)
            for u, start, end in zip(users.tolist(), starts.tolist(), [*starts[1:].tolist(), len(cells)]):
                before, told = set(known[u][2]), (True, None, [])
                if u not in reached:
                    others = before - set(touched[start:end].tolist())
                    left = {p for p in others if (p + 1) * period - 1 > self.oldest(newest[u])} | written.get(u, set())
                    told = (False, None if keep_days is None else newest[u], sorted(left))
                for p in before.difference(told[2]):
                    self.clicks.removeKey((u, p))
                if told != known[u]:
                    self.users.updateValue((u,), told)

        def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
            """What an earlier run has counted."""
            at = numbers(initialState)
            known = self.known(at)
            listed = initialState["listed"].to_numpy("bool")
            for u in np.unique(at[listed, 0]).tolist():
                for p in known[u][2]:
                    self.clicks.removeKey((u, p))
                known[u] = (True, None, [])
                self.users.updateValue((u,), known[u])
            new = self.not_listed(at, known)
            if new.any():
                cells = summed(np.column_stack([at, initialState["click_count"].to_numpy("int64")])[new])
                self.put(cells, self.with_earlier(cells, known)[1], set(), known)

        def close(self) -> None:
            pass

    return Screen()


def screened(clicks: DataFrame, threshold: int, keep_days: int | None = None, exact: bool = True, everything: bool = False,
             earlier: DataFrame | None = None) -> DataFrame:
    """The clicks of a stream that pass, with the mark ``listed``; with ``everything`` all clicks, with ``kept`` too.

    ``earlier`` has what users had before the stream began: ``userid, date, adid, click_count``, with a null date for a
    listed user.
    """
    need_map_state(clicks.sparkSession)
    bucket = F.pmod(F.hash("userid"), F.lit(BUCKETS)).alias("_bucket")
    few = clicks.select(*schemas.AD_CLICK.names, F.unix_date(F.to_date("ts")).alias("date"), bucket)
    if exact and not everything:
        few = few.mapInPandas(first_clicks(threshold), few.schema)
    schema = schemas.like(ALL_CLICKS if everything else KEPT_CLICK, clicks)
    if earlier is not None:   # without nulls, which would make numbers inexact in pandas
        numbers = [F.coalesce(c, F.lit(0)).alias(n) for c, n in (
            (F.unix_date(F.to_date("date")), "date"), (F.col("adid"), "adid"), (F.col("click_count"), "click_count"))]
        earlier = earlier.select(bucket, "userid", *numbers, F.col("date").isNull().alias("listed")).groupBy("_bucket")
    return few.groupBy("_bucket").transformWithStateInPandas(
        screen_users(threshold, keep_days, exact, everything), schema, "Append", "None", earlier)
