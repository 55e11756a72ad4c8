"""Own state in streams: totals that start from a batch table, and sessions that timers close."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def own_state(spark: SparkSession) -> Iterator[None]:
    """A state store that keeps several named states of a key; the session's own one afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


#: Groups of users that share a state row of a day: one call of Python for each, not for each user.
GROUPS = 64


def daily_totals(events: DataFrame) -> DataFrame:
    """``(user_id, day, n, total)`` of every user and day of a batch, so far. The state of a day goes once the watermark passes it.

    ``events`` are ``(user_id, day, value)`` with a watermark. Users of a group and day are summed together.
    """

    def add(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        parts = [batch.groupby(["none", "user"])["value"].agg(["size", "sum"]) for batch in batches]
        new = pd.concat(parts).groupby(level=[0, 1]).sum()
        old = pd.DataFrame(dict(zip(("none", "user", "size", "sum"), state.get, strict=True)) if state.exists else {"none": [], "user": [], "size": [], "sum": []})
        old = old.astype({"none": bool, "user": "int64", "size": "int64", "sum": float}).set_index(["none", "user"])
        whole = pd.concat([old, new]).groupby(level=[0, 1]).sum()
        rows = whole.reset_index()
        state.update(tuple(rows[c].tolist() for c in ("none", "user", "size", "sum")))
        day_ends = int(pd.Timestamp(key[1], tz="UTC").timestamp() + 86_400) * 1000
        state.setTimeoutTimestamp(max(day_ends, state.getCurrentWatermarkMs() + 1))
        told = whole.loc[new.index].reset_index()
        yield pd.DataFrame({"user_id": told["user"].astype("Int64").mask(told["none"]), "day": key[1], "n": told["size"], "total": told["sum"]})

    users = events.withColumns({"none": F.col("user_id").isNull(), "user": F.coalesce("user_id", F.lit(0)).cast("long"), "part": F.pmod(F.xxhash64("user_id"), F.lit(GROUPS))})
    return users.groupBy("part", "day").applyInPandasWithState(
        add, "user_id long, day string, n long, total double", "none array<boolean>, user array<long>, n array<long>, total array<double>", "update", "EventTimeTimeout"
    )


#: Groups of words and of users whose own state is one value each.
WORD_GROUPS, USER_GROUPS = 256, 512


class Totals(StatefulProcessor):
    """One number for each word of a group, which starts from the initial state and grows with every batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getValueState("totals", "word array<string>, n array<long>")

    def _add(self, new: pd.Series) -> pd.Series:
        """The totals of the words in ``new``, which are counts by word."""
        if self._totals.exists():
            words, n = self._totals.get()
            old = pd.Series(n, index=pd.Index(words, dtype=object), dtype="int64")
            whole = pd.concat([old, new]).groupby(level=0, dropna=False).sum()
        else:
            whole = new
        self._totals.update(([w if isinstance(w, str) else None for w in whole.index], whole.tolist()))
        return whole.loc[new.index]

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        self._add(initialState.groupby("word", dropna=False)["n"].sum())

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([part.groupby("word", dropna=False).size() for part in rows]).groupby(level=0, dropna=False).sum()
        told = self._add(new)
        yield pd.DataFrame({"word": [w if isinstance(w, str) else None for w in told.index], "n": told.to_numpy()})

    def close(self) -> None:
        pass


def running_totals(words: DataFrame, seed: DataFrame) -> DataFrame:
    """``(word, n)`` for every word of a batch: its occurrences so far on top of the seed's ``(word, n)``. Words of a group are one call of Python."""
    part = F.pmod(F.xxhash64("word"), F.lit(WORD_GROUPS)).alias("part")
    return words.select("word", part).groupBy("part").transformWithStateInPandas(
        statefulProcessor=Totals(), outputStructType="word string, n long", outputMode="Update", timeMode="None", initialState=seed.select("word", "n", part).groupBy("part")
    )


class Sessions(StatefulProcessor):
    """Open sessions of a group of users by user and start, each with its end and number of events. A timer closes a session once the watermark is a gap past its end.

    Events may arrive in any order as long as they are not behind the watermark; one that lies between two sessions joins them.
    """

    _COLUMNS = ["none", "user", "start", "last", "n"]

    def __init__(self, gap_ms: int) -> None:
        self._gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "rows binary")

    def _sessions(self) -> pd.DataFrame:
        rows = np.frombuffer(bytes(self._open.get()[0]), np.int64) if self._open.exists() else np.empty(0, np.int64)
        return pd.DataFrame(rows.reshape(-1, len(self._COLUMNS)), columns=self._COLUMNS)

    def _keep(self, sessions: pd.DataFrame) -> None:
        """Sessions that stay open, and a timer for the first one to close."""
        if sessions.empty:
            self._open.clear()
            return
        self._open.update((sessions[self._COLUMNS].to_numpy(np.int64).tobytes(),))
        self._handle.registerTimer(int(sessions["last"].min()) + self._gap)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([part[["none", "user", "ms"]] for part in rows]).rename(columns={"ms": "start"})
        every = pd.concat([self._sessions(), new.assign(last=new["start"], n=1)[self._COLUMNS].astype("int64")])
        every = every.sort_values(["none", "user", "start"], ignore_index=True)
        user = every[["none", "user"]].to_numpy()
        reached = every.groupby(["none", "user"])["last"].cummax().to_numpy()
        begins = np.append(True, (user[1:] != user[:-1]).any(axis=1) | (every["start"].to_numpy()[1:] - reached[:-1] > self._gap))
        merged = every.groupby(np.cumsum(begins)).agg({"none": "first", "user": "first", "start": "min", "last": "max", "n": "sum"})
        self._keep(merged)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sessions = self._sessions()
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        closed = sessions["last"] + self._gap <= until
        if closed.any():
            self._keep(sessions[~closed])
            done = sessions[closed]
            yield pd.DataFrame({"user_id": done["user"].astype("Int64").mask(done["none"] == 1), "start": done["start"], "last": done["last"], "n": done["n"]})

    def close(self) -> None:
        pass


def closed_sessions(events: DataFrame, gap_ms: int) -> DataFrame:
    """``(user_id, start, last, n)`` in milliseconds, of sessions without a pause longer than the gap, as they close. ``events`` have ``user_id``, ``ts`` with a watermark. Users of a group are one call of Python."""
    user = {"none": F.col("user_id").isNull(), "user": F.coalesce("user_id", F.lit(0)).cast("long"), "ms": F.unix_millis("ts"), "part": F.pmod(F.xxhash64("user_id"), F.lit(USER_GROUPS))}
    rows = events.select("ts", *[column.alias(name) for name, column in user.items()])
    return rows.groupBy("part").transformWithStateInPandas(
        statefulProcessor=Sessions(gap_ms), outputStructType="user_id long, start long, last long, n long", outputMode="Append", timeMode="EventTime"
    )
