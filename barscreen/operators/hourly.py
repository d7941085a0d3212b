"""All that an hourly bar's features read of the bars and sessions before it, a partition at a time.

The same measures as in `volume`, `volatility`, `progress`, `sequence`, `structure`, `levels`,
`pivots` and `market`, whose windows and joins would move the bars several times. Here bars and
their sessions' daily bars move together, once, to their security.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.functions import vectors as vc
from barscreen.functions.trailing import min_valid
from barscreen.operators import daily as dl
from barscreen.operators import levels as lv
from barscreen.operators import pivots as pv
from barscreen.operators import sequence as sq
from barscreen.operators import structure as st
from barscreen.operators.market import market_series
from barscreen.operators.progress import PROGRESS_SPANS, VOLUME_SPANS
from barscreen.operators.volatility import ATR_PERIOD

#: The slot of a session's own row, which stands before its bars.
SESSION = -1
LONG, SHORT = 60, 20
OF_BAR = (
    "_pc", "true_range", "atr20_bar", *[f"_close_{k}" for k in PROGRESS_SPANS], "vol_pct_slot_60", "vol_pct_slot_20",
    "vol_z_slot_60", "spread_pct_slot_60", "_usual", *[f"cum_vol_pct_{k}" for k in VOLUME_SPANS],
    "repeat_hv_narrow_5", "repeat_upper_reject_5", "_hi", "_lo", "_hc", "_lc",
)
OF_SESSION = (
    "daily_atr", "pos", *st.LEVELS, *[f"set_{a}" for a in lv.ANCHORS], *[f"touch_{a}" for a in lv.ANCHORS],
    "pivot_low", "node", "beta_60", *[a for a in lv.ANCHORS if a not in st.LEVELS],
)


def _sessions(day: np.ndarray, bars: dict, of: dict, place: np.ndarray) -> dict[str, np.ndarray]:
    """OF_SESSION of daily bars `of` (high, low, close, m); `bars` are the hourly ones in order,
    with their session's number."""
    high, low, close = of["high"], of["low"], of["close"]
    week, month = dl.periods(day)
    found: dict[str, np.ndarray] = {"pos": place.astype(float)}
    dl.with_beta(found, close, of["m"], week, place)
    found["daily_atr"] = vc.averaged(dl.true_range(high, low, close, place), place, ATR_PERIOD)[0]
    dl.with_levels(found, high, low, week, month, place)
    for level in lv.ANCHORS:
        if level in st.LEVELS:
            found[f"set_{level}"] = vc.last_at(low if "low" in level else high, found[level], place)
    first = np.flatnonzero(place == 0)
    states = [
        pv.pivot_states(high[a:z], low[a:z], pv.COUNTER_MOVE_ATR * found["daily_atr"][a:z])
        for a, z in zip(first, np.append(first[1:], len(place)))
    ]
    state = np.concatenate(states) if states else np.empty((0, len(pv.STATE)))
    for i, name in enumerate(pv.STATE[:4]):
        found[name] = vc.lag(state[:, i], 1, place)
    touches = {a: np.empty(len(place)) for a in lv.ANCHORS}
    for at in vc.chunks(len(place)):
        tops, bottoms = (vc.windows(side, lv.TOUCH_WINDOW, place, at) for side in (high, low))
        for a, counted in touches.items():
            level = found[a][at]
            inside = ((bottoms <= level[:, None]) & (tops >= level[:, None])).sum(axis=1)
            counted[at] = np.where(~np.isnan(level) & (place[at] > 0), inside, np.nan)
    found |= {f"touch_{a}": counted for a, counted in touches.items()}
    found["node"] = _nodes(bars, place)
    return found


def _nodes(bars: dict, place: np.ndarray, sessions: int = pv.NODE_SESSIONS, bins: int = pv.NODE_BINS) -> np.ndarray:
    """`pv.volume_nodes`."""
    starts = np.searchsorted(bars["session"], np.arange(len(place) + 1))
    some = np.diff(starts) > 0
    low, high, node = (np.full(len(place), np.nan) for _ in range(3))
    if some.any():
        low[some] = np.fmin.reduceat(bars["low"], starts[:-1][some])
        high[some] = np.fmax.reduceat(bars["high"], starts[:-1][some])
    traded = ~np.isnan(bars["close"]) & ~np.isnan(bars["volume"])
    prices, volumes = bars["close"][traded], bars["volume"][traded]
    starts = np.concatenate([[0], np.cumsum(traded)])[starts].tolist()
    for i in np.flatnonzero((place >= sessions) & (vc.count_before(some, sessions, place) == sessions)).tolist():
        lo, hi = np.fmin.reduce(low[i - sessions : i]), np.fmax.reduce(high[i - sessions : i])
        if not hi > lo:
            continue
        a, z, width = starts[i - sessions], starts[i], (hi - lo) / bins
        place_in = np.minimum(np.maximum(np.floor((prices[a:z] - lo) / width), 0), bins - 1).astype(np.int64)
        filled = np.bincount(place_in, volumes[a:z], bins)
        at = int(filled.argmax())
        if filled[at] > 0:
            node[i] = lo + (at + 0.5) * width
    return node


def _bars(rows: pa.Table, place: np.ndarray, limits: dict) -> dict[str, np.ndarray]:
    """OF_BAR of the hourly bars alone."""
    open_, high, low, close, volume = (vc.doubles(rows, c) for c in ("open", "high", "low", "close", "volume"))
    half, valid = vc.flags(rows, "is_half_day"), dl.valid(rows)
    found = {"_pc": vc.lag(close, 1, place), "true_range": dl.true_range(high, low, close, place)}
    span = found["true_range"]
    atr = found["atr20_bar"] = vc.averaged(span, place, ATR_PERIOD)[0]
    found |= {f"_close_{k}": vc.lag(close, k, place) for k in PROGRESS_SPANS}
    known = dl.spans(volume, valid, place)
    # The same slot of the sessions before: bars in order of security, slot and date.
    group = np.cumsum(place == 0)
    order = np.lexsort((np.arange(len(place)), rows["slot_index"].to_numpy(), group))
    slot = rows["slot_index"].to_numpy()[order]
    beside = vc.places(np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (slot[1:] != slot[:-1])]))
    names = ("vol_pct_slot_60", "vol_pct_slot_20", "vol_z_slot_60", "spread_pct_slot_60", "_usual", *[f"cum_vol_pct_{k}" for k in VOLUME_SPANS])
    found |= {name: np.full(len(place), np.nan) for name in names}
    log, spread, volumes = np.log1p(volume)[order], span[order], np.where(valid, volume, np.nan)[order]
    logs, spreads, stretches = np.where(valid[order], log, np.nan), np.where(valid[order], spread, np.nan), {k: v[order] for k, v in known.items()}
    need, ranked = min_valid(LONG), ~half[order]
    for at in vc.chunks(len(place)):
        to, at = order[at[ranked[at]]], at[ranked[at]]
        long = vc.windows(logs, LONG, beside, at)
        found["vol_pct_slot_60"][to] = vc.share_below(long, log[at], need)
        found["vol_pct_slot_20"][to] = vc.share_below(long[:, -SHORT:], log[at], min_valid(SHORT))
        found["vol_z_slot_60"][to] = vc.robust_z(long, log[at], need)
        found["spread_pct_slot_60"][to] = vc.share_below(vc.windows(spreads, LONG, beside, at), spread[at], need)
        found["_usual"][to] = vc.median(vc.windows(volumes, LONG, beside, at), need)
        for k, stretch in stretches.items():
            found[f"cum_vol_pct_{k}"][to] = vc.share_below(vc.windows(stretch, LONG, beside, at), stretch[at], need)
    busy = found["vol_pct_slot_60"] >= limits.get("busy_percentile", sq.BUSY_PERCENTILE)
    narrow = (atr > 0) & (span / atr <= limits.get("narrow_atr", sq.NARROW_ATR))
    rejected = (span > 0) & ((high - np.maximum(open_, close)) / span >= sq.LONG_WICK)
    for name, flag in (("repeat_hv_narrow_5", busy & narrow), ("repeat_upper_reject_5", busy & rejected)):
        n = sq.REPEAT_WINDOW
        found[name] = np.where(place >= n, vc.count_before(flag, n, place), np.nan)
    n = limits.get("extreme_window", sq.EXTREME_WINDOW)
    found |= {name: np.empty(len(place)) for name in ("_hi", "_lo", "_hc", "_lc")}
    for at in vc.chunks(len(place)):
        found["_hi"][at], found["_lo"][at] = vc.windows(high, n, place, at).max(axis=1), vc.windows(low, n, place, at).min(axis=1)
        closes = vc.windows(close, n, place, at)
        found["_hc"][at], found["_lc"][at] = closes.max(axis=1), closes.min(axis=1)
    return found


def _measured(rows: pa.Table, place: np.ndarray, limits: dict) -> pa.Table:
    day, slot, opens = rows["_day"].to_numpy(), rows["slot_index"].to_numpy(), place == 0
    session = slot == SESSION
    at, group = np.flatnonzero(session), np.cumsum(opens)
    # A bar's session is the last session row before it, if that is of its day and security.
    number = np.cumsum(session) - 1
    own = at[number] if len(at) else number
    of_own = ~session & (number >= 0) & (group[own] == group) & (day[own] == day) if len(at) else np.zeros(len(day), bool)
    bars = rows.filter(pa.array(~session))
    of = {c: vc.doubles(rows, c)[at] for c in ("high", "low", "close")} | {"m": vc.doubles(rows, "_m")[at]}
    within = {c: vc.doubles(rows, c)[of_own] for c in ("high", "low", "close", "volume")} | {"session": number[of_own]}
    begins = lambda g: vc.places(np.concatenate([[True], g[1:] != g[:-1]])[: len(g)])
    held = _sessions(day[at], within, of, begins(group[at]))
    bars = vc.with_columns(bars, _bars(bars, begins(group[~session]), limits))
    mine, has = np.maximum(number[~session], 0), of_own[~session]
    if not len(at):
        return vc.with_columns(bars, {name: np.full(len(mine), np.nan) for name in OF_SESSION})
    return vc.with_columns(bars, {name: np.where(has, held[name][mine], np.nan) for name in OF_SESSION})


def _partition(batches: Iterator[pa.RecordBatch], limits: dict) -> Iterator[pa.RecordBatch]:
    with np.errstate(invalid="ignore", divide="ignore"):
        for batch in vc.by_group(batches, "security_key", partial(_measured, limits=limits)):
            yield batch.select([*[c for c in batch.schema.names if c not in (*OF_BAR, *OF_SESSION)], *OF_BAR, *OF_SESSION])


def with_sessions(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Bars and, before those of each session, a row of its daily bar."""
    own = daily.select("security_key", "date", F.lit(SESSION).alias("slot_index"), "high", "low", "close")
    return bars.unionByName(own, allowMissingColumns=True)


def with_hourly_measures(rows: DataFrame, market_daily: DataFrame, **limits) -> DataFrame:
    """OF_BAR and OF_SESSION of the bars among rows of `with_sessions` that lie at their security."""
    returns = F.broadcast(market_series(market_daily, hourly=False).withColumnRenamed("market_return", "_m"))
    rows = rows.join(returns, "date", "left").withColumn("_day", F.unix_date("date"))
    rows = rows.sortWithinPartitions("security_key", "date", "slot_index")
    schema = ", ".join([f"{c} {kind}" for c, kind in rows.dtypes] + [f"{c} double" for c in (*OF_BAR, *OF_SESSION)])
    return rows.mapInArrow(partial(_partition, limits=limits), schema).drop("_m", "_day")
