"""Structured Streaming twin of the window gate: the same verdicts, as the samples arrive."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.windows import FLAT, HYSTERESIS, K_GATE, K_SD, MIN_CYCLES, MOST

_OUT = "run string, window bigint, n bigint, mean double, sd double, cycles bigint, status string"
_STATE = "buffer array<double>, window bigint, mean double, sd double, cycles bigint, done boolean"


def window_of(values: list[float], hysteresis: float = HYSTERESIS) -> tuple[float, float, int]:
    """Mean, sd (n - 1) and cycles of one window."""
    mean = math.fsum(values) / len(values)
    sd = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else math.nan
    band, state, crossings = hysteresis * sd, 0, 0
    for v in values:
        now = 1 if v > mean + band else -1 if v < mean - band else 0
        if now and state and now != state:
            crossings += 1
        state = now or state
    return mean, sd, crossings // 2


def passes(a: tuple[float, float, int], b: tuple[float, float, int], min_cycles: int = MIN_CYCLES, k_gate: float = K_GATE, k_sd: float = K_SD) -> bool:
    n = min(a[2], b[2])
    if n < min_cycles:
        return False
    drift, se = b[0] - a[0], math.sqrt((a[1] ** 2 + b[1] ** 2) / n)
    over = abs(drift) / se if se > 0 else 0.0 if drift == 0 else math.inf
    ratio = abs(math.log(b[1] / a[1])) if a[1] > 0 and b[1] > 0 else math.inf
    return over <= k_gate and ratio <= k_sd / math.sqrt(n)


def verdict(before: tuple[float, float, int] | None, now: tuple[float, float, int], window: int, most: int = MOST) -> str:
    if now[1] <= FLAT * max(abs(now[0]), 1.0):
        return "converged"
    if before is not None and passes(before, now):
        return "stationary"
    return "no_steady_state" if window + 1 >= most else "running"


def streaming_gate(samples: DataFrame, size: int, run: str = "run", order: str = "i", value: str = "value") -> DataFrame:
    """One row per closed window and run with its status; a run that has stopped ignores later samples.

    ``samples`` must arrive in order within a run (a monitor writes them so); within a micro-batch they are sorted.
    State per run: at most one window of samples and the statistics of the last window.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        buffer, window, mean, sd, cycles, done = state.get if state.exists else ([], 0, None, None, None, False)
        buffer, out = list(buffer), []
        rows = pd.concat(list(batches)).sort_values(order)
        for v in rows[value]:
            if done:
                break
            buffer.append(float(v))
            if len(buffer) == size:
                now = window_of(buffer)
                status = verdict(None if mean is None else (mean, sd, cycles), now, window)
                out.append((key[0], window, size, *now, status))
                (mean, sd, cycles), buffer, window, done = now, [], window + 1, status != "running"
        state.update((buffer, window, mean, sd, cycles, done))
        if out:
            yield pd.DataFrame(out, columns=["run", "window", "n", "mean", "sd", "cycles", "status"])

    return samples.groupBy(run).applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


#: The state store that keyed state of several kinds needs.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class RunGate(StatefulProcessor):
    """The verdict on the windows of one run with several signals, see :func:`signals_gate`.

    State: the samples of every open window and signal, the statistics of closed windows that wait for other signals
    or are the last ones decided, and the next window to decide (-1 once the run has stopped).
    """

    def __init__(self, signals: list[str], size: int, names: tuple[str, str, str, str], idle_ms: int | None):
        self.signals, self.size, self.idle_ms = sorted(set(signals)), size, idle_ms
        self.run, self.signal, self.order, self.value = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "signal string, window bigint", "at array<bigint>, value array<double>")
        self.closed = handle.getMapState("closed", "signal string, window bigint", "mean double, sd double, cycles bigint")
        self.next = handle.getValueState("next", "window bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due = self.next.get()[0] if self.next.exists() else 0
        out = []
        for pdf in rows:
            if due < 0:
                continue
            pdf = pdf[pdf[self.signal].isin(self.signals) & pdf[self.value].notna() & pdf[self.order].notna()]
            for (name, window), part in pdf.groupby([self.signal, pdf[self.order] // self.size]):
                self._take((str(name), int(window)), part)
        while due >= 0 and all(self.closed.containsKey((s, due)) for s in self.signals):
            status = self._decide(due)
            out.append((key[0], due, (due + 1) * self.size - 1, status))
            due = due + 1 if status == "running" else -1
        self.next.update((due,))
        if due < 0:
            self.open.clear()
            self.closed.clear()
        self._timer(due, timerValues)
        if out:
            yield pd.DataFrame(out, columns=["run", "window", "at", "status"])

    def _take(self, where: tuple[str, int], part: pd.DataFrame) -> None:
        """Samples of one window: a position counts once, and in any order; the full window becomes statistics."""
        if self.closed.containsKey(where):
            return
        held = dict(zip(*self.open.getValue(where), strict=True)) if self.open.containsKey(where) else {}
        for at, v in zip(part[self.order], part[self.value], strict=True):
            held.setdefault(int(at), float(v))
        if len(held) < self.size:
            self.open.updateValue(where, (list(held), list(held.values())))
            return
        self.closed.updateValue(where, window_of([held[k] for k in sorted(held)]))
        if self.open.containsKey(where):
            self.open.removeKey(where)

    def _decide(self, window: int) -> str:
        now = [self.closed.getValue((s, window)) for s in self.signals]
        before = [self.closed.getValue((s, window - 1)) for s in self.signals] if window else []
        for s in self.signals if window else []:
            self.closed.removeKey((s, window - 1))
        if all(sd <= FLAT * max(abs(mean), 1.0) for mean, sd, _ in now):
            return "converged"
        if before and all(passes(b, n) for b, n in zip(before, now, strict=True)):
            return "stationary"
        return "no_steady_state" if window + 1 >= MOST else "running"

    def _timer(self, due: int, timers) -> None:
        if self.idle_ms is None:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if due >= 0:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = self.next.get()[0] if self.next.exists() else 0
        if due >= 0:
            self.next.update((-1,))
            self.open.clear()
            self.closed.clear()
            yield pd.DataFrame([(key[0], due, due * self.size - 1, "unfinished")], columns=["run", "window", "at", "status"])

    def close(self) -> None:
        pass


def signals_gate(samples: DataFrame, size: int, signals: list[str], run: str = "run", signal: str = "signal", order: str = "i", value: str = "value", idle_ms: int | None = None) -> DataFrame:
    """One row (run, window, at, status) per window that all ``signals`` of a run have closed, as a stream; the verdict of :func:`windows.stop_decision`.

    Samples may arrive in any order and more than once, also over micro-batches: a position is counted once. Other signals
    and nulls are ignored, and so is all that comes after a run has stopped. With ``idle_ms``, a run that gets no
    sample for so long ends as unfinished, with the window it was in; this needs a trigger that keeps running, as with
    timers there is always another micro-batch (``availableNow`` would not end). The session needs the state store ``STORE``.
    """
    columns = samples.select(run, signal, order, value)
    gate = RunGate(signals, size, (run, signal, order, value), idle_ms)
    mode = "None" if idle_ms is None else "ProcessingTime"
    return columns.groupBy(run).transformWithStateInPandas(gate, "run string, window bigint, at bigint, status string", "append", mode)


def streaming_moving_stop(samples: DataFrame, target: float, tolerance: float = 5.0, width: int = 7, run: str = "run", order: str = "i", across: str = "across", up: str = "up") -> DataFrame:
    """The stream's twin of :func:`windows.moving_stop`: one row (run, stopped_at, angle) when a run's direction comes near the target.

    State per run: the last ``width`` samples, and whether it has stopped.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        a, b, done = state.get if state.exists else ([], [], False)
        a, b, out = list(a), list(b), []
        rows = pd.concat(list(batches)).sort_values(order)
        for at, x, y in zip(rows[order], rows[across], rows[up], strict=True):
            if done:
                break
            a, b = [*a, float(x)][-width:], [*b, float(y)][-width:]
            angle = math.degrees(math.atan2(math.fsum(b) / len(b), math.fsum(a) / len(a)))
            if len(a) == width and abs(math.remainder(angle - target, 360.0)) <= tolerance:
                out, done = [(key[0], int(at), angle)], True
        state.update((a, b, done))
        if out:
            yield pd.DataFrame(out, columns=["run", "stopped_at", "angle"])

    return samples.groupBy(run).applyInPandasWithState(step, "run string, stopped_at bigint, angle double", "a array<double>, b array<double>, done boolean", "append", GroupStateTimeout.NoTimeout)


def running_field_stats(samples: DataFrame, cell: str, value: str) -> DataFrame:
    """Running mean and rms of the fluctuation per cell, as a streaming aggregation (complete or update mode)."""
    from pyspark.sql import functions as F

    from tidemark.functions.expr import non_negative_root

    return samples.groupBy(cell).agg(F.avg(value).alias("mean"), non_negative_root(F.var_pop(value)).alias("rms"), F.count(F.lit(1)).alias("n"))
