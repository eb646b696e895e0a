"""Sweeps of points at the same time: failing, hanging and slow points hold no other up."""

from __future__ import annotations

import threading
import time

from pyspark.sql import functions as F

from tidemark.plans import flow


def test_points_run_at_the_same_time_and_keep_their_order():
    meet = threading.Barrier(3, timeout=20)
    out = flow.sweep(["a", "b", "c"], lambda p: (meet.wait(), p)[1], at_once=3)
    assert [(o.point, o.result, o.error) for o in out] == [("a", "a", None), ("b", "b", None), ("c", "c", None)]
    most, now, lock = [0], [0], threading.Lock()

    def step(p):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1

    assert len(flow.sweep(map(str, range(10)), step, at_once=2)) == 10 and most[0] == 2
    assert flow.sweep([], step) == []


def test_failing_and_hanging_jobs_hold_no_other_up(spark):
    spark.range(1).count()
    slow = F.udf(lambda v: time.sleep(300) or v, "long")

    def step(p):
        if p == "fails":
            spark.range(3).select(F.raise_error(F.lit("broken point"))).collect()
        if p == "hangs":
            spark.range(0, 2, 1, 2).select(slow("id")).collect()
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.range(10).filter(F.col("id") < int(p)).count()

    began = time.time()
    out = flow.sweep(["hangs", "3", "fails", "5", "7"], step, spark, at_once=2, timeout=8)
    took = time.time() - began
    assert [o.result[1] for o in out if o.error is None] == [3, 5, 7] and len({o.result[0] for o in out if o.result}) == 3
    assert out[0].error.startswith("TimeoutError") and "broken point" in out[2].error
    assert took < 60
    until = time.time() + 30
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.time() < until:
        time.sleep(0.2)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_point_that_goes_on_after_its_time_gets_no_job_through(spark):
    held, ended = threading.Event(), []

    def step(p):
        if p != "late":
            time.sleep(2)
            if p == "b":
                held.set()
            time.sleep(1)
            return p
        held.wait(20)  # its time is over by then
        try:
            spark.range(0, 4, 1, 2).select(F.udf(lambda v: time.sleep(60) or v, "long")("id")).collect()
        except Exception as e:
            ended.append(str(e))

    out = flow.sweep(["late", "a", "b"], step, spark, at_once=2, timeout=4)
    assert out[0].error.startswith("TimeoutError") and [o.result for o in out[1:]] == ["a", "b"]
    until = time.time() + 30
    while not ended and time.time() < until:
        time.sleep(0.2)
    assert ended and "cancelled" in ended[0].lower()
