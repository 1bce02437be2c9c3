import json
import sys
import threading
import time
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docsheaf.operators import calls as X
from docsheaf.operators import shared_rate as R
from docsheaf.session import workspace
from docsheaf.sources import journal as J

cloudpickle.register_pickle_by_value(sys.modules[__name__])
KEYS = ("id",)


def client_of(log, breaks_at=None):
    """Answers with the request; every call leaves a line in ``log``. One process ends in the midst of a call."""

    def make():
        def call(text):
            with open(log, "a") as out:
                out.write(f"{text} {time.time()}\n")
            if breaks_at is not None and text.endswith(breaks_at):
                import os

                time.sleep(0.3)
                os._exit(1)
            time.sleep(0.01)
            if text.endswith("7"):
                raise X.CallError("refused", "status", 400)
            return f"reply to {text}\nof two lines"

        return call

    return make


def rows(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select("id", F.concat(F.lit("r"), F.col("id")).alias("request"))


def made(log):
    return Counter(line.split()[0] for line in open(log))


def result(spark, folder):
    return {r.id: (r.raw, r.status, r.attempts, r.error) for r in J.read_outcomes(spark, folder, "id bigint").collect()}


def expected(n):
    return {
        k: (None, "failed", 1, "refused") if k % 10 == 7 else (f"reply to r{k}\nof two lines", "success", 1, None)
        for k in range(n)
    }


@pytest.mark.parametrize("in_flight", [1, 4])
def test_outcomes_are_on_record(spark, tmp_path, in_flight):
    folder, log = workspace(spark, "journal"), tmp_path / "log"
    assert result(spark, folder) == {}
    one = X.caller(client_of(log), X.MODEL_POLICY, X.no_wait)
    run = J.write_outcomes(rows(spark, 50), folder, KEYS, one, in_flight)
    assert result(spark, folder) == expected(50) and set(made(log).values()) == {1}
    done = json.load(open(f"{folder.removeprefix('file:')}/{run}.done"))
    assert sum(task["calls"] for task in done) == 50 and [task["partition"] for task in done] == [0, 1, 2]


@pytest.mark.parametrize("in_flight", [1, 4])
def test_a_killed_job_repeats_the_calls_under_way_alone(spark, tmp_path, in_flight):
    folder, log = workspace(spark, "journal"), tmp_path / "log"
    broken = X.caller(client_of(log, breaks_at="25"), X.MODEL_POLICY, X.no_wait)
    with pytest.raises(Exception, match="crashed|exited|abort|fail"):
        J.write_outcomes(rows(spark, 60), folder, KEYS, broken, in_flight)
    before = result(spark, folder)
    assert 0 < len(before) < 60 and before.items() <= expected(60).items()
    todo = X.pending(rows(spark, 60), J.read_outcomes(spark, folder, "id bigint"), "id")
    J.write_outcomes(todo, folder, KEYS, X.caller(client_of(log), X.MODEL_POLICY, X.no_wait), in_flight)
    assert result(spark, folder) == expected(60)
    repeated = sum(n - 1 for n in made(log).values())
    assert repeated <= 3 * in_flight


def test_a_later_attempt_of_a_task_goes_on(tmp_path):
    calls = []
    one = lambda request: calls.append(request) or ("x", "success", 1, 0.0, None)
    items = [((k,), f"r{k}") for k in range(10)]
    first = J.TaskJournal(str(tmp_path), 4, 17)
    assert J.recorded_calls(iter(items[:6]), first, KEYS, one, 1) == 6
    with open(tmp_path / first.files[0], "ab") as out:
        out.write(b'{"id": 8, "raw": "cut')
    assert J.recorded_calls(iter(items), J.TaskJournal(str(tmp_path), 4, 20), KEYS, one, 2) == 4
    assert sorted(calls) == sorted(r for _, r in items)
    # other tasks are told apart
    assert J.recorded_calls(iter(items), J.TaskJournal(str(tmp_path), 5, 21), KEYS, one, 2) == 10


def test_stores_without_append_get_a_file_for_each_outcome(spark, tmp_path, monkeypatch):
    journal = J.TaskJournal(str(tmp_path / "run"), 0, 0)
    monkeypatch.setattr(journal, "_open", lambda: False)
    one = lambda request: (request, "success", 1, 0.0, None)
    J.recorded_calls((((k,), f"r{k}") for k in range(5)), journal, KEYS, one, 2)
    assert len(journal.files) == 5
    assert {k: v[0] for k, v in result(spark, str(tmp_path)).items()} == {k: f"r{k}" for k in range(5)}


def test_repeated_and_cut_lines(spark, tmp_path):
    folder = tmp_path / "run"
    folder.mkdir()
    line = lambda k, raw: json.dumps({"id": k, "raw": raw, "status": "success", "attempts": 1, "waited": 0.0, "error": None, "end": True})
    (folder / "task-000000-000000000001.jsonl").write_text(f"{line(1, 'a')}\n{line(2, 'b')}\n{line(3, 'c')[:-20]}")
    (folder / "task-000000-000000000002.jsonl").write_text(f"{line(2, 'later')}\n{line(3, 'c')}\n{line(3, 'again')}\n")
    assert {k: v[0] for k, v in result(spark, str(tmp_path)).items()} == {1: "a", 2: "b", 3: "c"}


def test_outcomes_of_batches_in_order_and_without_waiting_at_their_ends():
    begun, lock = [], threading.Lock()

    def one(row):
        with lock:
            begun.append((row, time.monotonic()))
        time.sleep(0.4 if row == 0 else 0.01)
        return row

    batches = [[0, 1, 2], [3, 4, 5], [], [6, 7]]
    started = time.monotonic()
    assert list(X.in_order(iter(batches), one, 2)) == [[0, 1, 2], [3, 4, 5], [], [6, 7]]
    # while the first call goes on, the other thread is done with all others
    assert dict(begun)[7] - started < 0.35
    assert list(X.in_order(iter([[], []]), one, 2)) == [[], []]


# --- rate ---------------------------------------------------------------------------------


def simulated(rate, waiting, seconds, span=0.25, lag=1.03, limits=()):
    """Attempts made at each round's end, where tasks make all that is granted."""
    shares = [R.Shares(rate, span) for _ in waiting]
    waiting, made, clock, turn, out = list(waiting), [0] * len(waiting), 0.0, 0, []
    while clock < seconds and any(waiting):
        reports = [
            R.Report(min(w, R.most_waiting(rate, 8)), m, int(turn in limits and k == 0), clock, False)
            for k, (w, m) in enumerate(zip(waiting, made, strict=True))
        ]
        granted = [s.next(reports) for s in shares]
        assert all(g == granted[0] for g in granted)
        made = granted[0][0]
        assert all(g <= r.waiting for g, r in zip(made, reports, strict=True))
        waiting = [w - g for w, g in zip(waiting, made, strict=True)]
        clock += span + lag
        turn += 1
        out.append((clock, sum(made)))
    return out


@pytest.mark.parametrize("rate", [1, 7, 40, 900])
@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_the_rate_holds_over_all_tasks(rate, tasks):
    n = rate * 60
    steps = simulated(rate, [n] * tasks, 30)
    assert abs(sum(m for _, m in steps) / steps[-1][0] - rate) <= 0.05 * rate
    # half of the tasks end early
    steps = simulated(rate, [n if k % 2 == 0 else rate // 4 for k in range(tasks)], 30)
    assert abs(sum(m for _, m in steps) / steps[-1][0] - rate) <= 0.05 * rate


def test_all_rows_are_called_however_they_lie():
    for waiting in ([1000], [0, 0, 5, 995], [1] * 16, [0]):
        assert sum(m for _, m in simulated(100, waiting, 1e9)) == sum(waiting)


def test_rate_limits_slow_all_down_and_it_recovers():
    steps = [m for _, m in simulated(400, [10**6] * 4, 60, limits=(10, 11, 12))]
    full = 400 * 1.28
    assert all(m > 0.95 * full for m in steps[2:10]) and min(steps[10:15]) < 0.2 * full
    assert all(m > 0.95 * full for m in steps[30:])


@pytest.mark.parametrize("tasks, early", [(1, False), (4, False), (4, True), (16, True)])
def test_threads_of_all_tasks_keep_the_rate(tasks, early):
    rate, seconds = 80, 4
    meeting, said = threading.Barrier(tasks), [None] * tasks
    begun, lock, results = [], threading.Lock(), [0] * tasks

    def gather(place):
        def all_gather(message):
            said[place] = message
            meeting.wait()
            out = list(said)
            meeting.wait()
            return out

        return all_gather

    each = [rate * seconds // tasks * (2 if early else 1) if not early or k % 2 == 0 else 3 for k in range(tasks)]

    def task(place):
        gate = R.Gate()

        def one(row):
            gate.take()
            with lock:
                begun.append(time.monotonic())
            time.sleep(0.005)
            return row

        for _ in R.rated_calls(iter(range(1, each[place] + 1)), one, gather(place), place, rate, 8, gate):
            results[place] += 1

    threads = [threading.Thread(target=task, args=(k,)) for k in range(tasks)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert results == each
    begun.sort()
    # without the first and last spans, in which there may be less to do
    inner = [t for t in begun if begun[0] + 0.5 <= t <= begun[-1] - 0.5]
    assert abs((len(inner) - 1) / (inner[-1] - inner[0]) - rate) <= 0.05 * rate


def test_rate_over_barrier_tasks(spark, tmp_path):
    folder, log = workspace(spark, "journal"), tmp_path / "log"
    policy = X.RetryPolicy(2, 1, 0, 1, X.retry_by_type, calls_per_second=40)
    R.write_outcomes_at_rate(rows(spark, 100), folder, KEYS, client_of(log), policy, X.no_wait, 2, 4)
    assert result(spark, folder) == expected(100) and sum(made(log).values()) == 100
    times = sorted(float(line.split()[1]) for line in open(log))
    assert 99 / (times[-1] - times[0]) == pytest.approx(40, rel=0.1)
