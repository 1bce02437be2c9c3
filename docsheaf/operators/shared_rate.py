"""One rate of calls over all tasks of a run.

The tasks are those of a barrier stage, so all of them run at once and can
exchange messages. In each round every task says how many attempts wait, how
many it made and how many met a rate limit; from these messages each task works
out the same shares of the next round: attempts are granted to tasks in
proportion to what waits there, so when some tasks end their share goes to the
others at once. Grants are spread over the time that the last round took, with
its messages, and calls go on while messages are under way. The attempts made
count against the time that went by, on the first task's clock; time in which
nothing waited is lost. A rate limit that any task meets halves the rate of
all; each round without one raises it again by a tenth of the full rate.
"""

import json
import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from docsheaf.operators.calls import RetryPolicy, attempt_call
from docsheaf.sources import journal as J

#: Seconds from one round's grants to the next one's messages, and the longest round that is granted for.
SPAN, LONGEST = 0.25, 4.0
#: The least part of the rate that rate limits leave, and what a round without one gives back.
LEAST = 1 / 16
REGAIN = 0.1


@dataclass(frozen=True)
class Report:
    """A task's message: attempts that wait, attempts made and rate limits met since the last one."""

    waiting: int
    made: int
    limited: int
    clock: float
    ended: bool


class Shares:
    """The grants of all tasks, the same in each of them."""

    def __init__(self, rate: float, span: float = SPAN):
        self.rate, self.span, self.part = rate, span, 1.0
        self.credit, self.clock, self.turn = 0.0, 0.0, 0

    def next(self, reports: list[Report]) -> tuple[list[int], float]:
        """What each task may do, and the seconds over which."""
        clock = reports[0].clock
        gone, self.clock, self.turn = clock - self.clock, clock, self.turn + 1
        if any(r.limited for r in reports):
            self.part = max(LEAST, self.part / 2)
        else:
            self.part = min(1.0, self.part + REGAIN)
        rate, ahead = self.rate * self.part, min(LONGEST, max(self.span, gone))
        # what went by unused is lost, but for a round's worth or one attempt
        self.credit = min(self.credit + rate * gone - sum(r.made for r in reports), max(1.0, rate * ahead))
        room = max(0, int(self.credit + rate * ahead))
        return self._dealt(room, [r.waiting for r in reports]), ahead

    def _dealt(self, room: int, waiting: list[int]) -> list[int]:
        """In proportion to what waits; what is left over goes round, from another task in each span."""
        total = sum(waiting)
        if total <= room:
            return waiting
        out = [room * w // total for w in waiting]
        n = len(waiting)
        for k in sorted(range(n), key=lambda k: (-(room * waiting[k] % total), (k - self.turn) % n)):
            if sum(out) == room:
                break
            out[k] += out[k] < waiting[k]
        return out


def most_waiting(rate: float, in_flight: int) -> int:
    """Rows that a task holds: as many as it may be granted at once."""
    return in_flight + 2 * int(rate * LONGEST) + 2


class Gate:
    """Lets threads pass as their task's grants allow, evenly over a round."""

    def __init__(self, now: Callable[[], float] = time.monotonic):
        self.now, self.changed = now, threading.Condition()
        self.granted, self.begun, self.over, self.passed = 0, 0.0, 1.0, 0
        self.made, self.limited, self.waiting, self.shut = 0, 0, 0, False

    def open(self, granted: int, over: float) -> None:
        """Grants in place of those that are left."""
        with self.changed:
            self.granted, self.over, self.begun, self.passed = granted, over, self.now(), 0
            self.changed.notify_all()

    def take(self) -> None:
        with self.changed:
            self.waiting += 1
            try:
                while not self.shut:
                    due = self.begun + (self.passed + 0.5) * self.over / max(1, self.granted)
                    pause = due - self.now() if self.passed < self.granted else None
                    if pause is not None and pause <= 0:
                        break
                    self.changed.wait(pause)
                self.passed += 1
                self.made += 1
            finally:
                self.waiting -= 1

    def note(self, error: Exception) -> None:
        if getattr(error, "kind", None) == "rate_limit":
            with self.changed:
                self.limited += 1

    def count(self) -> tuple[int, int]:
        """Attempts made and rate limits met since the last count."""
        with self.changed:
            out, self.made, self.limited = (self.made, self.limited), 0, 0
            return out

    def close(self) -> None:
        with self.changed:
            self.shut = True
            self.changed.notify_all()


class Meeting(threading.Thread):
    """Exchanges messages round by round until no task has rows, and opens the task's gate."""

    def __init__(self, gate: Gate, gather: Callable[[str], list[str]], place: int, rate: float, span: float):
        super().__init__(daemon=True)
        self.gate, self.gather, self.place, self.rate, self.span = gate, gather, place, rate, span
        self.todo, self.ended, self.error = 0, False, None

    def run(self) -> None:
        shares, began = Shares(self.rate, self.span), time.monotonic()
        try:
            while True:
                ended, (made, limited) = self.ended, self.gate.count()
                own = Report(self.todo + self.gate.waiting, made, limited, time.monotonic() - began, ended)
                reports = [Report(**json.loads(m)) for m in self.gather(json.dumps(own.__dict__))]
                if all(r.ended for r in reports):
                    return
                granted, over = shares.next(reports)
                self.gate.open(granted[self.place], over)
                time.sleep(self.span)
        except BaseException as error:  # noqa: BLE001 - the task raises it
            self.error = error
        finally:
            self.gate.close()


def rated_calls(
    rows: Iterator, one: Callable, gather: Callable[[str], list[str]], place: int, rate: float,
    in_flight: int, gate: Gate, span: float = SPAN,
) -> Iterator[tuple]:
    """``(row, one(row))`` as calls end. ``one`` passes ``gate`` before each attempt.

    ``gather`` hands a message to all tasks and returns those of all, in order;
    ``place`` is this task's. A task without rows goes on until none has any.
    """
    meeting, ended = Meeting(gate, gather, place, rate, span), queue.SimpleQueue()
    todo, more, under_way = deque(), True, 0
    most = most_waiting(rate, in_flight)

    def call(row):
        try:
            ended.put((row, one(row), None))
        except BaseException as error:  # noqa: BLE001 - the task raises it
            ended.put((row, None, error))

    with ThreadPoolExecutor(in_flight) as threads:
        try:
            while True:
                while more and len(todo) < most:
                    row = next(rows, None)
                    more = row is not None
                    if more:
                        todo.append(row)
                while todo and under_way < in_flight:
                    threads.submit(call, todo.popleft())
                    under_way += 1
                meeting.todo = len(todo)
                if meeting.ident is None:
                    meeting.start()
                if not under_way:
                    break
                row, outcome, error = ended.get()
                if error or meeting.error:
                    raise error or meeting.error
                under_way -= 1
                yield row, outcome
            meeting.ended = True
            meeting.join()
            if meeting.error:
                raise meeting.error
        finally:
            gate.close()


def write_outcomes_at_rate(
    rows: DataFrame, folder: str, keys: tuple[str, ...], make_client: Callable, policy: RetryPolicy,
    sleep: Callable[[float], None], tasks: int, in_flight: int = 1, span: float = SPAN,
) -> str:
    """Call for every row of ``rows(*keys, request)`` at ``policy.calls_per_second`` over all ``tasks``.

    All tasks run at once, so there must be as many free slots. Outcomes go to
    the journal in ``folder`` as calls end; a stage that is lost is begun anew
    and goes on from it. Returns the name of the run.
    """
    run, rate = J.run_name(), policy.calls_per_second

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        place = context.partitionId()
        journal = J.TaskJournal(f"{folder}/{run}", place, context.taskAttemptId())
        known = {tuple(row[k] for k in keys) for row in journal.earlier()}
        gate, own = Gate(), threading.local()

        def one(row):
            if not hasattr(own, "client"):
                own.client = make_client()
            return attempt_call(own.client, row[1], policy, sleep, gate.take, gate.note)

        todo = (row for row in J.keyed_rows(batches, keys) if row[0] not in known)
        made = 0
        try:
            for (key, _), outcome in rated_calls(todo, one, context.allGather, place, rate, in_flight, gate, span):
                journal.add(dict(zip(keys, key, strict=True)) | dict(zip(J.OUTCOME, outcome, strict=True)))
                made += 1
        finally:
            journal.close()
        yield pa.RecordBatch.from_pydict({"task": [place], "files": [journal.files], "made": [made]})

    dealt = rows.select(*keys, "request").repartition(tasks, *keys)
    # a row for each task
    ended = dealt.mapInArrow(work, "task bigint, files array<string>, made bigint", barrier=True).collect()
    J.finish(folder, run, [tuple(row) for row in ended])
    return run
