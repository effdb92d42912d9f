"""Gates that change while files arrive: against a plain loop, with late, untimed and keyless rows, and a replay."""

import collections
import datetime as dt

import pytest

from tablecheck import TableRules, in_range, not_null
from tablecheck.session import scratch_path
from tablecheck.streaming import gates as G

SCHEMA = "key string, ts timestamp_ntz, v double"
RULES = TableRules("t", (not_null("key"), in_range("v", max=1.0)), threshold=0.25)


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour, minutes=minute)


PARTS = [
    [("a", at(0), 0.0), ("a", at(0, 5), 0.0), ("a", at(1), 9.0), ("b", at(0), 9.0), ("b", at(2), 0.0), (None, at(0), 0.0)],
    [("a", at(1, 30), 9.0), ("a", at(2), 0.0), ("a", at(0, 30), 9.0), ("a", None, 0.0), ("b", at(2, 1), 9.0)],
    [("a", at(4), 9.0), ("b", at(3), 0.0), ("b", at(4), 0.0), ("b", at(1), 0.0), ("c", at(0), 0.0), (None, at(3), 0.0)],
    [("a", at(5), 0.0), ("c", at(1), 0.0), ("a", at(4, 59), 0.0)],
]


def plain(parts):
    """The same by hand: rows one after another, windows judged when a batch holds a later one."""
    changes, books, floor = [], [], {}
    kept = collections.defaultdict(list)
    for n, part in enumerate(parts):
        book = collections.defaultdict(lambda: [0, 0, 0])
        for key, ts, v in part:
            hour = ts and ts.replace(minute=0)
            kind = 2 if ts is None else 1 if key in floor and hour < floor[key] else 0
            book[key][kind] += 1
            if kind == 0:
                kept[key, hour].append(v)
        for key, hour in kept:
            floor[key] = max(floor.get(key, hour), hour)
        books += [(n, key, sum(b), *b) for key, b in book.items()]
    for key in {k for k, _ in kept}:
        last = None
        for hour in sorted(h for k, h in kept if k == key and h < floor[key]):
            rows = kept[key, hour]
            is_open = key is not None and sum(v > 1 for v in rows) / len(rows) <= 0.25
            if is_open != last:
                changes.append((key, hour, is_open, "close" if not is_open else "open" if last is None else "reopen"))
            last = is_open
    return sorted(changes, key=repr), sorted(books, key=repr)


@pytest.fixture(scope="module")
def run(spark):
    inbox, path = scratch_path(spark, "inbox"), scratch_path(spark, "gates")
    for part in PARTS:
        frame = spark.createDataFrame(part, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(inbox)
        history = G.stream_gates(spark, inbox, frame.schema, RULES, "key", "ts", path=path)
    return history


def test_changes_and_rows_add_up(run):
    changes, books = plain(PARTS)
    assert sorted(map(tuple, run.transitions().drop("batch_id").collect()), key=repr) == changes
    assert sorted(map(tuple, run.accounting().collect()), key=repr) == books
    assert {c[3] for c in changes} == {"open", "close", "reopen"}


def test_gates_as_they_stand(run):
    got = {r.gate: (r.window_start, r.is_open) for r in run.gates().collect()}
    assert got == {"a": (at(5), True), "b": (at(4), True), "c": (at(1), True), None: (at(3), False)}


def test_a_replayed_batch_changes_nothing(spark, run):
    before = sorted(map(tuple, run.transitions().collect()), key=repr)
    books = sorted(map(tuple, run.accounting().collect()), key=repr)
    G._step(run, spark.createDataFrame(PARTS[3], SCHEMA), 3, RULES, "key", "ts", "1 hour")
    assert sorted(map(tuple, run.transitions().collect()), key=repr) == before
    assert sorted(map(tuple, run.accounting().collect()), key=repr) == books
