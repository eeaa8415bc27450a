"""Event-time windows, joins of streams and the state of calls: streams in small batches against tables and against runs."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from pagelake.operators import model
from pagelake.streaming import calls, joins, windows

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, user_id long, value double"


def at(minutes):
    return (START + dt.timedelta(minutes=minutes)).isoformat()


def files(folder, batches):
    """A JSON file for each batch, in order of its name and time."""
    folder.mkdir(parents=True)
    for i, rows in enumerate(batches):
        path = folder / f"{i:03d}.json"
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        import os

        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def collected(df, tmp_path, name, mode="append"):
    """Every row that the stream gives, to its end."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"cp_{name}")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return df.sparkSession.table(name)


def test_windows_of_streams_are_those_of_the_rows_that_came_in_time(spark, tmp_path):
    # Minutes of the events, batch by batch. The watermark is the latest minute so far less ten; what a batch drops is
    # judged by the watermark that the batch before it had.
    minutes = [[1, 5, 31], [28, 12, 50], [3, 39, 41], [4, 90], [75, 95, 200], [500]]
    batches = [[{"ts": at(m), "user_id": m % 2, "value": float(m)} for m in b] for b in minutes]
    folder = files(tmp_path / "in", batches)
    rows, late, high = [], [], [-1000, -1000]
    for b in minutes:
        for m in b:
            # A window of half an hour is closed once the watermark has reached its end.
            (late if (m // 30 + 1) * 30 <= high[-2] - 10 else rows).append(m)
        high.append(max(*b, high[-1]))
    assert late == [4]
    high = high[-1]
    numbers = {"n": F.count("*"), "total": F.sum("value")}
    got = collected(windows.tumbling(stream(spark, folder, SCHEMA), "30 minutes", ["user_id"], numbers, "10 minutes"), tmp_path, "tumbling")
    table = spark.createDataFrame([(START + dt.timedelta(minutes=m), m % 2, float(m)) for m in rows], SCHEMA)
    want = windows.tumbling(table, "30 minutes", ["user_id"], numbers).where(F.col("window_end") <= START + dt.timedelta(minutes=high - 10))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 5


def test_sliding_windows_and_sessions_of_streams(spark, tmp_path):
    minutes = [[0, 3, 21], [8, 40], [60, 61], [300]]
    folder = files(tmp_path / "in", [[{"ts": at(m), "user_id": 1, "value": 1.0} for m in b] for b in minutes])
    table = spark.createDataFrame([(START + dt.timedelta(minutes=m), 1, 1.0) for b in minutes for m in b], SCHEMA)
    closed = F.col("window_end") <= START + dt.timedelta(minutes=300 - 30)
    for name, made in (("sliding", lambda df, late=None: windows.sliding(df, "20 minutes", "10 minutes", ["user_id"], {"n": F.count("*")}, late)), ("sessions", lambda df, late=None: windows.sessions(df, "10 minutes", ["user_id"], {"n": F.count("*")}, late))):
        got = collected(made(stream(spark, folder, SCHEMA), "30 minutes"), tmp_path, name)
        assert sorted(got.collect()) == sorted(made(table).where(closed).collect()) and got.count() > 3


def test_pages_and_answers_of_two_streams(spark, tmp_path):
    pages = [[("p1", 0), ("p2", 1)], [("p3", 30)], [("p4", 100)], [("end", 2000)]]
    answers = [[("p1", 5, "a")], [("p2", 70, "too late"), ("p3", 31, "b"), ("p3", 40, "c")], [("nobody", 101, "d")], [("end", 2001, "e")]]
    one = files(tmp_path / "pages", [[{"page_id": p, "page_ts": at(m)} for p, m in b] for b in pages])
    two = files(tmp_path / "answers", [[{"page_id": p, "answer_ts": at(m), "text": t} for p, m, t in b] for b in answers])
    kinds = ("page_id string, page_ts timestamp", "page_id string, answer_ts timestamp, text string")
    got = collected(joins.answered_pages(stream(spark, one, kinds[0]), stream(spark, two, kinds[1])), tmp_path, "answered")
    table = joins.answered_pages(*(spark.read.schema(k).json(f) for k, f in zip(kinds, (one, two), strict=True)))
    key = lambda rows: sorted(((r.page_id, r.text) for r in rows), key=str)
    assert key(table.collect()) == [("end", "e"), ("p1", "a"), ("p2", None), ("p3", "b"), ("p3", "c"), ("p4", None)]
    assert key(got.collect()) == key(table.collect())  # outer rows too: their hour has passed


def played(policy, outcomes):
    """What call makes of a sequence of outcomes: status, attempts made and pauses."""
    left, pauses = list(outcomes), []

    def ask(prompt, level, resolution):
        o = left.pop(0)
        if o == "exception":
            raise OSError("down")
        return {"success": "{}", "empty": "", "bad_json": "{"}[o]

    try:
        done = model.call(ask, policy, "p", parse=json.loads, sleep=pauses.append)
    except IndexError:
        return None  # it would have asked on
    return done["status"], done["attempts"], sum(pauses)


SEQUENCES = [s for n in (1, 2, 3, 4) for s in itertools.product(model.OUTCOMES, repeat=n)]
POLICIES = [model.Policy("detect", "high", "high", 3), model.Policy("transcribe", "low", "high", 2), model.Policy("transcribe", "minimal", "low", 3)]


def machine(policy, outcomes):
    state, made = model.opened(policy), []
    for o in outcomes:
        if state.status == "open":
            made.append((o, state.level, state.resolution))
            state = model.advance(policy, state, o)
    return state, made


@pytest.mark.parametrize("policy", POLICIES, ids=lambda p: f"{p.stage} {p.retries}")
def test_calls_follow_the_machine(spark, policy):
    for s in SEQUENCES:
        state, made = machine(policy, s)
        # call() ends, or runs out of outcomes and so raises from within ask as an exception does.
        if state.status != "open":
            assert played(policy, s) == (state.status, made, state.pause)
    rows = [(i, n + 1, o) for i, s in enumerate(SEQUENCES) for n, o in enumerate(s)]
    table = model.replay(spark.createDataFrame(rows, "call_id long, attempt int, outcome string"), policy.stage, retries=policy.retries, level=policy.level, resolution=policy.resolution)
    for r in table.collect():
        state, _ = machine(policy, SEQUENCES[r.call_id])
        assert (r.status, r.level, r.resolution, r.tries, r.pause) == (state.status, state.level, state.resolution, state.tries, state.pause)


def test_streams_of_attempts_end_where_calls_do(spark, tmp_path):
    policy = POLICIES[1]
    # One attempt of every call in a batch, a minute apart, in the end a row that moves time on; each attempt comes twice.
    batches = [[{"call_id": i, "attempt": n + 1, "outcome": s[n], "ts": at(n)} for i, s in enumerate(SEQUENCES) if len(s) > n for _ in (0, 1)] for n in range(4)]
    batches += [[{"call_id": -1, "attempt": 1, "outcome": "success", "ts": at(600 + 600 * k)}] for k in range(2)]
    attempts = stream(calls.configured(spark), files(tmp_path / "in", batches), "call_id long, attempt int, outcome string, ts timestamp")
    events = collected(calls.call_states(attempts, policy), tmp_path, "call_events", "update").collect()
    last, due = {}, {}
    for e in events:
        if e.kind == "due":
            due.setdefault(e.call_id, set()).add(e.tries)
        elif e.tries >= last.get(e.call_id, e).tries:
            last[e.call_id] = e
    for i, s in enumerate(SEQUENCES):
        state, made = machine(policy, s)
        assert (last[i].status, last[i].level, last[i].resolution, last[i].tries, last[i].pause) == (state.status, state.level, state.resolution, state.tries, state.pause), s
        # A retry is due if the pause after an exception passes and no other attempt came before.
        assert due.get(i, set()) == ({state.tries} if state.status == "open" and s[-1] == "exception" else set()), s
