"""Windowed transaction resolution against a sequential model of the same rules."""

import random

import pytest

from tidewire.operators import transactions as T

LOG = "seq long, transactional_id string, kind string, topic string, value string, claimed_pid long, claimed_epoch int, is_commit boolean"


def model(rows):
    """(sessions, fenced, outcomes) of a log in order."""
    state, pids, sessions, fenced, pending, outcomes = {}, 0, [], [], {}, {}
    for seq, tid, kind, _, _, pid, epoch, commit in rows:
        known = state.get(tid)

        def end(what, tid=tid):
            outcomes.update(dict.fromkeys(pending.pop(tid, []), what))

        if kind == "INIT":
            if tid is None or known is None or known[1] == T.EPOCHS - 1:
                pids += 1
                new = [pids, 0, False]
            else:
                new = [known[0], known[1] + 1, False]
            if tid is not None:
                if known and known[2]:
                    end("ABORT")
                state[tid] = new
            sessions.append((seq, tid, new[0], new[1]))
        elif kind == "MSG":
            pending.setdefault(tid, []).append(seq)
            outcomes[seq] = "OPEN"
        else:
            ok = known is not None and known[:2] == [pid, epoch]
            fenced.append((seq, not ok))
            if ok:
                known[2] = kind == "ADD"
                if kind == "END":
                    end("COMMIT" if commit else "ABORT")
    return sessions, fenced, outcomes


def random_log(n, seed):
    rng, rows, state, pids = random.Random(seed), [], {}, 0
    for seq in range(n):
        tid, kind = f"t{rng.randrange(6)}", rng.choice(["INIT", "ADD", "MSG", "MSG", "END"])
        if kind == "INIT" and rng.random() < 0.2:
            tid = None
        if kind == "INIT":
            if tid is None or tid not in state:
                pids += 1
                if tid:
                    state[tid] = [pids, 0]
            else:
                state[tid][1] += 1
        pid, epoch = state.get(tid, [-1, 0])
        claims = (pid, epoch - (rng.random() < 0.2)) if kind in ("ADD", "END") else (None, None)
        rows.append((seq, tid, kind, "x", str(seq), *claims, rng.random() < 0.6 if kind == "END" else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs(spark, seed):
    rows = random_log(800, seed)
    log = spark.createDataFrame(rows, LOG).repartition(5)
    sessions, fenced, outcomes = model(rows)
    assert sorted((r.seq, r.transactional_id, r.pid, r.epoch) for r in T.producer_sessions(log).collect()) == sessions
    assert sorted((r.seq, r.fenced) for r in T.fence_checks(log).collect()) == fenced
    assert {r.seq: r.outcome for r in T.txn_outcomes(log).collect()} == outcomes


def test_epoch_rotation(spark):
    log = spark.range(T.EPOCHS + 2).selectExpr("id AS seq", "'t' AS transactional_id", "'INIT' AS kind")
    last = T.producer_sessions(log).where(f"seq >= {T.EPOCHS - 1}").orderBy("seq").collect()
    assert [(r.pid, r.epoch) for r in last] == [(1, T.EPOCHS - 1), (2, 0), (2, 1)]


def test_empty_log(spark):
    assert T.txn_outcomes(spark.createDataFrame([], LOG)).collect() == []


def test_rows_without_an_id_belong_to_no_transaction(spark):
    rows = [(1, "a", "INIT", None, None, None, None, None), (2, "a", "ADD", "t", None, 1, 0, None), (3, "a", "MSG", "t", "x", None, None, None), (4, None, "MSG", "t", "y", None, None, None), (5, "a", "END", None, None, 1, 0, True), (6, None, "END", None, None, 1, 0, True)]
    log = spark.createDataFrame(rows, LOG)
    assert [(r.seq, r.outcome, r.end_seq) for r in T.txn_outcomes(log).collect()] == [(3, "COMMIT", 5)]
    assert [(r.seq, r.terminal) for r in T.txn_terminals(log).collect()] == [(5, "COMMIT")]
    assert {r.seq: r.fenced for r in T.fence_checks(log).collect()} == {2: False, 5: False, 6: True}
    assert T.zombie_aborts(log).collect() == []


@pytest.mark.parametrize("size", [1, 7, 100])
def test_an_id_over_many_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(T, "RANGE", size)
    rows = random_log(400, size)
    log = spark.createDataFrame(rows, LOG).repartition(3)
    sessions, fenced, outcomes = model(rows)
    assert sorted((r.seq, r.transactional_id, r.pid, r.epoch) for r in T.producer_sessions(log).collect()) == sessions
    assert sorted((r.seq, r.fenced) for r in T.fence_checks(log).collect()) == fenced
    assert {r.seq: r.outcome for r in T.txn_outcomes(log).collect()} == outcomes


def hot_log(spark, n):
    """One id with n rows: an INIT every 1,000, of which some meet an open transaction, and a transaction of 97 rows in between."""
    k = "id % 1000"
    kind = f"CASE WHEN {k} = 0 THEN 'INIT' WHEN {k} % 97 = 1 THEN 'ADD' WHEN {k} % 97 = 96 THEN 'END' ELSE 'MSG' END"
    epoch = f"CAST(id DIV 1000 % {T.EPOCHS} AS INT)"
    return spark.range(n).selectExpr("id AS seq", "'hot' AS transactional_id", f"{kind} AS kind", "'t' AS topic", "CAST(id AS STRING) AS value", "CAST(1 AS LONG) AS claimed_pid", f"{epoch} AS claimed_epoch", f"{kind} = 'END' AND id % 2 = 0 AS is_commit")


def test_a_million_rows_of_one_id(spark):
    log = hot_log(spark, 1_000_000)
    wanted = model([tuple(r) for r in log.toPandas().itertuples(index=False)])[2]
    out = T.txn_outcomes(log)
    found = out.toPandas()
    assert dict(zip(found.seq, found.outcome, strict=True)) == wanted
    assert "part" in out._jdf.queryExecution().executedPlan().toString()


def scans(df, path):
    """How often the plan of df reads files under path."""
    return sum("FileScan" in x and path in x for x in df._jdf.queryExecution().executedPlan().toString().splitlines())


def test_the_log_is_read_at_most_twice(spark, tmp_path, monkeypatch):
    """Once while its control rows are written, and once for its messages."""
    path = str(tmp_path / "log")
    spark.createDataFrame(random_log(300, 9), LOG).write.parquet(path)
    written, keep = [], T.materialise
    monkeypatch.setattr(T, "materialise", lambda df, what: written.append(scans(df, path)) or keep(df, what))
    for operator, most in ((T.producer_sessions, 1), (T.fence_checks, 1), (T.txn_terminals, 1), (T.txn_outcomes, 2)):
        written.clear()
        out = operator(spark.read.parquet(path))
        assert sum(written) + scans(out, path) == most
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 5
