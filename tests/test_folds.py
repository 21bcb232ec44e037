"""A state that is advanced part by part is the reduction of the whole log."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from newsflow.operators import folds as O
from newsflow.operators import history as H

LOG = "id bigint, n int, changed_at int, status string, a string, b int, note string, part int"


def made_log(seed):
    rng = random.Random(seed)
    maybe = lambda value: value if rng.random() < 0.6 else None
    rows = []
    for n in range(300):
        status = rng.choice(["running", "running", "success", "failed"])
        rows.append((rng.choice([None, *range(40)]), n, rng.randint(0, 50), status, maybe(f"a{n}"), maybe(n), maybe(f"e{n}"), rng.randint(0, 4)))
    return rows


ORDER = ["changed_at", "n"]
CASES = {
    "history": (lambda: O.history_fold(ORDER, ["a"], ["b", "note"]), lambda log: H.history_state(log, ORDER, ["a"], ["b", "note"])),
    "runs": (lambda: O.dag_run_fold(ORDER, "id", ["a"], ["b", "note"]), lambda log: H.dag_run_state(log.filter("id is not null"), ORDER, "id", ["a"], ["b", "note"])),
    "upsert": (lambda: O.upsert_fold({"id": F.col("id")}, ORDER, ["a"], ["b", "status"]), lambda log: H.upsert_state(log, ["id"], ORDER, ["a"], ["b", "status"])),
    "written only": (lambda: O.upsert_fold({"id": F.col("id")}, ORDER, ["a"], ["b"], True), lambda log: H.upsert_state(log, ["id"], ORDER, ["a"], ["b"], True)),
    "files": (
        lambda: O.file_fold(ORDER, ["id"], "note", ["note", "a"], ["b"], key_chars=2),
        lambda log: H.file_upsert(log, ORDER, ["id"], "note", ["note", "a"], ["b"], key_chars=2),
    ),
}


def table(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("case", CASES)
def test_parts_in_any_order_give_the_whole(spark, case):
    make, whole = CASES[case]
    fold = make()
    rows = [r for r in made_log(1) if case != "runs" or r[0] is not None]
    log = spark.createDataFrame(rows, LOG)
    want = table(whole(log))
    for order in ([0, 1, 2, 3, 4], [3, 1, 4, 0, 2, 1, 1]):
        states = [fold.state(log.filter(F.col("part") == p)) for p in order]
        assert table(fold.result(fold.merge(*states))) == want
    # One part after the other, into what is there.
    state = states[0]
    for more in states[1:]:
        state = fold.merge(state, more)
    assert table(fold.result(state)) == want


def test_a_stored_state_is_advanced_where_it_is_touched(spark, tmp_path):
    make, whole = CASES["history"]
    fold = make()
    log = spark.createDataFrame(made_log(2), LOG)
    path = str(tmp_path / "state")
    for part in (4, 0, 2, 1, 3, 2):
        state = O.advance(spark, path, fold, log.filter(F.col("part") == part), buckets=8)
    assert table(fold.result(state)) == table(whole(log))
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/bucket=*/*.parquet")}
    before = files()
    O.advance(spark, path, fold, log.filter("id = 7"), buckets=8)
    kept = before.items() & files().items()
    # The bucket of one key was rewritten, the other seven were not.
    assert {os.path.dirname(f) for f, _ in kept} == {os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in files() if (f, before.get(f)) not in kept}
    assert len({os.path.dirname(f) for f, _ in kept}) == 7
    # No changes: nothing to do.
    assert table(fold.result(O.advance(spark, path, fold, log.filter("false"), buckets=8))) == table(whole(log))


def test_a_start_that_comes_late_lets_earlier_finishes_count(spark):
    fold = O.dag_run_fold(["at"], "run", ["name"], ["n"], time="at")
    schema = "run int, at int, status string, name string, n int"
    finish = spark.createDataFrame([(1, 5, "success", None, 3)], schema)
    start = spark.createDataFrame([(1, 9, "running", "late", None)], schema)
    early = spark.createDataFrame([(1, 2, "running", "early", None)], schema)
    state = fold.merge(fold.state(finish), fold.state(start))
    row = fold.result(state).first()
    assert (row["name"], row["status"], row["n"], row["completed_at"]) == ("late", "running", None, None)
    row = fold.result(fold.merge(state, fold.state(early))).first()
    assert (row["name"], row["status"], row["n"], row["completed_at"]) == ("early", "running", 3, 5)
    assert fold.result(fold.state(finish)).count() == 0
