"""Reports from the states of batches are the reports over all history."""

import datetime as dt
import random

from pyspark.sql import functions as F

from newsflow.operators import report_states as R
from newsflow.operators import stats as S

CRAWLS = "run_id string, ticker string, crawl_date date, article_count int, status string, part int"


def made_history():
    rng = random.Random(5)
    days = [None, dt.date(1899, 12, 31), dt.date(1969, 12, 31), dt.date(1970, 1, 1), *[dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(12)], dt.date(2101, 1, 1)]
    rows = [(f"r{rng.randint(0, 20)}", rng.choice([None, "A", "B", "C"]), rng.choice(days), rng.choice([None, 1, 2, 7]), rng.choice(["success", "failed", "running"]), rng.randint(0, 3)) for _ in range(400)]
    return rows + [("r99", "never", None, None, "running", 0)]


def table(df):
    names = sorted(df.columns)
    return names, sorted((tuple(round(v, 9) if isinstance(v := r[n], float) else v for n in names) for r in df.collect()), key=str)


def test_states_of_batches_give_the_reports_of_the_whole(spark, tmp_path):
    history, path = spark.createDataFrame(made_history(), CRAWLS), str(tmp_path / "states")
    # Batches share days; one of them is run twice.
    for part in (0, 1, 2, 3, 1):
        state = R.report_state(history.filter(F.col("part") == part))
        R.put_state(state, path, f"batch-{part}")
    states = R.stored_states(spark, path, state)
    assert table(R.ticker_stats_of(states)) == table(S.ticker_stats(history))
    assert table(R.latest_crawl_date_of(states)) == table(S.latest_crawl_date(history))
    runs = [R.report_state(history.filter(F.col("part") == p), "run_id") for p in range(4)]
    assert table(R.run_totals_of(runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3]))) == table(S.run_totals(history))


def test_merging_states_first_changes_nothing(spark):
    history = spark.createDataFrame(made_history(), CRAWLS)
    parts = [R.report_state(history.filter(F.col("part") == p)) for p in range(4)]
    some = R.merge_states(parts[0].unionByName(parts[1]))
    all_ = R.merge_states(some.unionByName(parts[2]).unionByName(parts[3]))
    assert table(R.ticker_stats_of(all_)) == table(S.ticker_stats(history))
    assert R.ticker_stats_of(parts[0].limit(0)).count() == 0
