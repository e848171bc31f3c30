"""Stored history state: waves equal one scan, states merge in any grouping."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pacekit.operators.prefix import add_history_segmented
from pacekit.operators.state import extend_history, history_state, merge_states

SCHEMA = "result_id long, runner_id long, race_id int, date date, speed_kmh double, speed_z_race double"


def rows(n=600):
    rng = random.Random(6)
    out = []
    for i in range(n):
        runner = rng.choice([1, 1, 1, 2, 3, 4, None, 5 + i % 40])               # a hot runner, and rows without one
        day = dt.date(2000, 1, 1) + dt.timedelta(days=i // 3)
        out.append((i, runner, i // 10, day, rng.choice([None, 10 + rng.random() * 5]), rng.choice([None, rng.gauss(0, 1)])))
    return out


def flat(df):
    names = [c for c in df.columns if c not in ("speed_kmh", "speed_z_race")]
    key = names.index("result_id") if "result_id" in names else 0
    def value(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else [value(x) for x in v] if isinstance(v, (list, tuple)) else v
    return sorted(([value(v) for v in r] for r in map(tuple, df.select(*names).collect())), key=lambda r: str(r[key]))


def test_waves_equal_one_scan(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    want = flat(add_history_segmented(df))
    for cuts in ([300], [1, 2, 599]):
        got, state = [], None
        for a, b in zip([0, *cuts], [*cuts, len(data)]):
            if a == b:
                continue
            features, state = extend_history(df.where((F.col("result_id") >= a) & (F.col("result_id") < b)), state)
            got += flat(features)
        assert sorted(got, key=lambda r: str(r[0])) == want
        assert flat(state) == flat(merge_states(history_state(df), history_state(df.where("false"))))


def test_states_merge_in_any_grouping(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    a, b, c = (history_state(df.where(w)) for w in ("result_id < 100", "result_id BETWEEN 100 AND 350", "result_id > 350"))
    whole = flat(history_state(df))
    assert flat(merge_states(merge_states(a, b), c)) == whole == flat(merge_states(a, merge_states(b, c)))
    hot = [r for r in whole if r[0] == 1][0]
    assert hot[1] > 200 and len(hot[-1]) == 3


def test_hot_entities_ship_three_rows_a_task(spark):
    plan = history_state(spark.createDataFrame(rows(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
