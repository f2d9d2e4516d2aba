"""Patterns, one-pass matches, sliding extremes and mergeable distinct counts, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import distinct, joins
from tidemark.plans import automaton, extremes
from tidemark.plans.automaton import step
from tidemark.streaming import folds

S = 1_000_000
PATTERNS = {
    "strict": [step("a"), step("b"), step("c")],
    "relaxed": [step("a"), step("b", relaxed=True), step("a", "c", relaxed=True)],
    "times": [step("a", times=2), step("b", times=2, relaxed=True)],
    "mixed": [step("a", "b"), step("b"), step("c", relaxed=True), step("a", times=2)],
    "one": [step("c")],
}


def events(seed=3, n=400):
    rnd = random.Random(seed)
    kinds = ["a", "b", "c", None]
    return [(i, rnd.choice(["k", "m", None]), rnd.randrange(300) * S // 2, rnd.choices(kinds, (4, 4, 3, 1))[0]) for i in range(n)]


def brute(rows, steps, within):
    """Every start walks on by itself."""
    places, found = automaton.chain(steps), []
    for key in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(own):
            if r[3] not in places[0][0]:
                continue
            at, ok = i, True
            for kinds, relaxed in places[1:]:
                at += 1
                while relaxed and at < len(own) and own[at][3] not in kinds:
                    at += 1
                ok = at < len(own) and own[at][3] in kinds
                if not ok:
                    break
            if ok and own[at][2] - r[2] < within:
                found.append((key, r[0], r[2], own[at][2]))
    return sorted(found, key=str)


@pytest.mark.parametrize("name", PATTERNS)
def test_patterns_by_brute_force(spark, name):
    rows = events()
    df = spark.createDataFrame(rows, "id long, key string, us long, kind string").withColumn("ts", F.timestamp_micros("us"))
    # few rows a batch, so that groups cross the batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = automaton.find_sequences(df, ["key"], "ts", "id", "kind", PATTERNS[name], "9 seconds")
        got = sorted((tuple(r) for r in out.select("key", "first_tie", F.unix_micros("first_at"), F.unix_micros("last_at")).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows, PATTERNS[name], 9 * S)
    assert got == want and want
    assert automaton.find_sequences(df.limit(0), ["key"], "ts", "id", "kind", PATTERNS[name], "9 seconds").count() == 0


@pytest.mark.parametrize("name", PATTERNS)
def test_pattern_fold_by_brute_force(name):
    rows = events(seed=8)
    fold = folds.Sequences("kind", PATTERNS[name], 9 * S)
    got = []
    for key in {r[1] for r in rows}:
        state = fold.start()
        for i, k, at, kind in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            state, _ = fold.expire(state, at)
            state, made = fold.step(state, at, i, {"kind": kind})
            got += [(k, *m) for m in made]
    assert sorted(got, key=str) == brute(rows, PATTERNS[name], 9 * S)


def test_match_by_brute_force(spark):
    rnd = random.Random(6)
    side = lambda n: [(i, rnd.choice(["x", "y", "z", None]), rnd.choice([None, *range(200)])) for i in range(n)]
    left, right = side(90), side(80) + [(200, "x", 50), (201, "x", 50)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, key string, at long").withColumn("ts", F.timestamp_seconds("at"))
    got = joins.match_with_timeout(frame(left), frame(right), "key", "ts", "5 seconds", "3 seconds")
    assert got.columns == ["key", "l_id", "l_at", "l_ts", "r_id", "r_at", "r_ts", "tag"]
    fits = lambda a, b: None not in (a[1], a[2], b[2]) and a[1] == b[1] and -3 <= b[2] - a[2] <= 5
    want = [(a[0], b[0], "matched") for a in left for b in right if fits(a, b)]
    want += [(a[0], None, "left_only") for a in left if not any(fits(a, b) for b in right)]
    want += [(None, b[0], "right_only") for b in right if not any(fits(a, b) for a in left)]
    assert sorted(map(str, ((r.l_id, r.r_id, r.tag) for r in got.collect()))) == sorted(map(str, want))
    assert {t for *_, t in want} == {"matched", "left_only", "right_only"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("how", ["max", "min"])
def test_sliding_extremes_by_brute_force(spark, how):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), rnd.randrange(400), rnd.choice([None, rnd.randrange(50)])) for _ in range(150)]
    df = spark.createDataFrame(rows, "key string, at long, v long").withColumn("ts", F.timestamp_seconds("at"))
    out = extremes.sliding_extreme(df, ["key"], "ts", "20 seconds", "5 seconds", F.col("v"), how, bucket="1 minute")
    got = {}
    for r in out.select("key", F.unix_seconds("first_end").alias("a"), F.unix_seconds("next_end").alias("b"), "highest").collect():
        for end in range(r.a, r.b, 5):
            assert (r.key, end) not in got
            got[(r.key, end)] = r.highest
    want = {}
    for key in "ab":
        for end in range(0, 430, 5):
            held = [v for k, t, v in rows if k == key and v is not None and end - 20 <= t < end]
            if held:
                want[(key, end)] = {"max": max, "min": min}[how](held)
    assert got == want


def test_distinct_parts_by_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.randrange(300), rnd.choice([None, rnd.randrange(100_000), rnd.randrange(20)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "key string, at long, v long").withColumn("ts", F.timestamp_seconds("at"))
    want = {}
    for key, at, v in rows:
        for end in range(at // 10 * 10 + 10, at // 10 * 10 + 61, 10):
            if v is not None:
                want.setdefault((key, end), set()).add(v)
    exact = distinct.sliding_bitmap_distinct(df, ["key"], "ts", "60 seconds", "10 seconds", F.col("v"))
    assert {(r.key, int(r.window_end.timestamp())): r.cnt for r in exact.collect()} == {k: len(v) for k, v in want.items()}
    about = distinct.sliding_sketch_distinct(df, ["key"], "ts", "60 seconds", "10 seconds", F.col("v"))
    for r in about.collect():
        n = len(want[(r.key, int(r.window_end.timestamp()))])
        assert abs(r.cnt - n) <= 3 * 0.83 / 64 * n + 1
