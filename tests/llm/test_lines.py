"""Line de-duplication against brute force, its runs, and the awkward rows."""

import hashlib
import random
from collections import Counter, defaultdict

from linkflow.llm.line_dedup import LineRuns, dedup_lines, long_enough
from pyspark.sql import functions as F

from .data import ROWS, docs, lowered, table

WHITE = " \t\n\x0b\x0c\r"
SHARED = [f"Shared Line {i} that is long enough to be a key of its own, É{i}" for i in range(4)]


def brute(rows, min_chars=40, min_docs=5):
    key = lambda line: lowered(line.strip(WHITE))
    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k].append(-1 if i is None else i)
    keep = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keep.get(key(x), -1 if i is None else i) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def corpus(n=60, seed=3):
    rnd = random.Random(seed)
    rows = [(r[0], r[1]) for r in ROWS]
    for i in range(n):
        lines = [rnd.choice(["", " ", "\t"]) + (x.upper() if rnd.random() < .3 else x) + rnd.choice(["", "\r", " "])
                 for x in SHARED if rnd.random() < .4]
        lines += [f"own line {i} " + "z" * 40, "short", ""]
        rnd.shuffle(lines)
        rows.append((100 + i if i % 7 else None, "\n".join(lines)))
    # four documents are too few; é counts once, so 39 code points are too few
    rows += [(300 + i, "four documents hold this line, which is not enough") for i in range(4)]
    rows += [(310 + i, "é" * 39) for i in range(6)] + [(320 + i, "é" * 40) for i in range(6)]
    # repeated rows are documents, and rows of the greatest id keep the line
    rows += [(400, "repeated rows are documents of their own here\nx")] * 6
    return rows


def frame(spark, rows):
    return docs(spark, [(i, t, None, None) for i, t in rows])


def test_lines_equal_brute_force(spark):
    rows = corpus()
    for batches in (1, 2, 7):
        assert table(dedup_lines(frame(spark, rows), batches=batches)) == brute(rows), batches
    assert table(dedup_lines(frame(spark, rows), min_chars=5, min_docs=2)) == brute(rows, 5, 2)


def test_no_rows_and_only_null_ids(spark):
    assert dedup_lines(frame(spark, [])).collect() == []
    rows = [(None, SHARED[0])] * 6 + [(None, None)]
    assert table(dedup_lines(frame(spark, rows))) == brute(rows)


def test_runs_are_levelled_and_settled_keys_are_left_out(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2, buckets=4)
    truth, seen = Counter(), []
    for batch in range(6):  # greater ids first
        rows = [(bytes([k]) * 16, 100 - 10 * batch - j) for k in range(20) for j in range(1 + k % 2) if (k + batch) % 3]
        rows += [(b"hot" * 5, 100 - 10 * batch - j) for j in range(5)]
        truth.update(k for k, _ in rows)
        runs.add(spark.createDataFrame(rows, "key binary, id bigint"))
        assert all(len(level) < 2 for level in runs.levels)
        seen.append(sum(r.n for name in runs.runs() for r in spark.table(name).filter("n >= 5").collect()
                        if bytes(r.key) == b"hot" * 5))
    assert set(seen) == {5}  # settled by the first batch, never added again
    assert {bytes(r.key) for r in runs.repeated().collect()} == {k for k, n in truth.items() if n >= 3}
    assert {r.holder for r in runs.repeated().filter(F.col("key") == F.lit(b"hot" * 5)).collect()} == {100}
    names = runs.runs()
    runs.close()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_runs_are_joined_as_they_lie(spark):
    runs = LineRuns(spark, min_docs=2, fanout=3, buckets=4)
    runs.add(spark.createDataFrame([(bytes([k]) * 16, 9) for k in range(50)], "key binary, id bigint"))
    own = spark.createDataFrame([(b"a" * 16, 1)], "key binary, id bigint").groupBy("key").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run = spark.table(runs.runs()[0])
        plan = own.join(run.hint("merge"), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    runs.close()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's


def test_code_points_count():
    assert long_enough("é".encode() * 40, 40) and not long_enough("é".encode() * 39, 40)
    assert long_enough(b"x" * 40, 40) and not long_enough(b"x" * 39, 40)
    assert long_enough("\U0001f600".encode() * 40, 40) and not long_enough("\U0001f600".encode() * 39, 40)
