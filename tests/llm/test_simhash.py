"""SimHash groups against brute force over all pairs."""

import random
from collections import defaultdict

import pytest
import xxhash

from linkflow.llm import simhash
from linkflow.llm.components import components
from tests.llm.data import ROWS, docs, lowered, words


def fingerprint(text, k=3):
    w = words(lowered(text))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, bits=2):
    """Smallest label that links within ``bits`` reach, for each label."""
    items = list(prints.items())
    root = {k: k for k, _ in items}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if (x ^ y).bit_count() <= bits:
                hi, lo = max(find(a), find(b)), min(find(a), find(b))
                root[hi] = lo
    return {k: find(k) for k, _ in items}


def test_near_duplicates(spark):
    rows = [r for r in ROWS if r[0] is not None]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    prints = {r[0]: fingerprint(r[1]) for r in rows}
    label = grouped(prints)
    assert sorted((g.doc_id, g.fingerprint, g.component_id) for g in got) == sorted(
        (r[0], f"{prints[r[0]]:016x}", label[r[0]]) for r in rows)


def test_null_ids_share_their_group(spark):
    got = simhash.near_duplicates(docs(spark, [(None, None, None, None), (5, "", None, None), (None, "lone text", None, None)]))
    assert sorted(map(tuple, got.select("fingerprint", "component_id").collect()), key=str) == sorted(
        [("0" * 16, 5), ("0" * 16, 5), (f"{fingerprint('lone text'):016x}", None)], key=str)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def cluster_points(seed, n, flips):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    for b in base:
        for _ in range(n):
            x = b
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


@pytest.mark.parametrize("crowd", [1, 8, 1000])
@pytest.mark.parametrize("bits", [1, 2])
def test_crowded_keys_lose_no_link(spark, crowd, bits):
    points = cluster_points(crowd, 60, 5)
    df = spark.createDataFrame([(p,) for p in points], "fp bigint")
    got = {r.node: r.component for r in components(simhash.links(df, bits, crowd)).collect()}
    want = grouped({p: p & (2**64 - 1) for p in points}, bits)
    assert {p: got.get(p, p) for p in points} == want


def test_far_pairs_do_not_link(spark):
    df = spark.createDataFrame([(0,), (7,), (7 << 20,)], "fp bigint")
    assert simhash.links(df).count() == 0


def test_keep_one(spark):
    df = docs(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    prints = defaultdict(list)
    for r in ROWS:
        prints[fingerprint(r[1])].append(r[0])
    label = grouped({k: k for k in prints})
    groups = defaultdict(list)
    for fp, ids in prints.items():
        groups[label[fp]] += ids
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    n = 70
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(200, 200), (300, 301), (301, 300)], "u bigint, v bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {300: 300, 301: 300}


def plans(spark, run):
    """The plans, as they ran, of all that ``run`` executes."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def seen():
        bus.waitUntilEmpty(30_000)
        found = store.executionsList()
        return {x.executionId(): x.physicalPlanDescription() for x in map(found.apply, range(found.size()))}

    before = seen()
    run()
    return [v for k, v in seen().items() if k not in before]


@pytest.mark.parametrize("of", [simhash.near_duplicates, simhash.keep_one])
def test_no_table_is_built_in_the_driver(spark, of):
    # small tables of fingerprints, far below the broadcast threshold
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(i, f"{text} end{i % 7}", None, None) for i in range(40)] + [(100 + i, f"one text {i}", None, None) for i in range(40)]
    found = plans(spark, lambda: of(docs(spark, rows)).collect())
    assert sum("SortMergeJoin" in p for p in found) > 3
    assert not [p for p in found if "BroadcastExchange" in p]


def test_links_of_a_hot_node_are_split(spark):
    size = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    conf = {size: "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k, None) for k in conf}
    links = spark.createDataFrame([(0, i) for i in range(1, 4000)], "u bigint, v bigint")
    got = []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = plans(spark, lambda: got.extend(components(links).collect()))
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {r.node: r.component for r in got} == {i: 0 for i in range(4000)}
    assert len(got) == 4000
    assert any("SortMergeJoin(skew=true)" in p for p in found)
