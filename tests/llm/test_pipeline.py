"""The pipeline's stages, each held against its operator's meaning, and the query registry."""

from collections import Counter, defaultdict

import corpus_pipeline
from linkflow.llm.queries import QUERIES, SQL
from tests.llm.data import ROWS, SENTENCES, docs, words
from tests.llm.test_models import corpus
from tests.llm.test_native import base_spans
from tests.llm.test_simhash import fingerprint, grouped

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    rows = [*ROWS, *corpus(60), (500, SENTENCES["en"] * 6, "en", "a")]
    df = docs(spark, rows)
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    assert len(names) == 5
    known = stages[0](spark, df, SF)
    assert known.columns == df.columns
    left = Counter((r.doc_id, r.text) for r in known.collect())
    assert left == Counter((r[0], r[1]) for r in rows if any(map(str.isalpha, r[1] or "")))

    one = stages[1](spark, known, SF)
    assert one.columns == df.columns
    prints = defaultdict(list)
    for (i, t), n in left.items():
        prints[fingerprint(t)] += [i] * n
    label = grouped({p: p for p in prints})
    groups = defaultdict(list)
    for p, ids in prints.items():
        groups[label[p]] += ids
    firsts = Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())
    assert Counter(r.doc_id for r in one.collect()) == firsts

    masked = stages[2](spark, one, SF)
    assert masked.columns == df.columns and masked.count() == sum(firsts.values())
    for r in masked.collect():
        assert r.n_chars == len(r.text) and not base_spans(r.text)

    mixed = stages[3](spark, masked, SF)
    assert mixed.columns == df.columns
    size = {r.doc_id: len(words(r.text)) for r in masked.collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(size) and max(times.values()) <= 2
    assert sum(n * size[i] for i, n in times.items()) <= 1.5 * sum(size.values()) + 1

    packed = stages[4](spark, mixed, SF).collect()
    assert Counter(p.doc_id for p in packed if p.piece == 0) == times
    for stage in stages:
        assert stage(spark, docs(spark, []), SF).count() == 0


def test_queries_are_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14)) and len(QUERIES) == 13
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(SQL) <= set(entry.oracle_sql())


def test_run_on_the_smallest_table(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ends = defaultdict(int)
    for p in sorted(rows, key=lambda p: (p.sequence_id, p.offset)):
        assert ends[p.sequence_id] == p.offset
        ends[p.sequence_id] += p.length
    assert rows and max(ends.values()) <= 2048
