"""Quality rules and secret scans against plain Python."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkflow.llm import rules, secret_scan
from tests.llm.data import ROWS, SENTENCES, docs, words


def base_figures(text):
    text, w = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_rules_base(spark):
    got = rules.quality_rules(docs(spark)).collect()
    figures = [(g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) for g in got]
    want = []
    for r in ROWS:
        f = base_figures(r[1])
        want.append((r[0], *f, f[0] < 50 or 100 * f[4] > 50 * f[0]))
    assert sorted(figures, key=str) == sorted(want, key=str)
    assert not any(g.kept for g in got if g.base_failed)
    assert rules.quality_rules(docs(spark, [])).count() == 0
    assert [r.kept for r in rules.quality_rules(docs(spark, [(1, None, None, None)])).collect()] == [False]


def _varied(rng, n):
    pool = [w.strip(".,") for s in SENTENCES.values() for w in s.split()]
    return " ".join(rng.choice(pool) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def test_quality_rules_drop_odd_distributions(spark):
    rng = random.Random(3)
    rows = [(i, _varied(rng, 150), "en", "a") for i in range(60)]
    rows += [(100, " ".join(w + "###" for w in _varied(rng, 150).split()), "en", "a"),
             (101, _varied(rng, 150).upper(), None, "a"),
             (102, " ".join("".join(rng.choices(string.ascii_letters, k=7)) for _ in range(150)), "en", "a")]
    kept = {r.doc_id: r.kept for r in rules.quality_rules(docs(spark, rows)).collect()}
    assert [kept[i] for i in (100, 101, 102)] == [False] * 3
    assert all(kept[i] for i in range(60))


def _whole_vocabulary(rng, n):
    """Text over 20,000 words whose frequencies fall as 1 / (rank + 10)."""
    ranks = rng.choices(range(20_000), cum_weights=_whole_vocabulary.steps, k=n)
    return " ".join(_spelled(r) for r in ranks)


_whole_vocabulary.steps = [math.log((r + 11) / 10) for r in range(20_000)]


def _spelled(rank):
    """A lower-case word of its own for each rank; rarer ones are longer."""
    out = "aeiou"[rank % 5]
    while rank:
        rank, r = divmod(rank, 19)
        out += "bcdfghjklmnpqrstvwx"[r] + "aeiou"[r % 5]
    return out


def test_text_without_a_known_word_is_dropped(spark):
    """Also where the vocabulary is large, and its common words are a small part of the text."""
    rng = random.Random(4)
    rows = [(i, _whole_vocabulary(rng, 300), "en", "a") for i in range(400)]
    odd = range(1000, 1010)
    rows += [(i, " ".join("z" + "".join(rng.choices(string.ascii_lowercase, k=7)) for _ in range(300)), "en", "a")
             for i in odd]
    got = {r.doc_id: r for r in rules.quality_rules(docs(spark, rows)).collect()}
    assert not any(got[i].kept for i in odd)
    assert all(got[i].kept for i in range(400))


@pytest.mark.parametrize("n", [1, 19, 20])
def test_rare_languages_are_kept_at_every_count(spark, n):
    """Clean text of a language with few documents, or without a label, is not held to other languages."""
    rng = random.Random(7)
    arabic = lambda: " ".join("".join(chr(0x627 + r) for r in rng.choices(range(20), k=5))
                              for _ in range(12)) + " "
    finnish = [_spelled(r) for r in range(5000, 5040)]
    rows = [(i, _varied(rng, 150), "en", "a") for i in range(60)]
    pool = arabic().split()
    rows += [(100 + i, " ".join(rng.choices(pool, k=120)), "ar", "a") for i in range(n)]
    rows += [(200 + i, " ".join(rng.choices(finnish, k=120)), "fi", "a") for i in range(n)]
    rows += [(300, " ".join(rng.choices(pool, k=120)), None, "a"), (301, " ".join(rng.choices(finnish, k=120)), "", "a"),
             (302, _varied(rng, 150).upper(), None, "a")]
    got = {r.doc_id: r for r in rules.quality_rules(docs(spark, rows)).collect()}
    assert all(got[i].kept for i in got if i != 302) and not got[302].kept
    assert [got[100].class_distance is None, got[200].word_distance is None] == [n < 20] * 2


def test_words_in_bands_of_ranks(spark):
    """Distance with bands equals that of the bins counted in Python, for words of every length."""
    rng = random.Random(6)
    texts = [_whole_vocabulary(rng, 200) for _ in range(40)]
    limits = rules.Limits()
    df = docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    (ref,) = rules.references(df, "text", "lang", limits)
    count = Counter(w for t in texts for w in t.split())
    order = sorted(count, key=lambda w: (-count[w], w))
    assert set(ref["words"]) == set(order[:32])
    edges = [32, 64, 128, 256, 512, 1024, 2048, 4096, 8192]
    bin_of = {w: i if i < 32 else 32 + next(j for j, e in enumerate(edges[1:]) if i < e) for i, w in
              enumerate(order) if w in ref["words"] or w in ref["bands"]}
    assert max(map(len, ref["bands"])) > 5
    total = sum(count.values())
    q, p = Counter(), Counter()
    for w, k in count.items():
        q[bin_of.get(w, -1)] += k / total
    for w in texts[0].split():
        p[bin_of.get(w, -1)] += 1 / 200
    m = {b: (p[b] + q[b]) / 2 for b in p.keys() | q.keys()}
    want = math.sqrt(sum(x[b] * math.log2(x[b] / m[b]) for x in (p, q) for b in m if x[b]) / 2)
    got = next(r for r in rules.quality_rules(df).collect() if r.doc_id == 0)
    assert got.word_distance == pytest.approx(want)


def test_jensen_shannon_distance(spark):
    refs = [{"lang": "x", "classes": [0.5, 0.5, 0, 0, 0, 0, 0, 0], "words": {"a": 0.25, "b": 0.25}}]
    text = spark.createDataFrame([(1, 2, "A a c d")], "k1 bigint, k2 int, text__ string")
    one = rules.binned_words(text, refs).select(
        rules.class_distance(F.array(*[F.lit(v).cast("bigint") for v in (3, 0, 1, 0, 0, 0, 0, 0)]), refs).alias("c"),
        rules.word_distance(F.col("bins"), 4 * F.col("rows"), refs).alias("w")).first()

    def js(p, q):
        m = [(x + y) / 2 for x, y in zip(p, q, strict=True)]
        part = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x)
        return math.sqrt((part(p) + part(q)) / 2)

    assert one.c == pytest.approx(js([0.75, 0, 0.25], [0.5, 0.5, 0]))
    assert one.w == pytest.approx(js([0.5, 0, 0.5], [0.25, 0.25, 0.5]))


def test_class_counts(spark):
    text = "AbéÉ 日1\t.,#|~\n"
    row = spark.createDataFrame([(text,)], "t string").select(rules.class_counts(F.col("t")).alias("c")).first()
    assert row.c == [2, 2, 1, 1, 3, 2, 2, 1]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


MANY = "é\U0001f600 " + " ".join(f"token{'=' if i % 3 else ':'}val{i:05d} {'ab' * 12}" for i in range(400))


def test_secret_scan_base(spark):
    rows = [*ROWS, (20, MANY, "en", "a"), (21, "token=token:abcdefgh password: x secret='a.b-c_d='", "en", "a")]
    got = secret_scan.scan(docs(spark, rows)).collect()
    want = []
    for r in rows:
        s = base_spans(r[1])
        n = Counter(k for _, k, _ in s)
        want.append((r[0], n[0], n[1], n[2], hashlib.sha256(listed(s).encode()).hexdigest()))
    assert sorted([(g.doc_id, g.n_assign, g.n_access, g.n_hex, g.base_sha256) for g in got], key=str) == sorted(want, key=str)
    for g in got:
        spans = [s.split(":") for s in g.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (int(s[1]), secret_scan.KINDS.index(s[0])))
    assert secret_scan.scan(docs(spark, [])).count() == 0


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(5)
    alphabet = string.ascii_letters + string.digits
    secrets = {i: "".join(rng.choices(alphabet, k=rng.choice([32, 40, 60]))) for i in range(80)}
    rows = [(i, f"see é {s} end", "en", "a") for i, s in secrets.items()]
    plain = ["thisisalongwordofmanyletters" * 2, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "some/path/to/a/file/in/the/tree",
             "UPPER_CASE_CONSTANT_NAME_HERE", "abcdefghijklmnopqrstuvwxyz", "0" * 40, "12345678901234567890123"]
    rows += [(100 + i, f"a {t} b", "en", "a") for i, t in enumerate(plain * 3)]
    got = {r.doc_id: r for r in secret_scan.scan(docs(spark, rows)).collect()}
    found = [i for i in secrets if f"random:6:{6 + len(secrets[i])}" in got[i].spans]
    assert len(found) >= 0.9 * len(secrets)
    assert [got[i].n_random for i in got if i >= 100] == [0] * (3 * len(plain))


def test_a_secret_alone_in_its_class_is_found(spark):
    """One secret per encoding and length class, with prose around it, over ten seeds."""
    alphabets = [string.digits + "abcdef", string.ascii_uppercase + "234567", string.ascii_letters + string.digits,
                 string.ascii_letters + string.digits + "+/"]
    lengths = [24, 40, 80, 160, 320]
    found = Counter()
    for seed in range(10):
        rng = random.Random(100 + seed)
        secrets = {(a, n): "".join(rng.choices(alphabets[a], k=n)) for a in range(4) for n in lengths}
        rows = [(100 * a + n, f"see {t} end", "en", "a") for (a, n), t in secrets.items()]
        rows += [(5000 + i, SENTENCES["en"] * 3, "en", "a") for i in range(5)]
        got = {r.doc_id: r for r in secret_scan.scan(docs(spark, rows, clash=False)).collect()}
        found.update(k for k, t in secrets.items() if f":4:{4 + len(t)}" in got[100 * k[0] + k[1]].spans)
        assert not any(got[5000 + i].n_random for i in range(5))
    assert len(found) == 20 and min(found.values()) >= 9, found


def test_classes_of_others_are_kept_back(spark):
    """Many tokens that are not random, wherever their p lies below the upper quarter, pass no cut."""
    rng = random.Random(8)
    rows = [(0, 5, 0.3)]  # alone
    rows += [(1, 5, rng.random()) for _ in range(2000)]  # random
    rows += [(2, 5, rng.uniform(0.5, 0.7)) for _ in range(2000)] + [(2, 6, rng.uniform(0, 0.4)) for _ in range(2000)]
    rows += [(3, 5, rng.random()) for _ in range(500)] + [(3, 5, rng.uniform(0, 0.05)) for _ in range(5000)]
    battery = secret_scan.Battery()
    got = secret_scan.cuts(spark.createDataFrame(rows, "encoding int, size int, p double"), battery)
    assert got[0, 5] == got[1, 5] == battery.cuts[0]
    assert (2, 5) not in got and (2, 6) not in got
    others = sum(1 for e, _, p in rows[-5000:] if p > got[3, 5])
    mine = sum(1 for e, _, p in rows[-5500:-5000] if p > got[3, 5])
    assert others <= battery.max_false * (others + mine) * 1.5 and mine > 300


def test_p_values(spark):
    """Random tokens have p spread evenly; the normal tail is right."""
    zs = spark.createDataFrame([(-2.0,), (0.0,), (1.0,), (3.0,)], "z double")
    tail = [r[0] for r in zs.select(secret_scan._upper_tail(F.col("z"))).collect()]
    assert tail == pytest.approx([0.5 * math.erfc(z / math.sqrt(2)) for z in (-2, 0, 1, 3)], abs=1e-6)
    rng = random.Random(1)
    tokens = spark.createDataFrame([("".join(rng.choices("0123456789abcdef", k=64)),) for _ in range(400)], "t string")
    p = [r[0] for r in tokens.select(secret_scan.random_p(F.col("t"), 0)).collect()]
    assert 0.4 < sum(p) / len(p) < 0.6


def test_redact(spark):
    df = docs(spark)
    got = secret_scan.redact(df)
    assert got.columns == df.columns
    texts = Counter((r.doc_id, r.text) for r in got.collect())
    want = Counter()
    for r in ROWS:
        out, at = [], 0
        for a, _, b in base_spans(r[1]):
            if a >= at:
                out += [r[1][at:a], "[SECRET]"]
            at = max(at, b)
        want[r[0], r[1] if r[1] is None else "".join(out) + r[1][at:]] += 1
    assert texts == want
