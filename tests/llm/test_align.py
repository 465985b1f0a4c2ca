"""Alignment of two tokenizers against brute force over the libraries."""

import hashlib
from collections import Counter

import pyarrow as pa
from linkflow.llm import align as al

from .data import ROWS, docs, table

ODD = ["a  b", "a \n b", " lead", "trail ", "x▁y z", "a　b 　c", "\x00 \x1c q", "a\n\n\n b", "\ta b", "a   b c",
       "café \U0001f600 naïve", "a  b", "1234 56 7,8 ...", "<s> </s> <unk> <0x41>", "don't we'll"]


def libraries():
    return al.vocabularies(al.VOCAB_A, al.VOCAB_B)


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(text):
    """(n_a, n_b, n_groups, links, digest), or None without tokens."""
    v = libraries()
    if not text:
        return None
    a, b = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text)
    parts_a, parts_b = [v.bytes_a[i] for i in a], [v.bytes_b[i] for i in b]
    raw = (" " + text).encode()
    if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return None
    sa, sb = spans(parts_a), spans(parts_b)
    groups, links, i, j = [], [], 0, 0
    for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
        x, y = i, j
        while i < len(a) and sa[i][1] <= cut:
            i += 1
        while j < len(b) and sb[j][1] <= cut:
            j += 1
        groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links += [(a[p], b[q]) for p in range(x, i) for q in range(y, j) if sa[p][0] < sb[q][1] and sb[q][0] < sa[p][1]]
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(rows):
    per = [(i, brute(t)) for i, t in rows]
    count = Counter(x for _, p in per if p for x in p[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = [(i, 0, 0, 0, 0, 0, 0, "") if p is None else
           (i, p[0], p[1], p[2], len(p[3]), sum(count[x] == best[x[1]] for x in p[3]), sum(count[x] for x in p[3]), p[4])
           for i, p in per]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)), count


def test_alignment_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in ROWS] + [(100 + i, t) for i, t in enumerate(ODD)]
    want, count = expected(rows)
    frame = docs(spark, [(i, t, None, None) for i, t in rows])
    for frequent in (65_536, 5, 0):  # 0: every irregular pair comes back by the join
        got, pairs = al.alignment(frame, frequent=frequent)
        assert table(got) == want, frequent
        assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)


def test_no_rows(spark):
    got, pairs = al.alignment(docs(spark, []))
    assert got.collect() == [] and pairs.collect() == []


def test_identity_map_has_equal_bytes():
    v = libraries()
    assert v.by_words
    both = [(i, int(j)) for i, j in enumerate(v.identity) if j >= 0]
    assert len(both) > 10_000 and all(v.bytes_a[i] == v.bytes_b[j] for i, j in both)
    a = v.a.encode("<|endoftext|>", add_special_tokens=False).ids
    assert len(a) > 1  # plain text


def test_pieces_are_forgotten_and_learnt_again():
    texts = [t for _, t, *_ in ROWS if t] + ODD + [f"word{i} thing{i % 7}" for i in range(300)]
    small, large = al.Aligner(libraries(), max_pieces=40, max_held=400), al.Aligner(libraries())
    for k in range(0, len(texts), 9):
        part = pa.array(texts[k:k + 9], pa.string())
        for x, y in zip(small.documents(part), large.documents(part), strict=True):
            assert list(map(str, x)) == list(map(str, y))
    assert len(small.pieces) < len(large.pieces)
