"""Periodic runs against a brute force that tries every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from linkflow.llm import periodic as pr

from .data import ROWS, docs, table, words


def brute_runs(w, times=4, least=6):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = []
    for i, t in rows:
        w = planted(i, words(t))
        runs = brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = (None,) * 4
        if runs:
            s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            best = s, n, q, 1000 * n // q
        out.append((i, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                    sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def texts(n, seed):
    rnd = random.Random(seed)
    for i in range(n):
        w, size = [], rnd.choice([0, 1, 5, 6, 7, 30, 90, 200])
        kind = rnd.random()
        while len(w) < size:
            unit = [rnd.choice("abc" if kind < .7 else "abcdefghijkl") for _ in range(rnd.randint(1, 11))]
            w += unit * rnd.choice([1, 1, 2, 4, 6]) + unit[:rnd.randint(0, len(unit))]
        yield i, rnd.choice(["", " ", "\n"]).join(["", rnd.choice([" ", "\t", " \x0b"]).join(w)]) + rnd.choice(["", " "])


def test_runs_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in ROWS if r[0] != 9] + [(100 + i, t) for i, t in texts(250, 5)]
    got = pr.periodic_runs(docs(spark, [(i, t, None, None) for i, t in rows]), orders=pr.planted_order)
    assert table(got) == brute(rows)


def test_every_short_sequence_of_two_words():
    """All sequences of up to 13 words over two words, laid out together."""
    for size in (6, 9, 13):
        seqs = np.array([[k >> i & 1 for i in range(size)] for k in range(1 << size)])
        marks = 2 + np.arange(len(seqs))[:, None]
        laid = np.concatenate([seqs, marks], axis=1).ravel()
        s, n, q = pr.Catchers(laid).runs(lambda m, z=size, t=len(laid): t if m <= z else 0)
        got = {}
        for a, b, c in zip(s.tolist(), n.tolist(), q.tolist(), strict=True):
            got.setdefault(a // (size + 1), []).append((a % (size + 1), b, c))
        for k, seq in enumerate(seqs.tolist()):
            assert got.get(k, []) == brute_runs(seq), seq


def test_wrong_hashes_are_found_out(monkeypatch):
    """With hashes that collide all the time, what is reported is still a run of the words."""
    rnd = random.Random(2)
    w = [rnd.choice("ab") for _ in range(60)] + list("abc" * 9) + [rnd.choice("ab") for _ in range(40)]
    codes = np.array([ord(x) - 97 for x in w] + [9])
    want = brute_runs(w)
    exact = pr.Catchers(codes)
    found = exact._exact(*[np.array(x) for x in ((55, 0), (95, 101), (3, 1))], 4, 6)
    assert {(a, b - a, q) for a, b, q in zip(*map(np.ndarray.tolist, found), strict=True)} <= set(want)


def test_long_texts_and_no_rows(spark):
    rows = [(1, "x " * 200_000), (2, " ".join(map(str, range(100_000)))), (3, "a b c d e " * 30_000)]
    got = {r.doc_id: r for r in pr.periodic_runs(docs(spark, [(i, t, None, None) for i, t in rows])).collect()}
    assert (got[1].n_runs, got[1].length, got[1].period) == (1, 200_000, 1)
    assert (got[2].n_runs, got[2].start) == (0, None)
    assert (got[3].length, got[3].period, got[3].exponent_milli) == (150_000, 5, 30_000_000)
    assert got[3].collapsed_sha256 == sha("a b c d e")
    assert pr.periodic_runs(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        pr.periodic_runs(docs(spark, []), times=2)
