"""Alignment of the tokens of two tokenizers, with an identity map for the plain case.

A text is encoded by tokenizer A and by tokenizer B.  Where a token of either
ends at the same byte the text is cut into groups; tokens whose bytes overlap are
linked.  Links of an id pair are counted over the corpus.

* ``identity``: for each A id the B id of the same bytes, or -1.  A group of one
  A token and the B token of the map is the plain case: its links are counted in
  a vector as long as A's vocabulary.  Each task adds up one such vector, so what
  the plain groups send on is bounded by the vocabulary.
* Only links of other (irregular) groups enter the shuffle of pairs, summed per
  document and per task before it.
* Counts come back in the same two ways: the vector, each B id's highest count
  (as long as B's vocabulary) and the ``frequent`` most frequent irregular pairs
  go to the tasks; the rarer pairs of a document are joined to their counts.  No
  rare pair holds more than 1 / ``frequent`` of the links, so no join key is hot.

Texts are cut before each space that a visible character follows, where neither
tokenizer joins; each distinct word of a batch is encoded and aligned once.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import saved
from linkflow.llm.subwords import by_bytes, vocab_file

VOCAB_A, VOCAB_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: A space that white space or nothing follows: such a text is encoded whole.
LOOSE_SPACE = " ([ \t-\r\x1c-\x1f\x85\xa0  -     　]|$)"

#: The word mark of sentencepiece.
MARK = "▁"


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the identity map."""

    def __init__(self, vocab_a: str, vocab_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocab_file(vocab_a))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocab_file(vocab_b))
        ids = self.a.get_vocab(with_added_tokens=True)
        never = b"\xff"  # of ids that stand for no bytes; occurs in no text
        self.bytes_a: list[bytes] = [never] * (max(ids.values()) + 1)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        for token, i in ids.items():
            if all(c in byte_of for c in token):
                self.bytes_a[i] = bytes(byte_of[c] for c in token)
        b = self.b
        self.bytes_b = [never if b.is_control(i) or b.is_unknown(i) else bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                        else b.id_to_piece(i).replace(MARK, " ").encode() for i in range(b.get_piece_size())]
        # words stand alone in B if no piece has a mark behind another character
        self.by_words = not any(MARK in b.id_to_piece(i).lstrip(MARK) for i in range(b.get_piece_size()))
        at = {}
        for i in sorted(range(len(self.bytes_b)), key=b.is_byte):  # a piece before a byte
            at.setdefault(self.bytes_b[i], i)
        self.identity = np.array([-1 if x == never else at.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), np.int64)
        number = [b"%d" % i for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.pool = [x + end for end in (b",", b"|", b";") for x in number]  # an id and what follows it
        self.n_numbers = len(number)

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A's ids of a space and each piece, and B's of each piece."""
        return ([e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)],
                self.b.encode(pieces, num_threads=1))


@functools.lru_cache(maxsize=1)
def vocabularies(vocab_a: str, vocab_b: str) -> Vocabularies:
    return Vocabularies(vocab_a, vocab_b)


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The positions of stretches, given by begin and length, one after the other."""
    stop = np.cumsum(n)
    return np.repeat(begin - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)


class Aligner:
    """Alignments of pieces of text, each kept for the next batches.

    When ``max_pieces`` or ``max_held`` characters are kept, the pieces that only
    one batch had go, and of the others the less used.
    """

    def __init__(self, v: Vocabularies, max_pieces: int = 150_000, max_held: int = 8 << 20):
        self.v, self.max_pieces, self.max_held = v, max_pieces, max_held
        self._keep(np.zeros(0, np.int64), first=True)

    def _keep(self, some: np.ndarray, first: bool = False) -> None:
        """Forgets all pieces but some."""
        if first:
            self.pieces: list[str] = []
            self.text: list[bytes] = []              # groups, as written in the digest
            self.sizes = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups (0: not aligned), links
            self.begin = np.zeros(0, np.int64)       # of a piece's links in ``links``
            self.links = np.zeros(0, np.int64)       # a * |B| + b; by the identity map: -1 less that
            self.uses = np.zeros(0, np.int64)
        self.links = self.links[spread(self.begin[some], self.sizes[some, 3])]
        self.sizes, self.uses = self.sizes[some], self.uses[some] // 2
        self.begin = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        self.pieces, self.text = [self.pieces[i] for i in some], [self.text[i] for i in some]
        self.at = {p: i for i, p in enumerate(self.pieces)}
        self.held = sum(map(len, self.pieces))  # characters

    def _shrink(self) -> None:
        often = np.flatnonzero(self.uses > 1)
        often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:self.max_pieces // 2]])
        room = np.cumsum([len(self.pieces[i]) for i in often]) <= self.max_held // 2
        self._keep(often[room] if len(often) else often)

    def places(self, pieces: list[str]) -> np.ndarray:
        """The place of each (distinct) piece; pieces not seen before are aligned."""
        at = np.fromiter((self.at.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.text) + np.arange(len(new))
            self._learn([pieces[i] for i in new])
        self.uses[at] += 1
        return at

    def _fine(self, pieces, a_ids, b_ids) -> list[int]:
        """The pieces that both tokenizers give back byte by byte."""
        v = self.v
        raw = [b" " + p.encode() for p in pieces]
        return [i for i, (p, a, b) in enumerate(zip(raw, a_ids, b_ids, strict=True))
                if len(p) > 1 and b"".join([v.bytes_a[x] for x in a]) == p and b"".join([v.bytes_b[x] for x in b]) == p]

    def _learn(self, pieces: list[str]) -> None:
        v = self.v
        first = len(self.text)
        a_ids, b_ids = v.encode(pieces)
        good = self._fine(pieces, a_ids, b_ids)
        sizes = np.zeros((len(pieces), 4), np.int64)
        text, begin = [b""] * len(pieces), np.full(len(pieces), len(self.links), np.int64)
        if good:
            a_ids, b_ids = [a_ids[i] for i in good], [b_ids[i] for i in good]
            n_a, n_b = np.array(list(map(len, a_ids))), np.array(list(map(len, b_ids)))
            a = np.fromiter(itertools.chain.from_iterable(a_ids), np.int64, int(n_a.sum()))
            b = np.fromiter(itertools.chain.from_iterable(b_ids), np.int64, int(n_b.sum()))
            end_a, end_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
            # a link is a stretch between neighbouring ends of tokens of either kind
            ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
            ends = ends[np.concatenate([[True], np.diff(ends) > 0])]
            of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
            cut = (end_a[of_a] == ends) & (end_b[of_b] == ends)
            lone = cut & np.concatenate([[True], cut[:-1]])  # a group of one link: one token on either side
            plain = lone & (v.identity[a[of_a]] == b[of_b])
            link = a[of_a] * len(v.bytes_b) + b[of_b]
            bound = np.concatenate([[0], np.searchsorted(ends, end_a[np.cumsum(n_a) - 1]) + 1])
            cuts = np.concatenate([[0], np.cumsum(cut)])
            sizes[good] = np.column_stack([n_a, n_b, np.diff(cuts[bound]), np.diff(bound)])
            begin[good] = len(self.links) + bound[:-1]
            self.links = np.concatenate([self.links, np.where(plain, -link - 1, link)])
            for i, t in zip(good, self._written(a, b, end_a, end_b, ends[cut], np.diff(cuts[bound])), strict=True):
                text[i] = t
        self.held += sum(map(len, pieces))
        self.at.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.pieces += pieces
        self.text += text
        self.sizes = np.concatenate([self.sizes, sizes])
        self.begin = np.concatenate([self.begin, begin])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def _written(self, a, b, end_a, end_b, cuts, n_groups) -> list[bytes]:
        """The groups of each piece in the form of the digest."""
        v = self.v
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        last_a = np.concatenate([np.diff(group_a) > 0, [True]])
        last_b = np.concatenate([np.diff(group_b) > 0, [True]])
        code = np.concatenate([a + v.n_numbers * last_a, b + 2 * v.n_numbers * last_b])
        group = np.concatenate([group_a, group_b])
        order = np.lexsort((np.arange(len(code)), group))  # within a group A's tokens, then B's
        said = list(map(v.pool.__getitem__, code[order].tolist()))
        ends = np.cumsum(np.bincount(group, minlength=len(cuts)))[np.cumsum(n_groups) - 1].tolist()
        return [b"".join(said[x:y])[:-1] for x, y in zip([0, *ends[:-1]], ends, strict=True)]

    def documents(self, texts: pa.Array):
        """(sizes, digests, bounds of the links, links) of a batch of texts.

        Links are sorted and distinct within a document; the last item has how
        often each occurs.
        """
        if len(self.at) > self.max_pieces or self.held > self.max_held:
            self._shrink()
        texts = pc.fill_null(texts, "")
        whole = np.asarray(pc.match_substring_regex(texts, LOOSE_SPACE)) | np.asarray(pc.starts_with(texts, " "))
        if not self.v.by_words:
            whole[:] = True
        lists = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        coded = lists.flatten().dictionary_encode()
        place = self.places(coded.dictionary.to_pylist())[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64)
        loose = texts.filter(pa.array(whole)).to_pylist()
        known = dict(zip(seen := list(dict.fromkeys(loose)), self.places(seen).tolist(), strict=True))
        n_pieces = np.ones(len(texts), np.int64)
        n_pieces[~whole] = np.diff(np.asarray(lists.offsets))
        ends = np.cumsum(n_pieces)
        piece = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        of_whole = np.repeat(whole, n_pieces)
        piece[of_whole] = [known[t] for t in loose]
        piece[~of_whole] = place
        doc = np.repeat(np.arange(len(texts)), n_pieces)
        bad = np.zeros(len(texts), bool)
        bad[doc[self.sizes[piece, 2] == 0]] = True
        sizes = np.zeros((len(texts), 4), np.int64)
        for k in range(4):
            sizes[:, k] = np.bincount(doc, self.sizes[piece, k], len(texts)).astype(np.int64)
        sizes[bad] = 0
        begins, said = (ends - n_pieces).tolist(), piece.tolist()
        digests = ["" if x else hashlib.sha256(b";".join(map(self.text.__getitem__, said[s:e]))).hexdigest()
                   for x, s, e in zip(bad.tolist(), begins, ends.tolist(), strict=True)]
        n = np.where(bad[doc], 0, self.sizes[piece, 3])
        link, owner = self.links[spread(self.begin[piece], n)], np.repeat(doc, n)
        half = len(self.v.bytes_a) * len(self.v.bytes_b) + 1
        key, times = np.unique(owner * (2 * half) + link + half, return_counts=True)
        bounds = np.searchsorted(key, np.arange(len(texts) + 1) * (2 * half))
        return sizes, digests, bounds, key % (2 * half) - half, times


def _aligned(rows: DataFrame, id_col: str, vocab_a: str, vocab_b: str) -> DataFrame:
    """Per row: sizes, digest, and its distinct links with their numbers."""
    kind = rows.schema[id_col].dataType.simpleString()
    names = ["row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "times"]
    schema = (f"row bigint, `{id_col}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, links array<bigint>, times array<bigint>")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies(vocab_a, vocab_b))
        for batch in batches:
            done = 0
            for part in by_bytes(batch.column(2)):
                sizes, digests, bounds, links, times = aligner.documents(part)
                edge = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, len(part)), batch.column(1).slice(done, len(part)),
                    *(pa.array(sizes[:, k]) for k in range(4)), pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(edge, pa.array(links)), pa.ListArray.from_arrays(edge, pa.array(times)),
                ], names)
                done += len(part)

    return rows.mapInArrow(align, schema)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).flatten()).astype(np.int64)


def pair_counts(aligned: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """(pair, n, plain) of all id pairs of the corpus; ``plain``: some links are by the identity map."""

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pair = np.zeros(n_a, np.int64), np.full(n_a, -1, np.int64)
        for batch in batches:
            link, times = _flat(batch, "links"), _flat(batch, "times")
            plain = link < 0
            a = (-link[plain] - 1) // n_b
            pair[a] = -link[plain] - 1
            np.add.at(total, a, times[plain])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair[some]), pa.array(total[some])], ["pair", "n"])

    arrays = aligned.select("links", "times")
    plain = arrays.mapInArrow(vector, "pair bigint, n bigint").withColumn("plain", F.lit(True))
    odd = arrays.select(F.explode(F.arrays_zip("links", "times")).alias("x")).filter("x.links >= 0") \
        .select(F.col("x.links").alias("pair"), F.col("x.times").alias("n"), F.lit(False).alias("plain"))
    return plain.unionByName(odd).groupBy("pair").agg(F.sum("n").alias("n"), F.bool_or("plain").alias("plain"))


def alignment(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_a: str = VOCAB_A,
              vocab_b: str = VOCAB_B, frequent: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): the alignment of each row, and the id pairs of the corpus.

    ``documents``: id, n_a, n_b, n_groups, n_links, n_best (links whose pair has
    the highest count of its B id, ties included), count_sum (of the links'
    counts), groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).  ``pairs``: a, b, n.

    Null and empty texts, and texts that either tokenizer does not give back byte
    by byte, have no tokens: zeros and ''.  Very long texts are aligned whole.
    Null or repeated ids and repeated rows are rows of their own and all count.
    An empty table gives no rows.  Other columns are not read, so their names
    cannot clash.
    """
    v = vocabularies(vocab_a, vocab_b)
    n_a, n_b = len(v.bytes_a), len(v.bytes_b)
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col).alias("text__"))
    aligned = saved(_aligned(rows, id_col, vocab_a, vocab_b), "align-documents")  # fixes the row numbers
    pairs = saved(pair_counts(aligned, n_a, n_b), "align-pairs")

    # at most a number per id of either vocabulary, and ``frequent`` pairs, come to the driver
    plain, best = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    for r in pairs.filter("plain").collect():
        plain[r.pair // n_b] = r.n
    for r in pairs.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("n")).collect():
        best[r.b] = r.n
    odd = pairs.filter("NOT plain").orderBy(F.desc("n"), "pair").limit(frequent).select("pair", "n").collect()
    often = np.array(sorted((r.pair, r.n) for r in odd) or np.zeros((0, 2)), np.int64).reshape(-1, 2)
    identity = v.identity
    names = ["row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link, times = _flat(batch, "links"), _flat(batch, "times")
            bounds = np.asarray(batch.column("links").offsets).astype(np.int64)
            bounds = bounds - bounds[0]
            pair = np.where(link < 0, -link - 1, link)
            at = np.minimum(np.searchsorted(often[:, 0], pair), max(len(often) - 1, 0))
            met = often[at, 0] == pair if len(often) else np.zeros(len(pair), bool)
            mapped = (identity[pair // n_b] == pair % n_b) & (plain[pair // n_b] > 0)
            n = np.where(mapped, plain[pair // n_b], often[at, 1] if len(often) else 0)
            known = met | mapped
            sums = np.concatenate([[0], np.cumsum(np.where(known, times * n, 0))])
            tops = np.concatenate([[0], np.cumsum(np.where(known & (n == best[pair % n_b]), times, 0))])
            rest = np.concatenate([[0], np.cumsum(~known)])
            edge = pa.array(rest[bounds], pa.int32())
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names),
                pa.array(np.diff(tops[bounds])), pa.array(np.diff(sums[bounds])),
                pa.ListArray.from_arrays(edge, pa.array(pair[~known])),
                pa.ListArray.from_arrays(edge, pa.array(times[~known]))], [*names, "tops", "sums", "pairs", "times"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", tops bigint, sums bigint, pairs array<bigint>, times array<bigint>"
    part = saved(aligned.mapInArrow(counted, schema), "align-counted")
    rare = part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("row", F.col("x.pairs").alias("pair"), "x.times")
    highest = pairs.select("pair", "n").join(
        pairs.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("highest")),
        F.col("pair") % n_b == F.col("b"))
    more = rare.join(highest, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_tops"),
        F.sum(F.col("times") * F.col("n")).alias("more_sums"))
    docs = part.join(more, "row", "left").select(
        F.col(id_col), "n_a", "n_b", "n_groups", "n_links",
        (F.col("tops") + F.coalesce("more_tops", F.lit(0))).alias("n_best"),
        (F.col("sums") + F.coalesce("more_sums", F.lit(0))).alias("count_sum"), "groups_sha256")
    named = pairs.select(F.floor(F.col("pair") / n_b).alias("a"), (F.col("pair") % n_b).alias("b"), "n")
    return docs, named
