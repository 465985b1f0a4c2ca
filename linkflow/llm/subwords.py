"""Batch encoding of whole texts to subword ids inside Arrow functions.

The vocabulary file is a parameter: an absolute path, or the name of a file
that the installed ``public_tokenizers`` package finds on each executor.
``.json`` files are read by tokenizers, ``.model`` files by sentencepiece.

Two routes give the same ids as one call of the library per text:

* by words, for a vocabulary that drops white space and never joins characters
  across it.  A batch is cut at white space, its *distinct* words are cut into
  pre-tokens by Arrow's functions, each distinct pre-token is encoded once, and
  the texts' ids are gathered from the words' ids.
* by pieces, for all others.  A long text is cut between a letter, one space
  and a letter, and the pieces are encoded in batches of bounded bytes.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text encoded at a time, and of a piece of a long text.
BATCH_BYTES = 2 << 20
PIECE_BYTES = 64 << 10

# The pre-token pattern of the vocabularies that the route by
# words serves, and the same pattern over PLAIN's lower-case characters.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "a-zß-öø-ÿ"
PLAIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+"
#: Words of these characters have one composed form and context-free case.
PLAIN = r"[!-~À-ÖØ-öø-ÿ]+"


def vocab_file(vocab: str) -> str:
    """Path of a vocabulary given by path or by its public name."""
    if os.path.sep in vocab:
        return vocab
    import public_tokenizers
    return public_tokenizers.path(vocab)


@functools.lru_cache(maxsize=2)
def encoder(vocab: str) -> Encoder:
    """The encoder of a vocabulary, kept for the life of the Python worker."""
    path = vocab_file(vocab)
    if path.endswith(".model"):
        return PieceModelEncoder(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return WordEncoder(path) if _drops_space(spec) else Encoder(path)


def _drops_space(spec: dict) -> bool:
    """Whether white space always ends a pre-token and leaves no id."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first = steps[0]
    norms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (first.get("type") == "Split" and first.get("invert") is True
            and first.get("behavior") == "Removed"
            and (first.get("pattern") or {}).get("Regex") == WORD_PATTERN
            and norms == ["NFC", "Replace", "Lowercase"]
            and not any(t["lstrip"] or t["rstrip"] or t["normalized"]
                        for t in spec.get("added_tokens", [])))


def by_bytes(texts: pa.Array, limit: int = BATCH_BYTES):
    """Slices of at most ``limit`` bytes of text, or of one longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield texts.slice(start)


#: Each word's place among a batch's distinct words, these, and each text's bounds in the words.
Words = tuple[np.ndarray, pa.Array, np.ndarray]


def distinct_words(texts: pa.Array) -> Words:
    """The words of a batch, A-Z lower-cased.

    The empty word stands for the ends of a text that starts or ends with
    white space; no word is empty.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    bounds = np.asarray(lists.offsets).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary, bounds - bounds[0]


class Encoder:
    """The route by pieces, over the tokenizers library."""

    #: Whether the space at a cut stays with the piece after it.
    keeps_space = True

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list[str]:
        if len(text) <= PIECE_BYTES:
            return [text]
        out, start = [], 0
        for m in re.finditer(r"(?<=[A-Za-z]) (?=[A-Za-z])", text):
            if m.start() - start >= PIECE_BYTES:
                out.append(text[start:m.start()])
                start = m.start() if self.keeps_space else m.end()
        return [*out, text[start:]]

    def ids(self, texts: pa.Array, found: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32) and each text's bounds in them; null is empty.

        ``found``: the distinct words of the texts, where they are known already.
        """
        flat, lengths = [], []
        for part in by_bytes(texts, BATCH_BYTES // 2):
            pieces = [self._pieces(t or "") for t in part.to_pylist()]
            got = iter(self._batch([p for ps in pieces for p in ps]))
            for ps in pieces:
                own = [np.asarray(next(got), dtype=np.uint32) for _ in ps]
                lengths.append(sum(map(len, own)))
                flat += own
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
        return (np.concatenate(flat) if flat else np.zeros(0, np.uint32)), bounds

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return np.diff(self.ids(texts)[1])


class PieceModelEncoder(Encoder):
    """The route by pieces, over the sentencepiece library.

    A piece after a cut starts with the word mark that the library puts
    before every text, in place of the space.
    """

    keeps_space = False

    def __init__(self, path: str):
        import sentencepiece
        self.tok = sentencepiece.SentencePieceProcessor(model_file=path)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return self.tok.encode(texts, num_threads=1)


class WordEncoder(Encoder):
    """The route by words.

    ``max_words`` bounds the pre-tokens that are remembered between batches; when
    it is reached, the memory is cleared and they are encoded again as they come.
    """

    def __init__(self, path: str, max_words: int = 400_000):
        super().__init__(path)
        self.max_words = max_words
        self.model = self.tok.model
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in printable]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._clear()

    def _clear(self) -> None:
        self.part_at: dict[str, int] = {"": 0}
        self.start = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, new: list[str], plain: list[bool]) -> None:
        """Remembers the ids of parts not seen before: plain pre-tokens and other words."""
        tokenize, raw = self.model.tokenize, self.byte_chars.get
        odd = iter(self._batch([p for p, simple in zip(new, plain, strict=True) if not simple]))
        own: list[int] = []
        ends = []
        for p, simple in zip(new, plain, strict=True):
            if not simple:
                own += next(odd)
            else:
                own += [t.id for t in tokenize(p if p.isascii() else "".join(map(raw, p.encode())))]
            ends.append(len(own))
        length = np.diff(ends, prepend=0)
        first = len(self.start)
        self.start = np.concatenate([self.start, len(self.pool) + np.array(ends, np.int64) - length])
        self.length = np.concatenate([self.length, length])
        self.pool = np.concatenate([self.pool, np.array(own, np.uint32)])
        self.part_at.update(zip(new, range(first, first + len(new)), strict=True))

    def _parts(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each part's place in the memory, and each word's bounds in the parts.

        A plain word's parts are its pre-tokens; any other word is one part.
        """
        if len(self.part_at) > self.max_words:
            self._clear()
        plain = pc.match_substring_regex(names, f"^{PLAIN}$")
        lower = pc.if_else(plain, pc.utf8_lower(names), names)
        mixed = pc.and_(plain, pc.match_substring_regex(lower, f"[^{LETTERS}]"))  # a word of letters is one pre-token
        spaced = pc.replace_substring_regex(lower.filter(mixed), f"({PLAIN_PATTERN})", r"\1 ")
        lists = pc.split_pattern(pc.replace_with_mask(lower, mixed, pc.ascii_rtrim_whitespace(spaced)), " ")
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.part_at.get, parts, itertools.repeat(-1)), np.int64, len(parts))
        unseen = np.flatnonzero(at < 0)
        if len(unseen):
            new = coded.dictionary.take(pa.array(unseen))
            first = len(self.start)
            self._learn([parts[i] for i in unseen], pc.match_substring_regex(new, f"^{PLAIN}$").to_pylist())
            at[unseen] = np.arange(first, first + len(unseen))
        bounds = np.asarray(lists.offsets).astype(np.int64)
        return at[np.asarray(coded.indices)], bounds - bounds[0]

    def _special(self, texts: pa.Array) -> np.ndarray:
        """Texts that may hold a special token; their case must stay as it is."""
        return np.asarray(pc.fill_null(pc.match_substring(texts, "<|"), False))

    def _mixed(self, texts: pa.Array, special: np.ndarray):
        """Ids of a batch in which some texts need the route by pieces."""
        mask = pa.array(special)
        f1, b1 = self.ids(texts.filter(pc.invert(mask)))
        f2, b2 = Encoder.ids(self, texts.filter(mask))
        parts, i, j = [], 0, 0
        for s in special:
            if s:
                parts.append(f2[b2[j]:b2[j + 1]])
                j += 1
            else:
                parts.append(f1[b1[i]:b1[i + 1]])
                i += 1
        bounds = np.concatenate([[0], np.cumsum(list(map(len, parts)), dtype=np.int64)]).astype(np.int64)
        return np.concatenate(parts), bounds

    def ids(self, texts: pa.Array, found: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        flats, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for part in [texts] if found else by_bytes(texts):
            special = self._special(part)
            if special.any():
                flat, bounds = self._mixed(part, special)
                lengths.append(np.diff(bounds))
            else:
                at, names, word_bounds = found or distinct_words(part)
                pieces, piece_bounds = self._parts(names)
                pool, start = _gathered(self.pool, self.start[pieces], self.length[pieces])
                start = start[piece_bounds]  # of each distinct word's ids
                flat, ends = _gathered(pool, start[at], np.diff(start)[at])
                lengths.append(np.diff(ends[word_bounds]))
            flats.append(flat)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
        return np.concatenate(flats), bounds

    def counts(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for part in by_bytes(texts):
            special = self._special(part)
            if special.any():
                out.append(np.diff(self._mixed(part, special)[1]))
            else:
                at, names, word_bounds = distinct_words(part)
                pieces, piece_bounds = self._parts(names)
                length = np.diff(_bounds(self.length[pieces])[piece_bounds])
                out.append(np.diff(_bounds(length[at])[word_bounds]))
        return np.concatenate(out)


def _bounds(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _gathered(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``pool`` one after the other, and the bounds of each."""
    bounds = _bounds(length)
    return pool[np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])], bounds
