"""Quality rules by distribution divergence, in DataFrame functions only.

Each language's reference is measured over all of its documents: the shares of
character classes, and the shares of its words: a bin for each of the most
frequent ones, and a bin for each band of the next ranks, doubling in width, so
that most of the running text is in a bin and a short text still fills it.  A
document's own shares are compared with every reference by Jensen-Shannon
distance (base 2, 0 to 1), and the nearest reference counts, so a label that
names another of these languages does no harm.  A histogram of too few
characters or words says little, so it is only judged from a minimum length on.

A language of few documents has no reference, and others' references say
nothing about it: its documents are not judged by distance.  Documents without
a label can be in any language, so their words are not judged either; their
characters are, unless their script is in no reference.

Two base rules come first: too few words, and too many words in repeated
three-word windows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import let, saved, words

# Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: White space between words, inside a character class.
WORD_GAP_CHARS = r" \t-\r"
#: Punctuation of running text; a class of its own.
MARKS = ".,;:!?'\"()-"


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict."""

    min_words: int = 50            # base rule: fewer words fail
    max_repeat_percent: int = 50   # base rule: more words in repeated windows fail
    top_words: int = 32            # words per reference with a bin of their own
    band_words: int = 8192         # words per reference, those in bands of ranks included
    chars_from: int = 200          # characters from which the class histogram is judged
    words_from: int = 100          # words from which the word histogram is judged
    max_chars: float = 0.28        # largest class distance that is kept
    max_words: float = 0.45        # largest word distance that is kept
    reference_docs: int = 20       # documents that a language needs for a reference,
    reference_words: int = 1000    # and words


def _count(text: Column, chars: str) -> Column:
    """Number of a text's characters that are among some."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))


#: Lower-case letters, upper-case letters, other letters and marks, digits,
#: white space, punctuation, symbols, all others.
N_CLASSES = 8


def class_counts(text: Column, gaps: Column | None = None) -> Column:
    """Array of the numbers of a text's characters by class; ``gaps``: of white space, if known.

    Most characters are a-z and white space: these go first, and the other classes
    are counted in what is left.
    """
    gaps = _count(text, WORD_GAP_CHARS) if gaps is None else gaps

    def counted(rest: Column) -> Column:
        return F.array(F.length(text) - F.length(rest) - gaps + _count(rest, r"\p{Ll}"), _count(rest, r"\p{Lu}"),
                       _count(rest, r"\p{Lt}\p{Lm}\p{Lo}\p{M}"), _count(rest, r"\p{Nd}"),
                       gaps, _count(rest, re.escape(MARKS)), _count(rest, re.escape(SYMBOLS)))

    known = let(F.regexp_replace(text, f"[a-z{WORD_GAP_CHARS}]+", ""), counted)
    return let(known, lambda k: F.concat(
        F.transform(k, lambda x: x.cast("bigint")),
        F.array(F.aggregate(k, F.length(text).cast("bigint"), lambda a, x: a - x))))


def n_repeat_words(w: Column) -> Column:
    """Words of the array inside three-word windows that occur twice or more.

    Windows are compared by 64-bit hash.  Texts without a repeated one are
    told by a hash set; in the others the windows are sorted with their
    positions, so that equal ones stand side by side.
    """
    positions = F.sequence(F.lit(0), F.size(w) - 3)
    marks = F.transform(positions, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def count(h: Column) -> Column:
        paired = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def beside(s: Column) -> Column:
            equal = lambda x, j: F.coalesce(F.get(s, j).getField("h") == x.getField("h"), F.lit(False))
            twice = F.filter(s, lambda x, i: equal(x, i - 1) | equal(x, i + 1))
            at = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            return F.size(F.array_distinct(at))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(paired, beside))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(marks, count))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_columns(text: Column, w: Column) -> list[Column]:
    """The base figures of a non-null text with the words ``w``."""
    return [F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _count(text, re.escape(SYMBOLS)).cast("bigint").alias("n_symbols"),
            n_dup_lines(text).cast("bigint").alias("n_dup_lines"),
            n_repeat_words(w).cast("bigint").alias("n_repeat_words")]


def _frequent(df: DataFrame, lang: Column, text: Column, enough: list[str], limits: Limits) -> dict[str, list]:
    """Per language the (word, count) of its most frequent words, by count and then word.

    The words of every count above the one at which ``band_words`` would be
    passed, so at most that many; which count that is follows from the number
    of words of each count, and no task sees a whole vocabulary.
    """
    counted = saved(df.select(lang, F.explode(words(F.lower(text))).alias("w")).filter(F.col("lang__").isin(enough))
                    .groupBy("lang__", "w").agg(F.count(F.lit(1)).alias("k")), "rules-words")
    held: dict[str, list] = {}
    for r in counted.groupBy("lang__", "k").agg(F.count(F.lit(1)).alias("n")).collect():
        held.setdefault(r["lang__"], []).append((r["k"], r["n"]))
    chosen = F.lit(False)
    for k, rows in held.items():
        least, n = 0, 0
        for count, more in sorted(rows, reverse=True):
            n += more
            if n > limits.band_words:
                least = count
                break
        chosen = chosen | ((F.col("lang__") == k) & (F.col("k") > least))
    found: dict[str, list] = {}
    for r in counted.filter(chosen).collect():
        found.setdefault(r["lang__"], []).append((r["w"], r["k"]))
    return {k: sorted(v, key=lambda x: (-x[1], x[0])) for k, v in found.items()}


def figures(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(id, k1, k2, lang__, base figures, c) of every row, written once.

    ``k1``, ``k2``: the row by its id and a hash of its text; ``c``: its class histogram.
    """
    base = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text__"),
                     F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang__"))
    text = F.col("text__")
    measured = let(words(text), lambda w: F.struct(*base_columns(text, w)))
    rows = base.select(id_col, *_row_key(id_col, text), "lang__", "text__", measured.alias("m__"))
    gaps = F.length("text__") - F.col("m__.word_chars").cast("int")
    return saved(rows.select(id_col, "k1", "k2", "lang__", "m__.*", class_counts(F.col("text__"), gaps).alias("c")),
                 "rules-rows")


def _row_key(id_col: str, text: Column) -> list[Column]:
    """A row's id, and a hash that tells the texts of an id (64 bits where there is no id)."""
    k = F.col(id_col)
    return [k.alias("k1"), F.when(k.isNull(), F.xxhash64(text)).otherwise(F.hash(text)).alias("k2")]


def references(df: DataFrame, text_col: str, lang_col: str, limits: Limits, rows: DataFrame | None = None) -> list[dict]:
    """Per language: class shares, the shares of its common words, and its bands of the next ones.

    Measured over all documents (``rows``: their figures, if they are there
    already).  A language with too few documents or words has none, so that a
    rare or wrong label is not its own measure; if there is no label at all, all
    documents make one.  One row per language and ``band_words`` words for each
    reach the driver: languages are codes, a bounded set.  Words are
    pre-aggregated in the scan's tasks.
    """
    if rows is None:
        rows = figures(df, text_col, text_col, lang_col)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang__")
    text = F.coalesce(F.col(text_col), F.lit(""))
    totals = [F.count(F.lit(1)), F.sum("n_words"), *[F.sum(F.col("c")[i]) for i in range(N_CLASSES)]]
    sums = {r[0]: list(r)[1:] for r in rows.groupBy("lang__").agg(*totals).collect()}
    enough = sorted(k for k, v in sums.items()
                    if k and v[0] >= limits.reference_docs and v[1] >= limits.reference_words)
    if set(sums) == {""} and sums[""][1]:
        enough = [""]
    found = _frequent(df, lang, text, enough, limits) if enough else {}
    out = []
    for k in enough:
        _, n, *chars = sums[k]
        frequent = found.get(k, [])
        top, rest = frequent[:limits.top_words], frequent[limits.top_words:]
        # bands of top_words, twice as many, and so on
        bands = {w: ((i // limits.top_words) + 1).bit_length() - 1 for i, (w, _) in enumerate(rest)}
        masses = [0.0] * (max(bands.values(), default=-1) + 1)
        for w, m in rest:
            masses[bands[w]] += m / n
        out.append(telling({"lang": k, "classes": [c / sum(chars) for c in chars],
                            "words": {w: m / n for w, m in sorted(top)}, "bands": bands, "masses": masses}, limits))
    return out


def telling(ref: dict, limits: Limits) -> dict:
    """``ref``, without its words if a text with none of them would be within the limit.

    That is so where words hardly repeat, as in scripts without spaces: word
    shares tell nothing there.
    """
    q = max(0.0, 1.0 - sum(ref["words"].values()) - sum(ref["masses"]))
    m = (1 + q) / 2
    twice = (1 - q) - math.log2(m) + (q * math.log2(q / m) if q > 0 else 0.0)
    return ref if math.sqrt(twice / 2) > limits.max_words else ref | {"words": {}, "bands": {}, "masses": []}


def _term(p: Column, q: Column) -> Column:
    """A bin's part of twice the Jensen-Shannon divergence."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _distance(twice_divergence: Column) -> Column:
    return F.sqrt(F.greatest(twice_divergence / 2, F.lit(0.0)))


def class_distance(counts: Column, refs: list[dict]) -> Column:
    """Distance of a class histogram to the nearest reference; null for no character."""
    def nearest(p: Column) -> Column:
        own = [sum((_term(p[i], F.lit(r["classes"][i])) for i in range(N_CLASSES)), F.lit(0.0)) for r in refs]
        return _distance(F.least(*own) if len(own) > 1 else own[0])

    def measure(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
        return let(total, lambda n: F.when(n > 0, let(F.transform(c, lambda x: x / n), nearest)))

    return let(counts, measure)


def script_known(counts: Column, refs: list[dict]) -> Column:
    """Whether a reference has mostly letters without case, or the class histogram has not."""
    caseless = lambda c: 2 * c[2] > c[0] + c[1] + c[2]
    return F.lit(True) if any(caseless(r["classes"]) for r in refs) else ~caseless(counts)


def _bins(ref: dict) -> tuple[dict[str, int], list[float]]:
    """A reference's word bins: the bin of each word, and the share of each bin."""
    own = {w: i for i, w in enumerate(ref["words"])}
    return (own | {w: len(own) + i for w, i in ref.get("bands", {}).items()},
            [*ref["words"].values(), *ref.get("masses", [])])


def _word_divergence(doc: Column, shares: list[float]) -> Column:
    """Twice the divergence of a document's (b, p) entries from the shares of a reference's bins."""
    mass = min(1.0, sum(shares))
    known = F.array(*map(F.lit, shares))
    met = F.transform(doc, lambda x: F.struct(x["p"].alias("p"), F.get(known, x["b"]).alias("q")))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("t", "p", "q")])
    sums = F.aggregate(met, zero, lambda a, x: F.struct(
        (a["t"] + _term(x["p"], x["q"])).alias("t"), (a["p"] + x["p"]).alias("p"), (a["q"] + x["q"]).alias("q")))
    # bins of the reference that the document lacks, then all other words
    return let(sums, lambda z: z["t"] + F.greatest(F.lit(mass) - z["q"], F.lit(0.0))
               + _term(F.greatest(1 - z["p"], F.lit(0.0)), F.lit(1.0 - mass)))


#: Stands before the words of each row, so that rows equal in id and text are told.
ROW, ROW_BIN = "\n", -1


def binned_words(texts: DataFrame, refs: list[dict]) -> DataFrame:
    """(k1, k2, bins, rows) of texts (k1, k2, text__): how often they have words of which bins.

    The references' words are a table of at most ``band_words`` rows for each,
    which every task holds; the bins of a reference are numbered from where those
    of the one before end.  Words are counted in the scan's tasks, so a text sends
    on a row per bin.
    """
    table, begin = [(ROW, ROW_BIN)], 0
    for bins, shares in map(_bins, refs):
        table += [(w, begin + b) for w, b in bins.items()]
        begin += len(shares)
    known = F.broadcast(texts.sparkSession.createDataFrame(table, "w string, bin int"))
    each = texts.select("k1", "k2", F.explode(F.concat(F.array(F.lit(ROW)), words(F.lower("text__")))).alias("w"))
    counted = each.join(known, "w").groupBy("k1", "k2", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("k1", "k2").agg(
        F.collect_list(F.when(F.col("bin") != ROW_BIN, F.struct("bin", "n"))).alias("bins"),
        F.max(F.when(F.col("bin") == ROW_BIN, F.col("n"))).alias("rows"))


def word_distance(bins: Column, n_words: Column, refs: list[dict]) -> Column:
    """Distance of a word histogram (``bin``, ``n`` of ``n_words``) to the nearest reference.

    A reference's bins are its common words, its bands and one for all others.
    """
    def divergence(doc: Column, begin: int, shares: list[float]) -> Column:
        own = F.filter(doc, lambda x: (x["b"] >= begin) & (x["b"] < begin + len(shares)))
        moved = F.transform(own, lambda x: F.struct((x["b"] - begin).alias("b"), x["p"].alias("p")))
        return let(moved, lambda d: _word_divergence(d, shares))

    def nearest(doc: Column) -> Column:
        each, begin = [], 0
        for _, shares in map(_bins, refs):
            each.append(divergence(doc, begin, shares))
            begin += len(shares)
        return _distance(F.least(*each) if len(each) > 1 else each[0])

    return let(F.transform(bins, lambda x: F.struct(x["bin"].alias("b"), (x["n"] / n_words).alias("p"))), nearest)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept) of every row.

    ``kept``: no base rule fails and each distance that judges the document is
    within its limit.  A distance is null where it does not: the text is too
    short, its language has no reference, or the language is null or empty and
    the reference says nothing about it (``word_distance``; ``class_distance``
    for a script that no reference has).

    Null and empty texts have no words and fail.  Null or repeated ids and repeated
    rows give a row each.  An empty table gives no rows.  Other columns are
    not read, so their names cannot clash.
    """
    rows = figures(df, id_col, text_col, lang_col)
    refs = references(df, text_col, lang_col, limits, rows)
    telling_words = [r for r in refs if r["words"]]
    lang, judged = F.col("lang__"), F.col("n_words") >= limits.words_from
    own = lang.isin([r["lang"] for r in refs]) if refs else F.lit(False)
    none = F.lit(None).cast("double")
    out = rows.withColumn("class_distance", F.when(
        (F.col("word_chars") + F.col("c")[4] >= limits.chars_from)
        & (own | ((lang == "") & script_known(F.col("c"), refs))), class_distance(F.col("c"), refs)) if refs else none)
    if telling_words:
        text = F.coalesce(F.col(text_col), F.lit("")).alias("text__")
        of_own = df.filter(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).isin([r["lang"] for r in refs]))
        texts = of_own.select(F.col(id_col), text).select(*_row_key(id_col, F.col("text__")), "text__")
        binned = binned_words(texts, telling_words).withColumnsRenamed({"k1": "of1", "k2": "of2"})
        out = out.join(binned, F.col("k1").eqNullSafe(F.col("of1")) & (F.col("k2") == F.col("of2")), "left") \
            .withColumn("word_distance", F.when(own & judged, word_distance(
                F.col("bins"), F.col("n_words") * F.col("rows"), telling_words)))
    else:
        out = out.withColumn("word_distance", none)
    out = out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "word_distance",
                     "class_distance")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    usual = (F.coalesce(F.col("class_distance") <= limits.max_chars, F.lit(True))
             & F.coalesce(F.col("word_distance") <= limits.max_words, F.lit(True)))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & usual)
