"""Secret scans by a randomness test battery, in DataFrame functions only.

Fixed patterns give the base spans (assigned secrets, access keys, long hex).
The method adds tokens that look like drawn at random from an encoding's
alphabet.  The smallest of four alphabets that holds a token's characters is
its encoding, and three tests of "uniform and independent" give p-values:

* chi-squared of the character counts against a uniform alphabet,
* runs above and below the middle of the alphabet,
* serial correlation of neighbouring characters.

Fisher's sum combines them to one p-value per token.  Text fails the tests
(p near 0), random tokens have p evenly spread over 0 to 1.  How well the two
separate depends on the length, so false discoveries are controlled per
encoding and length class, over all tokens of the corpus: the number of random
tokens is estimated from the upper quarter of p, where others hardly come, and a
class reports the tokens above the smallest cut at which the share of others among
them is at most ``max_false``.  The estimate is the upper end of its confidence
interval: a class must show others before it keeps tokens back, so a token alone in
its class is judged by its own p, and a class of many tokens by their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import fresh, let, saved

# The kinds of spans in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encoding, the tokens that it holds, and its alphabet in order.  A token has
#: the first that fits; hex digits and base 32 are compared in one case.
ENCODINGS = (("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGIT + "abcdef"),
             ("base32", r"^[A-Z2-7]+$", _LOWER + "234567"),
             ("base62", r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGIT),
             ("base64", r"^[A-Za-z0-9+/_-]+$", _UPPER + _LOWER + _DIGIT + "+/"))


@dataclass(frozen=True)
class Battery:
    """Parameters of the method."""

    min_length: int = 20      # shorter tokens are too short for the tests
    max_false: float = 0.1    # share of other tokens among the reported ones
    upper: float = 0.75       # p from which the number of random tokens is estimated
    cuts: tuple[float, ...] = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.4, 0.5)


def spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (start, kind, end, found) of the matches that pass ``keep``.

    Matches are leftmost and do not overlap; a match that fails ``keep`` still
    takes its characters.  Offsets are code points.  The text between matches
    and the matches alternate, so their lengths sum to the places; sums are
    taken in blocks, so that many matches in one text stay affordable.
    """
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,found:string>>")

    def located(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        return let(pieces, lambda p: _located(p, found, kind))

    got = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return F.when(text.rlike(pattern), F.filter(got, keep)).otherwise(none)


_BLOCK = 128


def _located(pieces: Column, found: Column, kind: int) -> Column:
    steps = F.transform(found, lambda f, i: (F.length(F.get(pieces, i)) + F.length(f)).cast("bigint"))

    def place(s: Column) -> Column:
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)
        blocks = F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: total(F.slice(s, b * _BLOCK + 1, F.lit(_BLOCK))))

        def with_sums(per_block: Column) -> Column:
            heads = F.transform(per_block, lambda x, b: total(F.slice(per_block, F.lit(1), b)))
            return let(heads, with_heads)

        def with_heads(head: Column) -> Column:
            def one(f: Column, i: Column) -> Column:
                b = F.floor(i / _BLOCK).cast("int")
                before = F.get(head, b) + total(F.slice(s, b * _BLOCK + 1, i - b * _BLOCK))
                start = before + F.length(F.get(pieces, i))
                return F.struct(start.alias("start"), F.lit(kind).alias("kind"),
                                (start + F.length(f)).alias("end"), f.alias("found"))
            return F.transform(found, one)

        return let(sums, with_sums)

    return let(steps, place)


def base_spans(text: Column) -> Column:
    """The base spans of a non-null text, by start and then kind."""
    # of an assignment, what follows the mark and an opening quote
    value = lambda x: F.regexp_extract(x["found"], ASSIGN, 2)
    assign = spans(text, ASSIGN, 0, lambda x: F.length(value(x)) >= ASSIGN_MIN)
    access = spans(text, ACCESS, 1, lambda x: F.length(x["found"]) >= ACCESS_MIN)
    # runs are maximal, so the shorter ones can be left out by the pattern
    hexes = spans(text, f"(?<![0-9a-f])[0-9a-f]{{{HEX_MIN},}}", 2, lambda x: F.lit(True))
    bare = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    return F.sort_array(F.transform(F.concat(assign, access, hexes), bare))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by the polynomial of Abramowitz and Stegun, 26.2.17."""
    def tail(a: Column) -> Column:
        t = 1 / (1 + 0.2316419 * a)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return let(F.abs(z), lambda a: F.when(z >= 0, tail(a)).otherwise(1 - tail(a)))


def _uniformity(counts: Column, n: Column, k: int) -> Column:
    """p of chi-squared against a uniform alphabet of ``k``, by the Wilson-Hilferty cube root."""
    squares = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    chi2, df = squares * k / n - n, k - 1
    z = (F.pow(F.greatest(chi2, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    return let(z, _upper_tail)


def _runs(codes: Column, n: Column, k: int) -> Column:
    """p of the number of runs above and below the middle of the alphabet."""
    high = lambda x: (x >= k // 2).cast("int")

    def measure(c: Column) -> Column:
        n1 = c["up"].cast("double")
        mean = 2 * n1 * (n - n1) / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        z = (1 + c["turns"] - mean) / F.sqrt(var)
        return F.when(var > 0, let(z, lambda v: 2 * _upper_tail(F.abs(v)))).otherwise(F.lit(0.0))

    zero = F.struct(F.lit(0).alias("up"), F.lit(0).alias("turns"), F.lit(-1).alias("last"))
    seen = F.aggregate(codes, zero, lambda a, x: F.struct(
        (a["up"] + high(x)).alias("up"),
        (a["turns"] + ((a["last"] >= 0) & (a["last"] != high(x))).cast("int")).alias("turns"), high(x).alias("last")))
    return let(seen, measure)


def _serial(codes: Column, n: Column) -> Column:
    """p of the correlation of each character with the next."""
    def measure(s: Column) -> Column:
        mean = s["x"] / n
        var = s["xx"] / n - mean * mean
        r = (s["xy"] / (n - 1) - mean * mean) / var
        z = (r + 1 / n) * F.sqrt(n)
        return F.when(var > 0, let(z, lambda v: 2 * _upper_tail(F.abs(v)))).otherwise(F.lit(0.0))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("x", "xx", "xy", "last")])
    sums = F.aggregate(codes, zero, lambda a, x: F.struct(
        (a["x"] + x).alias("x"), (a["xx"] + x * x).alias("xx"), (a["xy"] + a["last"] * x).alias("xy"),
        x.cast("double").alias("last")))
    return let(sums, measure)


def random_p(token: Column, encoding: int) -> Column:
    """Combined p-value that the token is random in the encoding; padding is left out."""
    name, _, alphabet = ENCODINGS[encoding]
    k = len(alphabet)
    plain = F.translate(token, "-_", "+/") if name == "base64" else token
    plain = F.lower(plain) if name in ("hex", "base32") else plain
    letters = F.array(*[F.lit(c) for c in alphabet])

    def tests(t: Column) -> Column:
        n = F.length(t).cast("double")
        counts = F.transform(letters, lambda c: F.length(t) - F.length(F.replace(t, c, F.lit(""))))
        codes = F.transform(F.split(t, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)

        def battery(x: Column) -> Column:
            floor = lambda p: -2 * F.log(F.greatest(p, F.lit(1e-300)))
            fisher = floor(_uniformity(counts, n, k)) + floor(_runs(x, n, k)) + floor(_serial(x, n))
            return let(fisher / 2, lambda h: F.exp(-h) * (1 + h + h * h / 2))

        return let(codes, battery)

    return let(plain, tests)


def candidates(text: Column, battery: Battery) -> Column:
    """Array of (start, end, encoding, size, p) of the tokens that the tests judge.

    ``size``: the length class, the binary logarithm of the length.
    """
    char = r"[A-Za-z0-9+/_-]"
    found = spans(text, f"(?<!{char}){char}{{{battery.min_length},}}+={{0,2}}", 3, lambda x: F.lit(True))

    def judged(x: Column) -> Column:
        token = F.rtrim(x["found"], F.lit("="))

        def with_token(t: Column) -> Column:
            enc, p = F.lit(None).cast("int"), F.lit(0.0)
            for i, (_, holds, _) in reversed(list(enumerate(ENCODINGS))):
                enc = F.when(t.rlike(holds), F.lit(i)).otherwise(enc)
                p = F.when(t.rlike(holds), random_p(t, i)).otherwise(p)
            # tokens of digits alone are numbers, whatever the tests say
            p = F.when(t.rlike("^[0-9]+$"), F.lit(0.0)).otherwise(p)
            return F.struct(x["start"].alias("start"), x["end"].alias("end"), enc.alias("encoding"),
                            F.floor(F.log2(F.length(t))).cast("int").alias("size"), p.alias("p"))

        return let(token, with_token)

    return F.transform(found, judged)


def _most(n: int) -> float:
    """Upper end of the 95 % interval of a Poisson mean of which ``n`` were counted."""
    return n + 1.92 + 1.96 * (n + 0.96) ** 0.5


def cuts(tested: DataFrame, battery: Battery) -> dict[tuple[int, int], float]:
    """The p above which a token is reported, by (encoding, length class).

    ``tested``: the tokens of the whole corpus.  At most 4 x 31 classes with
    one count per cut reach the driver.
    """
    at_least = [F.count_if(F.col("p") > c).alias(f"n{i}") for i, c in enumerate([*battery.cuts, battery.upper])]
    rows = tested.groupBy("encoding", "size").agg(*at_least).collect()
    out = {}
    for r in rows:
        *counts, high = [r[f"n{i}"] for i in range(len(battery.cuts) + 1)]
        random = _most(high) / (1 - battery.upper)
        for cut, n in zip(battery.cuts, counts, strict=True):
            if n and 1 - random * (1 - cut) / n <= battery.max_false:
                out[r["encoding"], r["size"]] = cut
                break
    return out


def reported(tokens: Column, base: Column, limits: dict[tuple[int, int], float]) -> Column:
    """The base spans and the random tokens apart from them, by start and then kind."""
    if not limits:
        return base
    cut = F.create_map(*[F.lit(v) for (e, n), c in sorted(limits.items()) for v in (100 * e + n, c)])
    apart = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    chosen = F.filter(tokens, lambda x: (x["p"] > F.coalesce(
        F.element_at(cut, 100 * x["encoding"] + x["size"]), F.lit(2.0))) & apart(x))
    added = F.transform(chosen, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"),
                                                   x["end"].alias("end")))
    return F.sort_array(F.concat(base, added))


def _listed(found: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         battery: Battery = Battery()) -> DataFrame:  # noqa: B008
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row.

    ``spans``: kind:start:end of all spans by start and then kind, in code
    points, the end exclusive; ``base_sha256``: the digest of the base spans in
    that form.

    Null and empty texts have no span; very long texts are scanned whole.  Null or
    repeated ids and repeated rows give a row each.  An empty table gives no rows.
    Other columns are not read, so their names cannot clash.  The texts are scanned once: the spans
    are written to the shared scratch folder before the cuts are known.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = saved(df.select(F.col(id_col).alias("id__"), base_spans(text).alias("base"),
                            candidates(text, battery).alias("tokens")), "secret-spans")
    limits = cuts(found.select(F.explode("tokens").alias("t")).select("t.*"), battery)
    base = F.col("base")
    count = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("bigint")
    out = found.withColumn("all", reported(F.col("tokens"), base, limits))
    return out.select(
        F.col("id__").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), (F.size("all") - F.size("base")).cast("bigint").alias("n_random"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"))


def redact(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]",
           battery: Battery = Battery()) -> DataFrame:  # noqa: B008
    """``df`` with the spans that ``scan`` reports replaced by ``mask`` in the text.

    Spans that overlap become one mask.  All rows and columns stay, ``text`` is
    the only column that changes, and a null text stays null.
    """
    spans_of, tokens, text = fresh(df, "spans__"), fresh(df, "tokens__"), F.col(text_col)
    known = F.coalesce(text, F.lit(""))
    # the battery runs once: the texts go with its tokens to the shared scratch folder
    tested = saved(df.withColumn(tokens, candidates(known, battery)), "secret-tokens")
    limits = cuts(tested.select(F.explode(tokens).alias("t")).select("t.*"), battery)
    found = let(base_spans(known), lambda b: reported(F.col(tokens), b, limits))
    marked = tested.withColumn(spans_of, F.when(text.isNotNull(), found))

    zero = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("bigint").alias("at"))

    def step(a: Column, x: Column) -> Column:
        between = F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int"))
        return F.when(x["start"] >= a["at"], F.struct(
            F.concat(a["parts"], F.array(between, F.lit(mask))).alias("parts"), x["end"].alias("at"))
        ).otherwise(F.struct(a["parts"].alias("parts"), F.greatest(a["at"], x["end"]).alias("at")))

    joined = F.aggregate(F.col(spans_of), zero, step, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    masked = F.when(F.size(spans_of) > 0, joined).otherwise(text)
    return marked.withColumn(text_col, masked).select(*df.columns)
