"""Document fingerprints by winnowing, in DataFrame expressions only.

A text's words are hashed; hashes of k-grams of words come from those of half their length by a polynomial modulo a
prime, H(2m, i) = H(m, i) * B^m + H(m, i + m). From each window of w neighbouring k-grams the least hash is taken, of
equal ones the rightmost, with its position. Any passage of w + k - 1 words that two texts share gives them a common
fingerprint; no passage shorter than k words does. A word is up to 16 letters, marks and digits in a row, or one letter
of a script that is written without spaces, so that such texts have words too, wherever a passage starts.

A hash and its position are one long: the hash (below 2^31) above, 2^32 - 1 - position below, so that the least long is
the least hash, of equal ones the rightmost.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

K, W = 4, 4
# Scripts written without spaces.
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in "Han Hiragana Katakana Thai Lao Khmer Myanmar".split())
TOKENS = rf"[{UNSPACED}&&[\p{{L}}\p{{M}}\p{{N}}]]|[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]{{1,16}}"
#: All letters of these scripts come after U+0E00; texts without such signs take a shorter pattern to the same words.
LATER, SPACED = r"[\x{0E00}-\x{10FFFF}]", r"[\p{L}\p{M}\p{N}]{1,16}"
PRIME, BASE, HALF = (1 << 31) - 1, 1_000_003, 1 << 32


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _halves(h: Column, m: int, f) -> Column:
    """``f(h[i], h[i + m])`` for every i that has both."""
    n = F.greatest(F.size(h) - m, F.lit(0))
    return F.zip_with(F.slice(h, 1, n), F.slice(h, F.lit(m + 1), n), f)


def gram_hashes(h: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` (a power of 2) neighbouring items, from the items' hashes below 2^31."""
    doubled = lambda m: lambda x: _halves(x, m, lambda a, b: (a * F.lit(pow(BASE, m, PRIME)) + b) % F.lit(PRIME))
    m = 1
    while m < k:
        h = let(h, doubled(m))
        m *= 2
    return h


def window_minima(h: Column, w: int) -> Column:
    """Least items of all windows of ``w`` (a power of 2) neighbours; one window over all where there are fewer."""

    doubled = lambda m: lambda y: _halves(y, m, lambda a, b: F.least(a, b))

    def all_windows(x: Column) -> Column:
        m = 1
        while m < w:
            x = let(x, doubled(m))
            m *= 2
        return x

    return let(h, lambda x: F.when(F.size(x) < w, F.filter(F.array(F.array_min(x)), lambda y: y.isNotNull())).otherwise(all_windows(x)))


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """Fingerprints of a text as packed longs in order of position. A text of fewer than ``k`` words is one gram, its whole
    string; an empty or null one has none."""
    small = lambda c: F.xxhash64(c).bitwiseAND(F.lit(PRIME))
    packed = lambda g: F.transform(g, lambda x, i: x * F.lit(HALF) + (F.lit(HALF - 1) - i))
    short = F.array(small(text) * F.lit(HALF) + F.lit(HALF - 1))
    tokens = F.when(text.rlike(LATER), F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))).otherwise(F.regexp_extract_all(text, F.lit(SPACED), F.lit(0)))
    of = let(tokens, lambda t: F.when(F.size(t) < k, short).otherwise(F.array_distinct(window_minima(packed(gram_hashes(F.transform(t, small), k)), w))))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<bigint>")).otherwise(of)


def hashes(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda x: F.shiftright(x, 32)))


def as_text(prints: Column) -> Column:
    """``hash@position`` of each fingerprint, comma-joined."""
    return F.array_join(F.transform(prints, lambda x: F.concat(F.shiftright(x, 32), F.lit("@"), F.lit(HALF - 1) - x.bitwiseAND(F.lit(HALF - 1)))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two hash sets; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return let(shared, lambda s: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(s / (F.size(a) + F.size(b) - s)))


def _above(bounds: Column) -> Column:
    """How many of the bounds are greater than doc_id: the number of its range, counted from the highest ids."""
    return F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))


def _in_ranges(docs: DataFrame, rows_per_part: int) -> DataFrame:
    """``docs`` with ``part``, a range of ids of about ``rows_per_part`` rows, numbered by descending id; null ids come last.

    Ranges are cut at quantiles of the ids, and each again at its own, into 1,000 times 1,000 at most (beyond that many,
    ranges hold more rows). Only the first level's bounds reach the driver; the second level is written, because
    approximate quantiles that are computed again may differ.
    """
    parts = max(1, -(-docs.count() // rows_per_part))
    coarse = min(1000, math.isqrt(parts - 1) + 1)
    fine = min(1000, -(-parts // coarse))
    quantiles = lambda n: F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n) if n > 1 else F.array().cast("array<bigint>")
    first = sorted(set(docs.agg(quantiles(coarse)).first()[0] or []))
    numbered = docs.withColumn("coarse", F.when(F.col("doc_id").isNull(), F.lit(len(first) + 1)).otherwise(_above(F.array(*map(F.lit, first)).cast("array<bigint>"))))
    second = stored(numbered.select("coarse", "doc_id").groupBy("coarse").agg(F.array_distinct(quantiles(fine)).alias("cuts")), "ranges")
    part = F.col("coarse") * 1000 + F.coalesce(_above(F.col("cuts")), F.lit(0))
    return numbered.join(F.broadcast(second), "coarse").withColumn("part", F.when(F.col("doc_id").isNull(), F.col("coarse") * 1000).otherwise(part)).drop("coarse", "cuts")


def with_next(docs: DataFrame, rows_per_part: int = 1_000) -> DataFrame:
    """``docs (doc_id, text)`` with ``next``, the text of the following row by descending (doc_id, text); after the last, the first.

    Each range of ids is one window, and a copy of the next range's first row stands at a range's end.
    """
    keyed = _in_ranges(docs, rows_per_part).select("doc_id", "text", "part")
    # One row a range, a million at most, is put in order and broadcast.
    heads = keyed.groupBy("part").agg(F.max("doc_id").alias("head"))
    at = heads.selectExpr("head", "coalesce(lag(part) over (order by part), max(part) over ()) as part")
    ends = docs.join(F.broadcast(at), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("doc_id", "part").agg(F.max("text").alias("text")).withColumn("end", F.lit(True))
    rows = keyed.withColumn("end", F.lit(False)).unionByName(ends)
    order = "order by end, doc_id desc nulls last, text desc nulls last"
    return rows.withColumn("next", F.expr(f"lead(text) over (partition by part {order})")).where("not end").drop("part", "end")


def fingerprints_and_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """For every row of ``docs (doc_id, text)``: doc_id, n_chars, text, edited, prints, edited_prints, near_edited, near_next.

    The edited text is the text with its last floor(n / 3) characters replaced by the first as many of the next
    document, by descending doc_id. Null texts are empty; two texts without fingerprints are alike (1). Repeated ids are
    ordered by text. A single document is its own next one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The next document's fingerprints are computed again here: they are larger to shuffle than its text.
    paired = with_next(rows).withColumn("prints", fingerprint(F.col("text"), k, w)).withColumn("next_prints", fingerprint(F.col("next"), k, w))
    third = "cast(floor(length(text) / 3) as int)"
    edited = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.expr(f"concat(substring(text, 1, length(text) - {third}), substring(next, 1, {third}))"))
    edited = edited.withColumn("edited_prints", fingerprint(F.col("edited"), k, w))
    own, changed, following = hashes(F.col("prints")), hashes(F.col("edited_prints")), hashes(F.col("next_prints"))
    return edited.withColumn("near_edited", let(own, lambda a: let(changed, lambda b: likeness(a, b)))).withColumn("near_next", let(own, lambda a: let(following, lambda b: likeness(a, b)))).select("doc_id", "n_chars", "text", "edited", "prints", "edited_prints", "near_edited", "near_next")
