"""Benchmark decontamination by template canonicalisation, in DataFrame expressions only.

Numbers, names (capitalised words inside a sentence) and units after a number become typed placeholders; their values
are slots. Windows of template tokens of the documents are hash-joined with those of the benchmark's items. Matches on
one diagonal (document position less item position) are one copy of the item; its slots must be consistent, each item
value always replaced by one and the same value, which tells a re-parameterised question from a chance likeness.

Windows of mostly placeholders say too little as templates, and items shorter than a window have no template window;
these are joined by their literal tokens in the same pass, so their verbatim copies are found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused
from .winnow import BASE, PRIME, gram_hashes, let

WINDOW, LEAST_WINDOWS, LEAST_LITERALS = 8, 6, 4
#: Items' windows are sent to all tasks up to this number of rows (about 100 bytes each), else joined by shuffle.
BROADCAST_ROWS = 200_000
#: Up to this number of distinct hashes of items' windows, a document's are looked up in a set of them before they become rows.
LOOKED_UP = 20_000
# Fixed values.
UNITS = "mm cm dm m km g kg mg t s ms min mins h hr hrs hour hours day days week weeks month months year years second seconds minute minutes metre metres meter meters mile miles inch inches foot feet yard yards gram grams kilogram kilograms pound pounds ounce ounces litre litres liter liters ml percent dollar dollars euro euros cent cents degree degrees watt watts volt volts kwh mph km2 m2 stunde stunden jahre tage euros heures jours ans horas dias"
NUMBER, NAME, UNIT, VALUE, JOINT = "ⓝ", "ⓐ", "ⓤ", "§", "ⓙ"
SEPARATORS = r"[^\p{L}\p{M}\p{So}§0-9]+"


def template(text: Column) -> Column:
    """The tokens of a text: lower-cased words and placeholders, each followed by § and its value.

    A number with its separators (12.5, 1,000, 7:30, 1/2) and a run of two or three names (New York) are one token each,
    so values of any length stand at the same place of the template; longer runs, as in titles, are a token a word. Documents and items are cut by this one rule, so positions agree; signs
    of the text itself that are reserved for placeholders are left out.
    """
    of = lambda kind, group: f" {kind}{VALUE}${group} "
    units = "|".join(sorted(set(UNITS.split()), key=lambda u: (-len(u), u)))
    signs = [*NUMBER + NAME + UNIT + JOINT, *(NUMBER + NAME + UNIT + JOINT).upper(), VALUE]
    # Few texts hold such signs, and to look for them costs less than to replace none.
    held = reduce(Column.__or__, [F.contains(text, F.lit(x)) for x in signs])
    clean = F.when(held, F.regexp_replace(text, f"[{''.join(signs)}]", " ")).otherwise(text)
    # Each pattern looks at the sign ahead first: at most places that fails, before anything is looked at behind.
    named = F.regexp_replace(clean, r"(?=\p{Lu})(?<=[\p{L}\p{N},;)] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", of(NAME, 1).strip())
    word = r"\p{Lu}\p{Ll}++"
    named = F.regexp_replace(named, rf"(?={NAME})(?<!{NAME}{VALUE}\p{{Lu}}\p{{Ll}}{{1,60}} )({NAME}{VALUE}{word}) {NAME}{VALUE}({word})(?: {NAME}{VALUE}({word}))?(?! {NAME})", f"$1{JOINT}$2{JOINT}$3")
    joined = F.regexp_replace(named, r"(?=[.,:/]\p{Nd})(?<=\p{Nd})[.,:/]", JOINT)
    with_units = F.regexp_replace(joined, rf"(?i)(?=\p{{Nd}})(?<![\p{{L}}\p{{Nd}}{JOINT}])([\p{{Nd}}{JOINT}]+)\s?({units})(?![\p{{L}}\p{{N}}])", of(NUMBER, 1) + of(UNIT, 2))
    numbered = F.regexp_replace(with_units, rf"(?=\p{{Nd}})(?<![{VALUE}\p{{Nd}}{JOINT}])([\p{{Nd}}{JOINT}]+)", of(NUMBER, 1))
    marked = F.when(text.rlike(r"\p{Nd}"), numbered).otherwise(named)
    # Only the first and the last token can be empty.
    cut = lambda t: F.slice(t, F.when(t[0] == "", 2).otherwise(1), F.greatest(F.lit(0), F.size(t) - F.when(t[0] == "", 1).otherwise(0) - F.when((F.size(t) > 1) & (F.element_at(t, -1) == ""), 1).otherwise(0)))
    return let(F.split(F.lower(marked), SEPARATORS), cut)


def _kind(token: Column) -> Column:
    return F.substring_index(token, VALUE, 1)


def run_hashes(h: Column, k: int) -> Column:
    """``gram_hashes`` for any ``k``."""
    m = 1 << (k.bit_length() - 1)
    if m == k:
        return gram_hashes(h, k)
    n = F.greatest(F.size(h) - (k - 1), F.lit(0))
    return F.zip_with(F.slice(gram_hashes(h, m), 1, n), F.slice(run_hashes(h, k - m), F.lit(m + 1), n), lambda a, b: (a * F.lit(pow(BASE, k - m, PRIME)) + b) % F.lit(PRIME))


def _literal(token: Column) -> Column:
    return F.substring_index(token, VALUE, -1)


def _hashed(tokens: Column, form) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(form(t)).bitwiseAND(F.lit(PRIME)))


def keys(tokens: Column, window: int, lengths: list[int]) -> Column:
    """Hashes of all template windows, then of all runs of each length of literal tokens, its length above 32 bits."""
    tagged = lambda h, k: F.transform(run_hashes(h, k), lambda x: x + F.lit(k << 32))
    literal = lambda h: F.concat(*[tagged(h, k) for k in lengths])
    template_hashes = gram_hashes(_hashed(tokens, _kind), window)
    return F.concat(template_hashes, let(_hashed(tokens, _literal), literal)) if lengths else template_hashes


def _at(place: Column, length: Column, size: Column, window: int, lengths: list[int]) -> Column:
    """The token at which the hash at ``place`` of ``keys`` starts, in a text of ``size`` tokens."""
    before = F.greatest(size - (window - 1), F.lit(0))
    start = F.lit(0)
    for k in lengths:
        start = F.when(length == k, before).otherwise(start)
        before = before + F.greatest(size - (k - 1), F.lit(0))
    return place - start


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, text, tokens, size, n``: the size in tokens and the number of windows; an item shorter than a window is one."""
    items = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    return items.withColumn("tokens", template(F.col("text"))).withColumn("size", F.size("tokens")).where("size > 0")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, at, hash, length, size, n`` for each window of each item: of its template where it has enough words
    besides placeholders, else (``length`` > 0) of its literal tokens; an item shorter than a window is one literal run.

    An item's first word may be a name where a document quotes it inside a sentence, so its first window counts both
    ways. ``n`` is the number of the item's windows.
    """
    items = _items(benchmark).withColumn("n", F.greatest(F.lit(1), F.col("size") - (window - 1)))
    long = items.where(F.col("size") >= window)
    again = long.where(r"text rlike '^\\s*\\p{Lu}\\p{Ll}'").withColumn("tokens", F.expr(f"transform(slice(tokens, 1, {window}), (t, i) -> if(i = 0, '{NAME}{VALUE}' || t, t))"))
    rows = long.unionByName(again).select("item_id", "size", "n", "tokens", F.posexplode(let(F.col("tokens"), lambda t: keys(t, window, [window]))).alias("place", "hash"), F.size("tokens").alias("held"))
    length = F.shiftright("hash", 32).cast("int")
    rows = rows.withColumn("at", _at(F.col("place"), length, F.col("held"), window, [window]))
    few = F.expr(f"size(filter(slice(tokens, at + 1, {window}), t -> contains(t, '{VALUE}')))") <= window - LEAST_LITERALS
    whole = F.coalesce(*[F.when(F.col("size") == k, let(run_hashes(_hashed(F.col("tokens"), _literal), k), lambda h: h[0]) + F.lit(k << 32)) for k in range(1, window)])
    short = items.where(F.col("size") < window).select("item_id", F.lit(0).alias("at"), whole.alias("hash"), "size", "n")
    found = rows.where(few == (length == 0)).select("item_id", "at", "hash", "size", "n").unionByName(short)
    return found.distinct().withColumn("length", length)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")


def candidates(docs: DataFrame, wanted: DataFrame, window: int, small: bool) -> DataFrame:
    """``doc_id, text_hash, item_id, diagonal, size, n`` of all matches that are long enough, slots not yet looked at."""
    lengths = sorted(r[0] for r in wanted.select("length").where("length > 0").distinct().collect())  # at most ``window`` rows
    cut = let(template(F.col("text")), lambda t: F.struct(F.size(t).alias("held"), keys(t, window, lengths).alias("hashes")))
    own = _documents(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), cut.alias("cut")).select("doc_id", "text_hash", F.col("cut.held").alias("held"), F.col("cut.hashes").alias("hashes"))
    hashes = [r[0] for r in wanted.select("hash").distinct().limit(LOOKED_UP + 1).collect()]
    if 0 < len(hashes) <= LOOKED_UP:
        # Most windows are in no item: to make a row of each costs more than all that comes before.
        hits = F.expr(f"filter(transform(hashes, (x, i) -> if(x in ({','.join(f'{h}L' for h in hashes)}), struct(i as place, x as hash), null)), y -> y is not null)")
        found = own.select("doc_id", "text_hash", "held", F.inline(hits))
    else:
        found = own.select("doc_id", "text_hash", "held", F.posexplode("hashes").alias("place", "hash"))
    items = wanted.select("hash", "length", "item_id", "at", "size", "n")
    joined = found.join(F.broadcast(items) if small else items, "hash").withColumn("pos", _at(F.col("place"), F.col("length"), F.col("held"), window, lengths))
    return joined.groupBy("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("at")).alias("diagonal"), "size", "n").agg(F.countDistinct("at").alias("n_windows"))


def enough(least: int) -> Column:
    return F.col("n_windows") >= F.least(F.lit(least), F.greatest(F.lit(1), F.ceil(F.col("n") * 0.6)))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST_WINDOWS) -> DataFrame:
    """Copies of items in documents, consistent or not: one row per (doc_id, text_hash, item_id, diagonal).

    Hashes find the copies over all documents; tokens are then compared in the documents that have one.
    """
    wanted = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    found = stored(candidates(docs, wanted, window, wanted.count() <= BROADCAST_ROWS).where(enough(least)), "leak-candidates")
    # Texts move only to their own candidates: few are sent to all tasks, beyond that both sides are shuffled.
    wanted_texts = found.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct()
    if found.count() <= BROADCAST_ROWS:
        wanted_texts = F.broadcast(wanted_texts)
    texts = _documents(docs).join(wanted_texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_h")), "left_semi").select(F.col("doc_id").alias("_d"), "text", F.xxhash64("text").alias("_h")).dropDuplicates(["_d", "_h"])
    items = _items(benchmark).select(F.col("item_id").alias("_item"), F.col("tokens").alias("item"))
    held = found.join(texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).select("doc_id", "text_hash", "item_id", "diagonal", "size", "n", template(F.col("text")).alias("tokens"))
    # A candidate's passage, of the item's length, beside the item.
    copy = held.select("doc_id", "text_hash", "item_id", "diagonal", "size", "n", F.expr("slice(tokens, greatest(diagonal, 0) + 1, greatest(0, size + least(diagonal, 0)))").alias("copy"))
    both = copy.join(items, F.col("item_id").eqNullSafe(F.col("_item"))).where(F.size("item") == F.col("size")).withColumn("item", F.expr("slice(item, greatest(-diagonal, 0) + 1, size(copy))")).withColumn("copy", F.expr("slice(copy, 1, size(item))"))
    compared = both.withColumn("pairs", F.zip_with("item", "copy", lambda i, d: F.struct(i.alias("i"), d.alias("d"), (_literal(i) == _literal(d)).alias("equal"), ((_kind(i) == _kind(d)) | (_literal(i) == _literal(d))).alias("same"))))
    few = lambda ps: F.size(F.filter(ps, lambda p: F.contains(p.i, F.lit(VALUE)))) <= window - LEAST_LITERALS
    equal = lambda ps: F.forall(ps, lambda p: p.equal)
    alike = lambda ps: (equal(ps) | (few(ps) & F.forall(ps, lambda p: p.same))).cast("int")
    windows = F.transform(F.sequence(F.lit(1), F.size("pairs") - (window - 1)), lambda i: let(F.slice("pairs", i, F.lit(window)), alike))
    whole = F.array(((F.size("pairs") == F.col("size")) & equal(F.col("pairs"))).cast("int"))
    alike_windows = F.when(F.col("size") < window, whole).when(F.size("pairs") >= window, windows).otherwise(F.array().cast("array<int>"))

    def in_windows(w: Column) -> Column:
        """The number of matching windows, and the slots of the pairs inside of them: what stands beside is another text's."""
        inside = lambda j: F.exists(F.slice(w, F.greatest(j - (window - 1), F.lit(0)) + 1, F.least(j + 1, F.lit(window))), lambda x: x == 1)
        pairs = F.filter("pairs", lambda p, j: F.contains(p.i, F.lit(VALUE)) & F.contains(p.d, F.lit(VALUE)) & inside(j))
        return F.struct(F.size(F.filter(w, lambda x: x == 1)).alias("n_windows"), F.array_distinct(F.transform(pairs, lambda p: F.struct(p.i.alias("i"), p.d.alias("d")))).alias("slots"))

    counted = compared.select("doc_id", "text_hash", "item_id", "diagonal", "n", let(alike_windows, in_windows).alias("m")).select("doc_id", "text_hash", "item_id", "diagonal", "n", "m.*")
    return counted.where(enough(least)).select("doc_id", "text_hash", "item_id", "diagonal", "n_windows", F.col("n").alias("item_windows"), F.size("slots").alias("n_slots"), F.size(F.filter("slots", lambda x: x.i != x.d)).alias("n_changed"), (F.size(F.array_distinct(F.transform("slots", lambda x: x.i))) == F.size("slots")).alias("consistent"))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST_WINDOWS) -> DataFrame:
    """``doc_id, text_hash, item_id, n_windows, item_windows, n_slots, n_changed``: documents that hold a benchmark item.

    A copy counts if its slots are consistent and it matches ``least`` windows (13 tokens in a row or more), or six
    tenths of a shorter item's windows. An item of fewer tokens than a window, even of one, counts where all its tokens
    stand literally in a row. Of several copies in a document the fullest is reported, of equals the one with
    fewest changed slots. Null and empty texts and items hold nothing; repeated rows are one; null ids, of documents and of
    items, stay. Other columns are ignored.
    """
    kept = matches(docs, benchmark, window, least).where("consistent")
    best = F.max_by(F.struct("n_windows", "item_windows", "n_slots", "n_changed"), F.struct(F.col("n_windows"), -F.col("n_changed"), -F.col("diagonal")))
    return kept.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b")).select("doc_id", "text_hash", "item_id", "b.*")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST_WINDOWS, shortest: int = 1) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns and repeated rows as they are.

    Items of fewer than ``shortest`` tokens are left out: by 1, an item of one word removes every document with that word.
    """
    if shortest > 1:
        benchmark = benchmark.where(F.size(template(F.coalesce(F.col("text").cast("string"), F.lit("")))) >= shortest)
    of, h = unused(docs, "_id"), unused(docs, "_hash")
    found = stored(leaks(docs, benchmark, window, least).select(F.col("doc_id").alias(of), F.col("text_hash").alias(h)).distinct(), "leaks")
    few = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return docs.join(few, F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(F.col("text").cast("string")) == F.col(h)), "left_anti")
