"""Benchmark decontamination by winnowing, with DataFrame functions alone.

A text's fingerprints are the smallest k-gram hash of every run of w k-grams, so any shared span of
k + w - 1 words shares one.  Fingerprints of documents and items are joined, and every hit is extended to
the windows around it, whose words are compared one by one.

Hashes are taken of fully lower-cased words, which is coarser than the A-Z that the comparison lowers, so
no window is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, without_keys

#: Characters that are no part of a word, before and after A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K, WINDOW = 5, 10
#: Rows of the benchmark's tables up to which they are broadcast; beyond, the same joins shuffle.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text with A-Z lowered; none for null."""
    return _split(F.translate(text, UPPER, LOWER))


def coarse_words(text: Column) -> Column:
    """The words, lower-cased in full and without regard to their neighbours."""
    return _split(F.lower(F.replace(text, F.lit("Σ"), F.lit("σ"))))


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def gram_hashes(column: str, n: int) -> Column:
    """Hash of the n words from each word on; the last n - 1 are of fewer words."""
    at = F.col(column)
    return F.transform(at, lambda x, i: F.xxhash64(F.lit(n), x, *(F.get(at, i + j) for j in range(1, n))))


def winnowed(column: str, w: int) -> Column:
    """Smallest hash of each run of w hashes; the last w - 1 runs are shorter."""
    at = F.col(column)
    return F.transform(at, lambda h, i: F.least(h, *(F.get(at, i + j) for j in range(1, w))))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows: fp, o (words before the fingerprint), words, items."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("e"), coarse_words(F.col(text_col)).alias("c"))
    long = items.where(F.size("e") >= WINDOW).withColumn("g", gram_hashes("c", K)).select("item", "e", "g", F.explode(F.sequence(F.lit(0), F.size("e") - WINDOW)).alias("s"))
    inside = F.slice(F.col("g"), F.col("s") + 1, F.lit(WINDOW - K + 1))
    long = long.select("item", F.slice("e", F.col("s") + 1, F.lit(WINDOW)).alias("words"), inside.alias("g")).withColumn("fp", F.array_min("g"))
    long = long.select("item", "words", "fp", (F.array_position("g", F.col("fp")) - 1).cast("int").alias("o"))
    short = items.where((F.size("e") > 0) & (F.size("e") < WINDOW))
    whole = F.coalesce(*(F.when(F.size("c") == n, F.xxhash64(F.lit(n), *(F.get("c", F.lit(j)) for j in range(n)))) for n in range(1, WINDOW)))
    short = short.select("item", F.col("e").alias("words"), whole.alias("fp"), F.lit(0).alias("o"))
    return long.unionByName(short).groupBy("fp", "o", "words").agg(F.collect_set("item").alias("items"))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def find_windows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Columns doc_id, k, start, length, items: every place in a document's words where a benchmark window occurs.

    k is the text's hash; equal rows of `docs` give one set of places.
    """
    windows = checkpointed(benchmark_windows(benchmark, item_col, item_text_col))
    shape = windows.agg(F.count("*").alias("n"), F.collect_set(F.when(F.size("words") < WINDOW, F.size("words"))).alias("short")).first()
    n, short = shape["n"], sorted(shape["short"])
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k"), F.col(text_col).alias("text"))

    # First pass: hashes alone leave the scan.
    hashed = keyed.select("doc_id", "k", coarse_words(F.col("text")).alias("c")).withColumn("g", gram_hashes("c", K))
    prints = F.array_distinct(F.concat(winnowed("g", WINDOW - K + 1), *(gram_hashes("c", m) for m in short)))
    found = hashed.select("doc_id", "k", F.explode(prints).alias("fp")).join(_sized(windows.select("fp").distinct(), n), "fp", "left_semi")
    hit = found.groupBy(F.col("doc_id").alias("d"), F.col("k").alias("t")).agg(F.collect_set("fp").alias("fps"))

    # Second pass: texts with a hit; the fifteen words around each hit leave the scan.
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("t"))
    texts = keyed.join(hit.hint("shuffle_hash"), same).select("doc_id", "k", "fps", words(F.col("text")).alias("e"), coarse_words(F.col("text")).alias("c"))
    grams = {K: gram_hashes("c", K)} | {m: gram_hashes("c", m) for m in short}
    places = F.concat(*(F.filter(F.transform(g, lambda h, i: F.struct(i.alias("p"), h.alias("fp"))), lambda s: F.array_contains(F.col("fps"), s["fp"])) for g in grams.values()))
    around = texts.select("doc_id", "k", "e", F.explode(F.array_distinct(places)).alias("at"))
    first = F.greatest(F.col("at.p") - (WINDOW - K), F.lit(0))
    around = around.select("doc_id", "k", "at.p", "at.fp", first.alias("a"), F.slice("e", first + 1, F.lit(2 * WINDOW - K)).alias("near"))
    start = F.col("p") - F.col("o")
    at = F.when(start >= F.col("a"), start - F.col("a") + 1)
    matched = around.join(_sized(windows, n), "fp").where(F.slice("near", at, F.size("words")) == F.col("words"))
    return matched.select("doc_id", "k", start.cast("long").alias("start"), F.size("words").cast("long").alias("length"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of `docs`.

    Words are runs of letters, digits and non-ASCII characters with A-Z lowered.  A window is 10 consecutive words of
    an item, or all words of a shorter one; an item without words has none.  n_hit counts words inside any occurrence
    of a window, n_items the item ids with one.  Null and empty texts have no words; null item ids hit words but are
    not listed; repeated items count once; repeated rows and null ids are rows like any other.
    """
    found = find_windows(docs, benchmark, id_col, text_col, item_col, item_text_col)
    spans = found.groupBy("doc_id", "k").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    spans = spans.select(F.col("doc_id").alias("d"), F.col("k").alias("t"), covered.cast("long").alias("n_hit"), "items")
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("k"), F.size(_split(text)).cast("long").alias("n_words"))
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("t")), "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, in which no benchmark window occurs; the rules are those of :func:`contamination`.

    Null, empty and blank texts stay, null ids and repeated rows are judged by their texts, texts are read whole at any
    length, an empty table stays empty and an empty benchmark removes nothing; columns may have any names.
    """
    found = find_windows(docs, benchmark, id_col, text_col, item_col, item_text_col).select(F.col("doc_id").alias("d"), F.col("k").alias("t")).distinct()
    return without_keys(docs, found, id_col, text_col)
