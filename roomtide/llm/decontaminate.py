"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is 10 consecutive words of an item; an item of fewer words, but not none, is one window. An
occurrence must hold every word of its window, so the prefix of the filter is a single token: the
window's rarest word, by counts over all documents. Document words join windows on that token
alone; the positions of the token in the document and in the window give the only possible start, which
must leave room for the whole window; the words there are then compared one by one.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Null and empty texts have no words
and are clean; null and empty items have no window. Rows with equal doc_id and text are judged alike,
rows with equal doc_id and other text apart. Equal item_ids count once, a null item_id as an empty
one. Other columns are ignored; without items every document is clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import LOWER, UPPER

WINDOW = 10
#: Windows and item words are broadcast up to so many rows (about 20 MB); beyond, they are joined by shuffle.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _bounded(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, gram) of every window."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text").cast("string")).alias("words"))
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = words.where(F.size("words") > 0).select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    return starts.select("item_id", F.slice("words", F.col("start") + 1, window).alias("gram")).distinct()


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    return judge_rows(docs, items, window).drop("h")


def judge_rows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """As `decontaminate`, with the `text_hash` h: a row is judged by doc_id and h."""
    text = F.col("text").cast("string")
    # split anew in each pass: stored word arrays would take more room than the documents
    split = docs.select(F.col("doc_id"), text_hash().alias("h"), words_of(text).alias("words"))
    split = split.withColumn("n_words", F.size("words").cast("long"))

    owned = item_windows(items, window).withColumn("gram_id", F.xxhash64("gram"))
    owned = stage(owned, "item-windows")
    grams = owned.select("gram_id", "gram").distinct()
    in_gram = grams.select("gram_id", "gram", F.posexplode("gram").alias("off", "token"))

    vocabulary = stage(in_gram.select("token").distinct(), "item-words")
    spoken = split.select(F.explode("words").alias("token"))
    counts = spoken.join(_bounded(vocabulary, vocabulary.count()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = in_gram.join(stage(counts, "item-word-counts"), "token", "left")
    rarest = ranked.groupBy("gram_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off")).alias("r"))
    grams = grams.join(rarest, "gram_id").select("gram_id", "gram", F.col("r.token").alias("token"), F.col("r.off").alias("off"), F.size("gram").alias("len"))
    # a word that no document has can be in no occurrence
    grams = stage(grams.join(rarest.where("r.n > 0").select("gram_id"), "gram_id", "left_semi"), "item-grams")

    n_grams = grams.count()
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    same = F.slice("words", start + 1, F.col("len")) == F.col("gram")
    key = ["doc_id", "h"]
    if n_grams <= BROADCAST_ROWS:
        at = split.select(*key, "n_words", "words", F.posexplode("words").alias("pos", "token"))
        found = at.join(F.broadcast(grams), "token").where(fits & same)
    else:
        at = split.select(*key, "n_words", F.posexplode("words").alias("pos", "token"))
        # other words than the windows' rarest leave before the shuffle, while the set of these is small
        prefixes = stage(grams.select("token").distinct(), "prefix-words")
        n_prefixes = prefixes.count()
        at = at.join(F.broadcast(prefixes), "token", "left_semi") if n_prefixes <= BROADCAST_ROWS else at
        near = at.join(grams, "token").where(fits).select(F.col("doc_id").alias("d"), F.col("h").alias("k"), "pos", "off", "len", "gram", "gram_id")
        found = near.join(split, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k"))).where(same)
    hits = stage(found.select(*key, start.alias("start"), "len", "gram_id").distinct(), "window-hits")

    covered = hits.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos")).distinct()
    covered = covered.groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    named = hits.select(*key, "gram_id").distinct().join(owned.select("gram_id", "item_id"), "gram_id").select(*key, "item_id").distinct()
    named = named.groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    marks = covered.join(named.withColumnsRenamed({"doc_id": "d", "h": "k"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")))
    marks = marks.select(F.col("doc_id").alias("d"), F.col("h").alias("k"), "n_hit", "items")
    out = split.select(*key, "n_words").join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")), "left")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "h",
    )
