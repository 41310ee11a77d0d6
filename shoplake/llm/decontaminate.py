"""Benchmark decontamination by spaced seeds.

A mask names the word positions that count and skips the others.  Every
position of every text is hashed under each mask, training hashes join the
hashes of the benchmark items, and each hit names a diagonal (text position
minus item position).  On the diagonal the words of text and item are compared
one to one, and the pair is reported when some stretch of ``STRETCH`` aligned
words (the whole item when it is shorter) holds at most ``TOLERANCE``
different words.

The two masks guarantee the search: in 13 words, wherever two of them are
substituted, at least one mask fits somewhere without touching them (a test
checks all 78 cases).  A stretch shorter than 13 words tolerates no
substitution; items shorter than the shortest mask span are not searched.

Scale: DataFrame functions only.  Texts are split and exploded within their
own scan task; the benchmark side is broadcast when it has at most
``broadcast_seeds`` seed rows, otherwise both sides are shuffled by the hash.
Only hits move: they are reduced to one row per (document, item, diagonal)
with at most an item's length of word hashes, so a passage that a third of all
documents share costs one row per document.

Edge cases: null or empty texts and items have no seeds; repeated rows of
documents give one result row per (doc_id, item_id) with the best stretch;
equal items are all reported; empty tables give no rows; null ids are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import normal_words, packed, text_of, word_hashes

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
STRETCH = 13
TOLERANCE = 2
BROADCAST_SEEDS = 1_000_000


def _seeds(hashed: DataFrame, masks: tuple, *keep: str) -> DataFrame:
    """``hashed`` has the array ``wh``; one row per position and mask: ``keep``, wh, pos, seed."""
    spans = [m[-1] + 1 for m in masks]
    n = F.size("wh")
    rows = hashed.select(*keep, "wh", F.explode(F.when(
        n >= min(spans), F.sequence(F.lit(0), n - min(spans)))).alias("pos"))
    seed = F.array(*[
        F.when(F.col("pos") + span <= F.size("wh"),
               F.xxhash64(F.lit(k), *[F.get("wh", F.col("pos") + i) for i in mask]))
        for k, (mask, span) in enumerate(zip(masks, spans))])
    return rows.select(*keep, "wh", "pos", F.explode(seed).alias("seed")).filter("seed is not null")


def _best_stretch(same: Column, stretch: int) -> Column:
    """Struct (matched, words, start) of the stretch with the most equal words, the first of equals."""
    n = F.least(F.lit(stretch), F.size(same))
    scores = F.transform(F.sequence(F.lit(0), F.size(same) - n), lambda i: F.struct(
        F.aggregate(F.slice(same, i + 1, n), F.lit(0), lambda a, x: a + x).alias("matched"),
        n.alias("words"), (-i).alias("back")))
    return F.array_max(scores)


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple = MASKS, stretch: int = STRETCH,
                 tolerance: int = TOLERANCE, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row per (document, item) that overlap.

    Columns: doc_id, item_id, matched_words and stretch_words of the best
    stretch, doc_start and item_start (word positions from 0) of its begin.
    """
    items = benchmark.select("item_id", word_hashes(normal_words(text_of("text"))).alias("wh"))
    item_seeds = _seeds(items, masks, "item_id").select(
        "seed", "item_id", F.col("pos").alias("item_pos"), F.size("wh").alias("item_len")).distinct()
    if item_seeds.count() <= broadcast_seeds:
        item_seeds = F.broadcast(item_seeds)
    text = docs.select("doc_id", word_hashes(normal_words(text_of("text"))).alias("wh"))
    hits = _seeds(text, masks, "doc_id").join(item_seeds, "seed")
    diag = F.col("pos") - F.col("item_pos")
    low = F.greatest(F.lit(0), -diag)          # first item word that lies on the text
    high = F.least(F.col("item_len"), F.size("wh") - diag)
    aligned = hits.select("doc_id", "item_id", diag.alias("diag"), low.alias("low"),
                          F.slice("wh", diag + low + 1, high - low).alias("seg")).distinct()
    words = items.select(F.col("item_id").alias("_item"), F.col("wh").alias("item_wh")).distinct()
    pairs = aligned.join(words, F.col("item_id").eqNullSafe(F.col("_item")))
    same = F.transform("seg", lambda x, i: (x == F.get("item_wh", F.col("low") + i)).cast("int"))
    best = (pairs.withColumn("same", same).withColumn("best", _best_stretch(F.col("same"), stretch))
            .filter((F.size("same") >= F.least(F.lit(stretch), F.size("item_wh")))
                    & (F.col("best.matched") >= F.col("best.words")
                       - F.when(F.col("best.words") >= stretch, F.lit(tolerance)).otherwise(F.lit(0)))))
    start = F.col("low") - F.col("best.back")
    return (best.groupBy("doc_id", "item_id").agg(F.max(F.struct(
                F.col("best.matched").alias("matched_words"), F.col("best.words").alias("stretch_words"),
                (-(F.col("diag") + start)).alias("_doc"), (-start).alias("_item"))).alias("b"))
            .select("doc_id", "item_id", "b.matched_words", "b.stretch_words",
                    (-F.col("b._doc")).alias("doc_start"), (-F.col("b._item")).alias("item_start")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents (all columns, of any name) that overlap no benchmark item; a row is told by its doc_id and its text."""
    hashed = packed(docs)
    rows = hashed.select(F.struct("doc_id", "_hash").alias("doc_id"), "text")
    bad = contaminated(rows, benchmark, **params).select(
        F.col("doc_id.doc_id").alias("_bad"), F.col("doc_id._hash").alias("_text")).distinct()
    return hashed.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad")) & (F.col("_hash") == F.col("_text")),
                       "left_anti").select("_row.*")
