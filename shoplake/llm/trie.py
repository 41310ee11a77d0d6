"""Conversation prefix trie by van Emde Boas recursion.

A conversation is a sequence of turns; every distinct sequence of first d
turns is a node.  The sequences are cut at half of a power-of-two height.  The
cut names the prefix above it, and all suffixes below one name form a forest.
The upper trie and the lower forests have half the height and are cut in the
same way, all pieces of one height in parallel, until the height is one and the
name above a piece is a node.  Names are 128-bit hashes: of a turn's role and
text, of two neighbouring blocks for a block of twice the size, and of the name
above with the block between for a cut prefix.  So naming takes two passes over
the heights: blocks upwards, cuts downwards.

Totals are grafted upwards in the same recursion.  A node first knows the total
of its subtree within its own piece; joining two heights, the roots of each
lower forest hand their totals to the cut node above them, and from there to
the cut node's ancestors within the upper trie.

Scale: all tables hold hashes and counts, never texts.  Rows are keyed by
(conversation, position), so a conversation with a third of all turns spreads
over tasks; its turns are numbered in ranges whose sizes are summed afterwards.
Counts per node are partial aggregates, so a first turn that everybody shares
is one row per task.  The heights need log2 of the longest conversation; each
is written to the shared folder, so no plan spans two of them.  The ids that
end at a node are joined to text in chunks by tasks that each hold one range;
only the hash over the chunks runs through them in order.

Edge cases: null role and text are empty; null turns come first; equal turns
are ordered by their hash (any order of equal rows is the same); the remainder
of a negative conv_id is negative, as in SQL; rows without
conv_id belong to no conversation and are left out; a conversation that the rebuilding
leaves without turns is a member of the root only; the root's conv_id is the
least of all and its parent null; a childless root is a leaf; an empty table
gives no rows; only conv_id, turn, role and text are read, so other columns may
have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of, words_of

GROUP = 20
SHARES = 4
SEGMENT = 10_000
CHUNK_BYTES = 1 << 20
ROOT = (0, 0)


def _names(*cols) -> tuple[Column, Column]:
    """A 128-bit hash of the columns, as two longs."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(F.lit(1), *cols), F.xxhash64(*cols[::-1], F.lit(2))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), the turn's name (da, db) and its number of words.

    The turns are laid out in ranges of (conv_id, turn), numbered within each
    range, and moved on by the sizes of the conversation's earlier ranges.
    """
    role, text = text_of("role"), text_of("text")
    da, db = _names(role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", da.alias("da"), db.alias("db"),
        F.size(words_of(text)).cast("long").alias("words"))
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "da", "db")
    ranged = stored(turns.repartitionByRange("conv_id", "turn", "da", "db").withColumn("part", F.spark_partition_id())
                    .withColumn("place", F.row_number().over(inside) - 1).drop("turn"), "trie-ranges")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
               .select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    return ranged.join(offsets, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("place")).alias("pos"), "da", "db", "words")


def rebuilt_turns(turns: DataFrame, group: int = GROUP, shares: int = SHARES,
                  segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Conversations c that begin with the first h turns of conversation c - c % ``group``, h = crc32(c) % ``shares``.

    Returns (turns, conversations): conv_id, pos, da, db, words; and one row conv_id for each, turnless ones too.
    """
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("len")), "trie-sizes")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shares
    plan = sizes.select("conv_id", "len", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head.alias("h"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    plan = plan.join(base, "base", "left").withColumn("given", F.least("h", F.coalesce("base_len", F.lit(0))))
    # a row of the plan for every segment of a long conversation, so no key holds more than a segment
    parts = plan.select("conv_id", "h", "given", F.explode(
        F.sequence(F.lit(0).cast("long"), F.expr(f"(len - 1) div {segment}"))).alias("segment"))
    own = (turns.withColumn("segment", F.expr(f"pos div {segment}")).join(parts, ["conv_id", "segment"])
           .where(F.col("pos") >= F.col("h"))
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "da", "db", "words"))
    first = turns.where(F.col("pos") < shares - 1).withColumnRenamed("conv_id", "base")
    given = plan.where("given > 0").select("conv_id", "base", "h").join(first, "base").where(
        F.col("pos") < F.col("h")).select("conv_id", "pos", "da", "db", "words")
    return own.unionByName(given), sizes.select("conv_id")


def prefix_names(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, int]:
    """The name (fa, fb) of every prefix: a row per conversation and depth, 0 included; and the height."""
    longest = (turns.agg(F.max("pos")).first()[0] or 0) + 1
    height = 2
    while height <= longest:
        height *= 2
    blocks = {1: turns.select("conv_id", F.col("pos").alias("i"), "da", "db")}
    size = 2
    while size < height:
        def half(col: str, odd: int) -> Column:
            return F.max(F.when(F.col("i") % 2 == odd, F.col(col)))
        pairs = blocks[size // 2].groupBy("conv_id", F.expr("i div 2").alias("j")).agg(
            half("da", 0).alias("la"), half("db", 0).alias("lb"), half("da", 1).alias("ra"), half("db", 1).alias("rb"))
        da, db = _names("la", "lb", "ra", "rb")
        blocks[size] = stored(pairs.where("ra is not null").select(
            "conv_id", F.col("j").alias("i"), da.alias("da"), db.alias("db")), f"trie-blocks-{size}")
        size *= 2
    pieces = conversations.select("conv_id", F.lit(0).cast("long").alias("i"), F.lit(ROOT[0]).cast("long").alias("fa"),
                                  F.lit(ROOT[1]).cast("long").alias("fb"))
    size = height
    while size > 1:
        upper_block = blocks[size // 2].where("i % 2 = 0").select("conv_id", F.expr("i div 2").alias("i"), "da", "db")
        la, lb = _names("fa", "fb", "da", "db")
        upper = F.struct((F.col("i") * 2).alias("i"), "fa", "fb")
        lower = F.struct((F.col("i") * 2 + 1).alias("i"), la.alias("fa"), lb.alias("fb"))
        cut = pieces.join(upper_block, ["conv_id", "i"], "left").select("conv_id", F.explode(
            F.when(F.col("da").isNull(), F.array(upper)).otherwise(F.array(upper, lower))).alias("p"))
        pieces = stored(cut.select("conv_id", "p.*"), f"trie-pieces-{size // 2}")
        size //= 2
    return pieces.withColumnRenamed("i", "depth"), height


def _grafted(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """``nodes`` with leaves and saved summed over subtrees."""
    def with_sums(now: DataFrame, adds: DataFrame, name: str) -> DataFrame:
        sums = adds.groupBy("na", "nb").agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
        return stored(now.join(sums, ["na", "nb"], "left")
                      .withColumn("leaves", F.col("leaves") + F.coalesce("_l", F.lit(0)))
                      .withColumn("saved", F.col("saved") + F.coalesce("_s", F.lit(0))).drop("_l", "_s"), name)
    now, size = nodes, 2
    while size <= height:
        half = size // 2
        # the roots of the lower forests are one deeper than the cut
        cut = (now.where(F.expr(f"depth > 0 and (depth - 1) % {size} = {half}")).groupBy("pa", "pb").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("conv_id").alias("conv_id"),
            (F.max("depth") - 1).alias("cut")))
        adds = cut.select(F.col("pa").alias("na"), F.col("pb").alias("nb"), "leaves", "saved")
        if half > 1:
            above = cut.select("conv_id", "leaves", "saved", F.explode(
                F.sequence(F.col("cut") - (half - 1), F.col("cut") - 1)).alias("depth"))
            adds = adds.unionByName(above.join(paths.select("conv_id", "depth", "na", "nb"), ["conv_id", "depth"])
                                    .select("na", "nb", "leaves", "saved"))
        now = with_sums(now, adds, f"trie-totals-{size}")
        size *= 2
    top = now.where("depth = 1").select(F.col("pa").alias("na"), F.col("pb").alias("nb"), "leaves", "saved")
    return with_sums(now, top, "trie-totals")


def _chunks(limit: int):
    """Sorted Arrow batches (na, nb, conv_id) -> (na, nb, first, chunk): ids of one node joined by commas."""
    def run(batches):
        import pyarrow as pa
        key, first, ids, size = None, None, [], 0

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*rows)) or [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["na", "nb", "first", "chunk"])
        for batch in batches:
            rows = []
            for na, nb, c in zip(*(batch.column(x).to_pylist() for x in ("na", "nb", "conv_id"))):
                if (na, nb) != key or size > limit:
                    if ids:
                        rows.append((*key, first, b",".join(ids)))
                    key, first, ids, size = (na, nb), c, [], 0
                ids.append(b"%d" % c)
                size += len(ids[-1]) + 1
            yield out(rows)
        if ids:
            yield out([(*key, first, b",".join(ids))])
    return run


def _end_hashes(batches):
    """Sorted Arrow batches (na, nb, first, chunk) -> (na, nb, ends_sha256); a node may continue in the next batch."""
    import hashlib

    import pyarrow as pa
    key, digest = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            list(zip(*rows)) or [()] * 3, (pa.int64(), pa.int64(), pa.string()))], names=["na", "nb", "ends_sha256"])
    for batch in batches:
        rows = []
        for na, nb, chunk in zip(*(batch.column(x).to_pylist() for x in ("na", "nb", "chunk"))):
            if (na, nb) == key:
                digest.update(b",")
            else:
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = (na, nb), hashlib.sha256()
            digest.update(chunk)
        yield out(rows)
    if key is not None:
        yield out([(*key, digest.hexdigest())])


def end_hashes(ends: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(na, nb, conv_id) rows -> per node the SHA-256 of its ids, ascending and comma-joined."""
    chunks = (ends.repartitionByRange("na", "nb", "conv_id").sortWithinPartitions("na", "nb", "conv_id")
              .mapInArrow(_chunks(chunk_bytes), "na bigint, nb bigint, first bigint, chunk binary"))
    return (chunks.repartition("na", "nb").sortWithinPartitions("na", "nb", "first")
            .mapInArrow(_end_hashes, "na bigint, nb bigint, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, group: int = GROUP, shares: int = SHARES, segment: int = SEGMENT,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations.

    Columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns, convs = rebuilt_turns(numbered_turns(conversations), group, shares, segment)
    turns = stored(turns, "trie-turns")
    names, height = prefix_names(turns, convs)
    above = names.join(turns.withColumnRenamed("pos", "depth"), ["conv_id", "depth"]).select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), "words")
    paths = stored(names.join(above, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.col("fa").alias("na"), F.col("fb").alias("nb"), "pa", "pb",
        F.coalesce("words", F.lit(0)).alias("words")), "trie-paths")
    nodes = stored(paths.groupBy("na", "nb", "pa", "pb", "depth", "words").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("na"), F.col("pb").alias("nb")).agg(
        F.count("*").alias("n_children"))
    own = stored(nodes.join(children, ["na", "nb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                 .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
                 .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-own")
    totals = _grafted(own, paths, height)
    lengths = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("depth"))
    last = convs.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("depth", F.lit(0)).alias("depth"))
    ends = stored(end_hashes(paths.join(last, ["conv_id", "depth"]).select("na", "nb", "conv_id"), chunk_bytes), "trie-ends")
    parents = nodes.select(F.col("na").alias("pa"), F.col("nb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (totals.join(parents, ["pa", "pb"], "left").join(ends, ["na", "nb"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
