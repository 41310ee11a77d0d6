"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has a bit set where over half of a text's shingle hashes have
it.  Two fingerprints that differ in at most ``MAX_BITS`` = 4 bits differ in at
most 4 of their 8 bytes, so they share at least 4 positional bytes: that is the
guaranteed minimum of the count filter.

The index lists fingerprints by positional bytes.  Lists of single bytes would
hold a 256th of all fingerprints each, and tallying their pairs would be
quadratic in practice.  So a list is keyed by three positions and their
bytes, for the 20 position triples of a covering design: any 4 of the 8 positions contain
one of the triples, hence each pair that reaches the minimum meets in a list.
Within a list, blocks of fingerprints tally the equal bytes of their pairs,
keep the pairs with at least 4 and verify the bit distance.

Scale: work is on distinct fingerprints, so a group of copies is one entry.  A
list emits a spanning forest of its links, never its pairs: connected
components need no more.  A list longer than ``BLOCK`` is cut into blocks by a
hash; every pair of blocks is a task's unit of its own, so a hot list spreads
over tasks and no pair is dropped.  Components are found by rounds over stored
edges; documents get theirs by a join on the fingerprint, which AQE can split
on a hot one.

Edge cases: null and empty texts have fingerprint zero and link like any other
(0 differs in no bit from 0); texts shorter than a shingle hash their whole word sequence; repeated
rows get equal results; null doc_ids never name a group
that has another id; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, stored
from .graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 1024
SHORT = 32


def position_triples(minimum: int = 4) -> list[tuple[int, ...]]:
    """Triples of the 8 byte positions such that any 4 positions contain one of them.

    Turan's construction: positions in three classes; a triple lies in one
    class, or has two positions in a class and one in the next.
    """
    kind = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in combinations(range(8), 3):
        n = [sum(kind[i] == c for i in t) for c in range(3)]
        if 3 in n or any(n[c] == 2 and n[(c + 1) % 3] == 1 for c in range(3)):
            out.append(t)
    return out


def _fingerprints(shingle: int, seed: int):
    """Arrow batches (doc_id, ..., text) -> (doc_id, ..., fp)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest
        lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
        step = 1 << 16

        def fingerprint(text: bytes | None) -> int:
            words = (text or b"").translate(lower).split()      # splits at exactly \x20 and \x09-\x0D
            if not words:
                return 0
            joined = b" ".join(words)
            if len(words) <= shingle:
                return xxh64_intdigest(joined, seed)
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            counts = np.zeros(64, dtype=np.int64)
            n = len(words) - shingle + 1
            for at in range(0, n, step):
                a, b = starts[at:min(at + step, n)].tolist(), ends[at + shingle - 1:min(at + step, n) + shingle - 1].tolist()
                h = np.array([xxh64_intdigest(joined[x:y], seed) for x, y in zip(a, b)], dtype="<u8")
                counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(fps)], names=[*names, "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, seed: int = SEED, also: tuple = ()) -> DataFrame:
    """doc_id, the columns ``also``, fp (the 64 bits as a signed long)."""
    rows = docs.select("doc_id", *also, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *also))
    return rows.mapInArrow(_fingerprints(shingle, seed), f"{kept}, fp bigint")


def _unit_edges(fp, max_bits: int):
    """Edges (pairs of positions) that connect the linked fingerprints of one long unit: a spanning forest."""
    import numpy as np
    raw, bits = fp.view(np.uint8).reshape(-1, 8), fp.view(np.uint64)
    todo = np.ones(len(fp), dtype=bool)
    us, vs = [], []
    for first in range(len(fp)):
        if not todo[first]:
            continue
        todo[first] = False
        frontier = [first]
        while frontier:
            at = frontier.pop()
            rest = np.flatnonzero(todo)
            rest = rest[(raw[rest] == raw[at]).sum(axis=1) >= 8 - max_bits]
            rest = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= max_bits]
            todo[rest] = False
            us += [at] * len(rest)
            vs += rest.tolist()
            frontier += rest.tolist()
    return np.array(us, dtype=np.int64), np.array(vs, dtype=np.int64)


def _partition_edges(max_bits: int, short: int):
    """Sorted Arrow batches (unit, fp) of whole units -> edges (u, v); a unit may continue in the next batch.

    Units of up to ``short`` fingerprints are compared together, one distance
    in the sorted order at a time; longer ones one by one.
    """
    def edges_of(unit, fp):
        import numpy as np
        raw, bits = fp.view(np.uint8).reshape(-1, 8), fp.view(np.uint64)
        cut = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]).any(axis=1)]))
        size = np.diff(np.concatenate([cut, [len(fp)]]))
        left = np.repeat(cut + size, size) - np.arange(len(fp)) - 1      # members after this one
        left[np.repeat(size > short, size)] = 0
        us, vs = [], []
        for d in range(1, int(left.max(initial=0)) + 1):
            a = np.flatnonzero(left >= d)
            # tally of shared positional bytes, then the bit distance of those that reach the minimum
            a = a[(raw[a] == raw[a + d]).sum(axis=1) >= 8 - max_bits]
            a = a[np.bitwise_count(bits[a] ^ bits[a + d]) <= max_bits]
            us.append(fp[a])
            vs.append(fp[a + d])
        for at, n in zip(cut[size > short], size[size > short]):
            own = fp[at:at + n]
            u, v = _unit_edges(own, max_bits)
            us.append(own[u])
            vs.append(own[v])
        return np.concatenate(us or [fp[:0]]), np.concatenate(vs or [fp[:0]])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held_unit, held_fp = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64)

        def out(unit, fp):
            u, v = edges_of(unit, fp)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        for batch in batches:
            unit = np.concatenate([held_unit, np.stack([batch.column(c).to_numpy() for c in ("key", "a", "b")], axis=1)])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
            whole = len(fp)
            if whole:
                whole = int(np.flatnonzero((unit == unit[-1]).all(axis=1))[0])     # the last unit may go on
            if whole:
                yield out(unit[:whole], fp[:whole])
            held_unit, held_fp = unit[whole:], fp[whole:]
        if len(held_fp):
            yield out(held_unit, held_fp)
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints within ``max_bits`` bits of each other."""
    if max_bits > 4:
        raise ValueError("the position triples cover fingerprints that share at least 4 of 8 bytes")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    entries = fps.select("fp", F.explode(F.array(*[
        F.lit(k << 24).cast("long") + byte[a] * (1 << 16) + byte[b] * (1 << 8) + byte[c]
        for k, (a, b, c) in enumerate(position_triples())])).alias("key"))
    sizes = entries.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    listed = (entries.join(sizes, F.col("key") == F.col("_key")).select("key", "fp", blocks.alias("blocks"))
              .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    units = listed.select("key", "fp", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("mine")).alias("a"), F.greatest(o, F.col("mine")).alias("b")))).alias("p"))
    dealt = (units.select("key", F.col("p.a").cast("long").alias("a"), F.col("p.b").cast("long").alias("b"), "fp")
             .repartition("key", "a", "b").sortWithinPartitions("key", "a", "b"))
    return dealt.mapInArrow(_partition_edges(max_bits, short), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
                    block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """One row per document: doc_id, fp, component_id (least doc_id that links lead to)."""
    fps = stored(fingerprints(docs, shingle, seed), "simhash-fp")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = components(links(distinct.select("fp"), max_bits, block, short))
    grouped = (distinct.join(root, F.col("fp") == F.col("node"), "left")
               .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    first = grouped.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    by_fp = grouped.join(first, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return fps.join(by_fp, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
                block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """The documents, all columns, one row of each group: the one with the least doc_id, then the least text hash.

    Rows without doc_id come last; of rows that repeat the doc_id and the text one stays.  Other columns may have
    any name and come back unchanged.
    """
    hashed = packed(docs)
    fps = stored(fingerprints(hashed, shingle, seed, also=("_hash",)), "simhash-rows")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("_id"), F.col("_hash").alias("_text"))
    distinct = fps.groupBy("fp").agg(F.min(row).alias("least"))
    root = components(links(distinct.select("fp"), max_bits, block, short))
    keep = (distinct.join(root, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("_root")).agg(F.min("least").alias("least"))
            .select("least._id", "least._text"))
    kept = hashed.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_hash"]).select("_row.*")
