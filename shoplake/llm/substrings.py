"""Substring dedup: repeated word sequences found with prefix-partitioned suffix trees.

A window is ``WINDOW`` = 50 consecutive words of one document.  A word goes when
a window that covers it also starts in a document with a smaller doc_id.

1. One scan hashes the words and picks sparse suffix starts: of the 12-word
   sequences in a window the one of least hash.  Equal windows pick equal
   sequences at equal places, so each repeat has a suffix start in common.
2. Suffixes are split by prefix: the 12 words at the start.  Prefixes that occur in
   one document only cannot be part of a repeat and go.  Whole copies go
   first: all windows of a copy start in the copy of smallest id.
3. Each remaining suffix carries the hashes of 50 words to its right and of 38
   to its left; places of a document with the same context share one row.  A task takes groups of whole prefixes, as many as fit
   ``TREE_ROWS``, and builds the suffix tree of the right sides and the tree
   of the reversed left sides by sorting: neighbours' common prefix lengths
   give the internal nodes at each depth.  A window that starts j words
   left of the suffix start is a pair of nodes, at depth j to the left and
   50 - j to the right; together they are a node of depth 50, and suffixes below
   it whose doc_id is not the least mark the window.
4. A prefix with more than ``HOT_ROWS`` places does not go to one task.  It is
   lengthened to the full depth: each of its 39 windows becomes a prefix of its own,
   whose least doc_id is a partial aggregate.

Scale: 1 in 20 positions is a suffix start, and only those in repeated text
are carried on.  The text is scanned once for hashes and joined once with
the documents that have repeats; those are stored and read again for the
result.  No list of all links or documents reaches one task.

Edge cases: null and empty texts have no words (hash of the empty string);
rows without a doc_id, and repeated rows of one doc_id, neither remove from one another
(not smaller) nor crash, and repeated rows get equal results; rows without doc_id keep all words; texts under 50
words keep all; an empty table gives no rows; other columns are ignored.
Words are compared by 64-bit hashes, fifty of them to a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 50
PREFIX = 12
TREE_ROWS = 40_000
HOT_ROWS = 20_000
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _word_hashes(words: list):
    import numpy as np
    from xxhash import xxh3_64_intdigest
    return np.array([xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def _digest(joined: bytes) -> tuple[int, int]:
    from xxhash import xxh3_128_digest
    d = xxh3_128_digest(joined)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _suffix_starts(hashes, window: int, prefix: int):
    """(positions, prefix hashes) of the least prefix of each window."""
    import numpy as np
    n = len(hashes) - prefix + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for i in range(prefix):
            h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    span = window - prefix + 1
    picked = []
    step = 1 << 16
    for at in range(0, n - span + 1, step):
        part = np.lib.stride_tricks.sliding_window_view(h[at:min(at + step + span - 1, n)], span)
        picked.append(np.unique(part.argmin(axis=1) + np.arange(at, at + len(part))))
    pos = np.unique(np.concatenate(picked))
    return pos, h[pos].view(np.int64)


def _lists(arrays: list, kind):
    """Arrow list array of numpy arrays."""
    import numpy as np
    import pyarrow as pa
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _index(window: int, prefix: int):
    """Arrow batches (_row, doc_id, text) -> one row per document with its suffix starts."""
    def run(batches):
        import hashlib
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            sizes, shas, d1, d2, starts, keys, own, counts = [], [], [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                words = text.split()                    # splits at exactly \x20 and \x09-\x0D
                joined = b" ".join(words)
                a, b = _digest(joined)
                pos = key = np.zeros(0, dtype=np.int64)
                if len(words) >= window:
                    pos, key = _suffix_starts(_word_hashes(words), window, prefix)
                sizes.append(len(words))
                shas.append(hashlib.sha256(joined).hexdigest())
                d1.append(a)
                d2.append(b)
                starts.append(pos.astype(np.int32))
                keys.append(key)
                distinct, count = np.unique(key, return_counts=True)
                own.append(distinct)
                counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), _lists(starts, np.int32), _lists(keys, np.int64),
                 _lists(own, np.int64), _lists(counts, np.int64)],
                names=["_row", "doc_id", "n_words", "sha", "c1", "c2", "pos", "key", "own", "count"])
    return run


INDEX = ("_row bigint, doc_id bigint, n_words bigint, sha string, c1 bigint, c2 bigint, pos array<int>, key array<bigint>, "
         "own array<bigint>, count array<bigint>")


def _suffixes(window: int, prefix: int, hot: bool):
    """Arrow batches (_row, doc_id, text, pos, key, shared) -> one row per distinct suffix context of a document.

    ``shared`` names the prefixes to take.  Periodic text repeats one context
    many times; the row then lists all its places.
    """
    left_words = window - prefix

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from numpy.lib.stride_tricks import sliding_window_view
        for batch in batches:
            for row, doc, text, pos, key, shared in zip(*[batch.column(c).to_pylist() for c in (
                    "_row", "doc_id", "text", "pos", "key", "shared")]):
                wanted = np.array([x["key"] for x in shared if x["hot"] == hot], dtype=np.int64)
                key, pos = np.array(key, dtype=np.int64), np.array(pos, dtype=np.int64)
                mine = np.isin(key, wanted)
                key, pos = key[mine], pos[mine]
                if not len(pos):
                    continue
                hashes = _word_hashes(text.split())
                padded = np.concatenate([np.zeros(left_words, np.uint64), hashes, np.zeros(window, np.uint64)])
                at: dict[tuple, list] = {}
                for k in range(0, len(pos), 4096):                    # contexts of a few thousand places at a time
                    part = pos[k:k + 4096]
                    right = np.ascontiguousarray(sliding_window_view(padded, window)[part + left_words])
                    left = np.ascontiguousarray(sliding_window_view(padded, left_words)[part][:, ::-1])
                    sizes = zip(np.minimum(part, left_words).tolist(), np.minimum(len(hashes) - part, window).tolist())
                    for p, x, l, r, n in zip(part.tolist(), key[k:k + 4096].tolist(), left, right, sizes):
                        at.setdefault((x, *n, l.tobytes(), r.tobytes()), []).append(p)
                n = len(at)
                x, n_left, n_right, left, right = zip(*at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row)), pa.array(np.full(n, doc)), pa.array(list(at.values()), pa.list_(pa.int64())),
                     pa.array(x, pa.int64()), pa.array(n_left, pa.int64()), pa.array(n_right, pa.int64()),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    names=["_row", "doc_id", "pos", "key", "n_left", "n_right", "left", "right"])
    return run


SUFFIX = ("_row bigint, doc_id bigint, pos array<bigint>, key bigint, n_left bigint, n_right bigint, "
          "left binary, right binary")


def _nodes(rows, width: int):
    """Tree of the rows (arrays of word hashes): place in sorted order, common words with the one before."""
    import numpy as np
    flat = np.ascontiguousarray(rows)
    order = np.argsort(flat.view(f"V{8 * width}").ravel(), kind="stable")
    s = flat[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place, np.concatenate([[0], common])


def _tree_marks(doc, n_left, n_right, left, right, window: int, prefix: int):
    """(suffix number, words to its left) of the marked windows of one task's groups."""
    import numpy as np
    left_words = window - prefix
    r_place, r_common = _nodes(right, window)
    l_place, l_common = _nodes(left, left_words)
    n = len(doc)
    out = []
    for j in range(left_words + 1):
        valid = np.flatnonzero((n_left >= j) & (n_right >= window - j))
        if len(valid) < 2:
            continue
        # nodes at depth j of the left tree and 50 - j of the right one, as numbers
        l_node = np.cumsum(l_common < j)[l_place[valid]]
        r_node = np.cumsum(r_common < window - j)[r_place[valid]]
        _, node = np.unique(l_node * np.int64(n + 1) + r_node, return_inverse=True)
        least = np.full(node.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc[valid])
        hit = valid[doc[valid] > least[node]]
        out.append(np.stack([hit, np.full(len(hit), j)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)


def _trees(window: int, prefix: int, tree_rows: int):
    """Sorted Arrow batches of suffixes -> (_row, start, stop): stretches of words to remove."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        names = ("_row", "doc_id", "pos", "key", "n_left", "n_right", "left", "right")

        def work(table):
            cols = {c: table.column(c) for c in names}
            num = {c: cols[c].to_numpy() for c in ("_row", "doc_id", "n_left", "n_right")}
            wide = [np.frombuffer(b"".join(cols[c].to_pylist()), dtype=np.uint64).reshape(table.num_rows, -1)
                    for c in ("left", "right")]
            found = _tree_marks(num["doc_id"], num["n_left"], num["n_right"], *wide, window, prefix)
            # every place of the marked contexts
            places = [np.array(p, dtype=np.int64) for p in cols["pos"].to_pylist()]
            row = np.repeat(num["_row"][found[:, 0]], [len(places[h]) for h in found[:, 0]])
            start = np.concatenate([places[h] - j for h, j in found.tolist()]) if len(found) else found[:, 0]
            order = np.lexsort((start, row))
            row, start = row[order], start[order]
            # windows that touch become one stretch
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + window)
            last = np.append(np.flatnonzero(new)[1:], len(row))[:new.sum()].astype(np.int64) - 1
            return pa.RecordBatch.from_arrays(
                [pa.array(row[new]), pa.array(start[new]), pa.array(start[last] + window)], names=["_row", "start", "stop"])

        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows >= tree_rows:
                key = held.column("key").to_numpy()
                whole = int(np.flatnonzero(key == key[-1])[0])        # the last group may go on
                if whole:
                    yield work(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield work(held)
    return run


def _deep_prefixes(hot: DataFrame, window: int, prefix: int) -> DataFrame:
    """The marked windows of prefixes too frequent for one task: every window is a prefix of full depth."""
    each = hot.select("_row", "doc_id", "pos", "n_left", "n_right", "left", "right",
                      F.explode(F.sequence(F.lit(0), F.lit(window - prefix))).alias("j"))
    each = each.filter((F.col("n_left") >= F.col("j")) & (F.col("n_right") >= window - F.col("j")))
    words = F.concat(F.expr("substring(left, 1, 8 * j)"),
                     F.expr(f"substring(right, 1, 8 * ({window} - j))"))
    each = each.select("_row", "doc_id", "pos", "j", F.md5(words).alias("node"))
    least = each.groupBy(F.col("j").alias("_j"), F.col("node").alias("_node")).agg(F.min("doc_id").alias("least"))
    return (each.join(least, (F.col("j") == F.col("_j")) & (F.col("node") == F.col("_node")))
            .filter("doc_id > least").select("_row", "j", F.explode("pos").alias("pos"))
            .select("_row", (F.col("pos") - F.col("j")).alias("start"), (F.col("pos") - F.col("j") + window).alias("stop"))
            .distinct())


def _kept(batches):
    """Arrow batches (_row, text, spans) -> (_row, n_removed, kept_sha)."""
    import hashlib
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        removed, shas = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.split()
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            for s in spans:
                edge[s["start"]] += 1
                edge[s["stop"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                                         names=["_row", "n_removed", "kept_sha"])


def _matching(batches):
    """Keep the rows whose text is the one that was indexed (a doc_id may come with several texts)."""
    import pyarrow as pa
    for batch in batches:
        same = [_digest(b" ".join(t.split())) == (a, b) for t, a, b in zip(
            *[batch.column(c).to_pylist() for c in ("text", "c1", "c2")])]
        yield batch.filter(pa.array(same, pa.bool_())).drop_columns(["c1", "c2"])


def _build(docs: DataFrame, window: int, prefix: int, tree_rows: int, hot_rows: int):
    """(index of all documents with ``least``, stored documents with suffixes, stretches to remove)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    index = stored(rows.withColumn("_row", F.monotonically_increasing_id()).select("_row", "doc_id", "text")
                   .mapInArrow(_index(window, prefix), INDEX), "substring-index")
    first = (index.filter("doc_id is not null").groupBy(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"))
             .agg(F.min(F.struct("doc_id", "_row")).alias("m")).select("_c1", "_c2", F.col("m.doc_id").alias("least"),
                                                                      F.col("m._row").alias("rep")))
    ids = index.join(first, (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")), "left").drop("_c1", "_c2")
    # of equal rows one stands for all
    own = ids.filter("doc_id = least and _row = rep").select("_row", "doc_id", F.inline(F.arrays_zip("own", "count"))).withColumnRenamed(
        "own", "key")
    shared = (own.groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                                          F.sum("count").alias("rows")).filter("lo < hi"))
    marks = (own.join(shared, F.col("key") == F.col("_key")).groupBy(F.col("_row").alias("_r"))
             .agg(F.collect_list(F.struct("key", (F.col("rows") > hot_rows).alias("hot"))).alias("shared")))
    wanted = marks.join(index.select("_row", F.col("doc_id").alias("_id"), "c1", "c2", "pos", "key"), F.col("_r") == F.col("_row"))
    shape = ("_row bigint, doc_id bigint, pos array<int>, key array<bigint>, shared array<struct<key:bigint,hot:boolean>>, "
             "text binary")
    suspects = stored(
        rows.join(wanted, F.col("doc_id") == F.col("_id")).select("_row", "doc_id", "c1", "c2", "pos", "key", "shared", "text")
        .mapInArrow(_matching, shape).dropDuplicates(["_row"]), "substring-suspects")

    def suffixes(hot: bool) -> DataFrame:
        return suspects.filter(F.exists("shared", lambda x: x["hot"] == F.lit(hot))).mapInArrow(
            _suffixes(window, prefix, hot), SUFFIX)
    normal = suffixes(False).repartition("key").sortWithinPartitions("key").mapInArrow(
        _trees(window, prefix, tree_rows), "_row bigint, start bigint, stop bigint")
    stretches = normal.unionByName(_deep_prefixes(suffixes(True), window, prefix))
    return ids, suspects, stretches


def repeated_spans(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, tree_rows: int = TREE_ROWS,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stretches of repeated words, overlapping where several windows do: doc_id, start, stop (word numbers from 0)."""
    ids, _, stretches = _build(docs, window, prefix, tree_rows, hot_rows)
    copies = ids.filter((F.col("doc_id") > F.col("least")) & (F.col("n_words") >= window)).select(
        "doc_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop"))
    rows = ids.filter("doc_id = least").select(F.col("rep").alias("_row"), "doc_id")
    return stretches.join(rows, "_row").select("doc_id", "start", "stop").unionByName(copies)


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, tree_rows: int = TREE_ROWS,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    ids, suspects, stretches = _build(docs, window, prefix, tree_rows, hot_rows)
    spans = stretches.groupBy(F.col("_row").alias("_r")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = (suspects.select("_row", "text").join(spans, F.col("_row") == F.col("_r")).select("_row", "text", "spans")
           .mapInArrow(_kept, "_row bigint, n_removed bigint, kept_sha string")
           .select(F.col("_row").alias("_k"), "n_removed", "kept_sha"))
    copy = F.coalesce((F.col("doc_id") > F.col("least")) & (F.col("n_words") >= window), F.lit(False))
    own = F.when(F.col("doc_id") == F.col("least"), F.col("rep")).otherwise(F.col("_row"))
    return (ids.select(own.alias("_own"), "doc_id", "n_words", "sha", "least").join(cut, F.col("_own") == F.col("_k"), "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256")))
