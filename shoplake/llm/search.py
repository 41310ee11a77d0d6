"""Ranked lexical search over bit-sliced Bloom signatures.

``build_index`` reads every whole text once and writes blocks of documents.  A
block is a matrix of bits: column = document, row = one bit position of the
documents' Bloom signatures.  A signature holds (term, level) entries; a term
that occurs tf times enters every level of ``LEVELS`` up to tf.  The rows of a
term's bits, and-ed, are the bitmap of the documents that may hold it at that
level: false bits are possible, missing ones are not.

A search turns the bitmaps of its terms into upper bounds: the levels found for
a document bound tf from above, a term's score grows with tf, and the weighted
slices add up to a bound on the document's score.  The documents with the
greatest bounds are scored exactly first; their k-th score is a threshold that
the result must reach.  Every document whose bound reaches the threshold is
then scored exactly from its text, so the result is that of scoring all.

Scale: documents of similar size share a block, so long texts get wide
signatures and short ones narrow ones (about ``BITS`` bits per entry).  Blocks
are built within the scan tasks and never shuffled; a task holds at most
``BLOCK_BITS`` bits per size class.  The lexicon (term, document frequency) is
written with the blocks in pieces and summed for the searched terms only.  The
queries are taken in blocks of bounded size; per query and task at most
``seeds`` rows leave the first pass, and the second pass emits exactly the
documents that are not provably excluded, without a cap.  These meet the texts
in a join: broadcast when there are at most ``broadcast_pairs`` of them, an
ordinary one otherwise.

Edge cases: null or empty texts and items hold no term, such items return no
rows; equal (item_id, text) rows of the queries count as one query; repeated
documents are ranked one by one, ties by ascending doc_id with null last, then
by a hash of the text; an empty table gives no rows; only doc_id, item_id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.session import shared_dir

from .common import stored, text_of

BITS = 10
HASHES = 5
BLOCK_DOCS = 4096
BLOCK_BITS = 1 << 22
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 4096, 16384, 65536)
LEXICON_PIECE = 400_000
TOP_K = 10
SEEDS = 40
QUERY_CHARS = 4_000_000
QUERY_ITEMS = 1000
BROADCAST_PAIRS = 500_000
INDEX = ("width int, ids array<bigint>, marks array<bigint>, lengths array<bigint>, slices binary, "
         "term binary, df bigint, n_docs bigint, n_terms bigint")

# ASCII letters and digits and all other characters belong to terms; A-Z are lower-cased, the rest separates
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return (text or b"").translate(_TERM_BYTES).split()


def _bit_rows(hashes, level: int, width: int):
    """Bit positions (entries x HASHES) of (term hash, level) in signatures of ``width`` bits."""
    import numpy as np
    h = hashes + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((a[:, None] + steps * b[:, None]) % np.uint64(width)).astype(np.int64)


def _indexer(bits: int, block_docs: int, block_bits: int, lexicon_piece: int):
    """Arrow batches (doc_id, mark, text) -> rows of INDEX."""
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest
        levels = np.array(LEVELS)
        known: dict[bytes, int] = {}
        lexicon: Counter = Counter()
        classes: dict[int, list] = {}
        n_docs = n_terms = 0
        schema = pa.schema([("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()), ("term", pa.binary()),
                            ("df", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])

        def rows(**cols):
            n = len(next(iter(cols.values())))
            return pa.RecordBatch.from_arrays([pa.array(cols.get(f.name, [None] * n), f.type) for f in schema], schema=schema)

        def block(width: int, members: list):
            matrix = np.zeros((width, len(members)), dtype=bool)
            hashes, depth = (np.concatenate([m[i] for m in members]) for i in (3, 4))
            column = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])
            for level in range(int(depth.max())):
                at = np.flatnonzero(depth > level)
                matrix[_bit_rows(hashes[at], level, width), column[at][:, None]] = True
            return rows(width=[width], ids=[[m[0] for m in members]], marks=[[m[1] for m in members]],
                        lengths=[[m[2] for m in members]], slices=[np.packbits(matrix, axis=1).tobytes()])

        def words():
            return rows(term=list(lexicon), df=list(lexicon.values()))

        for batch in batches:
            for doc_id, mark, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "text"))):
                counts = Counter(terms_of(text))
                if not counts:
                    continue
                if len(known) > lexicon_piece:
                    known.clear()
                known.update((t, xxh64_intdigest(t)) for t in counts if t not in known)
                n = counts.total()
                n_docs, n_terms = n_docs + 1, n_terms + n
                lexicon.update(counts.keys())
                hashes = np.fromiter(map(known.__getitem__, counts), np.uint64, len(counts))
                depth = np.searchsorted(levels, np.fromiter(counts.values(), np.int64, len(counts)), side="right")
                size = max(64, 1 << int(depth.sum() - 1).bit_length())
                members = classes.setdefault(size, [])
                members.append((doc_id, mark, n, hashes, depth))
                if len(members) >= min(block_docs, max(1, block_bits // (size * bits))):
                    yield block(size * bits, classes.pop(size))
                if len(lexicon) >= lexicon_piece:
                    yield words()
                    lexicon.clear()
        for size, members in classes.items():
            yield block(size * bits, members)
        if lexicon:
            yield words()
        if n_docs:
            yield rows(n_docs=[n_docs], n_terms=[n_terms])
    return run


@dataclass
class Index:
    """A written index: its rows, and the documents it was made of."""
    rows: DataFrame
    docs: DataFrame
    n_docs: int
    n_terms: int


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, mark, text; the mark (a hash of the text) names a row where ids are missing or repeated."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of("text")).alias("mark"),
                       text_of("text").cast("binary").alias("text"))


def build_index(docs: DataFrame, path: str | None = None, bits: int = BITS, block_docs: int = BLOCK_DOCS,
                block_bits: int = BLOCK_BITS, lexicon_piece: int = LEXICON_PIECE) -> Index:
    """Write the index of ``docs`` (to a new folder of the shared directory by default)."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "llm-search-index")
    _marked(docs).mapInArrow(_indexer(bits, block_docs, block_bits, lexicon_piece), INDEX).write.parquet(path)
    return open_index(spark, path, docs)


def open_index(spark: SparkSession, path: str, docs: DataFrame) -> Index:
    """An index that ``build_index`` wrote for ``docs``."""
    rows = spark.read.schema(INDEX).parquet(path)
    total = rows.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
    return Index(rows, docs, total["n"] or 0, total["t"] or 0)


@dataclass
class _Queries:
    """One block of queries: ids, and per query its distinct terms with weight x occurrences."""
    ids: list
    terms: list            # distinct terms of the block
    of: list               # per query: positions in ``terms``
    weights: list          # per query: weight x occurrences of these terms


def _query_block(index: Index, items: DataFrame) -> _Queries:
    """Reads a block's items (bounded by QUERY_CHARS and QUERY_ITEMS) and their document frequencies."""
    import math
    from collections import Counter
    read = items.toArrow()
    counts = [Counter(terms_of(t)) for t in read.column("text").to_pylist()]
    terms = sorted(set().union(*counts))
    spark = index.rows.sparkSession
    wanted = spark.createDataFrame([(t,) for t in terms], "term binary")
    df = dict((bytes(r["term"]), r["df"]) for r in index.rows.where("term is not null").join(F.broadcast(wanted), "term")
              .groupBy("term").agg(F.sum("df").alias("df")).collect())
    terms = [t for t in terms if t in df]
    weight = {t: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df[t] + 1))) for t in terms}
    place = {t: i for i, t in enumerate(terms)}
    of = [[place[t] for t in c if t in place] for c in counts]
    return _Queries(read.column("item_id").to_pylist(), terms, of,
                    [[c[t] * weight[t] for t in c if t in place] for c in counts])


def _length_norm(n, index_docs: int, index_terms: int):
    return 25 + (75 * n * index_docs) // index_terms


def _bounds(q: _Queries, n_docs: int, n_terms: int):
    """A function: Arrow row of a block -> upper bounds (queries x documents)."""
    import numpy as np
    from xxhash import xxh64_intdigest
    hashes = np.array([xxh64_intdigest(t) for t in q.terms], dtype=np.uint64)
    top = np.array([x - 1 for x in LEVELS[1:]] + [np.iinfo(np.int32).max])      # most occurrences at so many levels
    chunk = 512
    inside = []                                            # per chunk of terms: (query, own positions, weights)
    for low in range(0, len(hashes), chunk):
        part = []
        for i, (of, w) in enumerate(zip(q.of, q.weights)):
            got = [(t - low, x) for t, x in zip(of, w) if low <= t < low + chunk and x]
            if got:
                part.append((i, np.array([g[0] for g in got]), np.array([g[1] for g in got], dtype=np.int64)))
        inside.append(part)

    def bounds(width: int, lengths, slices: bytes):
        n = len(lengths)
        bitmap = np.frombuffer(slices, dtype=np.uint8).reshape(width, -1)
        m = _length_norm(lengths, n_docs, n_terms)
        tf = np.minimum(top[:, None], lengths)
        worth = np.zeros((len(LEVELS) + 1, n), dtype=np.int64)
        worth[1:] = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
        out = np.zeros((len(q.ids), n), dtype=np.int64)
        for low, part in zip(range(0, len(hashes), chunk), inside):
            own = hashes[low:low + chunk]
            found = np.zeros((len(own), n), dtype=np.uint8)
            alive, now = np.arange(len(own)), None
            for level in range(len(LEVELS)):
                rows = np.bitwise_and.reduce(bitmap[_bit_rows(own[alive], level, width)], axis=1)
                now = rows if now is None else now & rows
                left = now.any(axis=1)
                alive, now = alive[left], now[left]
                if not len(alive):
                    break
                found[alive] += np.unpackbits(now, axis=1, count=n)
            gain = np.take_along_axis(worth, found.astype(np.intp), axis=0)
            for i, terms, w in part:
                out[i] += w @ gain[terms]
        return out
    return bounds


def _block_rows(batches):
    import numpy as np
    for batch in batches:
        for r in batch.to_pylist():
            yield r["width"], np.array(r["ids"], dtype=object), np.array(r["marks"], dtype=np.int64), np.array(
                r["lengths"], dtype=np.int64), r["slices"]


PAIR = "item_no int, bound bigint, doc_id bigint, mark bigint"


def _pairs(item, bound, ids, marks):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array(bound, pa.int64()), pa.array(list(ids), pa.int64()), pa.array(marks, pa.int64())],
        names=["item_no", "bound", "doc_id", "mark"])


def _greatest(q: _Queries, n_docs: int, n_terms: int, seeds: int):
    """Per task and query the ``seeds`` documents with the greatest bounds."""
    def run(batches):
        import numpy as np
        bounds = _bounds(q, n_docs, n_terms)
        best: dict[int, tuple] = {}
        for width, ids, marks, lengths, slices in _block_rows(batches):
            for i, b in enumerate(bounds(width, lengths, slices)):
                at = np.flatnonzero(b)
                at = at[np.argpartition(-b[at], seeds)[:seeds]] if len(at) > seeds else at
                new = (b[at], ids[at], marks[at])
                if i in best:
                    new = tuple(np.concatenate([x, y]) for x, y in zip(best[i], new))
                    keep = np.argsort(-new[0], kind="stable")[:seeds]
                    new = tuple(x[keep] for x in new)
                best[i] = new
        for i, (b, ids, marks) in best.items():
            yield _pairs(np.full(len(b), i), b, ids, marks)
    return run


def _reaching(q: _Queries, n_docs: int, n_terms: int, least: dict):
    """Every document that is not provably below the threshold of a query: (score, doc_id) of its k-th seed."""
    def run(batches):
        import numpy as np
        bounds = _bounds(q, n_docs, n_terms)
        for width, ids, marks, lengths, slices in _block_rows(batches):
            for i, b in enumerate(bounds(width, lengths, slices)):
                score, doc_id = least.get(i, (1, None))
                at = np.flatnonzero(b >= score)
                if doc_id is not None:
                    # an equal score loses to the k seeds when its id comes later
                    at = np.array([x for x in at if b[x] > score or (ids[x] is not None and ids[x] <= doc_id)], dtype=np.int64)
                if len(at):
                    yield _pairs(np.full(len(at), i), b[at], ids[at], marks[at])
    return run


def _scorer(q: _Queries, n_docs: int, n_terms: int):
    """Arrow batches (doc_id, mark, text, items) -> exact scores."""
    def run(batches):
        from collections import Counter

        import pyarrow as pa
        for batch in batches:
            out = []
            for doc_id, mark, text, items in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "mark", "text", "items"))):
                terms = terms_of(text)
                tf, m = Counter(terms), _length_norm(len(terms), n_docs, n_terms)
                for i in items:
                    score = 0
                    for t, w in zip(q.of[i], q.weights[i]):
                        f = tf.get(q.terms[t])
                        if f:
                            score += w * ((1_000_000_000 * f) // (1000 * f + 8 * m))
                    if score > 0:
                        out.append((i, q.ids[i], doc_id, mark, score))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["item_no", "item_id", "doc_id", "mark", "score"])
    return run


def _scored(index: Index, q: _Queries, pairs: DataFrame, broadcast_pairs: int, name: str) -> DataFrame:
    """Exact scores of (item_no, doc_id, mark) pairs, from the texts."""
    pairs = stored(pairs, f"search-{name}")
    wanted = pairs.groupBy("doc_id", "mark").agg(F.collect_set("item_no").alias("items")).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "items")
    if pairs.count() <= broadcast_pairs:
        wanted = F.broadcast(wanted)
    met = _marked(index.docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    return met.select("doc_id", "mark", "text", "items").mapInArrow(
        _scorer(q, index.n_docs, index.n_terms), "item_no int, item_id bigint, doc_id bigint, mark bigint, score bigint")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "mark")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: Index, q: _Queries, k: int, seeds: int, broadcast_pairs: int) -> DataFrame:
    blocks = index.rows.where("width is not null").select("width", "ids", "marks", "lengths", "slices")
    size = (index.n_docs, index.n_terms)
    greatest = blocks.mapInArrow(_greatest(q, *size, seeds), PAIR)
    order = Window.partitionBy("item_no").orderBy(F.col("bound").desc(), F.col("doc_id").asc_nulls_last(), "mark")
    first = greatest.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= seeds).drop("_r")
    kth = _best(_scored(index, q, first, broadcast_pairs, "seeds"), k).where(F.col("rank") == k)
    least = {r["item_no"]: (r["score"], r["doc_id"]) for r in kth.collect()}           # a row per query of the block
    reaching = blocks.mapInArrow(_reaching(q, *size, least), PAIR)
    return _best(_scored(index, q, reaching, broadcast_pairs, "pairs"), k)


def search(index: Index, items: DataFrame, k: int = TOP_K, seeds: int = SEEDS, query_chars: int = QUERY_CHARS,
           query_items: int = QUERY_ITEMS, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").cast("binary").alias("text")).distinct()
    total = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.count("*").alias("n")).first()
    n_blocks = max(1, -(-total["chars"] // query_chars), -(-total["n"] // query_items))
    out = None
    for b in range(n_blocks if index.n_docs else 0):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        found = stored(_search_block(index, _query_block(index, own), k, seeds, broadcast_pairs)
                       .select("item_id", "rank", "doc_id", "score"), "search-found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return index.rows.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out
