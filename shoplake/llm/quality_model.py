"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), with the
pair sum computed in time linear in the features as
1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

Features of a document (never its labels, lang, source or doc_id):

* words, lower-cased, hashed to ``BUCKETS`` buckets, with log counts scaled to unit length;
* structure: shares of symbols, upper case, digits, ``!`` and ``|``, distinct, longest,
  most frequent and doubled words, repeated lines, word length;
* metadata: the length of the text as log of words and of characters.

Training: labelled rows outside the held-out fold, at most ``TRAIN_ROWS`` of
them, those of least id hash.  Their features (a few MB, bounded by that number
and ``BUCKETS``) go to the driver, which fits by Adam in ``EPOCHS`` passes with
a fixed seed.  Scoring is one map over all documents; the model has
BUCKETS x (FACTORS + 1) numbers, a proven bound, and travels with the task.

Edge cases: null and empty texts have structure features only and get a score;
without any label the model is constant and every score 0.5; rows that repeat a
document are scored alike; rows of ``labels`` without id or label are ignored; a doc_id
labelled several times counts as often; an empty table gives no rows; a null doc_id counts as held out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
FACTORS = 6
TRAIN_ROWS = 20_000
EPOCHS = 6
BATCH = 128
RATE = 0.02
L2 = 1e-5
SEED = 7
FOLDS = 5
THRESHOLD = 0.3
N_STRUCTURE = 16


def fold(doc_id):
    """crc32 of the id as text, modulo ``FOLDS``; fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def features(text: bytes, buckets: int = BUCKETS):
    """(indices, values): hashed words, then the structure statistics at ``buckets`` and up."""
    import math
    from zlib import crc32
    import numpy as np
    words = text.lower().split()
    n, size = len(words), len(text)
    idx, val = np.zeros(0, dtype=np.int64), np.zeros(0)
    distinct, doubled, frequent = 0, 0.0, 0.0
    if n:
        hashed = np.fromiter(map(crc32, words), dtype=np.int64, count=n)
        distinct = len(np.unique(hashed))
        doubled = float((hashed[1:] == hashed[:-1]).mean()) if n > 1 else 0.0
        idx, counts = np.unique(hashed & (buckets - 1), return_counts=True)
        frequent = counts.max() / n
        val = np.log1p(counts)
        val = val / np.sqrt((val * val).sum())

    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / max(size, 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper, digits = share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"0123456789")
    stats = [1.0, math.log1p(n) / 8, math.log1p(size) / 10, 4 * share(b"#*$%&<>"), 2 * upper, 4 * digits, 8 * share(b"!"),
             8 * share(b"|"), 4 * share(b".,;:?"), distinct / max(n, 1), 1 - len(set(lines)) / max(len(lines), 1),
             (size / max(n, 1)) / 10, min(max(map(len, words), default=0), 100) / 50, math.log1p(len(lines)) / 5,
             2 * doubled, frequent]
    return (np.concatenate([idx, np.arange(buckets, buckets + N_STRUCTURE)]),
            np.concatenate([val, np.array(stats)]))


def pair_sum(v, val):
    """Sum over pairs of <v_i, v_j> x_i x_j by the sum-of-squares identity; v: rows of the present features."""
    vx = v * val[:, None]
    s = vx.sum(axis=0)
    return 0.5 * float((s * s).sum() - (vx * vx).sum())


def fit(rows: list, labels, buckets: int = BUCKETS, factors: int = FACTORS, epochs: int = EPOCHS, batch: int = BATCH,
        rate: float = RATE, l2: float = L2, seed: int = SEED):
    """Adam on the logistic loss.  rows: (indices, values) each; returns (w0, w, v)."""
    import numpy as np
    rng = np.random.default_rng(seed)
    dims = buckets + N_STRUCTURE
    # column 0: linear weights, the others: factors
    p = np.concatenate([np.zeros((dims, 1)), rng.normal(0, 0.05, (dims, factors))], axis=1)
    w0, y = 0.0, np.asarray(labels, dtype=float)
    m, s, step = np.zeros_like(p), np.zeros_like(p), 0
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            own = order[at:at + batch]
            idx = np.concatenate([rows[i][0] for i in own])
            val = np.concatenate([rows[i][1] for i in own])
            sizes = np.array([len(rows[i][0]) for i in own])
            cut = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vx = p[idx] * val[:, None]
            sums = np.add.reduceat(vx, cut, axis=0)
            squares = np.add.reduceat(vx[:, 1:] ** 2, cut, axis=0)
            z = w0 + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(axis=1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) / len(own)
            e = np.repeat(err, sizes)[:, None]
            g_rows = np.concatenate([e * val[:, None], e * val[:, None] * (np.repeat(sums[:, 1:], sizes, axis=0) - vx[:, 1:])], axis=1)
            g = np.stack([np.bincount(idx, g_rows[:, k], dims) for k in range(p.shape[1])], axis=1) + l2 * p
            step += 1
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
            w0 -= rate * float(err.sum())
    return w0, p[:, 0].copy(), p[:, 1:].copy()


def score_text(text: bytes, model) -> float:
    import math
    w0, w, v = model
    idx, val = features(text, len(w) - N_STRUCTURE)
    z = w0 + float(w[idx] @ val) + pair_sum(v[idx], val)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``train_rows`` labelled texts of the learning folds: text, quality."""
    chosen = (labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
              .filter("_id is not null and quality is not null").filter(fold(F.col("_id")) != 0)
              .orderBy(F.xxhash64("_id"), "_id", "quality").limit(train_rows))
    # at most train_rows rows of two numbers: a proven bound for the broadcast
    return docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "quality")


def _featured(buckets: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            rows = [features(t, buckets) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))],
                names=["doc_id", "quality", "idx", "val"])
    return run


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, buckets: int = BUCKETS, **params):
    """The model (w0, w, v), fitted on the driver from a bounded set of feature rows."""
    import numpy as np
    picked = training_rows(docs, labels, train_rows)
    kind = picked.schema["doc_id"].dataType.simpleString()
    # doc_ids may repeat in documents, so the bound is applied to the joined rows again
    got = picked.mapInArrow(_featured(buckets), f"doc_id {kind}, quality int, idx array<int>, val array<float>").orderBy(
        F.xxhash64("doc_id"), "quality", F.xxhash64("idx", "val")).limit(train_rows).toArrow()
    idx, val = got.column("idx").combine_chunks(), got.column("val").combine_chunks()
    flat_i, flat_v = idx.values.to_numpy(), val.values.to_numpy()
    cut = idx.offsets.to_numpy() if len(got) else np.zeros(1, dtype=int)
    rows = [(flat_i[a:b], flat_v[a:b].astype(float)) for a, b in zip(cut[:-1], cut[1:])]
    return fit(rows, got.column("quality").to_numpy(), buckets, **params)


def _scorer(model):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            scores = [score_text(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "score"])
    return run


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(_scorer(model), f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
