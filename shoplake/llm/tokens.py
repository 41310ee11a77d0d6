"""Token ids as ORC files.

Each document becomes one row (doc_id, n_tokens, crc32, ids): the ids of its
whole text and an end id.  The files hold the documents in ascending doc_id
order, also across files (part numbers follow the ranges).  ORC stores the ids
with its integer run-length encoding, in stripes of ``STRIPE_BYTES`` with row
indexes, and keeps a Bloom filter on doc_id, so readers work stripe by stripe
in parallel and a filter on doc_id skips stripes by their statistics.

Scale: the ranges, of doc_id and a hash of the text so that a repeated id can be split, are found on the rows as read, then each task encodes and
sorts the documents of one range, one Arrow batch at a time.  Text crosses the
network once, ids never do.  The place of a document in the token stream is a
running sum within its file plus the sum of the files before, which are one
row each.

Pieces and words between spaces or line feeds are encoded once per task and remembered
(twice ``CACHED_WORDS`` at most); white space separates this vocabulary's tokens, so
the ids are those of the whole text.

Edge cases: null text gives the end id alone; equal doc_ids stay as separate
rows, in no particular order among themselves; null doc_ids come first; an
empty table gives no rows; other columns are not written.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.session import shared_dir

END_ID = 1
STRIPE_BYTES = 32 << 20
CACHED_WORDS = 400_000
TOKENIZER = "word_bpe_49k.json"
ENCODED = "doc_id bigint, n_tokens bigint, crc32 bigint, ids array<int>"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_symbols() -> dict[int, str]:
    """Byte-level BPE writes a byte as the Latin-1 character of its value if that is visible, else as 256, 257, ..."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Words:
    """Ids of the words between spaces, as little-endian 32-bit integers.

    Remembers two generations of up to ``cached`` words: when the younger is full it becomes the
    older one, and words met again move back.

    A text of printable ASCII and Latin-1 letters is cut by the vocabulary's own pre-tokenizer
    rule and its pieces, as byte symbols, go to the BPE model, once each while they are remembered.
    Any other text is taken word by word: such words in the same way, any other word, and any that
    may hold a special token, through the whole tokenizer.
    """

    # FIXED VALUES: such words, and the pre-tokenizer's pattern for them in lower case
    PLAIN = r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
    PLAIN_TEXT = r"[ \n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*"
    PIECES = (r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d"
              r"|[^ \na-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    # the rules of a vocabulary that this holds for; texts go through any other tokenizer whole
    RULES = {
        "normalizer": {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
             "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    }

    def __init__(self, path: str, cached: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        self.by_words = all(json.dumps(rules[k], sort_keys=True) == json.dumps(v, sort_keys=True) for k, v in self.RULES.items())
        self.cached = cached
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut = re.compile(self.PIECES).findall
        self.plain = re.compile(self.PLAIN).fullmatch
        self.plain_text = re.compile(self.PLAIN_TEXT).fullmatch
        self.symbols = _byte_symbols()
        self.forget()

    def forget(self) -> None:
        """The words of the last generation stay at hand, so that frequent ones are not learned anew."""
        self.older, self.known = self.known, {"": b""}

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= self.cached:
                self.older_pieces, self.pieces = self.pieces, {}
            got = self.older_pieces.get(piece)
            if got is not None:
                self.pieces[piece] = got
                return got
            symbols = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.symbols)
            ids = [t.id for t in self.model.tokenize(symbols)]
            got = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def _learn(self, words: set) -> None:
        rest = []
        for w in words:
            ids = self.older.get(w)
            if ids is not None:
                self.known[w] = ids
            elif self.plain(w) and "<|" not in w and len(w) <= 100:
                self.known[w] = b"".join(map(self._piece, self.cut(w.lower())))
            else:
                rest.append(w)
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            self.known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, text: str | None) -> bytes:
        if not self.by_words:
            ids = self.tokenizer.encode(text or "", add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        text = text or ""
        if "<|" not in text and self.plain_text(text):
            pieces = self.cut(text.lower())
            got = list(map(self.pieces.get, pieces))
            at = -1
            for _ in range(got.count(None)):
                at = got.index(None, at + 1)
                got[at] = self._piece(pieces[at])
            return b"".join(got)
        words = text.replace("\n", " ").split(" ")
        got = list(map(self.known.get, words))
        if None in got:
            new = {w for w, ids in zip(words, got) if ids is None}
            if len(self.known) + len(new) > self.cached:
                self.forget()
                new = set(words) - {""}
            self._learn(new)
            got = list(map(self.known.get, words))
        return b"".join(got)


def _worker_words(path: str, cached: int) -> _Words:
    """The word store of this Python worker, kept for its later tasks.

    Functions reach a worker by value, without this module, so the store hangs on a module of the worker's own.
    """
    import sys
    import types
    state = sys.modules.setdefault("_token_words", types.ModuleType("_token_words")).__dict__
    key = f"{path}:{cached}"
    if key not in state:
        state[key] = _Words(path, cached)
    return state[key]


def _encoder(path: str, end_id: int, cached: int):
    """A function over Arrow batches (doc_id, text)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        encode, end = _worker_words(path, cached).encode, struct.pack("<I", end_id)
        for batch in batches:
            rows = [encode(text) + end for text in batch.column("text").to_pylist()]
            lengths = np.array([len(r) // 4 for r in rows], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "n_tokens", "crc32", "ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 stripe_bytes: int = STRIPE_BYTES, cached_words: int = CACHED_WORDS) -> None:
    """Encode ``text`` and write the ORC files, ordered by doc_id."""
    tokenizer = tokenizer or tokenizer_path()
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id"))
    encoded = ranged.mapInArrow(_encoder(tokenizer, end_id, cached_words), ENCODED)
    (encoded.write.option("orc.stripe.size", stripe_bytes).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.create.index", "true").option("orc.compress", "ZSTD").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on doc_id prune stripes."""
    return spark.read.schema(ENCODED).orc(path)


def token_stream(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ids_crc32 is computed from the ids read back and must equal the stored one.
    """
    rows = spark.read.schema(ENCODED).orc(path).select(
        "doc_id", "n_tokens", "crc32", "ids", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    read = rows.mapInArrow(_checked, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, file string, block bigint, seq bigint")
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    starts = files.select(F.col("file").alias("_file"),
                          F.coalesce(F.sum("file_tokens").over(earlier), F.lit(0)).alias("file_start"))
    inside = (Window.partitionBy("file").orderBy("doc_id", "block", "seq")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = read.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return (placed.join(starts, F.col("file") == F.col("_file"))
            .select("doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def _checked(batches):
    import numpy as np
    import pyarrow as pa
    seq = 0
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        sums = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        counts = np.diff(offsets)
        if sums != batch.column("crc32").to_pylist() or counts.tolist() != batch.column("n_tokens").to_pylist():
            raise ValueError("token file damaged: ids do not match their checksum or count")
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), batch.column("file"),
             batch.column("block"), pa.array(range(seq, seq + n), pa.int64())],
            names=["doc_id", "n_tokens", "ids_crc32", "file", "block", "seq"])
        seq += n


def encode_corpus(docs: DataFrame, path: str | None = None, **params) -> DataFrame:
    """Write the files (to a new folder of the shared directory by default) and return their token stream."""
    path = path or shared_dir(docs.sparkSession, "llm-tokens")
    write_tokens(docs, path, **params)
    return token_stream(docs.sparkSession, path)
