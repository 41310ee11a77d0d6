"""Jaccard join of documents on word n-grams, by token-combination prefixes.

A document's set holds its distinct 4-word shingles.  Two documents link when
their sets share at least 85 of 100 of their union.  A set of size n that links
at all shares t = ceil(0.85 n) tokens with its partner, so at most e = n - t of
its tokens are not shared.

Tokens fall in two classes: rare ones and frequent ones (in more documents than
a threshold).  All sets are ordered rare first, then by hash.  A set's prefix is
indexed: each rare token alone, and frequent tokens as pairs of the same group
(hash modulo a number of groups).  To leave a prefix without a common signature,
e misses must hit every rare token and all but one token of each group; so the
prefix is extended until that takes more than e misses.  The common tokens
within the prefixes of two linked sets are initial parts of one ordered list,
and the shorter part holds a signature: both index it.  Groups are as many as an
eighth of the size class, so a prefix has a linear number of signatures; a set
whose partners may be in the class below is indexed for both.

Sets that share a signature are verified on their whole sets.  First each is
compared with one centre of its list; connected components settle most lists at
once.  Longer lists (more than ``SHORT`` sets) that still hold several components
get a second centre, picked by a hash that differs from list to list, so a set
meets many others of its group.  In lists with sets of several components, all pairs over component
borders (of sizes that can link) are judged, so no link between components is missed.

Scale: work is on distinct sets, a group of copies is one.  Document
frequencies are counted over all documents: tasks send sorted, delta-coded 48-bit
hashes (about four bytes each), parts of about ``PART_TOKENS`` are counted apart, and
only frequent hashes come back, as a bitmap of at most ``BITMAP_BITS``.  A
hash collision there only moves a token to the other class, for all documents alike,
and the class never decides a link.  The threshold doubles until the frequent
tokens fit the bitmap.  Lists are streamed in sorted order; long ones are cut
into blocks before pairs over component borders are made.  A candidate pair is
first judged by parity bitmaps of about a bit per token: where they differ, the
sets differ, so a pair with more such bits than a link allows is none.  Bitmaps
folded to ``SKETCH_BITS`` travel with the members of lists over borders, and a task
judges the pairs there.  Those left never become rows, which would grow with the
square of a group: the sets that they connect leave the task as clusters, one row
per set.  A pair that meets in many lists is left to the list of the least signature that both
sets hold among their ``LOW`` least ones, if there is one.  Clusters are then cut by the
unfolded bitmaps.  Where the whole sets of a cluster
meet, its pairs are verified until links join its components, so it gives fewer links
than it has sets.  Whole sets, made again from the texts, travel only for clusters and for
the pairs of sets with centres that the bitmaps leave.

Sets are 64-bit hashes of shingles, and a distinct set is named by 64 bits over
its size and members: two of N distinct sets share a name with probability of
about N * N / 2^65.

Edge cases: null texts and texts without words have the empty set and link with
nothing, fewer than four words are one token; documents with equal sets link (a
null doc_id too, but the component is named by the least id there is, null if
none); repeated rows stay; an empty table gives no rows; only doc_id and text
are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .graph import components

SHINGLE_WORDS = 4
PERCENT = 85
FREQUENT = 8
PART_TOKENS = 2_000_000
BITMAP_BITS = 1 << 27
SKETCH_BITS = 512
SHORT = 8
LOW = 4
BLOCK = 1024
BROADCAST_DOCS = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: bytes | None, size: int = SHINGLE_WORDS):
    """The sorted distinct 64-bit hashes of a text's shingles.

    Words are hashed anew each time: looking them up among a million known ones misses the processor's caches and takes longer.
    """
    import numpy as np
    from xxhash import xxh64_intdigest
    words = (text or b"").translate(_LOWER).split()        # splits at exactly \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    k = min(size, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _name(tokens) -> int:
    """The set's name as a signed 64-bit number."""
    from xxhash import xxh64_intdigest
    x = xxh64_intdigest(tokens.tobytes(), len(tokens))
    return x - (1 << 64) if x >> 63 else x


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of("text")).alias("mark"),
                       text_of("text").cast("binary").alias("text"))


def _parity(tokens) -> bytes:
    """A power of two of bits, one per token at least: bit i is the parity of the tokens that hash to i."""
    import numpy as np
    width = max(SKETCH_BITS, 1 << (len(tokens) - 1).bit_length())
    at = (tokens >> np.uint64(20)).astype(np.int64) & (width - 1)
    return np.packbits(np.bincount(at, minlength=width) & 1).tobytes()


def parity_difference(x: bytes, y: bytes) -> int:
    """At most the size of the symmetric difference of the two sets; the wider bitmap is folded."""
    import numpy as np
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    w = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(z.reshape(-1, w), axis=0) for z in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def fold(bits: bytes, width: int = SKETCH_BITS // 8) -> bytes:
    """A parity bitmap folded to ``width`` bytes."""
    import numpy as np
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, width), axis=0).tobytes()


def _folded(batches):
    """Arrow batches (node, bits) -> (node, sketch): parity bitmaps folded to ``SKETCH_BITS``."""
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([fold(b) for b in batch.column("bits").to_pylist()], pa.binary())], names=["node", "sketch"])


def most_different(sizes, percent: int = PERCENT):
    """The greatest symmetric difference of two sets that link, from the sum of their sizes."""
    return sizes - 2 * -(-percent * sizes // (100 + percent))


def _sized(shingle: int):
    """Arrow batches (doc_id, mark, text) -> doc_id, mark, n, node, bits."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            sets = [shingles(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_name(s) for s in sets], pa.int64()), pa.array([_parity(s) if len(s) else b"" for s in sets], pa.binary())],
                names=["doc_id", "mark", "n", "node", "bits"])
    return run


def _packed(values, counts) -> bytes:
    """Sorted 48-bit numbers with counts: differences by byte planes, then place and count of those above one."""
    import numpy as np
    step = np.diff(values, prepend=np.uint64(0))
    planes = step.view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    many = np.flatnonzero(counts > 1)
    head = np.array([len(values), used, len(many)], dtype="<u4").tobytes()
    return head + planes[:used].tobytes() + many.astype("<u4").tobytes() + counts[many].astype("<u4").tobytes()


def _unpacked(blob: bytes):
    import numpy as np
    n, used, many = np.frombuffer(blob, "<u4", 3)
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[:used] = np.frombuffer(blob, np.uint8, used * n, 12).reshape(used, n)
    values = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)
    counts = np.ones(n, dtype=np.int64)
    at = 12 + int(used) * int(n)
    counts[np.frombuffer(blob, "<u4", many, at)] = np.frombuffer(blob, "<u4", many, at + 4 * int(many))
    return values, counts


def _token_parts(shingle: int, parts: int, flush: int):
    """Arrow batches (text) -> (part, blob): the tokens of many documents with their counts, by hash range."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held, size = [], 0

        def out():
            values, counts = np.unique(np.concatenate(held) >> np.uint64(16), return_counts=True)
            part = ((values * np.uint64(parts)) >> np.uint64(48)).astype(np.int64) if parts < 1 << 16 else \
                (values.astype(np.float64) * (parts / 2.0 ** 48)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = [*cuts[1:], len(part)]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[cuts], pa.int64()),
                 pa.array([_packed(values[a:b], counts[a:b]) for a, b in zip(cuts, ends)], pa.binary())], names=["part", "blob"])
        for batch in batches:
            for text in batch.column("text").to_pylist():
                tokens = shingles(text, shingle)
                if len(tokens):
                    held.append(tokens)
                    size += len(tokens)
                if size >= flush:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
    return run


def _counted(least: int):
    """The blobs of one part -> (key, df) of the tokens in more than ``least`` documents."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        got = [_unpacked(b) for b in table.column("blob").to_pylist()]
        values, where = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        df = np.bincount(where, weights=np.concatenate([g[1] for g in got])).astype(np.int64)
        own = df > least
        return pa.table({"key": pa.array(values[own].astype(np.int64)), "df": pa.array(df[own])})
    return run


def frequent_tokens(docs: DataFrame, tokens: int, shingle: int = SHINGLE_WORDS, least: int = FREQUENT,
                    part_tokens: int = PART_TOKENS, bitmap_bits: int = BITMAP_BITS):
    """Bitmap over the top 48 bits of token hashes (modulo its length): set for tokens in many documents."""
    import numpy as np
    parts = max(1, -(-tokens // part_tokens))
    blobs = docs.select(text_of("text").cast("binary").alias("text")).mapInArrow(
        _token_parts(shingle, parts, part_tokens), "part bigint, blob binary")
    counted = stored(blobs.groupBy("part").applyInArrow(_counted(least), "key bigint, df bigint"), "join-frequent")
    n = counted.count()
    while n * 16 > bitmap_bits:
        least = max(1, 2 * least)
        counted = counted.where(F.col("df") > least)
        n = counted.count()
    bits = min(bitmap_bits, max(1 << 16, 1 << (64 * max(1, n) - 1).bit_length()))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for batch in counted.select("key").toArrow().to_batches():        # at most bitmap_bits / 16 keys
        at = batch.column("key").to_numpy() % bits
        np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bitmap


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of size n shares with any set it links to."""
    return -(-percent * n // 100)


def signatures(tokens, bitmap, percent: int = PERCENT):
    """Signatures of a sorted set: hashes of single rare tokens and of pairs of frequent ones."""
    import numpy as np
    n = len(tokens)
    misses = n - least_shared(n, percent)
    at = (tokens >> np.uint64(16)).astype(np.int64) % (8 * len(bitmap))
    often = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    rare = tokens[~often][:misses + 1]
    if len(rare) > misses:
        return rare
    found, many = [rare], tokens[often]
    for size_class in {n.bit_length(), least_shared(n, percent).bit_length()}:
        groups = np.uint64(max(1, (1 << size_class) >> 4))
        group = many % groups
        order = np.argsort(group, kind="stable")
        ranked = group[order]
        later = np.zeros(len(many), dtype=np.int64)
        later[order[1:]] = ranked[1:] == ranked[:-1]              # not the first of its group
        end = int(np.searchsorted(np.cumsum(later), misses + 1 - len(rare))) + 1
        order = order[order < end]
        ranked, own = group[order], many[order]
        d = 1
        while d < len(own):
            pair = np.flatnonzero(ranked[d:] == ranked[:-d])
            if not len(pair):
                break
            h = (own[pair] * np.uint64(0xA0761D6478BD642F)) ^ (own[pair + d] + np.uint64(size_class))
            h *= np.uint64(0xE7037ED1A0B428DB)
            found.append(h ^ (h >> np.uint64(32)))
            d += 1
    return np.concatenate(found)


def _indexed(shingle: int, percent: int, bitmap):
    """Arrow batches (text) -> (sig, node, n); a set that the task has seen is not indexed again."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        seen = set()
        for batch in batches:
            sigs, nodes, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text, shingle)
                if len(tokens) < 2 or (node := _name(tokens)) in seen:    # a set of one links to its copies only
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                sigs.append(signatures(tokens, bitmap, percent))
                nodes.append(node)
                sizes.append(len(tokens))
            per = [len(s) for s in sigs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sigs or [np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.repeat(np.array(nodes, dtype=np.int64), per)),
                 pa.array(np.repeat(np.array(sizes, dtype=np.int32), per))], names=["sig", "node", "n"])
    return run


def _listed(percent: int):
    """Sorted Arrow batches (sig, n, node) -> members of lists of two or more, each with its centre.

    The centre is the first member whose size can link; rows of a list may span batches.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = [np.zeros(0, dtype=np.int64)] * 3
        last = None                                       # (sig, centre, its size) of the list that goes on

        def out(sig, n, node, last):
            new = np.concatenate([[True], (sig[1:] != sig[:-1])])
            keep = np.concatenate([[True], new[1:] | (node[1:] != node[:-1])])
            sig, n, node = sig[keep], n[keep], node[keep]
            cut = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([cut, [len(sig)]]))
            goes_on = last is not None and len(sig) and sig[0] == last[0]
            size_seen = size.copy()
            if goes_on:
                size_seen[0] += 1
            whole = np.repeat(size_seen > 1, size)
            first = np.repeat(cut, size)
            centre, centre_n = node[first].copy(), n[first].copy()
            if goes_on:
                centre[:size[0]], centre_n[:size[0]] = last[1], last[2]
            # lists that hold sizes too far apart get further centres
            wide = np.flatnonzero((100 * centre_n < percent * n) & whole)
            for at in np.unique(np.searchsorted(cut, wide, side="right") - 1):
                c, cn = centre[cut[at]], centre_n[cut[at]]
                for i in range(cut[at], cut[at] + size[at]):
                    if 100 * cn < percent * n[i]:
                        c, cn = node[i], n[i]
                    centre[i], centre_n[i] = c, cn
            now = (sig[-1], centre[-1], centre_n[-1])
            cols = [x[whole] for x in (sig, node, n, centre, centre_n)]
            return now, pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["sig", "node", "n", "centre", "centre_n"])
        for batch in batches:
            now = [np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, ("sig", "n", "node"))]
            whole = len(now[0]) and int(np.searchsorted(now[0], now[0][-1]))      # the last list may go on
            if not whole and len(now[0]) > 100_000:
                whole = len(now[0]) - 1                                     # a long list is streamed
            if whole:
                last, rows = out(*(x[:whole] for x in now), last)
                yield rows
            held = [x[whole:] for x in now]
        if len(held[0]):
            yield out(*held, last)[1]
    return run


def named_clusters(root, node):
    """(name, places) of the groups of two or more equal roots; the name is a hash of the group's nodes."""
    import numpy as np
    from xxhash import xxh64_intdigest
    order = np.lexsort((node, root))
    for own in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
        if len(own) > 1:
            yield xxh64_intdigest(node[own].tobytes()), own


def _border_clusters(percent: int):
    """Sorted Arrow batches (sig, a, b, mine, node, n, label, low, sketch) of whole units -> (cluster, node, label).

    A pair of different labels may link when its sizes allow it and the sketches differ in no more bits than the sets may
    differ in tokens.  Such pairs stay in the task: a cluster holds the sets of a unit that they connect, and is named by
    its sets, so that the same cluster of many units is one.  A pair that shares a lower one of its sets' least ``LOW``
    signatures is left to the list of that signature.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        names = ("sig", "a", "b", "mine", "node", "n", "label")
        held = [np.zeros(0, dtype=np.int64)] * len(names) + [
            np.zeros((0, LOW), dtype=np.int64), np.zeros((0, SKETCH_BITS // 64), dtype=np.uint64)]
        seen = set()

        def columns(batch):
            blob = b"".join(batch.column("sketch").to_pylist())
            return [batch.column(c).to_numpy().astype(np.int64) for c in names] + [
                batch.column("low").flatten().to_numpy().reshape(-1, LOW), np.frombuffer(blob, np.uint64).reshape(-1, SKETCH_BITS // 64)]

        def clusters_of(sig, a, b, mine, node, n, label, low, sketch):
            cut = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            found, rows = [], []
            for x, y in zip(cut, [*cut[1:], len(sig)]):
                root = None                               # of each set of the unit, where pairs have connected them
                for i in range(x, y - 1):
                    ok = (label[i + 1:y] != label[i]) & (percent * np.maximum(n[i], n[i + 1:y]) <= 100 * np.minimum(n[i], n[i + 1:y]))
                    if a[i] != b[i]:
                        ok &= mine[i + 1:y] != mine[i]
                    at = i + 1 + np.flatnonzero(ok)
                    if len(at):
                        apart = np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1, dtype=np.int64)
                        at = at[apart <= most_different(n[at] + n[i], percent)]
                    if len(at):
                        lower = low[i][low[i] < sig[i]]
                        at = at[~np.isin(low[at], lower).any(axis=1)]
                    if len(at):
                        root = np.arange(y - x) if root is None else root
                        joined = np.unique(root[np.append(at, i) - x])
                        if len(joined) > 1:
                            root[np.isin(root, joined)] = joined[0]
                if root is None:
                    continue
                for name, own in named_clusters(root, node[x:y]):
                    if name in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(name)
                    found.append(np.full(len(own), name, dtype=np.uint64))
                    rows.append(x + own)
            at = np.concatenate(rows or [np.zeros(0, np.int64)])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)), pa.array(node[at]), pa.array(label[at])],
                names=["cluster", "node", "label"])
        for batch in batches:
            now = [np.concatenate([h, c]) for h, c in zip(held, columns(batch))]
            whole = len(now[0])
            if whole:
                whole = int(np.flatnonzero((now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1]))[0])
            if whole:
                yield clusters_of(*(x[:whole] for x in now))
            held = [x[whole:] for x in now]
        if len(held[0]):
            yield clusters_of(*held)
    return run


def _clusters(batches, names):
    """Sorted Arrow batches -> the columns of one whole cluster after the other."""
    from itertools import groupby
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("cluster", *names))))
    for _, own in groupby(rows, key=lambda r: r[0]):
        yield list(zip(*own))[1:]


def _gathered(rows, names, most: int = 10_000):
    """Rows of 64-bit numbers -> Arrow batches."""
    from itertools import islice

    import pyarrow as pa
    rows = iter(rows)
    while part := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], names=names)


def near(n, label, bits, percent: int = PERCENT):
    """(i, places after i) of sets in order of size: those of other labels whose parity bitmaps leave a link with i possible.

    ``label`` may change between two steps.  Bitmaps are compared at the width of the smaller set, whose partners have at
    most twice that width.
    """
    import numpy as np
    widths = np.array([len(z) for z in bits])
    first = width = 0
    for i in range(len(n) - 1):
        at = i + 1 + np.flatnonzero((label[i + 1:] != label[i]) & (percent * n[i + 1:] <= 100 * n[i]))
        if not len(at):
            continue
        if width != widths[i]:
            first, width = i, int(widths[i])
            table = np.stack([np.frombuffer(fold(z, width), np.uint64) for z in bits[i:np.searchsorted(widths, 2 * width, side="right")]])
        apart = np.bitwise_count(table[at - first] ^ table[i - first]).sum(axis=1, dtype=np.int64)
        at = at[apart <= most_different(n[at] + n[i], percent)]
        if len(at):
            yield i, at


def _close_clusters(percent: int):
    """Batches (cluster, node, label, n, bits) sorted by cluster, n -> (cluster, node, label): clusters by the whole bitmaps."""
    def rows(batches):
        import numpy as np
        for node, label, n, bits in _clusters(batches, ("node", "label", "n", "bits")):
            node, label, root = np.array(node), np.array(label), np.arange(len(n))
            for i, at in near(np.array(n), label, bits, percent):
                joined = np.unique(root[np.append(at, i)])
                if len(joined) > 1:
                    root[np.isin(root, joined)] = joined[0]
            for name, own in named_clusters(root, node):
                name -= (1 << 64) if name >> 63 else 0
                yield from ((name, node[k], label[k]) for k in own)
    return lambda batches: _gathered(rows(batches), ["cluster", "node", "label"])


def _bridges(percent: int):
    """Batches (cluster, node, label, n, tokens) sorted by cluster, n -> (u, v): links that join the cluster's labels.

    Pairs of labels that links have not joined yet are verified on whole sets; a cluster gives fewer links than it has sets.
    """
    def rows(batches):
        import numpy as np
        for node, label, n, sets in _clusters(batches, ("node", "label", "n", "tokens")):
            sets, label = [np.frombuffer(t, np.uint64) for t in sets], np.array(label)
            for i, at in near(np.array(n), label, [_parity(t) for t in sets], percent):
                for j in at:
                    if label[i] != label[j] and linked(sets[i], sets[j], percent):
                        label[label == label[j]] = label[i]
                        yield min(node[i], node[j]), max(node[i], node[j])
    return lambda batches: _gathered(rows(batches), ["u", "v"])


def _with_sets(shingle: int):
    """Arrow batches (node, text) -> (node, tokens); each set once per task."""
    def run(batches):
        import pyarrow as pa
        seen = set()
        for batch in batches:
            nodes, blobs = [], []
            for node, text in zip(*(batch.column(c).to_pylist() for c in ("node", "text"))):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    blobs.append(shingles(text, shingle).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())], names=["node", "tokens"])
    return run


def _close(percent: int):
    """Arrow batches (u, v, n, m, x, y) -> (u, v) whose parity bitmaps leave a link possible."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            kept = [(u, v) for u, v, n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "n", "m", "x", "y")))
                    if parity_difference(x, y) <= most_different(n + m, percent)]
            us, vs = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


def linked(x, y, percent: int = PERCENT) -> bool:
    """Whether two sorted sets link."""
    import numpy as np
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _verified(percent: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            us, vs = [], []
            for u, v, x, y in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "x", "y"))):
                if linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


def _sets_of(docs: DataFrame, reps: DataFrame, nodes: DataFrame, shingle: int, broadcast_docs: int, name: str) -> DataFrame:
    """(node, tokens): the whole sets of ``nodes``, made again from the texts."""
    wanted = stored(reps.join(nodes, "node").select("node", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")),
                    f"join-wanted-{name}")
    keys = F.broadcast(wanted) if wanted.count() <= broadcast_docs else wanted
    texts = _marked(docs).join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    return stored(texts.select("node", "text").mapInArrow(_with_sets(shingle), "node bigint, tokens binary")
                  .dropDuplicates(["node"]), f"join-sets-{name}")


def _links(docs: DataFrame, reps: DataFrame, pairs: DataFrame, shingle: int, percent: int, broadcast_docs: int,
           name: str) -> DataFrame:
    """The pairs (u, v) of ``pairs`` whose whole sets link."""
    ends_of = [reps.select(F.col("node").alias(k), F.col("n").alias(n), F.col("bits").alias(b)) for k, n, b in (("u", "n", "x"), ("v", "m", "y"))]
    pairs = stored(pairs.join(ends_of[0], "u").join(ends_of[1], "v").select("u", "v", "n", "m", "x", "y")
                   .mapInArrow(_close(percent), "u bigint, v bigint"), f"join-close-{name}")
    sets = _sets_of(docs, reps, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), shingle, broadcast_docs, name)
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("tokens").alias("x")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("tokens").alias("y")), "v"))
    return stored(both.select("u", "v", "x", "y").mapInArrow(_verified(percent), "u bigint, v bigint"), f"join-links-{name}")


def _labelled(members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of the lists with the component of each set, and (sig, members) of the lists with several components."""
    parts = stored(components(found), "join-parts")
    labelled = stored(members.select("sig", "node", "n").join(parts, "node", "left").select(
        "sig", "node", "n", F.coalesce("root", "node").alias("label")), "join-labelled")
    split = labelled.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("members"))
    return labelled, stored(split.where("x <> y").select("sig", "members"), "join-split")


def _second_stars(labelled: DataFrame, split: DataFrame, percent: int, short: int = SHORT) -> DataFrame:
    """Pairs (u, v) of each set of a long list with the list's second centre, where components differ and sizes can link."""
    long = labelled.join(split.where(F.col("members") > short).select("sig"), "sig")
    centres = stored(long.groupBy("sig").agg(F.min(F.struct(F.xxhash64("sig", "node").alias("h"), "node", "n", "label")).alias("c"))
                     .select("sig", F.col("c.node").alias("c"), F.col("c.n").alias("cn"), F.col("c.label").alias("cl")), "join-centres")
    return (long.join(centres, "sig")
            .where((F.col("label") != F.col("cl")) & (100 * F.least("n", "cn") >= percent * F.greatest("n", "cn")))
            .select(F.least("node", "c").alias("u"), F.greatest("node", "c").alias("v")).distinct())


def similar_documents(docs: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT, frequent: int = FREQUENT,
                      part_tokens: int = PART_TOKENS, bitmap_bits: int = BITMAP_BITS, block: int = BLOCK,
                      broadcast_docs: int = BROADCAST_DOCS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id that links lead to)."""
    marked = _marked(docs)
    sized = stored(marked.mapInArrow(_sized(shingle), "doc_id bigint, mark bigint, n bigint, node bigint, bits binary"), "join-sizes")
    reps = stored(sized.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "mark")).alias("row"), F.first("n").alias("n"),
        F.first("bits").alias("bits")).select("node", "least", "row.doc_id", "row.mark", "n", "bits"), "join-sets")
    tokens = sized.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bitmap = frequent_tokens(docs, tokens, shingle, frequent, part_tokens, bitmap_bits)
    index = marked.select("text").mapInArrow(_indexed(shingle, percent, bitmap), "sig bigint, node bigint, n int")
    members = stored(index.repartition("sig").sortWithinPartitions("sig", "n", "node").mapInArrow(
        _listed(percent), "sig bigint, node bigint, n bigint, centre bigint, centre_n bigint"), "join-lists")
    stars = stored(members.where("centre <> node").select(
        F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v")).distinct(), "join-stars")
    found = _links(docs, reps, stars, shingle, percent, broadcast_docs, "stars")
    labelled, split = _labelled(members, found)
    again = stored(_second_stars(labelled, split, percent).join(stars, ["u", "v"], "left_anti"), "join-stars-again")
    found = stored(found.unionByName(_links(docs, reps, again, shingle, percent, broadcast_docs, "again")), "join-found")
    labelled, split = _labelled(members, found)
    split = split.select("sig", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    over = labelled.join(split, "sig")
    none = F.array_repeat(F.lit((1 << 63) - 1), LOW)
    lows = over.groupBy("node").agg(F.slice(F.concat(F.array_sort(F.collect_set("sig")), none), 1, LOW).alias("low"))
    sketches = reps.select("node", "bits").mapInArrow(_folded, "node bigint, sketch binary")
    units = over.join(lows, "node").join(sketches, "node").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select(
        "sig", "node", "n", "label", "low", "sketch", "mine", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda o: F.struct(F.least(o, F.col("mine")).alias("a"), F.greatest(o, F.col("mine")).alias("b")))).alias("p"))
    dealt = units.select("sig", "p.a", "p.b", "mine", "node", "n", "label", "low", "sketch").repartition("sig", "a", "b").sortWithinPartitions(
        "sig", "a", "b", "n", "node")
    cluster = "cluster bigint, node bigint, label bigint"
    clusters = stored(dealt.mapInArrow(_border_clusters(percent), cluster).dropDuplicates(["cluster", "node"]), "join-clusters")
    clusters = stored(clusters.join(reps.select("node", "n", "bits"), "node").repartition("cluster")
                      .sortWithinPartitions("cluster", "n", "node").select("cluster", "node", "label", "n", "bits")
                      .mapInArrow(_close_clusters(percent), cluster).dropDuplicates(["cluster", "node"]), "join-close-border")
    sets = _sets_of(docs, reps, clusters.select("node").distinct(), shingle, broadcast_docs, "border")
    sets = sets.withColumn("n", (F.length("tokens") / 8).cast("long"))
    more = stored(clusters.join(sets, "node").repartition("cluster").sortWithinPartitions("cluster", "n", "node")
                  .select("cluster", "node", "label", "n", "tokens").mapInArrow(_bridges(percent), "u bigint, v bigint"), "join-bridges")
    root = components(found.unionByName(more))
    grouped = reps.join(root, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    first = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(grouped.join(first, "root").select("node", "component_id"), "join-components")
    return sized.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
