"""Ranked search, n-gram join and conversation trie: small awkward tables, and plain-Python versions of the contracts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplake.llm import ngram_join, search, trie
from shoplake.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EXTRA = "mark string, n string, node string, sig string, items string, u string, _id string, score string, label string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 9) for i, t in rows], f"doc_id bigint, text string, {EXTRA}")


# --- ranked search --------------------------------------------------------------------------------------------------

def _ranked(docs, items, k=10):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in terms if t), sum(len(t) for _, t in terms)
    tf = [(i, len(t), Counter(t)) for i, t in terms]
    df = Counter(t for _, _, c in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for i, n, c in tf:
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in c:
                    m = 25 + (75 * n * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=str)


def _found(spark, docs, items, index=(), **kw):
    made = search.build_index(_docs(spark, docs), **dict(index))
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, term string")
    return sorted((tuple(r) for r in search.search(made, asked, **kw).collect()), key=str)


def test_search_query(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    got = E.queries()["op11_ranked_search"](spark, SF_SMALL)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _ranked(docs, items)


def test_search_on_awkward_tables(spark):
    rng = random.Random(5)
    some = [" ".join(rng.choice(["Ant", "bee!", "cat-Ünder", "déjà", "ELK", "fox9", "gnu", "7"]) for _ in range(rng.randint(1, 40)))
            for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(some)] + [(100, None), (101, ""), (102, " .,!"), (103, "bee " * 30_000),
                                                   (None, "ant bee elk"), (None, "gnu"), (7, "cat ünder"), (7, "cat ünder"), (3, some[3])]
    items = [(0, "ANT ant bee"), (1, "déjà fox9 ünder"), (2, None), (3, ""), (None, "elk"), (5, "nowhere"), (6, "Gnu 7"),
             (0, "ANT ant bee"), (0, "fox9")]
    want = _ranked(docs, sorted(set(items), key=str))
    assert _found(spark, docs, items) == want
    # many narrow blocks, few seeds, several query blocks, ordinary joins
    assert _found(spark, docs, items, index={"block_docs": 3, "bits": 4, "lexicon_piece": 2}.items(), seeds=1, query_items=2,
                  broadcast_pairs=0) == want
    assert _found(spark, docs, items, k=3) == [r for r in want if r[1] <= 3]
    assert _found(spark, [], items) == [] and _found(spark, docs, []) == []
    assert _found(spark, [(1, None)], items) == []


def test_search_ties_in_large_groups_of_copies(spark):
    docs = [(i, "alpha beta gamma") for i in range(500, 0, -1)] + [(i, "alpha delta") for i in range(501, 700)]
    items = [(1, "beta gamma"), (2, "delta alpha"), (3, "alpha")]
    assert _found(spark, docs, items) == _ranked(docs, items)


def test_bounds_never_fall_below_scores():
    import pyarrow as pa
    rng = random.Random(1)
    words = [f"w{i}".encode() for i in range(300)]
    texts = [b" ".join(rng.choices(words, k=rng.choice([1, 5, 60, 3000]))) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([0] * 50), pa.array(texts)], names=["doc_id", "mark", "text"])
    rows = [r for b in search._indexer(3, 20, 1 << 22, 1000)([batch]) for r in b.to_pylist()]
    n_docs, n_terms = 50, sum(len(search.terms_of(t)) for t in texts)
    q = search._Queries([0, 1], words[:40], [list(range(20)), list(range(15, 40))], [[7] * 20, [3] * 25])
    bounds, seen = search._bounds(q, n_docs, n_terms), 0
    for r in rows:
        if r["width"] is None:
            continue
        upper = bounds(r["width"], np.array(r["lengths"]), r["slices"])
        for col, i in enumerate(r["ids"]):
            c, n = Counter(search.terms_of(texts[i])), r["lengths"][col]
            m = 25 + (75 * n * n_docs) // n_terms
            for k in (0, 1):
                exact = sum(w * ((10 ** 9 * c[words[t]]) // (1000 * c[words[t]] + 8 * m)) for t, w in zip(q.of[k], q.weights[k]))
                assert upper[k][col] >= exact
                seen += 1
    assert seen == 100


# --- n-gram join ----------------------------------------------------------------------------------------------------

def _components(docs):
    sets = []
    for _, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    for i, j in {(i, j) for own in lists.values() for x, i in enumerate(own) for j in own[x + 1:]}:
        shared = len(sets[i] & sets[j])
        if 100 * shared >= 85 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def _joined(spark, docs, **kw):
    return sorted((tuple(r) for r in ngram_join.similar_documents(_docs(spark, docs), **kw).collect()), key=str)


def test_join_query(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = E.queries()["op12_ngram_jaccard_join"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _components(docs)


def _near_copies(seed, groups=12, size=30):
    """Groups of texts that differ from each other by a few words, around the threshold, plus a shared passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 10 ** 6)}" for _ in range(rng.choice([6, 20, 60, 200]))] + (passage if g % 3 == 0 else [])
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(own) // 30)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10 ** 9)}"
            docs.append((len(docs), " ".join(own)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("frequent", [1, 4, 32])
def test_join_loses_no_link(spark, frequent):
    docs = _near_copies(frequent)
    want = _components(docs)
    assert len({c for _, _, c in want}) > 12
    assert _joined(spark, docs, frequent=frequent, part_tokens=5000, block=8, broadcast_docs=0) == want


def test_border_rows_grow_with_the_sets(spark, monkeypatch):
    """Sets just below the threshold, whose bitmaps leave every pair possible: no step makes a row per pair."""
    def rows_by_step(size):
        base, rows = [f"b{i}" for i in range(1000)], {}
        docs = [(k, " ".join([f"k{k}x{i}" for i in range(100)] + base[100:])) for k in range(size)]
        docs += [(size + k, text + " end") for k, (_, text) in enumerate(docs[:3])]
        plain = ngram_join.stored

        def counting(df, name):
            got = plain(df, name)
            rows[name] = max(rows.get(name, 0), got.count())
            return got
        with monkeypatch.context() as patch:
            patch.setattr(ngram_join, "stored", counting)
            got = _joined(spark, docs)
        assert got == _components(docs)
        assert len({c for _, _, c in got}) == size
        return rows
    small, large = rows_by_step(30), rows_by_step(120)
    assert set(small) == set(large)
    # a second centre gives a row per entry of its list, whatever the pairs
    assert {k: (small[k], v) for k, v in large.items() if v > 5 * small[k] + 50 and "again" not in k} == {}


def test_clusters_keep_every_pair_that_may_link():
    """A pair over borders that the sketches leave possible lies in a cluster of one of the lists that it shares."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(4)]
    sets = [np.unique(np.concatenate([s[rng.random(len(s)) < 0.95], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])) for s in sets for _ in range(12)]
    lists = {g: [i for i in range(len(sets)) if rng.random() < 0.4] for g in range(-20, 20)}
    none = (1 << 63) - 1
    low = {i: (sorted(g for g in lists if i in lists[g]) + [none] * ngram_join.LOW)[:ngram_join.LOW] for i in range(len(sets))}
    sketch = [ngram_join.fold(ngram_join._parity(s)) for s in sets]
    rows = [(g, 0, 0, 0, i, len(sets[i]), i, low[i], sketch[i]) for g in sorted(lists) for i in sorted(lists[g], key=lambda i: (len(sets[i]), i))]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("sig", "a", "b", "mine", "node", "n", "label", "low", "sketch"), r)) for r in rows[k:k + 7]])
               for k in range(0, len(rows), 7)]
    clusters = defaultdict(set)
    for out in ngram_join._border_clusters(85)(batches):
        for r in out.to_pylist():
            clusters[r["cluster"]].add(r["node"])
    pairs = {(i, j) for own in lists.values() for i in own for j in own if i < j and ngram_join.parity_difference(
        ngram_join._parity(sets[i]), ngram_join._parity(sets[j])) <= ngram_join.most_different(len(sets[i]) + len(sets[j]))}
    assert len(pairs) > 20
    assert all(any(i in c and j in c for c in clusters.values()) for i, j in pairs)


def test_join_on_awkward_tables(spark):
    long = " ".join(f"l{i}" for i in range(20_000))
    docs = [(1, "One two THREE four five six seven eight nine ten"), (2, "one two three four five six seven eight nine ten"),
            (2, "one two three four five six seven eight nine ten"), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "ONE  two"),
            (8, "one"), (9, long), (10, long + " tail"), (11, "tail " * 5000), (None, "one two"), (None, None), (None, "no id at all here"),
            (12, "ünder Über"), (13, "ünder über"), (14, "a b c d e f g h"), (15, "a b c d e f g h i"), (16, "one two three four")]
    assert _joined(spark, docs) == _components(docs)
    assert _joined(spark, docs, bitmap_bits=8, frequent=0, block=1) == _components(docs)
    assert _joined(spark, []) == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(2, 400))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y, seen = x.copy(), 0
        while len(np.intersect1d(x, y)) * 100 >= 85 * len(np.union1d(x, y)):
            for bitmap in (np.zeros(8, np.uint8), np.full(8, 255, np.uint8), rng.integers(0, 256, 8).astype(np.uint8)):
                if len(x) > 1 and len(y) > 1:
                    assert np.intersect1d(ngram_join.signatures(x, bitmap), ngram_join.signatures(y, bitmap)).size
            y = np.unique(np.concatenate([np.delete(y, rng.integers(0, len(y))), rng.integers(0, 1 << 63, int(rng.integers(0, 3)), dtype=np.uint64)]))
            seen += 1
        assert seen


def test_parity_difference_never_exceeds_the_sets_difference():
    rng = np.random.default_rng(9)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 700)), dtype=np.uint64)) for _ in range(2))
        y = np.union1d(x[:len(x) * 9 // 10], y[:int(rng.integers(0, len(y)))])
        assert ngram_join.parity_difference(ngram_join._parity(x), ngram_join._parity(y)) <= len(np.setxor1d(x, y))
    assert ngram_join.parity_difference(ngram_join._parity(x), ngram_join._parity(x)) == 0


def test_join_sketches_lose_no_pair():
    """The folded bitmaps differ in at most as many bits as the sets differ in tokens, whatever the sizes."""
    rng = random.Random(11)
    rows = []
    for size in (1, 3, 40, 700, 5000):
        x = np.unique(np.array([rng.getrandbits(64) for _ in range(size)], dtype=np.uint64))
        y = np.unique(np.concatenate([x[:int(0.9 * size) + 1], np.array([rng.getrandbits(64)], dtype=np.uint64)]))
        rows.append((x, y))
    sets = [t for pair in rows for t in pair]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets)), pa.int64()), pa.array([ngram_join._parity(t) for t in sets], pa.binary())],
                                       names=["node", "bits"])
    folded = [np.frombuffer(b, np.uint64) for out in ngram_join._folded([batch]) for b in out.column("sketch").to_pylist()]
    assert {f.size * 64 for f in folded} == {ngram_join.SKETCH_BITS}
    for k, (x, y) in enumerate(rows):
        apart = int(np.bitwise_count(folded[2 * k] ^ folded[2 * k + 1]).sum())
        assert apart <= len(np.setxor1d(x, y))
    # most_different is the bound itself: sets that share one token less no longer link
    for n in range(1, 60):
        for m in range(n, 60):
            links = [n + m - 2 * s for s in range(n + 1) if 100 * s >= 85 * (n + m - s)]
            assert not links or max(links) == ngram_join.most_different(n + m)


def test_packed_tokens_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        values = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        counts = rng.integers(1, 4, len(values))
        v, c = ngram_join._unpacked(ngram_join._packed(values, counts))
        assert (v == values).all() and (c == counts).all()


# --- conversation trie ----------------------------------------------------------------------------------------------

def _trie(rows, group=20, shares=4):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % shares
        built[c] = convs.get(c - int(math.fmod(c, group)), [])[:h] + own[h:]
    members, children = defaultdict(list), Counter()
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        own = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own
    ends = {p: ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))) for p, m in members.items()}
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items()}


def _built(spark, rows, **kw):
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, "
                               "pos string, depth string, words string, part string, na string")
    got = [tuple(r) for r in trie.prefix_trie(df, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_trie_query(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = E.queries()["op13_conversation_trie"](spark, SF_SMALL)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {tuple(r) for r in got.collect()} == _trie(rows)


def test_trie_on_awkward_tables(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d e f"]))
            for c in [*range(0, 60), 100, 105, 119, -3, -41] for t in range(rng.randint(1, 9))]
    rows += [(200, t, None, None if t % 7 else "long one") for t in range(70)] + [(201, t, "user", "a b") for t in range(33)]
    rows += [(300, None, "system", "first of all"), (300, 0, "user", "x"), (None, 0, "user", "nobody"), (None, None, None, None),
             (301, 5, "", ""), (302, 5, "user", " \n"), (303, 1, "userx", "a"), (304, 1, "user", "xa")]
    want = _trie(rows)
    assert _built(spark, rows) == want
    assert _built(spark, rows, segment=3, chunk_bytes=4) == want
    assert _built(spark, rows, group=50, shares=3) == _trie(rows, 50, 3)
    assert _built(spark, []) == set() and _built(spark, [(None, 1, "user", "x")]) == set()


def test_trie_turnless_conversations_stay_in_the_root(spark):
    # conversations whose own turns all lie in the part that an absent conversation would have given
    rows = [(c, 0, "user", "hi there") for c in (21, 22, 23, 24, 25, 26)]
    want = _trie(rows)
    assert any(r[1] == 0 and r[3] == 6 for r in want) and _built(spark, rows) == want
    only = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4]
    assert _built(spark, only) == _trie(only)


def test_trie_repeated_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")]
    assert _built(spark, rows) == _trie(rows)
