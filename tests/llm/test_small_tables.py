"""Every operator and pipeline stage on awkward small tables: nulls, empty and long texts, ties, repeats, extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoplake.llm import (decontaminate, licenses, mixing, quality_model, quality_rules, secrets, simhash, substrings,
                          tokens, warc)

LONG = " ".join(f"word{i % 977} other{i}" for i in range(30_000))
PROSE = " ".join(f"alpha{i} beta{i}" for i in range(60)) + "."
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size string, wh string, "
          "fp string, key string, pos string, bin string, taken string, _row string, level string")
EXTRA = ("x",) * 10


def _rows():
    base = [(1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, "en", None), (4, "", None, "b"),
            (5, "   \n\t ", "en", "b"), (6, LONG, "en", "b"), (None, "no id here", "en", "c"), (None, None, None, None),
            (7, "one", "en", "c"), (8, PROSE + " tail", "en", "a")]
    return [(*r, len(r[1] or ""), *EXTRA) for r in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    item = " ".join(f"alpha{i} beta{i}" for i in range(10, 25))
    return spark.createDataFrame([(0, item, "x"), (1, None, "x"), (2, "", "x"), (None, "too short", "x")],
                                 "item_id bigint, text string, seed string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 0), (6, 1, None), (7, None, 0), (None, 1, 0)],
                                 "doc_id bigint, quality int, toxic int")


def test_quality(docs, empty):
    got = {(r.doc_id, r.n_words, r.kept) for r in quality_rules.quality_signals(docs).collect()}
    assert got == {(1, 120, True), (2, 120, True), (3, 0, False), (4, 0, False), (5, 0, False), (6, 60_000, True),
                   (None, 3, False), (None, 0, False), (7, 1, False), (8, 121, True)}
    assert quality_rules.quality_signals(empty).count() == 0
    assert sorted(r.doc_id for r in quality_rules.clean(docs).collect()) == [1, 2, 2, 6, 8]
    assert quality_rules.clean(docs).columns == docs.columns


def test_secrets(docs, empty):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == 11 and all(not r.base for r in got)
    assert secrets.find_secrets(empty).count() == 0


def test_simhash(docs, empty):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    # texts without words have fingerprint zero and link to each other, the row without id among them
    assert got >= {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (None, 3), (6, 6), (7, 7), (8, 1)}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 6), (False, 7), (True, 0)]


def test_substrings(docs, empty):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()}
    assert got == {(1, 120, 0), (2, 120, 120), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 60_000, 0), (None, 3, 0), (None, 0, 0),
                   (7, 1, 0), (8, 121, 120)}
    assert substrings.remove_repeats(docs).count() == 11
    assert substrings.remove_repeats(empty).count() == 0


def test_decontamination(docs, empty, bench):
    got = sorted((r.doc_id, r.item_id, r.matched_words) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == [(1, 0, 13), (2, 0, 13), (8, 0, 13)]
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    rest = decontaminate.decontaminate(docs, bench)
    assert rest.columns == docs.columns and rest.count() == 7


def test_rows_without_or_with_a_repeated_id_are_judged_by_their_text(spark, bench):
    words = [[f"{p}{i}" for i in range(80)] for p in ("kilo", "lima", "mike", "november")]
    a, b, c, d = [" ".join(w) for w in words]
    item = " ".join(f"alpha{i} beta{i}" for i in range(10, 25))
    rows = [(None, a), (None, b), (None, a), (3, c), (5, c), (5, d), (5, d)]
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, a), (0, b), (3, c), (5, d)])
    rows = [(None, a), (None, item), (5, b), (5, item), (6, item)]
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, a), (5, b)]


def test_line_rules_leave_lists_and_long_lines(spark):
    lists = "\n".join(f"- item{i} of" for i in range(20)) + "\n" + "\n".join(f"key{i} - value{i}" for i in range(20))
    long = " ".join(f"word{i}" for i in range(60)) + " the terms of use say and all rights reserved means " + PROSE
    nav = "Home | About\nHome > Shop > Shoes\nAll rights reserved\nLorem ipsum dolor sit amet, consectetur adipiscing elit"
    rows = [(1, lists), (2, long), (3, PROSE + "\n" + nav)]
    got = {r.doc_id: (r.text, r.n_chars) for r in quality_rules.clean(
        spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, n_chars bigint")).collect()}
    assert got == {1: (lists, len(lists)), 2: (long, len(long)), 3: (PROSE, len(PROSE))}


def test_repeated_rows_with_a_partial_repeat_stay_single(spark):
    rows = [(1, PROSE), (8, PROSE + " tail"), (8, PROSE + " tail"), (8, PROSE + "  tail"), (8, "other"), (9, "more " + PROSE)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert got == [(1, 120, 0), (8, 1, 0), (8, 121, 120), (8, 121, 120), (8, 121, 120), (9, 121, 120)]


def test_licenses(spark, docs, empty):
    own = docs.withColumn("text", F.when(F.col("doc_id") == 4, "Released under the MIT License.").otherwise(F.col("text")))
    got = [(r.doc_id, r.license_id, r.containment) for r in licenses.scan_licenses(own, licenses.template_table(spark)).collect()]
    assert got == [(4, "MIT", 1.0)]
    assert licenses.scan_licenses(empty, licenses.template_table(spark)).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix_plan(docs).collect()
    assert len(got) == 11 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix_plan(empty).count() == 0
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs).count() == sum(r.copies for r in got)


def test_tokens(docs, empty):
    got = tokens.encode_corpus(docs).orderBy("start").collect()
    assert len(got) == 11 and got[0].doc_id is None and got[-1].doc_id == 8
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens
    assert tokens.encode_corpus(empty).count() == 0


def test_warc(spark, empty):
    schema = "page_id bigint, url string, html string, sha string, best string"
    pages = spark.createDataFrame([(1, "http://a", "<p>x</p>", "", ""), (2, None, "<p>x</p>", "", ""), (2, None, "<p>x</p>", "", ""),
                                   (3, "http://b\r\nX: y", None, "", ""), (4, "", "", "", ""), (None, "u", "zz", "", ""),
                                   (5, "u", LONG, "", "")], schema)
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == [(0, 2, "response", None), (1, 8, "revisit", 2), (2, 8, "response", None), (2, 8, "response", None),
                   (3, 0, "revisit", 4), (4, 0, "response", None), (5, len(LONG), "response", None)]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_quality_model(docs, empty, labels):
    model = quality_model.train(docs, labels)
    got = quality_model.score(docs, model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert quality_model.score(empty, model).count() == 0
    untrained = quality_model.train(empty, labels.limit(0))
    assert {round(r.score, 6) for r in quality_model.score(docs, untrained).collect()} <= {0.5} or untrained[0] == 0.0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table_and_on_nulls(spark, docs, empty, bench, tmp_path, name, stage):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, empty):
        out = stage(spark, given, str(tmp_path))
        n = out.count()
        assert n <= 3 * given.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == given.columns


# names that the operators use inside; as columns of the documents they must come back as they were
INSIDE = ("_hash", "_id", "_text", "_bad", "_k", "_own", "_row", "_key", "_root", "least", "root", "node", "fp", "u", "v", "n", "key",
          "a", "b", "mine", "blocks", "seed", "pos", "wh", "diag", "low", "seg", "best", "same", "item_id", "item_pos", "item_len",
          "_item", "item_wh", "_source", "rate", "copies", "taken", "_copy", "size", "source_size", "target", "level", "fill", "cap",
          "words", "lines", "kept", "n_words", "base_failed", "ids", "crc32", "n_tokens", "start", "file", "block", "seq", "mark")


@pytest.mark.parametrize("stage", [f for f in corpus_pipeline.STAGES if f[0] != "token_output"], ids=lambda f: f[0])
def test_stages_leave_columns_of_any_name_alone(spark, tmp_path, bench, stage):
    rows = [(i, PROSE + f" own{i}" * 40 if i % 2 else "other " + " ".join(f"q{i}x{j}" for j in range(60)) + ".", "en", "ab"[i % 2],
             *[f"{c}-{i}" for c in INSIDE]) for i in range(1, 7)]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in INSIDE)
    wide = spark.createDataFrame(rows, schema)
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = stage[1](spark, wide, str(tmp_path))
    assert out.columns == wide.columns
    got = out.collect()
    assert got and all(r[c] == f"{c}-{r.doc_id}" for r in got for c in INSIDE)
    if stage[0] == "benchmark_decontamination":
        assert {r.doc_id for r in got} == {2, 4, 6}
