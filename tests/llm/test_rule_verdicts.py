"""Line rules and verdicts of the quality rules: plain Python and the SQL twin, neither taken from the operator."""

import random
import re

import duckdb

from shoplake.llm import quality_rules
from shoplake.llm.sql import ORACLE_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PHRASES = re.compile("enable javascript|javascript is disabled|lorem ipsum|we use cookies|cookie policy|accept all cookies|"
                     "terms of use|terms of service|all rights reserved|skip to content|click here to subscribe|"
                     "sign up for our newsletter|dolor sit amet|consectetur adipiscing elit|sed do eiusmod tempor|"
                     "incididunt ut labore et dolore")
FAIL = ["Home | News | Sport | About", "Home > Shop > Shoes", "all rights reserved", "We use cookies to improve this", "wow!! great!! buy!!",
        "Lorem ipsum dolor sit amet, consectetur adipiscing elit", "a » b", "x - y - z - w", "rate ### now $$$ here"]
GOOD = ["- item one of the list", "• a bullet and some words", "the price - as agreed - was paid in full by the buyer last week on Monday",
        "either - or", "Our lawyers read the terms of use of every site that we visit and then write a long summary for the board",
        "a plain sentence without a final stop", "He said: stop!! and went home to sleep", "C# and $HOME & co are words"]


def _fails(line):
    w = WORD.findall(line)
    noisy = sum(bool(re.search(r"([#*$%&|<>]{3,}|!!+)$", x)) for x in w)
    bars = [x for x in w[1:] if re.fullmatch(r"[|<>»›·•/\\-]+", x)]
    phrase_words = sum(len(p.split(" ")) for p in PHRASES.findall(line.lower()))
    return (noisy > 0.3 * len(w) or (len(bars) > 0.15 * len(w) and (len(bars) > 1 or any(re.search("[|»›]", x) for x in bars)))
            or (phrase_words > 0 and phrase_words >= 0.25 * len(w)))


def _verdict(text):
    w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    good = [x for i, x in enumerate(lines) if x not in lines[:i] and not _fails(x)]
    windows = [tuple(w[p:p + 8]) for p in range(len(w) - 7)]
    covered = {p + k for p, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    base = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return not base and sum(map(len, good)) >= 0.5 * sum(map(len, lines)), "\n".join(good)


def test_each_line_rule():
    assert [x for x in FAIL if not _fails(x)] == []
    assert [x for x in GOOD if _fails(x)] == []


def test_verdicts_equal_plain_python_and_sql(spark):
    rng = random.Random(4)
    texts = ["\n".join(rng.choices(FAIL, k=rng.randint(0, 5)) + rng.sample(GOOD, rng.randint(0, 8)) + ["", " \t"]) for _ in range(150)]
    texts = ["\n".join(rng.sample(t.split("\n"), len(t.split("\n")))) for t in texts] + [*FAIL, *GOOD, "", "\n\n", "one"]
    rows = [*enumerate(texts), (len(texts), None)]
    want = {i: _verdict(t or "") for i, t in rows}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: (r.kept, r.clean_text) for r in quality_rules.quality_signals(docs).collect()} == want
    assert {k for k, _ in want.values()} == {True, False}
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        twin = db.execute(ORACLE_SQL["op9_quality_rules"]).df()
    assert dict(zip(twin.doc_id, twin.kept)) == {i: k for i, (k, _) in want.items()}
