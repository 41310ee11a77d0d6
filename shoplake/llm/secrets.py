"""Secret scan: three fixed patterns plus a randomness test battery on token-like runs.

Base spans (leftmost, non-overlapping per kind; code points, end exclusive):

* ``assign``: a key word, ``:`` or ``=`` and a value of 12 or more characters;
* ``access``: ``AKIA`` and upper-case letters or digits, 18 or more characters;
* ``hex``: 16 or more of ``0-9a-f``.

The battery adds spans of kind ``random``.  Candidates are maximal runs of 20
or more of ``A-Za-z0-9+/_-`` outside the base spans.  The encoding is inferred
from the characters (lower or upper hex, base32, base36, base64); runs of one letter
case or of digits only have none and are not tested.  Over the encoding's
alphabet three tests of randomness are made:

* chi-squared uniformity of the characters, Wilson-Hilferty approximation;
* Wald-Wolfowitz runs of characters in the lower and upper half of the alphabet;
* serial correlation of neighbouring characters' places in the alphabet.

Their p-values are combined by Fisher's rule; a candidate that random text
would not produce (combined p under ``ALPHA``) is out.  For the others the
null is a run of natural text: its chi-squared statistic is noncentral, with a
noncentrality that grows with the length, and p is the chance that such a run
looks as uniform as the candidate.  Benjamini-Hochberg with weights in
proportion to length decides over all candidates of the corpus at rate ``FDR``.
P-values are compared in steps of a quarter decade, which only makes the
procedure stricter.

Scale: DataFrame functions only.  One scan computes base spans and candidates
and stores them without the text; the threshold needs a histogram of at most
``BINS`` rows.  No row needs another row, so there is no key to be hot.

Edge cases: null text counts as empty; documents without spans return zero
counts, the hash of the empty string and an empty span list; equal rows give
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored, text_of

# FIXED VALUES: the base patterns
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"      # 18 or more; a shorter run holds no other match
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
# FIXED VALUES: encoding, pattern, alphabet in code order, and how much likelier than 1 / size two characters of
# natural text agree (sum of squared letter frequencies of English, 0.066, over the alphabet; hex: letters a-f only)
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef", 4.2),
    ("hex_upper", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF", 4.2),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 2.1),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz", 2.4),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 4.2),
)
ALPHA = 0.01
FDR = 0.01
BINS = 400
_BLOCK = 256


def _total(a: Column, zero: Column) -> Column:
    return F.aggregate(a, zero, lambda s, x: s + x)


def before(lengths: Column) -> Column:
    """Sum of the elements before each element; by blocks, so that the work on long arrays stays far from quadratic."""
    zero, size = F.lit(0), _BLOCK

    def sums(v: Column) -> Column:
        count = F.floor((F.size(v) + size - 1) / size).cast("int")
        return F.transform(F.filter(F.sequence(F.lit(0), count), lambda b: b < count),
                           lambda b: _total(F.slice(v, b * size + 1, size), zero))

    def starts(v: Column) -> Column:
        return F.transform(v, lambda _, j: _total(F.slice(v, 1, j), zero))
    return let(lengths, lambda v: let(let(sums(v), starts), lambda at: F.transform(v, lambda _, i: (
        F.get(at, F.floor(i / size).cast("int")) + _total(F.slice(v, i - i % size + 1, i % size), zero)))))


def _spans(text: Column, pattern: str, found: Column) -> Column:
    """(start, end) of each match: what lies between matches and the matches themselves add up to the text."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    sizes = F.transform(found, lambda m: F.length(m))

    def place(g: Column, s: Column) -> Column:
        ends = let(F.transform(s, lambda x, i: F.get(g, i) + x), lambda steps: F.transform(
            before(steps), lambda b, i: b + F.get(steps, i)))
        return F.transform(ends, lambda e, i: F.struct((e - F.get(s, i)).alias("start"), e.alias("end")))
    return let(gaps, lambda g: let(sizes, lambda s: place(g, s)))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (Karagiannidis-Lioumpas), a few per cent off at most."""
    x = F.least(F.greatest(F.abs(z), F.lit(1e-6)), F.lit(37.0))
    q = (1 - F.exp(-1.4 * x)) * F.exp(-x * x / 2) / (F.lit(1.135 * math.sqrt(2 * math.pi)) * x)
    return F.when(z >= 0, q).otherwise(1 - q)


def _battery(token: Column) -> Column:
    """Struct of the test results of one candidate, null when no encoding fits."""
    encoding = F.coalesce(*[F.when(token.rlike(rx), F.lit(name)) for name, rx, _, _ in ENCODINGS])
    alphabet = F.coalesce(*[F.when(token.rlike(rx), F.lit(abc)) for _, rx, abc, _ in ENCODINGS])
    like = F.coalesce(*[F.when(token.rlike(rx), F.lit(c)) for _, rx, _, c in ENCODINGS])
    return F.struct(encoding.alias("encoding"), alphabet.alias("alphabet"), like.alias("likeness"))


def _tested(cands: DataFrame) -> DataFrame:
    """Add statistics and p-values to rows (token, encoding, alphabet, likeness)."""
    k = F.length("alphabet").cast("double")
    chars = F.split(F.translate("token", "_-", "/+"), "")
    a = cands.withColumn("chars", F.array_remove(chars, "")).withColumn("n", F.size("chars").cast("double"))
    codes = F.transform("chars", lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"))
    # how often each character of the alphabet occurs: what disappears with it
    counts = F.transform(F.array_distinct("chars"), lambda c: (
        F.col("n") - F.size(F.array_remove("chars", c))).cast("double"))
    b = a.withColumn("codes", codes).withColumn("counts", counts)
    n = F.col("n")

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    chi = k / n * total(F.transform("counts", lambda c: c * c)) - n
    high = F.transform("codes", lambda c: (c >= k / 2).cast("double"))
    c = b.withColumn("chi", chi).withColumn("high", high).withColumn("mean", total(F.col("codes")) / n)
    changes = total(F.transform("high", lambda h, i: F.when(i > 0, F.abs(h - F.get("high", i - 1))).otherwise(F.lit(0.0))))
    lag = total(F.transform("codes", lambda x, i: F.when(
        i > 0, (x - F.col("mean")) * (F.get("codes", i - 1) - F.col("mean"))).otherwise(F.lit(0.0))))
    spread = total(F.transform("codes", lambda x: (x - F.col("mean")) * (x - F.col("mean"))))
    d = (c.withColumn("runs", changes + 1).withColumn("n1", total(F.col("high")))
         .withColumn("serial", F.when(spread > 0, lag / spread).otherwise(F.lit(1.0))))
    df = k - 1
    wh = (F.pow(F.col("chi") / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    n1, n2 = F.col("n1"), n - F.col("n1")
    run_mean = 2 * n1 * n2 / n + 1
    run_var = (run_mean - 1) * (run_mean - 2) / (n - 1)
    run_z = F.when(run_var > 0, (F.col("runs") - run_mean) / F.sqrt(run_var)).otherwise(F.lit(9.0))
    delta = F.col("likeness") - 1
    text_z = (df + n * delta - F.col("chi")) / F.sqrt(2 * df + 4 * n * delta)
    tiny = F.lit(1e-300)
    e = (d.withColumn("p_chi", F.greatest(_upper_tail(wh), tiny))
         .withColumn("p_runs", F.greatest(2 * _upper_tail(F.abs(run_z)), tiny))
         .withColumn("p_serial", F.greatest(2 * _upper_tail(F.abs(F.col("serial") * F.sqrt("n"))), tiny))
         .withColumn("p_text", F.greatest(_upper_tail(text_z), tiny)))
    x = -(F.ln("p_chi") + F.ln("p_runs") + F.ln("p_serial"))
    return (e.withColumn("x", F.greatest(x, F.lit(0.0)))
            .withColumn("p_random", F.exp(-F.col("x")) * (1 + F.col("x") + F.col("x") * F.col("x") / 2)))


def _scan(docs: DataFrame) -> DataFrame:
    """One row per document: _row, doc_id, base (kind, start, end), tokens (start, end, token); no text."""
    text = F.col("text")
    none = F.array().cast("array<struct<start:int,end:int>>")
    rows = docs.select("doc_id", text_of("text").alias("text"))
    found = rows
    for kind, rx, group in (("assign", ASSIGN, 0), ("access", ACCESS, 0), ("hex", HEX, 0), ("token", TOKEN, 0)):
        found = found.withColumn(f"_{kind}", F.regexp_extract_all(text, F.lit(rx), F.lit(group)))
    for kind, rx in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN)):
        m = F.col(f"_{kind}")
        spans = F.when(F.size(m) > 0, _spans(text, rx, m)).otherwise(none)
        found = found.withColumn(f"{kind}_spans", spans)
    values = F.when(F.size("_assign") > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(F.col("_assign"))

    def kept(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                     s["end"].alias("end")))
    long_assign = F.filter("assign_spans", lambda s, i: F.length(F.get("_values", i)) >= 12)
    base = F.sort_array(F.concat(kept("assign", long_assign), kept("access", F.col("access_spans")),
                                 kept("hex", F.col("hex_spans"))))
    tokens = F.transform("token_spans", lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                              F.get("_token", i).alias("token")))
    outside = F.filter(tokens, lambda t: ~F.exists("base", lambda s: (s["start"] <= t["start"]) & (s["end"] >= t["end"])))
    return (found.withColumn("_values", values).withColumn("base", base).withColumn("tokens", outside)
            .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "base", "tokens"))


def candidates(scanned: DataFrame) -> DataFrame:
    """The token-like runs that have an encoding, with their test results and p-values."""
    one = scanned.select("_row", F.inline("tokens")).select("_row", "start", "end", "token",
                                                            _battery(F.col("token")).alias("e"))
    tested = _tested(one.filter("e.encoding is not null").select("_row", "start", "end", "token", "e.*"))
    return tested.select("_row", "start", "end", "encoding", "n", "chi", "runs", "serial",
                         "p_chi", "p_runs", "p_serial", "p_random", "p_text")


def _level(tested: DataFrame, fdr: float, alpha: float) -> tuple[float, int]:
    """Mean length, and the least bin of weighted p-values that Benjamini-Hochberg accepts (BINS + 1: none).

    Two jobs over the stored candidates; their results are one row and one bin number.
    """
    mean = tested.agg(F.avg("n")).first()[0]
    if mean is None:
        return 1.0, BINS + 1
    bins = tested.groupBy(_bin(mean, alpha).alias("bin")).agg(F.count("*").alias("c"))
    above = Window.orderBy(F.col("bin").desc())          # at most BINS + 1 rows
    ranked = bins.withColumn("r", F.sum("c").over(above)).withColumn("m", F.sum("c").over(Window.partitionBy()))
    ok = ranked.filter(F.col("m") * F.pow(F.lit(10.0), -F.col("bin") / 4) <= F.lit(fdr) * F.col("r"))
    least = ok.agg(F.min("bin")).first()[0]
    return mean, BINS + 1 if least is None else least


def _bin(mean: float, alpha: float) -> Column:
    p = F.when(F.col("p_random") < alpha, F.lit(1.0)).otherwise(F.col("p_text") * F.lit(mean) / F.col("n"))
    return F.least(F.greatest(F.floor(-4 * F.log10(p)), F.lit(0)), F.lit(BINS)).cast("int")


def find_secrets(docs: DataFrame, fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """Per document: doc_id, base and added, arrays of (start, kind number of KINDS, end) in text order."""
    scanned = stored(_scan(docs), "secrets-scan")
    tested = stored(candidates(scanned), "secrets-tests")
    mean, least = _level(tested, fdr, alpha)
    added = (tested.filter(_bin(mean, alpha) >= least).groupBy("_row")
             .agg(F.sort_array(F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")))
                  .alias("added")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return scanned.join(added, "_row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
