"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Only built-in DataFrame functions. A candidate is a maximal run of identifier characters; it is a secret if its
log-likelihood ratio under the two models is high enough, in sum and per character. Transition counts come from labelled
samples; only the table of counts (at most 128 x 128 x 2 numbers) reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: These two can take their least length into the pattern: a shorter match is a whole run and hides no other.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Words and numbers, and identifiers that join them.
_PART = r"(?:[A-Z]{2,12}|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*)[0-9]{0,4}"
ORDINARY = rf"(?<![A-Za-z0-9])(?:{_PART}|[0-9]{{1,8}})(?:[+/_=-](?:{_PART}|[0-9]{{1,8}}))*(?![A-Za-z0-9])"
#: Texts that the ordinary class is taken from, about.
SAMPLE = 20_000
KINDS = ("assign", "access", "hex", "markov")
CODES = 128
BLOCK = 256


def with_spans(df: DataFrame, text: str, out: str, pattern: str) -> DataFrame:
    """df with out, the matches of pattern in text: an array of structs of start, end (code points, exclusive) and hit.

    The gaps between matches come from split(), the matches from regexp_extract_all(); their lengths are summed within
    blocks of BLOCK matches and over blocks, so a text of very many matches doesn't cost their square.
    """
    t = F.col(text)
    m, g, b = (free_name(df, f"_{n}") for n in ("matches", "gaps", "blocks"))
    df = df.withColumn(m, F.regexp_extract_all(t, F.lit(pattern), 0))
    gaps = F.when(F.size(m) > 0, F.transform(F.split(t, pattern, -1), lambda x: F.length(x))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(g, F.zip_with(F.slice(gaps, 1, F.size(m)), F.transform(m, lambda x: F.length(x)), lambda a, b: (a + b).cast("long")))
    zero, add = F.lit(0).cast("long"), lambda a, b: a + b
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int")), lambda i: F.aggregate(F.slice(g, i * BLOCK + 1, F.lit(BLOCK)), zero, add))
    df = df.withColumn(b, F.when(F.size(m) > 0, blocks).otherwise(F.array().cast("array<bigint>")))

    def span(hit: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        end = F.aggregate(F.slice(b, F.lit(1), block), zero, add) + F.aggregate(F.slice(g, block * BLOCK + 1, i % BLOCK + 1), zero, add)
        return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))

    return df.withColumn(out, F.transform(m, span)).drop(m, g, b)


def labelled_samples(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Samples as columns sample and random: random ones are what the fixed patterns find in all texts; ordinary ones are the
    words, numbers and identifiers made of such parts (ORDINARY) in about sample rows, chosen by a hash of all their columns.

    A run in which letters and digits take turns is neither, so what the model is to find does not train the ordinary class.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), 2), lambda x: F.length(x) >= 8), F.regexp_extract_all(t, F.lit(ACCESS), 0), F.regexp_extract_all(t, F.lit(HEX), 0))
    random = docs.select(F.explode(found).alias("sample"), F.lit(True).alias("random"))
    every = max(1, docs.count() // sample)
    bare = F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    few = docs.filter(F.pmod(F.xxhash64(*docs.columns), F.lit(every)) == 0).select(F.explode(F.regexp_extract_all(bare, F.lit(ORDINARY), 0)).alias("sample"), F.lit(False).alias("random"))
    return random.unionByName(few)


def made_samples(spark: SparkSession, n: int = 1000) -> DataFrame:
    """n random strings each of base 64, of base 32-like capitals and of hexadecimal digits, from SHA-256 of counters."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    capitals = F.translate(F.base64(F.unhex(digest)), "abcdefghijklmnopqrstuvwxyz+/=", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return spark.range(n).select(F.explode(F.array(F.base64(F.unhex(digest)), capitals, F.substring(digest, 1, 40))).alias("sample"), F.lit(True).alias("random"))


def codes(x: Column) -> Column:
    """The characters' codes of a text, which is gone through once, whatever its length."""
    return F.transform(F.array_remove(F.split(x, ""), ""), F.ascii)


def fit_markov(samples: DataFrame, smoothing: float = 0.5, prior: float = 4.0) -> list[float]:
    """Log ratios log(P(b|a, random) / P(b|a, ordinary)) at index 128 * a + b, from columns sample and random.

    The counts after a count as prior further ones in the proportions of single characters (each with smoothing more).

    Null samples and labels, and characters beyond ASCII, count nothing; classes without samples are uniform.
    """
    pair = F.transform(F.sequence(F.lit(1), F.size("codes") - 1), lambda i: F.get("codes", i - 1) * CODES + F.get("codes", i))
    counts = (
        samples.filter((F.length("sample") >= 2) & F.col("random").isNotNull() & ~F.col("sample").rlike(r"[^\x00-\x7F]"))
        .select("random", codes(F.col("sample")).alias("codes"))
        .select("random", F.explode(pair).alias("pair"))
        .groupBy("random", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = {False: [0.0] * CODES**2, True: [0.0] * CODES**2}
    for row in counts.collect():  # at most 2 * 128 * 128 rows
        n[row["random"]][row["pair"]] = row["n"]
    known = sorted({b for c in n.values() for i, v in enumerate(c) if v for b in (i // CODES, i % CODES)})
    logs = {}
    for c, counts in n.items():
        after = [sum(counts[b::CODES]) + smoothing for b in range(CODES)]
        alone = [x / sum(after[b] for b in known) if known else 1.0 for x in after]  # of a character, whatever stands before
        sums = [sum(counts[a * CODES : (a + 1) * CODES]) for a in range(CODES)]
        logs[c] = [math.log((v + prior * alone[i % CODES]) / (sums[i // CODES] + prior)) for i, v in enumerate(counts)]
    ratios = [x - y for x, y in zip(logs[True], logs[False], strict=True)]
    return ratios


def scan_secrets(docs: DataFrame, model: list[float], text: str = "text", *, least_sum: float = 12.0, least_mean: float = 0.5) -> DataFrame:
    """docs with secrets: an array of structs of start, kind_no, end, kind and hit, by start and then kind.

    Kinds: assign, access and hex (the fixed patterns: leftmost, non-overlapping per kind; offsets are of whole matches),
    and markov (candidates that overlap none of those, hold a letter, and whose log-likelihood ratio reaches least_sum in
    all and least_mean per character). A null or empty text has an empty array. Rows are scanned one by one. A column
    named secrets is replaced; all others are kept, whatever they are called.
    """
    df = docs.drop(*[c for c in docs.columns if c.lower() == "secrets" and c != text])
    own = df.columns
    whole, assign, access, hexes, cand, base, scored = (free_name(df, f"_{n}") for n in ("text", "assign", "access", "hex", "candidates", "base", "scored"))
    df = df.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    for kind, pattern in ((assign, ASSIGN), (access, ACCESS), (hexes, HEX), (cand, CANDIDATE)):
        df = with_spans(df, whole, kind, pattern)
    df = df.withColumn(assign, F.filter(assign, lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 8))
    named = lambda name, k: F.transform(name, lambda s: F.struct(s["start"], F.lit(k).alias("kind_no"), s["end"], F.lit(KINDS[k]).alias("kind"), s["hit"]))
    df = df.withColumn(base, F.concat(named(assign, 0), named(access, 1), named(hexes, 2)))
    ratios = F.split(F.lit(",".join(f"{x:.6g}" for x in model)), ",").cast("array<double>")
    coded = F.transform(
        F.filter(cand, lambda s: s["hit"].rlike("[A-Za-z]")),
        lambda s: F.struct(s.alias("s"), codes(s["hit"]).alias("codes")),
    )
    ratio = lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda a, i: a + F.get(ratios, F.get(c, i - 1) * CODES + F.get(c, i)))
    df = df.withColumn(scored, F.transform(coded, lambda x: F.struct(x["s"].alias("s"), ratio(x["codes"]).alias("ratio"))))
    likely = F.filter(scored, lambda x: (x["ratio"] >= least_sum) & (x["ratio"] >= least_mean * F.length(x["s"]["hit"])))
    free = F.filter(F.transform(likely, lambda x: x["s"]), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    df = df.withColumn(cand, free)
    found = F.array_sort(F.concat(F.col(base), named(cand, 3)))
    return df.select(*[c for c in own if not (c == text and c.lower() == "secrets")], found.alias("secrets"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
