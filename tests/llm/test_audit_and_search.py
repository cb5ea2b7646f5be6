"""Source audit, vector groups and lexical search against plain Python, and on nulls, ties, repeated rows and hot groups."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from isobar.llm import embedding_dedup as vectors
from isobar.llm import lexical_search as search
from isobar.llm import source_audit as audit

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "Rß", "st", "É")]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def audited(docs, least=10, top=10):
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = sorted(s for at, s in groups if at == lang)

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def audit_rows(spark, docs, **options):
    return sorted(tuple(r) for r in audit.source_audit(spark.createDataFrame(docs, SCHEMA), **options).collect())


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    out = [(i, prose(rng.randrange(1, 60)), ("en", "de", None)[i % 3], f"s{rng.randrange(7) if i % 2 else 0}", 1) for i in range(240)]
    out += [(300, None, "en", "s1", 1), (301, "", "en", "empty", 1), (302, "42 -- !", "fr", "a", 1), (303, prose(9), "fr", None, 1), (304, "x" * 70_000, "it", "one", 1)]
    return [*out, *out[:20], (None, prose(30), "en", "s2", 7)]


def test_source_audit_brute(spark, docs):
    assert audit_rows(spark, docs) == audited(docs)
    assert {r[4] for r in audit_rows(spark, docs) if r[0] == "fr"} == {0}  # no term in ten documents


def test_source_audit_ties_and_many_sources(spark):
    """Hundreds of terms with one value, told apart by long common beginnings only; more sources than a block."""
    start = "é" * 40
    docs = [(i, " ".join([f"{start}{a}{b}" for a in "abcdefgh" for b in "xyzwvut"] + ["abc", start]), "en", "s", 1) for i in range(3)] + [(10 + i, "quux " * (1 + i % 5), "en", f"t{i}", 1) for i in range(70)]
    assert audit_rows(spark, docs, least_docs=2, top=9) == audited(docs, 2, 9)
    assert audit_rows(spark, [], least_docs=2) == []


def test_radix_top(spark, tmp_path):
    rng = random.Random(9)
    rows = [(g, f"{'k' * rng.randrange(9)}{i}", rng.choice((0, 1, 65_535, 65_536, 2**32 - 1, rng.randrange(2**32)))) for g in "abc" for i in range(400)] + [("d", "only", 0)]
    df = spark.createDataFrame(rows, "g string, item string, value bigint")
    for k in (1, 10, 150, 5000):
        got = sorted(tuple(r) for r in audit.radix_top(df, ["g"], "value", "item", k).collect())
        assert got == sorted(r for g in "abcd" for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:k])


def ranked(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    held = [(d, Counter(terms(t))) for d, t, *_ in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in df}
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            if (s := sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)) > 0:
                scores.append((d, s))
        out += [(item, r, d, s) for r, (d, s) in enumerate(sorted(scores, key=lambda x: (-x[1], x[0] is not None, x[0]))[:k], 1)]
    return sorted(out, key=repr)


def test_lexical_search_brute(spark, docs, monkeypatch):
    items = [(i, " ".join(random.Random(i).sample(WORDS, 4))) for i in range(9)] + [(20, None), (21, "no such thing"), (22, "BAN ban, Ban 42!"), (None, "ban dust"), (3, "kun")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    table = spark.createDataFrame(docs, SCHEMA)
    found = lambda **o: sorted((tuple(r) for r in search.lexical_search(table, asked, **o).collect()), key=repr)
    assert found() == ranked(docs, items)
    monkeypatch.setattr(search, "WINDOW", 16)  # many windows a task; queries in several blocks
    assert found(query_bytes=40) == ranked(docs, items)


def test_lexical_search_of_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    asked = spark.createDataFrame([(1, "ban")], "item_id bigint, text string")
    assert search.lexical_search(spark.createDataFrame(docs, SCHEMA), none).collect() == [] and search.lexical_search(spark.createDataFrame([], SCHEMA), asked).collect() == []
    names = spark.createDataFrame([("b", "ban"), ("a", "ban")], "name string, body string").withColumns({c: F.lit("x") for c in ("doc", "n", "terms", "score", "rank", "text")})
    rows = search.lexical_search(names, asked, doc_id="name", text="body").collect()  # ids of any type, clashing names
    assert [(r["name"], r["rank"]) for r in sorted(rows, key=lambda r: r["rank"])] == [("a", 1), ("b", 2)]


def vector_groups(rows, least=0.95):
    unit = []
    for _, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.abs(v).max() if ok else None)
    near = lambda i, j: unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] / np.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= least
    n = len(rows)
    links = {i: [j for j in range(n) if j != i and near(i, j)] for i in range(n)}
    of = brute.linked(dict(enumerate(range(n))), lambda a, b: b in links[a])
    least_id = {}
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if of[j] == of[i] and rows[j][0] is not None]
        least_id[i] = min(ids, default=None)
    return sorted(((rows[i][0], len(links[i]), least_id[i], rows[i][0] == least_id[i]) for i in range(n)), key=repr)


def close(rng, v, cosine):
    """A unit vector at a cosine to v."""
    u = rng.normal(size=len(v))
    v = v / np.linalg.norm(v)
    u -= (u @ v) * v
    return cosine * v + math.sqrt(1 - cosine**2) * u / np.linalg.norm(u)


def test_embedding_dedup_brute(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [(200 + i, close(rng, np.array(rows[i][1]), (0.94, 0.955, 0.99)[i % 3]).tolist()) for i in range(60)]
    rows += [(300 + i, (np.array(rows[0][1]) * (i + 1)).tolist()) for i in range(5)] + [(7, rows[7][1]), (None, rows[8][1]), (None, rows[9][1]), (None, [1.0] * 8)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None] + [0.0] * 6), (404, [float("nan")] * 8), (405, [float("inf")] + [0.0] * 7), (406, [1e300] * 8), (407, [2e300] * 8), (408, [1.0, 2.0]), (409, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(1) for c in ("label", "n", "key", "cell", "links")})
    for options in ({"reach": 0.1582, "cell": 20}, {"reach": 0.1582, "cell": 40, "numbers": 1}, {"cell": 10_000}):  # many cells, many blocks, one cell
        got = sorted((tuple(r) for r in vectors.embedding_dedup(df, **options).collect()), key=repr)
        assert got == vector_groups(rows)
    assert vectors.embedding_dedup(df.limit(0)).collect() == []


def test_embedding_dedup_recall(spark):
    """Of links at a cosine just over the threshold between vectors of many cells, hardly one is missed by the default reach."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(10_000 + i, close(rng, v, 0.9501 + 0.02 * (i % 3)).tolist()) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    out = {r["vec_id"]: r["component_id"] for r in vectors.embedding_dedup(df, cell=60).collect()}
    recall = sum(out[10_000 + i] == i for i in range(3000)) / 3000
    print(f"recall {recall:.4f}")
    assert recall >= 0.995 and all(out[i] == i for i in range(3000))
