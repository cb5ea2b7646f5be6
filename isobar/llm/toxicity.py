"""Toxicity by a linear-chain conditional random field over word tags (toxic or not).

Document labels are turned into word labels first: in documents labelled toxic, a word is tagged when it, or its first three
to five letters, stands in toxic documents far more often than in others. The field's features are the word and its first
three, four and five letters, hashed; forward-backward marginals of a line's words give the toxic spans, and a document's
score is a logistic function of its largest marginal and of their sum. Fitting takes a bounded sample of labelled rows;
scoring takes whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BUCKETS = 1 << 18
#: Words that the messages of a line go through one by one; a longer line is joined from such blocks, exactly.
STEP = 256
#: Labelled documents, and bytes of their texts, that a model is fitted on at most, and sequences (lines) of them.
SAMPLE, SAMPLE_BYTES, LINES = 12_000, 64 << 20, 12_000
_STRIP = ".,;:!?*#$%&|()[]{}\"'`-_"
_VOCABULARY = 600_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Words(dict):
    """A number for each word, and by number the hashed features; with a model also the weight of the tag."""

    def __init__(self, weights: np.ndarray | None = None) -> None:
        self.weights, self.features, self.emission = weights, [], []

    def __missing__(self, word: bytes) -> int:
        bare = word.decode().lower().strip(_STRIP)
        found = [xxhash.xxh32_intdigest(f"{k} {bare[:k] if k else bare}", 3) & (BUCKETS - 1) for k in (0, 3, 4, 5)] if bare else [0, 0, 0, 0]
        self.features.append(found)
        if self.weights is not None:
            self.emission.append(float(self.weights[found].sum()) if bare else -10.0)
        self[word] = n = len(self.features) - 1
        return n


def sequences(texts: list[str | None], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts; starts and lengths of the sequences (whole lines with a word); borders of the texts."""
    ids: list[int] = []
    starts: list[int] = []
    borders = [0]
    for text in texts:
        for line in (text or "").encode().split(b"\n"):
            first = len(ids)
            ids += map(known.__getitem__, line.split())
            if len(ids) > first:
                starts.append(first)
        borders.append(len(ids))
    at = np.array(starts, np.int64)
    return np.array(ids, np.int64), at, np.diff(np.append(at, len(ids))), np.array(borders)


def _block_products(x: np.ndarray, w: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each block the product (2 x 2, up to a factor) of what its words do to a message that comes from before."""
    out = np.broadcast_to(np.eye(2), (len(starts), 2, 2)).copy()
    for k in range(int(lengths.max(initial=0))):
        on = np.flatnonzero(lengths > k)
        step = np.broadcast_to(w, (len(on), 2, 2)).copy()
        step[:, :, 1] *= x[starts[on] + k, None]
        product = out[on] @ step
        out[on] = product / product.max((1, 2), keepdims=True)
    return out


def marginals(e: np.ndarray, starts: np.ndarray, lengths: np.ndarray, t: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Of every word the probability of the tag given its sequence, and the expected transitions (2 x 2) over all.

    e: weight of the tag per word; t: log weights of transitions, t[a, b] from a to b. Forward and backward messages are
    kept as ratios (toxic to not), so they need no scaling; all blocks of step words go on word by word together, the
    longest first. The messages at the borders of a longer sequence's blocks come from the products of whole blocks.
    """
    w, x = np.exp(t), np.exp(np.clip(e, -30, 30))
    n_blocks = -(-lengths // step)
    of = np.repeat(np.arange(len(starts)), n_blocks)
    number = np.arange(len(of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    at0 = starts[of] + number * step
    size = np.minimum(step, lengths[of] - number * step)
    before, after = np.full(len(of), np.nan), np.ones(len(of))  # messages that come into a block from both sides (none: nan, 1)
    long = np.flatnonzero(n_blocks > 1)
    if len(long):
        first = (np.cumsum(n_blocks) - n_blocks)[long]
        blocks = np.flatnonzero(n_blocks[of] > 1)
        place = np.full(len(of), -1)
        place[blocks] = np.arange(len(blocks))
        # the first block of a sequence begins with its first word, which has no word before it
        inner_at, inner_size = at0[blocks] + (number[blocks] == 0), size[blocks] - (number[blocks] == 0)
        products = _block_products(x, w, inner_at, inner_size)
        message = np.stack([np.ones(len(long)), x[starts[long]]], 1)
        for k in range(int(n_blocks[long].max()) - 1):
            on = np.flatnonzero(n_blocks[long] > k + 1)
            message[on] = np.einsum("ij,ijk->ik", message[on], products[place[first[on] + k]])
            message[on] /= message[on].max(1, keepdims=True)
            before[first[on] + k + 1] = message[on, 1] / np.maximum(message[on, 0], 1e-300)
        back = np.ones((len(long), 2))
        for k in range(int(n_blocks[long].max()) - 1, 0, -1):
            on = np.flatnonzero(n_blocks[long] > k)
            back[on] = np.einsum("ijk,ik->ij", products[place[first[on] + k]], back[on])
            back[on] /= back[on].max(1, keepdims=True)
            after[first[on] + k - 1] = back[on, 1] / np.maximum(back[on, 0], 1e-300)
    order = np.argsort(-size, kind="stable")
    at0, size, before, after = at0[order], size[order], before[order], after[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    forward, backward = np.empty(len(e)), np.ones(len(e))
    for k in range(steps):
        at = at0[: active[k]] + k
        r = forward[at - 1] if k else before
        moved = x[at] * (w[0, 1] + r * w[1, 1]) / (w[0, 0] + r * w[1, 0])
        forward[at] = moved if k else np.where(np.isnan(before), x[at], moved)
    backward[at0 + size - 1] = after
    expected = np.zeros((2, 2))

    def count(at: np.ndarray) -> None:
        b, r = x[at + 1] * backward[at + 1], forward[at]
        pair = np.stack([np.full(len(at), w[0, 0]), w[0, 1] * b, r * w[1, 0], r * w[1, 1] * b])
        expected[:] += (pair / pair.sum(0)).sum(1).reshape(2, 2)

    for k in range(steps - 2, -1, -1):
        at = at0[: active[k + 1]] + k
        b = x[at + 1] * backward[at + 1]
        backward[at] = (w[1, 0] + w[1, 1] * b) / (w[0, 0] + w[0, 1] * b)
        count(at)
    count((at0 - 1)[~np.isnan(before)])  # the last word of a block and the first of the next
    odds = forward * backward
    return odds / (1 + odds), expected


def word_tags(ids: np.ndarray, doc: np.ndarray, toxic: np.ndarray, features: np.ndarray, least_g: float = 25.0, least_odds: float = 2.0) -> np.ndarray:
    """Tags of the words from labels of documents: a feature tells when its document counts under the two labels differ by a
    likelihood ratio statistic of least_g and log odds of least_odds."""
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    count = np.zeros((2, BUCKETS))
    for k in range(features.shape[1]):
        pair = np.unique(doc * BUCKETS + features[ids, k])
        for label in (0, 1):
            count[label] += np.bincount((pair % BUCKETS)[toxic[pair // BUCKETS] == label], minlength=BUCKETS)
    share = (count + 0.5) / (n[:, None] + 1)
    mean = count.sum(0) / max(n.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * sum(np.where(count[k] > 0, count[k] * np.log(count[k] / (n[k] * mean)), 0) for k in (0, 1))
    tells = (g >= least_g) & (np.log(share[1] / share[0]) >= least_odds)
    return (tells[features].any(1)[ids] & (toxic[doc] == 1)).astype(float)


def document_features(p: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Per document 1, the log odds of the largest marginal, the log of 1 + their sum, and the log of 1 + words."""
    n = np.diff(borders)
    most, total = np.zeros(len(n)), np.zeros(len(n))
    if (full := np.flatnonzero(n)).size:
        most[full] = np.maximum.reduceat(p, borders[:-1][full])
        total[full] = np.add.reduceat(p, borders[:-1][full])
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(len(n)), np.log(most / (1 - most)), np.log1p(total), np.log1p(n)], 1)


def train(texts: list[str | None], toxic: np.ndarray, *, rounds: int = 40, rate: float = 0.5, lines: int = LINES, ridge: float = 1e-3) -> bytes:
    """A model from labelled texts: weights of BUCKETS features, transitions and the document function, as float64 bytes.

    The field is fitted on lines sequences at most, half of them with a tagged word; the document function on all texts.
    """
    rng = np.random.Generator(np.random.PCG64(11))
    weights, t, doc_weights = np.zeros(BUCKETS), np.zeros((2, 2)), np.array([-2.0, 0.5, 0.5, 0.0])
    known = Words()
    ids, starts, lengths, borders = sequences(texts, known)
    if len(ids) and 0 < toxic.sum() < len(toxic):
        features = np.array(known.features)
        doc = np.repeat(np.arange(len(texts)), np.diff(borders))
        tags = word_tags(ids, doc, toxic, features)
        hit = np.add.reduceat(tags, starts) > 0
        chosen = np.concatenate([rng.permutation(np.flatnonzero(h))[: lines // 2] for h in (hit, ~hit)])
        at = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[chosen], lengths[chosen], strict=True)])
        own, size = ids[at], lengths[chosen]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        y = tags[at]
        inner = np.ones(len(y), bool)
        inner[first] = False
        seen = np.bincount((2 * y[:-1] + y[1:])[inner[1:]].astype(int), minlength=4).reshape(2, 2)
        words, place = np.unique(own, return_inverse=True)
        of_words = features[words]
        square, square_t = np.full(BUCKETS, 1e-6), np.full((2, 2), 1e-6)
        for _ in range(rounds):  # full gradients, steps by their history
            p, expected = marginals(weights[of_words].sum(1)[place], first, size, t)
            slope = np.bincount(of_words.ravel(), np.repeat(np.bincount(place, y - p, minlength=len(words)), of_words.shape[1]), minlength=BUCKETS) - ridge * weights
            square += slope**2
            weights += rate * slope / np.sqrt(square)
            slope_t = seen - expected
            square_t += slope_t**2
            t += 0.2 * slope_t / np.sqrt(square_t)
            t[0, 0] = 0.0
        emission = weights[features].sum(1)
        emission[(features == 0).all(1)] = -10.0
        p, _ = marginals(emission[ids], starts, lengths, t)
        x, y = document_features(p, borders), toxic.astype(float)
        for _ in range(30):  # Newton's steps of a logistic regression
            q = 1 / (1 + np.exp(-np.clip(x @ doc_weights, -30, 30)))
            doc_weights = doc_weights + np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(4), x.T @ (y - q) - 0.1 * doc_weights)
    return np.concatenate([weights, t.ravel(), doc_weights]).tobytes()


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A model from one text of each of at most sample labelled keys (those with the least hashes), as many of these as have
    sample_bytes together, fitted in one task.

    A key with several labels is toxic if one of them is 1; a key with several texts has the least of them; keys and texts
    that are null and labels that aren't 0 or 1 are left out; without both labels the model scores every text low. Only the
    sample's keys and labels are broadcast.
    """
    keys = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("label"))
    keys = keys.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("text"))
    one = written(rows.join(F.broadcast(keys), "_key").groupBy("_key", "label").agg(F.min("text").alias("text")))
    turn = F.xxhash64("_key", F.lit("turn"))
    sizes = one.select("_key", F.sum(F.octet_length("text")).over(Window.orderBy(turn, "_key")).alias("_so_far"))  # sample rows at most
    few = sizes.filter((F.col("_so_far") <= sample_bytes)).select("_key")
    chosen = one.join(F.broadcast(few), "_key").select("text", "label", turn.alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        labels: list[int] = []
        for b in batches:
            texts += b.column(0).to_pylist()
            labels += b.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([train(texts, np.array(labels, int))])], names=["model"])

    model = chosen.repartition(1).sortWithinPartitions("turn", "label").mapInArrow(run, "model binary").first()
    return bytes(model["model"]) if model else train([], np.zeros(0, int))


def score_toxicity(docs: DataFrame, model: bytes, text: str = "text", least: float = 0.5) -> DataFrame:
    """docs with score, predicted, n_toxic_words and toxic_spans (start and end in code points, exclusive, and probability).

    A null or empty text scores as one without toxic words and has no spans. Rows are scored one by one. Columns with these
    names are replaced.
    """
    out = ["score", "predicted", "n_toxic_words", "toxic_spans"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in out])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.frombuffer(sent.value, np.float64)
        weights, t, doc_weights = numbers[:BUCKETS], numbers[BUCKETS : BUCKETS + 4].reshape(2, 2), numbers[BUCKETS + 4 :]
        known = Words(weights)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                b = whole.slice(start, 1000)
                if len(known) > _VOCABULARY:
                    known = Words(weights)
                texts = b.column(place).to_pylist()
                ids, starts, lengths, borders = sequences(texts, known)
                p, _ = marginals(np.array(known.emission)[ids] if len(ids) else np.zeros(0), starts, lengths, t)
                score = 1 / (1 + np.exp(-np.clip(document_features(p, borders) @ doc_weights, -30, 30)))
                toxic = p >= least
                n = np.diff(np.concatenate([[0], np.cumsum(toxic)])[borders])
                spans: list[list[dict]] = [[] for _ in texts]
                for i in np.flatnonzero(n):
                    found = p[borders[i] : borders[i + 1]]
                    spans[i] = [{"start": m.start(), "end": m.end(), "p": float(q)} for m, q in zip(_WORD.finditer(texts[i]), found, strict=True) if q >= least]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
                cols = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(n, pa.int64()), pa.array(spans, kind)]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, score double, predicted int, n_toxic_words bigint, toxic_spans array<struct<start:bigint,end:bigint,p:double>>")
