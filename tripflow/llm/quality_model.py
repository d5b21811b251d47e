"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its features: every word, the
character n-grams of every word (with word-boundary marks), and every word
bigram, hashed into a table of ``BUCKETS`` vectors. Softmax over the average
gives the label's probability. Vectors and softmax are trained by numpy
stochastic gradient descent on a bounded sample of labelled documents.

The softmax sees an average, so the log-odds of a document are the average of
one number per bucket; scoring ships that table of bounded size and runs over
all documents in their own partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import arrow_conf
from ._words import _PLACE, hash_strings, mix, ngram_hashes, words, tidy
from .encode import gathered

_U = np.uint64
BUCKETS = 1 << 18
DIM = 8
CHARS = (3, 4, 5)
#: Labelled documents that the model is fitted on, at most.
MAX_TRAIN = 3000
_SAME = mix(np.array([12345], np.uint64))[0]  # stands for a bigram of equal words


def word_features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its character n-grams, end to end, with the
    words' offsets."""
    n = len(vocabulary)
    own = (hash_strings(vocabulary) % _U(BUCKETS)).astype(np.int32)
    text = "".join(f"<{w}>" for w in vocabulary.to_pylist())
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in vocabulary.to_pylist()], np.int64)
    word = np.repeat(np.arange(n), size)
    ids, of = [own], [np.arange(n)]
    for k in CHARS:
        m = len(code) - k + 1
        if m <= 0:
            continue
        acc = code[:m] * _PLACE[k]
        for j in range(1, k):
            acc += code[j: j + m] * _PLACE[k + 7 * j]
        inside = word[:m] == word[k - 1: k - 1 + m]
        ids.append((mix(acc[inside] + _U(k)) % _U(BUCKETS)).astype(np.int32))
        of.append(word[:m][inside])
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order], np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n))))


def features(text: pa.Array):
    """Words of a batch as (index into the vocabulary, offsets of the texts,
    vocabulary features, their offsets, bigram buckets, bigram offsets)."""
    flat, off = words(text)
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy()
    vocabulary = coded.dictionary
    ids, voff = word_features(vocabulary)
    h = hash_strings(vocabulary)[index] if len(index) else np.zeros(0, np.uint64)
    pair, poff = ngram_hashes(h, off, 2)
    if len(pair):
        inside = np.ones(len(h) - 1, bool)
        ends = off[1:-1] - 1
        inside[ends[(ends >= 0) & (ends < len(inside))]] = False
        pair = np.where((h[:-1] == h[1:])[inside], _SAME, pair)
    return index, off, ids, voff, (pair % _U(BUCKETS)).astype(np.int32), poff


def document_bags(text: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct feature buckets of each text with their shares."""
    index, off, ids, voff, pair, poff = features(text)
    size = np.diff(voff)
    out = []
    for i in range(len(off) - 1):
        w = index[off[i]: off[i + 1]]
        n = size[w]
        at = np.repeat(voff[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        f, c = np.unique(np.concatenate((ids[at], pair[poff[i]: poff[i + 1]])), return_counts=True)
        out.append((f, (c / max(c.sum(), 1)).astype(np.float32)))
    return out


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, rate: float = 0.3,
          seed: int = 7) -> tuple[np.ndarray, float]:
    """Log-odds of every bucket, and the bias: softmax over averaged vectors,
    by SGD with a linearly falling rate. Classes weigh alike, whatever their
    sizes. Without bags all odds are even."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0, 1.0, (BUCKETS, DIM)).astype(np.float32)
    soft = np.zeros((DIM, 2), np.float32)
    bias = np.zeros(2, np.float32)
    weight = 0.5 / np.maximum(np.bincount(labels, minlength=2) / max(len(labels), 1), 0.05)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            f, share = bags[i]
            lr = rate * (1 - done / steps) * weight[labels[i]]
            done += 1
            if not len(f):
                continue
            own = vectors[f]
            mean = share @ own
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = soft @ p
            soft -= lr * np.outer(mean, p)
            bias -= lr * p
            # shares are small: over their squared norm the average itself moves by lr
            vectors[f] = own - (lr / float(share @ share)) * np.outer(share, back)
    return (vectors @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> tuple[pa.Array, np.ndarray]:
    """Whole texts and labels of at most ``limit`` labelled documents, those
    first in the order of a hash of doc_id. A doc_id whose label rows differ has
    no label; one with several texts gives its least, so ``limit`` rows at most
    reach the driver and none depends on the partitions."""
    marked = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id") \
        .agg(F.min("label").alias("label"), F.max("label").alias("_other")).filter("label = _other")
    some = marked.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.join(F.broadcast(some), "doc_id").groupBy("doc_id") \
        .agg(F.min("text").alias("text"), F.min("label").alias("label")).toArrow()
    rows = rows.sort_by("doc_id")
    return rows.column("text").combine_chunks(), rows.column("label").to_numpy()


def score_documents(docs: DataFrame, odds: np.ndarray, bias: float) -> DataFrame:
    """``doc_id`` and ``score`` of every row, over its whole text."""
    table = docs.sparkSession.sparkContext.broadcast((odds, bias))  # BUCKETS numbers

    def rows(batches):
        odds, bias = table.value
        for t in gathered(batches, "text"):
            index, off, ids, voff, pair, poff = features(t.column("text").combine_chunks())
            sums = np.concatenate(([0.0], np.cumsum(odds[ids], dtype=np.float64)))
            of_word = (sums[voff[1:]] - sums[voff[:-1]])[index]
            whole = np.concatenate(([0.0], np.cumsum(of_word)))
            pairs = np.concatenate(([0.0], np.cumsum(odds[pair], dtype=np.float64)))
            n = np.concatenate(([0], np.cumsum(np.diff(voff)[index])))
            count = n[off[1:]] - n[off[:-1]] + np.diff(poff)
            total = whole[off[1:]] - whole[off[:-1]] + pairs[poff[1:]] - pairs[poff[:-1]]
            z = np.clip(total / np.maximum(count, 1) + bias, -500, 500)
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id").combine_chunks(), pa.array(1 / (1 + np.exp(-z)))], names=["doc_id", "score"])

    return docs.mapInArrow(tidy(rows), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """Train on ``labels(doc_id, label)`` joined to ``docs(doc_id, text)`` and
    score every row of ``docs``: ``doc_id``, ``score`` (0 to 1, the probability
    of label 1) and ``predicted`` (1 if the score is 0.5 or more).

    Only the text is looked at. A null, empty or white-space text has no
    features and gets the softmax of the bias; without labelled rows every
    score is 0.5. Rows with a null doc_id are scored too; repeated rows are
    scored each; labels other than 0 and 1 are left out, and so are documents
    whose label rows differ. Other columns are ignored.
    """
    arrow_conf(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    text, label = training_sample(slim, marks, limit)
    odds, bias = train(document_bags(text), label)
    return score_documents(slim, odds, bias) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
