"""Quality classifier: a weak-label model over heuristic labellers, and a hashed linear scorer.

1. Nine labellers look at counts of a document and vote good, bad or abstain.
2. Votes are counted by pattern over all documents (at most 3 ** 9 patterns, so the table that
   reaches the driver has a fixed bound). Expectation-maximisation over it estimates each
   labeller's accuracies and the share of good documents, without any labelled row.
3. The posterior of a document's pattern is its soft label. A linear scorer over hashed features
   (byte grams, and the counts in coarse steps) is fitted to the soft labels of a bounded sample,
   and scores every document.

A document stays when the mean of the two log-odds, the pattern's and the scorer's, is not
under that of ``threshold``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrivals_star.llm import spans

U64 = np.uint64
GOOD, BAD, ABSTAIN = 1, -1, 0
DIM_BITS = 14
DIM = 1 << DIM_BITS
#: Prior chances of a vote (bad, none, good) in a bad and in a good document, weighed as this share
#: of the documents: labellers are taken to be better than chance.
PRIOR_VOTES, PRIOR_SHARE = ((0.3, 0.4, 0.3), (0.01, 0.4, 0.59)), 0.05
SAMPLE = 6000  # documents the scorer is fitted to, at most about; chosen by a hash of id and text
STATS = ("upper", "signs", "bare_words", "word_length", "top_word", "repeats", "exclaims", "few_kinds", "stop_words")
#: Common words of the four languages of the corpus, lower case.
STOP_WORDS = ("the of and to in is it that for was on are with as be this have from or by an at not "
              "der die und das den von zu mit sich des auf für ist im dem nicht ein eine "
              "le la de et les des en un du une que est pour qui dans sur au pas "
              "el los que se las por con para su al lo como más una y a").split()


def _classes() -> np.ndarray:
    """Bits of each byte: 1 letter (any byte past ASCII too), 2 upper case, 4 other sign, 8 exclamation."""
    t = np.zeros(256, np.uint8)
    t[65:91] = 1 | 2
    t[97:123] = 1
    t[128:] = 1
    for b in range(33, 127):
        if not chr(b).isalnum() and chr(b) not in ".,;:'\"()?!-":
            t[b] |= 4
    t[ord("!")] |= 8
    return t


CLASS = _classes()
FOLD = np.arange(256)
FOLD[65:91] += 32


def document_stats(buf: np.ndarray, offsets: np.ndarray, stop_hash: np.ndarray, hasher: spans.SpanHash) -> np.ndarray:
    """One row of STATS per document, after its number of words."""
    n = len(offsets) - 1
    out = np.zeros((n, 1 + len(STATS)))
    size = np.maximum(np.diff(offsets), 1)
    sums = {}
    for bit in (1, 2, 4, 8):
        running = np.zeros(len(buf) + 1, np.int64)
        for b in range(0, len(buf), spans.BLOCK):
            part = (CLASS[buf[b:b + spans.BLOCK]] & bit) > 0
            running[b + 1:b + 1 + len(part)] = np.cumsum(part) + running[b]
        sums[bit] = running
    per_doc = {bit: np.diff(s[offsets]) for bit, s in sums.items()}
    starts, ends, doc = spans.words(buf, offsets)
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    h = hasher(buf, starts, ends)
    bare = (sums[1][ends] - sums[1][starts]) == 0
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, doc[order][first], runs)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    known = np.searchsorted(stop_hash, h)
    stop = stop_hash[np.minimum(known, len(stop_hash) - 1)] == h
    out[:, 0] = count
    out[:, 1] = per_doc[2] / np.maximum(per_doc[1], 1)
    out[:, 2] = per_doc[4] / size
    out[:, 3] = np.bincount(doc[bare], minlength=n) / some
    out[:, 4] = np.bincount(doc, ends - starts, n) / some
    out[:, 5] = top / some
    out[:, 6] = np.bincount(doc[same], minlength=n) / some
    out[:, 7] = per_doc[8] / some
    out[:, 8] = np.where(count >= 30, 1 - np.bincount(doc[order][first], minlength=n) / some, 0)
    out[:, 9] = np.bincount(doc[stop], minlength=n) / some
    return out


#: Per labeller: votes bad from, and good under, this value; None: it looks for a defect only and
#: has no vote for good. Short texts get no votes.
RULES = {"upper": (0.5, None), "signs": (0.03, None), "bare_words": (0.2, None), "word_length": (14.0, 9.0),
         "top_word": (0.25, 0.12), "repeats": (0.3, None), "exclaims": (0.3, None),
         "few_kinds": (0.85, None)}
LEAST_WORDS = 12


def votes(stats: np.ndarray) -> np.ndarray:
    """Votes (documents x labellers) of +1 good, -1 bad, 0 none."""
    out = np.zeros((len(stats), len(STATS)), np.int64)
    for k, name in enumerate(STATS):
        x = stats[:, k + 1]
        if name in RULES:
            bad, good = RULES[name]
            out[:, k] = np.where(x >= bad, BAD, ABSTAIN if good is None else np.where(x < good, GOOD, ABSTAIN))
        else:  # stop words: many are good, none in a long text is bad
            out[:, k] = np.where(x >= 0.05, GOOD, np.where((x == 0) & (stats[:, 0] >= 50), BAD, ABSTAIN))
    out[stats[:, 0] < LEAST_WORDS] = ABSTAIN
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1).astype(np.int32)


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(STATS)) % 3 - 1


def fit_weak_labels(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior probability of good for each pattern, by expectation-maximisation.

    For both classes and every labeller the model has the chances of voting good, bad and not at
    all; votes are independent given the class. The start trusts a bad vote more than good ones, as
    labellers vote good wherever they see nothing wrong.
    """
    v = votes_of(pattern)
    silent = (v == ABSTAIN).all(axis=1)  # no votes at all: nothing to learn from, the prior holds
    count = np.where(silent, 0, count)
    good, bad = (v == GOOD).sum(axis=1), (v == BAD).sum(axis=1)
    post = np.where(bad > 0, 0.2, np.where(good > 0, 0.95, 0.75))
    onehot = np.stack([v == k for k in (BAD, ABSTAIN, GOOD)], axis=2).astype(float)
    believed = (np.array(PRIOR_VOTES) * (PRIOR_SHARE * count.sum() + 1))[:, None, :]
    for _ in range(rounds):
        weight = np.stack([count * (1 - post), count * post])  # class x pattern
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        chance = np.einsum("cp,plk->clk", weight, onehot) + believed
        chance /= chance.sum(axis=2, keepdims=True)
        logs = np.log(prior.clip(1e-9))[:, None] + np.einsum("plk,clk->cp", onehot, np.log(chance))
        new = 1 / (1 + np.exp((logs[0] - logs[1]).clip(-500, 500)))
        new[silent] = prior[1]
        if np.abs(new - post).max() < 1e-9:
            post = new
            break
        post = new
    return post


def hashed_features(buf: np.ndarray, offsets: np.ndarray, stats: np.ndarray):
    """Gram slots with their documents, and the slots of the stepped counts (documents x STATS)."""
    n, size = len(offsets) - 1, 3
    m = max(len(buf) - size + 1, 0)
    gram = np.zeros(m, np.uint32)
    for k in range(size):
        gram = gram << np.uint32(8) | buf[k:k + m]
    slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIM_BITS)
    steps = np.floor(np.log2(stats[:, 1:] * 64 + 1)).astype(np.int64)
    code = (np.arange(len(STATS)) + 1) * 64 + steps
    return slot, (code * 0x9E3779B1 >> 7) % DIM


def gram_means(slot: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each document's grams, in blocks."""
    n = len(offsets) - 1
    out = np.zeros(n)
    for b in range(0, len(slot), spans.BLOCK):
        e = min(len(slot), b + spans.BLOCK)
        first, last = int(np.searchsorted(offsets, b, "right")) - 1, int(np.searchsorted(offsets, e, "left"))
        inside = np.clip(offsets[first:last], b, e) - b
        docs = np.flatnonzero(np.diff(np.append(inside, e - b)) > 0)
        out[first + docs] += np.add.reduceat(weights[slot[b:e]], inside[docs])
    return out / np.maximum(np.diff(offsets), 1)


def _slices(col: pa.Array):
    """(first, last document, bytes, bounds) of slices of whole documents of about 4 MB."""
    buf, offsets = spans.run_buffer(col)
    d, n = 0, len(offsets) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(offsets, offsets[d] + (1 << 22), "right")) - 1)
        yield d, e, buf[offsets[d]:offsets[e]], offsets[d:e + 1] - offsets[d]
        d = e


def _stop_hashes(hasher: spans.SpanHash) -> np.ndarray:
    raw = [w.encode() for w in STOP_WORDS]
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(hasher(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends))


def vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = spans.SpanHash(73, FOLD)
    stop = _stop_hashes(hasher)
    for batch in batches:
        for _, _, buf, offsets in _slices(batch["text"]):
            pattern = pattern_of(votes(document_stats(buf, offsets, stop, hasher)))
            yield pa.RecordBatch.from_arrays([pa.array(pattern)], names=["pattern"])


def sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pattern and sparse features of the sampled documents: grams by share, counts as ones."""
    hasher = spans.SpanHash(73, FOLD)
    stop = _stop_hashes(hasher)
    for batch in batches:
        for _, _, buf, offsets in _slices(batch["text"]):
            stats = document_stats(buf, offsets, stop, hasher)
            pattern = pattern_of(votes(stats))
            slot, code = hashed_features(buf, offsets, stats)
            grams, weights = [], []
            for d, (i, j) in enumerate(zip(offsets, offsets[1:])):
                s, c = np.unique(slot[i:j], return_counts=True)
                grams.append(np.concatenate([s, code[d]]).astype(np.int32).tobytes())
                weights.append(np.concatenate([c / max(j - i, 1), np.full(len(STATS), 0.1)]).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(grams, pa.binary()), pa.array(weights, pa.binary())],
                                             names=["pattern", "grams", "weights"])


def score_batches(weights: np.ndarray, bias: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = spans.SpanHash(73, FOLD)
        stop = _stop_hashes(hasher)
        for batch in batches:
            for d, e, buf, offsets in _slices(batch["text"]):
                stats = document_stats(buf, offsets, stop, hasher)
                slot, code = hashed_features(buf, offsets, stats)
                z = bias + gram_means(slot, offsets, weights) + 0.1 * weights[code].sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(d, e - d), pa.array(pattern_of(votes(stats))), pa.array(z)],
                    names=["doc_id", "pattern", "margin"])
    return work


def fit_scorer(rows: list, target: np.ndarray, steps: int = 400, rate: float = 100.0, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer for soft labels, by full-batch gradient steps."""
    slots = [np.frombuffer(r["grams"], np.int32) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(s) for s in slots])
    slot = np.concatenate(slots) if slots else np.zeros(0, np.int32)
    value = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in rows]) if rows else np.zeros(0, np.float32)
    weights, bias = np.zeros(DIM), 0.0
    for _ in range(steps if rows else 0):
        z = bias + np.bincount(row, weights[slot] * value, len(rows))
        error = (1 / (1 + np.exp(-z)) - target) / len(rows)
        weights -= rate * (np.bincount(slot, error[row] * value, DIM) + l2 * weights / max(len(rows), 1))
        bias -= error.sum()
    return weights, float(bias)


def _smallest_hashes(docs: DataFrame, n: int) -> DataFrame:
    """n rows with the smallest hashes of id and text: n at most, however many rows are equal."""
    keyed = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    least = [r["h"] for r in keyed.select("h").orderBy("h").limit(n).collect()]
    if len(least) < n:
        return docs
    under = sum(h < least[-1] for h in least)
    # rows with the last hash are equal to each other, so it does not matter which of them are taken
    return keyed.where(F.col("h") < least[-1]).unionByName(keyed.where(F.col("h") == least[-1]).limit(n - under)).drop("h")


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
            sample: int = SAMPLE) -> DataFrame:
    """doc_id, weak_label, score, quality, kept of every document.

    ``weak_label`` is the posterior of the document's votes, ``score`` the scorer's probability,
    ``quality`` the probability of their mean log-odds; ``kept`` is quality >= threshold. Null text
    is empty; texts of fewer than twelve words get no votes and keep the prior, which is good in any
    corpus that is mostly good. ``sample`` bounds the documents the scorer is fitted to; votes,
    estimates and scores cover all. Null ids stay null; repeated rows each give a row; other
    columns are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    table = (docs.select("text").mapInArrow(vote_batches, "pattern int")
             .groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect())
    pattern, count = (np.array([r[k] for r in table], np.int64) for k in (0, 1))
    post = fit_weak_labels(pattern, count) if len(pattern) else np.zeros(0)
    rows = _smallest_hashes(docs, sample).select("text").mapInArrow(sample_batches, "pattern int, grams binary, weights binary").collect()
    by_pattern = dict(zip(pattern.tolist(), post.tolist()))
    weights, bias = fit_scorer(rows, np.array([by_pattern[r["pattern"]] for r in rows]))
    scored = docs.mapInArrow(score_batches(weights, bias), "doc_id long, pattern int, margin double")
    # the pattern table is bounded by 3 ** labellers, whatever the input
    known = df.sparkSession.createDataFrame([(p, w) for p, w in by_pattern.items()], "pattern int, weak_label double")
    odds = lambda c: F.log(F.greatest(c, F.lit(1e-6)) / F.greatest(1 - c, F.lit(1e-6)))
    joined = scored.join(F.broadcast(known), "pattern", "left").withColumn(
        "quality", 1 / (1 + F.exp(-(odds(F.col("weak_label")) + F.col("margin")) / 2)))
    return joined.select("doc_id", "weak_label", (1 / (1 + F.exp(-F.col("margin")))).alias("score"), "quality",
                         (F.col("quality") >= threshold).alias("kept"))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


__all__ = ["quality", "fit_weak_labels", "fit_scorer", "votes", "document_stats", "op1_quality"]
