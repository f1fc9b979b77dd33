"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their beginnings (3 to 5 letters),
hashed to 64 bits.  A term has a weight and a short vector; the score adds the
weights of the terms present and the inner products of all pairs of their
vectors, so two harmless terms that are harmful together (an insult with the
mention of a group) can be told from either alone, which a sum of weights
cannot do.

The classifier is fitted on a bounded sample of the labelled training rows
(``TRAIN_ROWS`` of each label, by hash of their id): its terms are counted by
Spark, all that are in ``MIN_ROWS`` rows or more are hashed into at most ``BUCKETS``
buckets (numbered from the most frequent on, so that beyond ``BUCKETS`` terms a
frequent one shares its bucket with rarer ones only), and
``ROUNDS`` rounds of AdaGrad run on the sample's partitions in parallel, each
from the average of the last round's models.  No term is left out for being alike
in both labels: what matters may be a pair of such terms.  The model (buckets x (1 + RANK)
numbers) and the sample's terms (at most its words / ``MIN_ROWS``) are all that
meets on the driver.  A task returns what it changed, not the whole model.  Where the bound leaves
out more of one label than of the other, the sample's log-odds are moved to
those of all training labels after training, so a score keeps its meaning
whatever the size of the input.  Every document is scored whole, in one pass
without a shuffle.

Defined results: null or empty text has no term and gets the score of the bias
alone; without training rows of both labels that is the smoothed share of the
label; null labels and labels without an id are ignored, a document labelled
twice counts as toxic if either label says so; repeated rows give repeated
result rows; an empty table gives no row; only ``doc_id`` and ``text`` of the
documents and ``doc_id`` and ``toxic`` of the labels are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import fold, on_workers, stored

FOLDS = 5
HELD_OUT = 0
TRAIN_ROWS = 12_000       # labelled rows of each label, at most
BUCKETS = 1 << 16         # of terms in the model
MIN_ROWS = 4              # sample rows a term must be in
RANK = 4
ROUNDS = 20
PARTITION_ROWS = 3_000    # sample rows that one partition learns from
RATE = 0.5
DECAY = 1e-5
PREFIXES = (3, 4, 5)
CACHE_TOKENS = 300_000    # tokens whose terms a worker remembers
MARKS = ".,;:!?\"'()"         # often around a word; no letters

HALF = 1 << 63
_WORD = re.compile(r"[^\W\d_]+")


def _words(token: str) -> list[str]:
    """Runs of letters."""
    plain = token.strip(MARKS)
    return [plain] if plain.isalpha() else _WORD.findall(token)


def _begins(word: str) -> list[str]:
    return [f"{word[:n]}-" for n in PREFIXES if len(word) >= n]


def _terms_of(token: str) -> list[int]:
    return [xxh3_64_intdigest(t) - HALF for w in _words(token) for t in (w, *_begins(w))]


class Terms:
    """Distinct hashed terms of a text; with ``known``, their numbers there.
    Tokens, and with ``known`` the beginnings of words, are remembered."""

    def __init__(self, known: dict[int, int] | None = None):
        self.known, self.seen, self.begun = known, {}, {}

    def _numbers(self, token: str) -> list[int]:
        known, out = self.known, []
        for w in _words(token):
            begin = w[:PREFIXES[-1]]
            ids = self.begun.get(begin)
            if ids is None:
                hashes = [xxh3_64_intdigest(t) - HALF for t in _begins(begin)]
                ids = self.begun[begin] = [known[x] for x in hashes if x in known]
            whole = known.get(xxh3_64_intdigest(w) - HALF)
            if whole is not None:
                out.append(whole)
            out += ids
        return out

    def __call__(self, text: str) -> list[int]:
        if len(self.seen) > CACHE_TOKENS:
            self.seen.clear()
        if len(self.begun) > CACHE_TOKENS:
            self.begun.clear()
        of = _terms_of if self.known is None else self._numbers
        seen, found = self.seen, set()
        for token in set((text or "").lower().split()):
            ids = seen.get(token)
            if ids is None:
                ids = seen[token] = of(token)
            found.update(ids)
        return sorted(found)


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(label, text) of the training sample; the ids chosen are bounded, so
    they are broadcast and no text is shuffled.  And by how much the log-odds
    of all training labels lie above the sample's."""
    import math
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1)))
    one = (known.where(fold(F.col("id"), FOLDS) != HELD_OUT)
           .groupBy("id").agg(F.max("label").alias("label")))
    n = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    parts = [n[k] / min(n[k], TRAIN_ROWS) if k in n else 1.0 for k in (0, 1)]      # labels a chosen one stands for
    order = [F.xxhash64("id"), F.col("id")]
    chosen = (one.where("label = 0").orderBy(*order).limit(TRAIN_ROWS)
              .unionByName(one.where("label = 1").orderBy(*order).limit(TRAIN_ROWS)))
    sample = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id").select(
        "label", "text")
    return sample, math.log(parts[1] / parts[0])


def _count_terms(batches):
    """Per task: in how many rows a term is."""
    from collections import Counter

    import pyarrow as pa
    terms, counts = Terms(), Counter()

    def rows():
        out = pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())},
                                         schema=pa.schema([("term", pa.int64()), ("n", pa.int64())]))
        counts.clear()
        return out

    for b in batches:
        for text in b.column(1):
            counts.update(terms(text.as_py()))
            if len(counts) > 500_000:
                yield rows()
    yield rows()


def _buckets(sample: DataFrame) -> dict[int, int]:
    """Bucket of every term in ``MIN_ROWS`` sample rows or more."""
    import numpy as np
    found = (sample.mapInArrow(_count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= MIN_ROWS).toArrow())
    term, n = found["term"].to_numpy(), found["n"].to_numpy()
    return {int(t): i % BUCKETS for i, t in enumerate(term[np.lexsort((term, -n))])}


def raw_score(ids, bias, weight, vector):
    """Bias, weights and pairwise products of the terms present."""
    v = vector[ids]
    s = v.sum(axis=0)
    return bias + weight[ids].sum() + 0.5 * float(s @ s - (v * v).sum())


def _epoch(ids_of, labels, table, seed):
    """The model's table after one AdaGrad pass over the rows, in a shuffled
    order; a row's terms are fetched and put back once."""
    import numpy as np
    t = table.copy()
    bias, gb = t[-1, 0], t[-1, 1]
    for r in np.random.default_rng(seed).permutation(len(labels)):
        ids = ids_of[r]
        x = t[ids]
        w, gw, v, gv = x[:, 0], x[:, 1], x[:, 2:2 + RANK], x[:, 2 + RANK:]
        s = v.sum(axis=0)
        z = bias + w.sum() + 0.5 * float(s @ s - (v * v).sum())
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[r]
        gb += g * g
        bias -= RATE * g / np.sqrt(gb)
        d = g + DECAY * w
        gw += d * d
        w -= RATE * d / np.sqrt(gw)
        d = np.clip(g * (s - v), -1, 1) + DECAY * v
        gv += d * d
        v -= 0.2 * RATE * d / np.sqrt(gv)
        t[ids] = x
    t[-1, :2] = bias, gb
    return t


FIELDS = ["w", "gw", *[f"v{i}" for i in range(RANK)], *[f"g{i}" for i in range(RANK)]]


def _table(m):
    """A model as a matrix: a row per term, with the bias in a last row."""
    import numpy as np
    terms = np.column_stack((m["w"], m["gw"], m["v"], m["gv"]))
    bias = np.zeros((1, len(FIELDS)))
    bias[0, :2] = m["bias"], m["gb"]
    return np.concatenate((terms, bias))


def _model(t):
    return {"bias": float(t[-1, 0]), "gb": float(t[-1, 1]), "w": t[:-1, 0], "gw": t[:-1, 1],
            "v": t[:-1, 2:2 + RANK], "gv": t[:-1, 2 + RANK:]}


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model: ``terms`` (hash -> number), bias, weights and vectors."""
    import numpy as np
    sample, offset = _sample(on_workers(docs), labels)
    sample = stored(sample, "op8-sample")
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    known = _buckets(sample) if n0 and n1 else {}
    k = min(len(known), BUCKETS)
    model = {"bias": prior, "gb": 1.0, "w": np.zeros(k), "gw": np.ones(k),
             "v": np.random.default_rng(7).normal(0, 0.01, (k, RANK)), "gv": np.ones((k, RANK))}
    if not k:
        return model | {"terms": known, "bias": prior + offset}
    shared_terms = docs.sparkSession.sparkContext.broadcast(known)

    def number(batches):
        import pyarrow as pa
        of = Terms(shared_terms.value)
        for b in batches:
            ids = pa.array([of(t.as_py()) for t in b.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["label", "ids"])

    rows = stored(sample.mapInArrow(number, "label int, ids array<int>"), "op8-terms")
    rows = rows.coalesce(-(-(n0 + n1) // PARTITION_ROWS))      # bounded by the sample; no shuffle
    out = "id int, " + ", ".join(f"{c} float" for c in FIELDS)
    total = [F.sum(c).alias(c) for c in FIELDS]
    for turn in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast(_table(model))

        def learn(batches, shared=shared, turn=turn):
            import numpy as np
            import pyarrow as pa
            labels, ids = [], []
            for b in batches:
                labels += b.column(0).to_pylist()
                cuts, values = b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy().astype(np.int64)
                ids += [values[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            if labels:
                # this partition's share of the change of the average model
                change = (_epoch(ids, labels, shared.value, turn) - shared.value) * (len(labels) / (n0 + n1))
                used = np.flatnonzero(change.any(axis=1))
                columns = [used.astype(np.int32), *change[used].T.astype(np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                                 names=["id", *FIELDS])

        # the partitions' models are averaged by Spark: one model reaches the driver
        change = rows.mapInArrow(learn, out).groupBy("id").agg(*total).toArrow()
        table = _table(model)
        table[change["id"].to_numpy()] += np.column_stack([change[c].to_numpy() for c in FIELDS])
        model = _model(table)
        shared.unpersist()
    return model | {"terms": known, "bias": model["bias"] + offset}


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model["terms"], model["bias"], model["w"], model["v"]))

    def score(batches):
        import numpy as np
        import pyarrow as pa
        known, bias, w, v = shared.value
        of = Terms(known)
        for b in batches:
            z = [raw_score(np.asarray(of(t.as_py()), np.int64), bias, w, v) for t in b.column(1)]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        score, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
