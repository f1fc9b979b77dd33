"""Language identification by multilingual mixture inference.

Every learned language has a model of hashed byte trigrams over words.  A
document is a mixture: each word comes from one of its languages, with that
language's trigram likelihood, and expectation-maximisation over the words
estimates the languages' proportions.  Sets of one, two, ... languages (the
most probable of the full mixture) are fitted in turn, and the set with the
highest likelihood less a penalty per language (half the logarithm of the
number of words, BIC) is taken; the prediction is its largest language, the
score that language's proportion.

The pipeline's stage adds one more component to the mixture, a background under
which every trigram is equally likely: text of no learned language (random
strings, encoded data, other scripts) is more likely under it than under any of
them, and a document of which the background is the largest part goes.  A
trigram of a learned language is several times likelier there than in the
background, so clean text, seen or not, stays.  ``op4_language_id`` names a
learned language for every text with a letter, and has no background.

Trigram counts cover all training rows; they are summed per task and by Spark,
and only the table (languages x ``BUCKETS``) meets on the driver.

Defined results: text that is null or without a letter is ``und`` with score
0, as is every text when nothing was learned; null langs are not learned from;
repeated rows give repeated result rows; an empty table gives no row; a very long
text is taken whole, in parts cut at spaces; of languages with equal shares the
first in alphabetical order is taken; only ``doc_id``, ``text`` and ``lang`` are
read, and a prediction reads the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, on_workers

FOLDS = 4
HELD_OUT = 2
BUCKETS = 1 << 15
STEPS = 8                 # EM steps for each language set
SMOOTHING = 0.5
BATCH_BYTES = 1 << 20     # text handled together (bounds memory)
MIN_SHARE = 1 / 3         # a document of which no language has this share is kept by no pipeline
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _folding():
    """Byte -> byte: small letters and bytes of other scripts stay, A-Z become
    small, all else parts words."""
    import numpy as np
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_TABLE = None


def trigrams(text: bytes):
    """(bucket, word) of every byte trigram that holds part of a word; words
    are numbered from 0."""
    import numpy as np
    global _TABLE
    if _TABLE is None:
        _TABLE = _folding()
    b = _TABLE[np.frombuffer(b" " + text + b" ", np.uint8)]
    inside = b != 32
    mid = np.flatnonzero(inside[1:-1]) + 1                # one trigram around every letter
    word = np.cumsum(~inside[:-1] & inside[1:])[mid - 1] - 1
    c = b.astype(np.uint32)
    code = c[mid - 1] | (c[mid] << 8) | (c[mid + 1] << 16)
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32), word


def _parts(text: bytes):
    """The text in parts of at most about BATCH_BYTES, cut at spaces."""
    at = 0
    while at < len(text):
        end = at + BATCH_BYTES
        cut = text.rfind(b" ", at, end) if end < len(text) else len(text)
        end = cut if cut > at else min(end, len(text))
        yield text[at:end]
        at = end


def _count(batches):
    """Per task: trigram counts of each language."""
    import numpy as np
    import pyarrow as pa
    counts: dict[str, object] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            table = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for part in _parts(text.as_py()):
                table += np.bincount(trigrams(part)[0], minlength=BUCKETS)
    for lang, table in counts.items():
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)),
                                          pa.array(table[used])], names=["lang", "bucket", "n"])


def fit(docs: DataFrame):
    """(languages, log-probabilities [bucket, language])."""
    import numpy as np
    train = on_workers(docs).where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("lang", "text")
    rows = (train.mapInArrow(_count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())   # languages x BUCKETS rows
    langs = sorted(rows["lang"].unique())
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    if langs:
        table[rows["bucket"], rows["lang"].map({x: i for i, x in enumerate(langs)})] += rows["n"]
    return langs, np.log(table / table.sum(axis=0, keepdims=True)).astype(np.float32)


def _mixture(like, starts, sizes, pi):
    """EM for all documents of a batch: like [word, language] scaled
    likelihoods, pi [document, language]."""
    import numpy as np
    of = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(STEPS):
        share = like * pi[of]
        share /= share.sum(axis=1, keepdims=True)
        pi = np.add.reduceat(share, starts, axis=0) / sizes[:, None]
    return pi


def _fit_of(like, starts, sizes, pi):
    import numpy as np
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.add.reduceat(np.log((like * pi[of]).sum(axis=1)), starts)


def infer(texts: list[bytes], logp):
    """(language number, proportion) for each text of a batch; every text has
    a word."""
    import numpy as np
    n_langs = logp.shape[1]
    like, sizes = [], []
    for t in texts:
        words = 0
        for part in _parts(t):
            bucket, word = trigrams(part)
            if len(word):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                like.append(np.add.reduceat(logp[bucket], first, axis=0))
                words += len(first)
        sizes.append(words)
    like, sizes = np.concatenate(like).astype(np.float64), np.array(sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    like = np.exp(np.maximum(like - like.max(axis=1, keepdims=True), -40))
    full = _mixture(like, starts, sizes, np.full((len(texts), n_langs), 1 / n_langs))
    order = np.argsort(-full, axis=1, kind="stable")
    lang, share, best = np.zeros(len(texts), int), np.ones(len(texts)), np.full(len(texts), -np.inf)
    for size in range(1, n_langs + 1):
        # no word's scaled likelihood is above 1, so no larger set can be better than its penalty
        if (-0.5 * (size - 1) * np.log(sizes) <= best).all():
            break
        pi = np.zeros_like(full)
        np.put_along_axis(pi, order[:, :size], 1 / size, axis=1)
        if size > 1:
            pi = _mixture(like, starts, sizes, pi)
        value = _fit_of(like, starts, sizes, pi) - 0.5 * (size - 1) * np.log(sizes)
        better = value > best
        best[better] = value[better]
        lang[better] = pi[better].argmax(axis=1)
        share[better] = pi[better].max(axis=1)
    return lang, share


def with_background(langs: list[str], logp):
    """The model with a last component, named ``UNKNOWN``, of equal trigrams."""
    import numpy as np
    if not langs:
        return langs, logp
    return [*langs, UNKNOWN], np.column_stack((logp, np.full(BUCKETS, -np.log(BUCKETS), np.float32)))


def predictor(docs: DataFrame, background: bool = False):
    """Learn from ``docs``; a function from a text column to (lang_pred, score)."""
    langs, logp = fit(docs)
    if background:
        langs, logp = with_background(langs, logp)
    shared = docs.sparkSession.sparkContext.broadcast((langs, logp))

    @F.pandas_udf("lang_pred string, score double")
    def predict(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, logp = shared.value
        for batch in column:
            texts = batch.tolist()
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            group, held = [], 0
            for i, t in enumerate([*texts, None]):
                if t is not None and langs and _LETTER.search(t):
                    group.append(i)
                    held += len(t)
                if group and (held > BATCH_BYTES or i == len(texts)):
                    for j, x, s in zip(group, *infer([texts[j].encode() for j in group], logp)):
                        pred[j], score[j] = langs[x], float(s)
                    group, held = [], 0
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return predict


def language_id(docs: DataFrame, background: bool = False) -> DataFrame:
    """``docs`` as struct column ``doc``, with held_out, lang_pred and score."""
    predict = predictor(docs, background)
    return (docs.select(F.struct("*").alias("doc")).withColumn("found", predict(F.col("doc.text").cast("string")))
            .select("doc", (fold(F.col("doc.doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                    "found.lang_pred", "found.score"))


def in_known_language(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """The documents of which at least ``min_share`` is in one learned
    language, unchanged; ``und``, text that is mostly background and mixtures
    without such a share go."""
    return (language_id(docs, background=True).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_share))
            .select("doc.*"))
