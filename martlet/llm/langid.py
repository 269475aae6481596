"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of labelled texts in Spark (one sparse count row per
language and bucket); the log-probability matrix, ``BUCKETS`` x languages, is
broadcast (its size is fixed by the two bounds below); texts are scored in
numpy batches by summing the matrix rows of their n-grams.

The classifier is fitted on a bounded sample: about ``PER_LANG`` labelled rows
of each language, picked by a hash of ``doc_id`` and read whole.  Everything
else reads all rows and whole texts.

Defined cases: a null text or one without a letter gets ``und`` and score 0;
with nothing to learn from every text gets ``und``; a null doc_id is not held
out and not learned from; rows that repeat are scored alike; other columns are
carried along by the caller's join-free select; an empty table gives an empty
result.  More than ``MAX_LANGS`` languages raise an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64

BUCKETS, ORDERS = 1 << 14, (1, 2, 3)
#: Bound of the training sample, rows per language; bound of the label set.
PER_LANG, MAX_LANGS = 20_000, 400
#: Characters scored at once (bounds a task's arrays).
SEGMENT = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_GAP = 32


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: bucket of every n-gram of the texts, and the text's number.
    Texts are padded with one space on either side; n-grams do not cross texts."""
    rows = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    code = np.concatenate(rows).astype(np.uint64) if rows else np.zeros(0, np.uint64)
    own = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(code) - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint64(0x100000001B3) + code[n - 1:n - 1 + m]
        if n in ORDERS:
            inside = own[:m] == own[n - 1:n - 1 + m]
            bucket = (mix64(h + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64)
            yield bucket[inside], own[:m][inside]


def _pieces(text: str) -> list[str]:
    """A very long text in pieces of SEGMENT characters; n-grams do not cross the
    seam, so a handful of n-grams per million differ
    (alike when learning and scoring)."""
    return [text[i:i + SEGMENT] for i in range(0, len(text), SEGMENT)] or [""]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
            docs[lang] = docs.get(lang, 0) + 1
            for piece in _pieces(text):
                for bucket, _ in grams([piece]):
                    total += np.bincount(bucket, minlength=BUCKETS)
    for lang, total in held.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.concatenate(([-1], at)), pa.int32()),
             pa.array(np.concatenate(([docs[lang]], total[at])), pa.int64())], names=["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(languages, log prior, log probability matrix)`` from the rows that
    are labelled and not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the matrix would exceed its size bound")
    if not sizes:
        return [], np.zeros(0), np.zeros((BUCKETS, 0))
    langs = sorted(r["lang"] for r in sizes)
    picked = F.lit(False)
    for r in sizes:
        share = min(1.0, PER_LANG / r["n"])
        picked = picked | ((F.col("lang") == r["lang"])
                           & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)))
    rows = (known.where(picked).select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())  # <= MAX_LANGS * (BUCKETS + 1) rows
    at = {lang: i for i, lang in enumerate(langs)}
    count, prior = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    for r in rows:
        if r["bucket"] < 0:
            prior[at[r["lang"]]] = r["n"]
        else:
            count[r["bucket"], at[r["lang"]]] = r["n"]
    smooth = count + 0.5
    logp = np.log(smooth) - np.log(smooth.sum(axis=0))
    return langs, np.log((prior + 1) / (prior + 1).sum()), logp


def score_texts(texts: list[str], prior: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every text, the posterior of every language, and how much more likely the
    best one makes an n-gram than a uniform background does (mean log ratio)."""
    total, n = np.tile(prior, (len(texts), 1)), np.zeros(len(texts))
    for bucket, own in grams(texts):
        n += np.bincount(own, minlength=len(texts))
        for j in range(logp.shape[1]):
            total[:, j] += np.bincount(own, weights=logp[bucket, j], minlength=len(texts))
    return _posterior(total, prior, n)


def _posterior(total: np.ndarray, prior: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best = total.argmax(axis=1)
    fit = (total[np.arange(len(total)), best] - prior[best]) / np.maximum(n, 1) + np.log(BUCKETS)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), fit


def _score_long(text: str, prior: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, float]:
    total, n = prior.copy(), 0
    for piece in _pieces(text):
        for bucket, _ in grams([piece]):
            n += len(bucket)
            total = total + np.bincount(bucket, minlength=BUCKETS) @ logp
    p, fit = _posterior(total[None, :], prior, np.array([n]))
    return p[0], float(fit[0])


def identify(docs: DataFrame, train_on: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_id: struct<lang_pred, score, fit>``; learns from
    ``train_on`` (default: ``docs`` itself), never from the held-out rows.  ``fit`` is
    the mean log ratio of the text's n-grams under the predicted language and under a
    uniform background (0 for ``und``): above 0, the language explains the text; null
    when there was nothing to learn from."""
    langs, prior, logp = train(docs if train_on is None else train_on)
    model = docs.sparkSession.sparkContext.broadcast((langs, prior, logp))

    @F.pandas_udf("lang_pred string, score double, fit double")
    def predict(column):  # noqa: ANN001, ANN202
        import pandas as pd

        langs, prior, logp = model.value
        texts = column.tolist()
        pred, score = ["und"] * len(texts), np.zeros(len(texts))
        fit = np.full(len(texts), 0.0 if langs else np.nan)
        ask = [i for i, t in enumerate(texts) if t and langs and _LETTER.search(t)]
        start, held = 0, 0
        for k, i in enumerate(ask):
            held += len(texts[i])
            if held < SEGMENT and k < len(ask) - 1:
                continue
            group, start, held = ask[start:k + 1], k + 1, 0
            long = [i for i in group if len(texts[i]) > SEGMENT]
            rest = [i for i in group if len(texts[i]) <= SEGMENT]
            made = dict(zip(rest, zip(*score_texts([texts[i] for i in rest], prior, logp)))) if rest else {}
            made.update((i, _score_long(texts[i], prior, logp)) for i in long)
            for i, (p, f) in made.items():
                best = int(p.argmax())
                pred[i], score[i], fit[i] = langs[best], round(float(p[best]), 6), round(float(f), 6)
        return pd.DataFrame({"lang_pred": pred, "score": score, "fit": fit})

    return docs.withColumn("lang_id", predict(F.col(f"`{text}`")))
