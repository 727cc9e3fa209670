"""Operator 4: language ID by averaged hashed subword embeddings.

A text is the mean of the embeddings of its byte n-grams (1 to 3 bytes, within
words, word ends included), hashed to ``BUCKETS`` rows; a linear softmax gives
the language. The embeddings and the softmax are trained together by
stochastic gradient descent in numpy on a bounded sample: the ``per_language``
documents of each language with the smallest hash of their id, each as a whole
and as a short window of its words. A fifth of the sample is held back to fit
the temperature, so the score is a calibrated probability; a text is rejected
when that probability is below ``min_score`` or when it has no letter.

Since embedding and softmax are linear, a text's logits are its n-gram counts
times one (buckets x languages) table, which every task applies to whole
texts, batch by batch.

Defined results: null text or text without a letter is ``und`` with score 0,
as is every text when no row can be learned from; a null id is never held out
nor learned from; repeated rows are predicted each on their own; an empty
table gives an empty result; extra columns are carried through or ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.arrow import tidy, utf8_slices
from quarry.llm.common import ship_package, table

BUCKETS = 8192
DIM = 16
PER_LANGUAGE = 400
MIN_SCORE = 0.4
UNDEFINED = "und"
SEED = 17
_CHUNK = 1 << 20

# letters keep their (lower-cased) byte, everything else ASCII is a gap
_LETTER = np.full(256, 32, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram that ends in ``data[2:]``; the caller pads."""
    b = _LETTER[data].astype(np.uint32)
    a0, a1, a2 = b[:-2], b[1:-1], b[2:]
    letter, middle = a2 != 32, a1 != 32
    one = a2[letter] * np.uint32(2654435761) + np.uint32(1)
    pair = letter | middle
    two = ((a1 * np.uint32(257) + a2)[pair] + np.uint32(70_000)) * np.uint32(2246822519)
    three = ((a0 * np.uint32(65_599) + a1 * np.uint32(257) + a2)[middle] + np.uint32(20_000_000)) * np.uint32(3266489917)
    grams = np.concatenate([one, two, three])
    grams ^= grams >> np.uint32(15)
    return (grams * np.uint32(2246822519)) >> np.uint32(19)  # 13 bits


def ngram_counts(text: np.ndarray) -> np.ndarray:
    """Counts of a whole text's n-grams per bucket, a slice at a time."""
    padded = np.concatenate([[32, 32], text, [32]]).astype(np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for i in range(0, len(padded) - 2, _CHUNK):
        counts += np.bincount(_buckets(padded[i:i + _CHUNK + 2]), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages, temperature included
    bias: np.ndarray
    min_score: float = MIN_SCORE

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        logits = counts @ self.weights / max(counts.sum(), 1) + self.bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def train(x: np.ndarray, y: np.ndarray, languages: list[str], hold: np.ndarray, epochs: int = 12,
          rate: float = 30.0, batch: int = 32, min_score: float = MIN_SCORE) -> Model:
    """Stochastic gradient descent on the rows of ``x`` (n-gram counts) that
    are not held back, then the temperature on those that are."""
    rng = np.random.default_rng(SEED)
    x = x / np.maximum(x.sum(axis=1, keepdims=True), 1)
    n = len(languages)
    embed = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, n), dtype=np.float32), np.zeros(n, dtype=np.float32)
    out += rng.normal(0, 0.5, out.shape)
    rows = np.flatnonzero(~hold) if (~hold).any() else np.arange(len(x))
    # rows of rare languages weigh more, so that the classes weigh alike
    share = np.bincount(y[rows], minlength=n)
    weight = (len(rows) / n / np.maximum(share, 1))[y].astype(np.float32)
    steps, done = epochs * -(-len(rows) // batch), 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for i in range(0, len(rows), batch):
            r = rows[i:i + batch]
            xb = x[r].astype(np.float32)
            hidden = xb @ embed
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(r)), y[r]] -= 1
            p *= weight[r, None] / len(r)
            lr = rate * (1 - done / steps)
            grad = p @ out.T
            out -= 0.05 * lr * (hidden.T @ p)
            bias -= 0.005 * lr * p.sum(axis=0)
            embed -= lr * (xb.T @ grad)
            done += 1
    weights = embed.astype(np.float64) @ out
    check = np.flatnonzero(hold) if hold.any() else np.arange(len(x))
    logits = x[check] @ weights + bias

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y[check]]).mean())

    # a perfect check set would want a temperature of 0; the range bounds it
    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return Model(tuple(languages), weights / temperature, bias / temperature, min_score)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _window(text: np.ndarray, seed: int) -> np.ndarray:
    """A run of 2 to 12 words at a place that depends on the seed."""
    words = text.tobytes().split()
    rng = np.random.default_rng(seed)
    at, n = int(rng.integers(0, max(len(words) - 1, 1))), int(rng.integers(2, 13))
    return np.frombuffer(b" ".join(words[at:at + n]), dtype=np.uint8)


def _sample_rows(batches):
    for batch in batches:
        out = {"lang": [], "h": [], "buckets": [], "counts": []}
        langs, hashes = batch.column("lang").to_pylist(), batch.column("h").to_pylist()
        for text, lang, h in zip(utf8_slices(batch.column("text")), langs, hashes):
            for part in (text, _window(text, h & 0x7FFFFFFF)):
                counts = ngram_counts(part)
                at = np.flatnonzero(counts)
                out["lang"].append(lang)
                out["h"].append(h)
                out["buckets"].append(at.astype(np.uint16).tobytes())
                out["counts"].append(counts[at].astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("lang", pa.string()), ("h", pa.int64()), ("buckets", pa.binary()), ("counts", pa.binary())]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, min_score: float = MIN_SCORE) -> Model | None:
    """Learn from at most ``per_language`` documents of each language; None
    if there is nothing to learn from."""
    ship_package(docs.sparkSession)
    usable = F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)
    known = docs.where(usable & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(F.lit(SEED), F.col(id_col)).alias("h"))
    # a hash cut leaves about 2 * per_language ids of each language, so that ranking
    # them never brings a frequent language together
    share = [(r["lang"], min(1.0, 2 * per_language / r["n"]))
             for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    cuts = docs.sparkSession.createDataFrame(share, "lang string, share double")
    ids = (known.join(F.broadcast(cuts), "lang").where(F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("share"))
           .select("id", "lang", "h").distinct())
    first = F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))
    chosen = ids.withColumn("rank", first).where(F.col("rank") <= per_language).drop("rank")
    texts = docs.where(usable & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # at most per_language rows for each language
    sample = (texts.join(F.broadcast(chosen), ["id", "lang"]).dropDuplicates(["id", "lang"])
              .select("lang", "h", "text"))
    rows = sample.mapInArrow(tidy(_sample_rows), "lang string, h long, buckets binary, counts binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["h"], r["lang"], r["buckets"]))
    languages = sorted({r["lang"] for r in rows})
    x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["buckets"], np.uint16)] = np.frombuffer(r["counts"], np.uint32)
    y = np.array([languages.index(r["lang"]) for r in rows])
    # a fifth of the documents, with both their rows
    hold = np.array([(r["h"] >> 7) % 5 == 0 for r in rows])
    return train(x, y, languages, hold, min_score=min_score)


def annotate(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None,
             lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` (the ``keep`` columns) with the predicted language and score;
    columns that already have those names are replaced."""
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (lang, score)]
    given = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"),
                        F.coalesce(F.rlike(text_col, F.lit(r"\p{L}")), F.lit(False)).alias("__letter"))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        m = shared.value
        for batch in batches:
            names, scores = [], []
            letters = batch.column(len(keep) + 1).to_pylist()
            for text, letter in zip(utf8_slices(batch.column(len(keep))), letters):
                name, p = m.predict(ngram_counts(text)) if m and letter else (UNDEFINED, 0.0)
                names.append(name)
                scores.append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, lang, score])

    return given.mapInArrow(tidy(predict), schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs)
    least = model.min_score if model else 0.0
    return (annotate(docs.withColumn("held_out", held_out("doc_id")), model, keep=["doc_id", "held_out"])
            .withColumn("rejected", (F.col("lang_pred") == UNDEFINED) | (F.col("score") < least)))


QUERIES = {"op4_language_id": op4_language_id}
