"""Language identification with string kernels (operator 7).

The kernel is the blended-spectrum presence kernel: the number of character
n-grams (n = 1..3, hashed, lower-cased text) that two texts share, divided by
the root of the product of their own numbers. It is taken over the grams that
occur in any landmark. Nyström landmarks, a few training texts per language,
turn it into features ``k(x, landmarks) W^-1/2``; one-versus-rest kernel ridge
regression on these gives one score per language. Scoring folds landmarks,
``W^-1/2`` and ridge weights into one gram-by-language matrix, so a slice of
texts is one product of its 0/1 gram matrix with that matrix.

Fitted on a bounded sample (``per_language`` texts of each language, at most
``max_train`` altogether, of which ``landmarks``, of any length, serve as
landmarks); the driver holds these features and the landmarks' grams only, at
most 2^20 gram ids for each. Every text is scored whole, in the
tasks; the model goes out as one broadcast of (grams x languages) numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, StringType, StructField,
                               StructType)

from .pinning import pinned
from .wordhash import stream

GRAM_BITS = 20
_FACTORS = stream(3, 7) | np.uint64(1)
UNKNOWN = "und"


def _gram_ids(text: str) -> list[np.ndarray]:
    """The hashed n-grams of the text for n = 1, 2, 3, repeated ones included."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    shift = np.uint64(64 - GRAM_BITS)
    out, run = [], np.zeros(len(points), np.uint64)
    for n in range(3):
        if len(points) <= n:
            break
        run = (run[:len(points) - n] + points[n:] * _FACTORS[n])
        run *= np.uint64(0x9E3779B97F4A7C15)
        out.append((run >> shift).astype(np.int64))
        run = run ^ (run >> np.uint64(31))
    return out


class Model:
    """``slot_of[gram id]`` is a row of ``weights`` (grams x languages) or the
    number of rows for grams outside the landmarks."""

    def __init__(self, langs: list[str], slot_of: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.langs, self.slot_of, self.weights, self.bias = langs, slot_of, weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        grams = self.weights.shape[0]
        present = presence(texts, self.slot_of, grams)
        sizes = np.sqrt(np.maximum(present.sum(axis=1), 1.0))
        return present @ self.weights / sizes[:, None] + self.bias


def presence(texts: list[str], slot_of: np.ndarray, grams: int) -> np.ndarray:
    """0/1 matrix of texts by landmark grams."""
    out = np.zeros((len(texts), grams + 1), np.float32)
    for i, text in enumerate(texts):
        for ids in _gram_ids(text):
            out[i, slot_of[ids]] = 1
    return out[:, :grams]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        landmarks: int = 96, per_language: int = 400, max_train: int = 4000,
        ridge: float = 1e-2, max_grams: int = 1 << 17) -> Model:
    """Fits on the rows of ``docs`` that have a text with letters and a language;
    the sample is the smallest md5 of the id within each language.

    Languages take turns at giving the ``landmarks``; there are more of these
    if there are more languages in the sample, so each has one at least. Of the
    landmarks' grams the ``max_grams`` of the smallest hashes count (a uniform
    choice), so the driver holds and broadcasts at most ``max_grams`` times the
    landmarks numbers, however long the texts are."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                      & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.md5(F.col("id").cast("string")), "id"))
    chosen = (rows.select("id", "lang").withColumn("rank", rank).where(F.col("rank") <= per_language)
              .orderBy("rank", "lang").limit(max_train))
    # at most max_train ids: a proven bound for the broadcast
    sample = pinned(rows.join(F.broadcast(chosen), ["id", "lang"]).select(
        "lang", "rank", "text", F.xxhash64("id", "text").alias("tie"))
        .repartition(16, "tie"), "language-sample")

    def grams(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [np.unique(np.concatenate(_gram_ids(t))).astype("<i4").tobytes() for t in batch.column(1).to_pylist()],
                pa.binary())], names=["lang", "grams"])

    turn = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "tie"))
    languages = sample.select("lang").distinct().count()
    marks = (sample.withColumn("turn", turn).orderBy("turn", "lang").limit(max(landmarks, languages))
             .select("lang", "text").mapInArrow(grams, StructType([
                 StructField("lang", StringType()), StructField("grams", BinaryType())])).collect())
    marks = [np.frombuffer(r["grams"], "<i4") for r in marks]
    if not marks:
        return Model([], np.zeros(1 << GRAM_BITS, np.int32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    vocabulary = np.unique(np.concatenate(marks))[:max_grams]
    marks = [own[own <= vocabulary[-1]] for own in marks]
    slot_of = np.full(1 << GRAM_BITS, len(vocabulary), np.int32)
    slot_of[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
    held = np.zeros((len(vocabulary), len(marks)), np.float32)  # grams x landmarks
    for k, own in enumerate(marks):
        held[slot_of[own], k] = 1
    held /= np.sqrt(np.maximum(held.sum(axis=0), 1))
    values, vectors = np.linalg.eigh((held.T @ held).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # W^-1/2 up to a rotation
    to_features = (held @ root).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((slot_of, to_features))

    def features(batches):
        slots, matrix = shared.value
        step = max(1, min(64, (1 << 22) // len(matrix)))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), step):
                present = presence(texts[a:a + step], slots, len(matrix))
                sizes = np.sqrt(np.maximum(present.sum(axis=1), 1.0))
                phi = (present @ matrix / sizes[:, None]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(phi)), pa.array(
                    phi.tolist(), pa.list_(pa.float64()))], names=["lang", "phi"])

    seen = sample.orderBy("rank", "lang", "tie").select("lang", "text").mapInArrow(features, StructType([
        StructField("lang", StringType()), StructField("phi", ArrayType(DoubleType()))])).collect()
    langs = sorted({r["lang"] for r in seen})
    phi = np.array([r["phi"] for r in seen])
    target = np.array([[r["lang"] == x for x in langs] for r in seen], float)
    # every language weighs alike, however many texts it has
    weight = (1 / target.sum(axis=0))[target.argmax(axis=1)]
    mean_phi, mean_target = np.average(phi, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    centred = phi - mean_phi
    gram = (centred * weight[:, None]).T @ centred
    solved = np.linalg.solve(gram + ridge * len(langs) / max(1, gram.shape[0]) * np.eye(len(gram)),
                             (centred * weight[:, None]).T @ (target - mean_target))
    return Model(langs, slot_of, (to_features @ solved).astype(np.float32),
                 (mean_target - mean_phi @ solved).astype(np.float32))


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score in 0..1 (the ridge
    scores cut to 0..1, the winner's share of their sum).

    ``und`` with score 0 where the text is null or has no letter (Unicode
    category L), or where the model has learned no language. Ties go to the
    language that sorts first. Columns of ``docs`` with the two names are
    replaced, all others pass through; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passed = [c for c in docs.columns if c.lower() not in (pred_col.lower(), score_col.lower())]
    schema = StructType([docs.schema[c] for c in passed] + [StructField(pred_col, StringType()),
                                                            StructField(score_col, DoubleType())])
    at = passed.index(text_col)
    names = schema.names

    def run(batches):
        import regex
        letter = regex.compile(r"\p{L}")
        model = shared.value
        step = max(1, min(256, (1 << 22) // max(1, model.weights.shape[0])))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                texts = part.column(at).to_pylist()
                known = [i for i, t in enumerate(texts) if t is not None and model.langs and letter.search(t)]
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    cut = np.clip(model.scores([texts[i] for i in known]), 1e-6, 1)
                    best = cut.argmax(axis=1)
                    for i, k, row in zip(known, best.tolist(), cut, strict=True):
                        langs[i], scores[i] = model.langs[k], float(row[k] / row.sum())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()),
                                                  pa.array(scores, pa.float64())], names=names)

    return docs.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in passed]).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Documents never learned from: crc32 of the id as text, modulo 4, is 2.
    Null ids are not held out, and not learned from either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **settings) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``: the model is
    fitted on the rows that are not held out and applied to all."""
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col, **settings)
    marked = docs.select(*[c for c in docs.columns if c.lower() != "held_out"]).withColumn("held_out", held_out(id_col))
    return predict(marked, model, text_col)
