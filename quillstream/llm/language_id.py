"""Operator 2: language identification by string-kernel classification.

The blended-spectrum presence kernel counts the distinct byte 1- to `longest`-grams that two lower-cased texts share,
divided by the geometric mean of their own counts. Nystrom landmarks give each text the features k(x, L) W^-1/2;
a one-versus-rest kernel ridge regression on them has a column of weights for each language. Texts are scored in
batches by matrix products: presence x landmark presence, then x weights.

Fitting takes at most `per_language` labelled texts (those of the smallest hashes of id and text) of each language, of which the
first `landmarks_per_language` are landmarks: two bounds that do not grow with the table. Whole texts are used throughout.

Very long texts are scored whole, by their distinct n-grams. Nulls: a null text, or one without letters, gets `und` and score 0; a null language is not learned from. Repeated rows
are judged alike; ties go to the alphabetically first language. Without any labelled row every text is `und`. Other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Superscripts, fractions and numerals are no letters.
LETTER = regex.compile(r"\p{L}")
#: The first code of the n-grams of each n, and the end.
FIRST = [0, 0, 1 << 8, (1 << 8) + (1 << 16), (1 << 8) + (1 << 16) + (1 << 24)]


def grams(text: str, longest: int = 3) -> np.ndarray:
    """Sorted codes of the distinct byte n-grams, n = 1..longest (at most 3)."""
    b = np.frombuffer(text.lower().encode("utf-8", "ignore"), np.uint8).astype(np.uint32)
    codes, code = [], np.zeros(len(b), np.uint32)
    for n in range(1, longest + 1):
        if len(b) < n:
            break
        code = (code[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
        codes.append(code + np.uint32(FIRST[n]))
    if not codes:
        return np.zeros(0, np.uint32)
    flat = np.concatenate(codes)
    flat.sort()
    return flat[np.concatenate([[True], flat[1:] != flat[:-1]])]


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # the landmarks' n-grams, sorted
    presence: np.ndarray  # n-grams x landmarks
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages, W^-1/2 included
    longest: int
    place: np.ndarray | None = None  # of each n-gram among the codes; made where it is used

    def __getstate__(self):
        return self.__dict__ | {"place": None}

    def kernel(self, found: list[np.ndarray]) -> np.ndarray:
        if self.place is None:
            self.place = np.full(FIRST[self.longest + 1], len(self.codes), np.uint16 if len(self.codes) < 65535 else np.uint32)
            self.place[self.codes] = np.arange(len(self.codes))
        x = np.zeros((len(found), len(self.codes) + 1), np.float32)
        for i, g in enumerate(found):
            x[i, self.place[g]] = 1
        x = x[:, :-1]
        own = np.maximum(np.array([len(g) for g in found], np.float32), 1)
        return (x @ self.presence) / np.sqrt(own[:, None] * self.sizes[None, :])

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        return self.kernel(found) @ self.weights


def fit(texts: list[str], labels: list[str], landmarks_per_language: int = 16, ridge: float = 0.02, longest: int = 3) -> Model | None:
    languages = sorted(set(labels))
    if not languages:
        return None
    found, y = [grams(t, longest) for t in texts], np.array([languages.index(x) for x in labels])
    chosen = np.concatenate([np.flatnonzero(y == k)[:landmarks_per_language] for k in range(len(languages))])
    codes = np.unique(np.concatenate([found[i] for i in chosen]))
    presence = np.zeros((len(codes), len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        presence[np.searchsorted(codes, found[i]), j] = 1
    model = Model(languages, codes, presence, np.maximum(presence.sum(0), 1), np.zeros(0), longest)
    value, vector = np.linalg.eigh(model.kernel([found[i] for i in chosen]).astype(float))
    root = vector * (1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    features = np.concatenate([model.kernel(found[i : i + 128]) for i in range(0, len(found), 128)]) @ root
    share = np.bincount(y, minlength=len(languages)) / len(y)
    w = 1 / share[y]
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    left = features.T @ (features * w[:, None]) + ridge * len(y) * np.eye(len(chosen)) / len(chosen)
    model.weights = (root @ np.linalg.solve(left, features.T @ (target * w[:, None]))).astype(np.float32)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(labelled: DataFrame, per_language: int = 240, landmarks_per_language: int = 16) -> Model | None:
    """labelled: (id, text, lang). Collects at most per_language texts of each language."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).withColumn("at", F.shiftrightunsigned(F.xxhash64("id", "text"), 1) / float(1 << 63))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * per_language / n))])
    # Repeated rows count once, however many there are, and no more than the bound reach the driver.
    near = rows.where(F.col("at") <= share[F.col("lang")]).groupBy("lang", "at").agg(F.min("text").alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    sample = near.withColumn("_k", first).where(F.col("_k") <= per_language).collect()
    sample.sort(key=lambda r: (r["at"], r["text"], r["lang"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample], landmarks_per_language)


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text", batch: int = 128) -> DataFrame:
    """The documents that get a language, with all their columns; without a model, those that hold letters."""

    def run(batches):
        for rows in batches:
            at = rows.schema.get_field_index(text_col)
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                yield part.filter(pa.array([x != "und" for x in languages_of(part.column(at).to_pylist(), model)[0]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def languages_of(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float]]:
    has = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    if has and model is None:
        for k in has:
            lang[k] = ""
    elif has:
        s = model.scores([grams(texts[k], model.longest) for k in has])
        for k, best, value in zip(has, s.argmax(1), s.max(1), strict=True):
            lang[k], score[k] = model.languages[best], float(min(1.0, max(0.0, (1 + value) / 2)))
    return lang, score


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", batch: int = 128) -> DataFrame:
    """(id, lang_pred, score) of every document."""

    def run(batches):
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                lang, score = languages_of(part.column(1).to_pylist(), model)
                lang = [x or "und" for x in lang]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def predict_documents(docs: DataFrame, per_language: int = 240, landmarks_per_language: int = 16) -> DataFrame:
    """Fits on the documents that are not held out; predicts all of them."""
    model = fit_on(docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang"), per_language, landmarks_per_language)
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
