"""Language identification by nearest centroids of character n-grams.

A text becomes a vector of hashed byte trigrams of its A-Z lower-cased letters (everything between letters is one
blank): logarithmic counts times inverse document frequency, scaled to length 1. Each language has several
centroids, the means of a spherical k-means over its training vectors; a text gets the language of the centroid with the
highest cosine. It is rejected when the best cosine is below the bound of its length class: ``slack`` times the
lowest that training texts of about that length or longer reach with their own language. Texts longer than all of these
have the bound of the longest.

The model is fitted on a bounded sample: about ``sample`` labelled documents of each language, chosen by a hash
of the id. Prediction reads the text alone, whole, row by row, without a shuffle. The model is centroids x
``dims`` numbers and passes the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected. Ties go to the
language that sorts first. Rows without a label are predicted like others and never learned from. Without any
labelled row all texts are ``und``. Equal rows get equal results. Further columns are kept by ``classify``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import prepare, table

UNKNOWN = "und"
# Letters of ASCII in lower case, bytes of other characters as they are, all else blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
VECTOR = "lang string, n int, vector binary"


def letters(text: str | None) -> bytes:
    """Folded text with single blanks; empty when there is no letter."""
    if not text or not any(c.isalpha() for c in text):
        return b""
    return b" " + b" ".join(text.encode("utf-8", "replace").translate(FOLD).split()) + b" "


def counts(folded: bytes, dims: int) -> np.ndarray:
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(dims, np.float32)
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return np.log1p(np.bincount((code >> np.uint32(16)) % np.uint32(dims), minlength=dims)).astype(np.float32)


def length_class(n: int) -> int:
    return min(20, int(n).bit_length())


@dataclass
class Model:
    """``languages`` names each row of ``centroids``; ``bounds`` is the least cosine by length class."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    bounds: np.ndarray
    dims: int

    def vectors(self, folded: list[bytes]) -> np.ndarray:
        x = np.stack([counts(t, self.dims) for t in folded]) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def predict(self, texts: list[str | None], step: int = 256) -> pd.DataFrame:
        lang, score, rejected = [], [], []
        for k in range(0, len(texts), step):
            folded = [letters(t) for t in texts[k : k + step]]
            if not self.languages:
                cos, best = np.zeros(len(folded)), None
            else:
                all_ = self.vectors(folded) @ self.centroids.T
                best, cos = all_.argmax(axis=1), all_.max(axis=1)
            for i, t in enumerate(folded):
                known = bool(t) and best is not None
                value = float(np.clip(cos[i], 0.0, 1.0)) if known else 0.0
                lang.append(self.languages[best[i]] if known else UNKNOWN)
                score.append(value)
                rejected.append(not known or value < self.bounds[length_class(len(t))])
        return pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})


def _vectors(dims: int):
    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 256):
                part = frame.iloc[k : k + 256]
                folded = [letters(t) for t in part["text"]]
                made = [counts(t, dims).tobytes() if t else None for t in folded]
                out = pd.DataFrame({"lang": part["lang"].to_numpy(), "n": np.array([len(t) for t in folded], np.int32), "vector": made})
                yield out[out["vector"].notna()]

    return vectors


def _means(centroids: int, rounds: int, dims: int):
    """Spherical k-means of one language's vectors."""

    def means(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float32) for v in frame["vector"]])
        seen = (x > 0).sum(axis=0).astype(np.float32)
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        order = np.lexsort(x[:, :64].T)
        k = min(centroids, len(x))
        c = x[order[np.linspace(0, len(x) - 1, k).astype(int)]]
        for _ in range(rounds):
            own = (x @ c.T).argmax(axis=1)
            c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(k)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        rows = [(frame["lang"].iloc[0], 1, v.astype(np.float32).tobytes()) for v in c]
        rows.append((frame["lang"].iloc[0], -len(x), seen.tobytes()))
        return pd.DataFrame(rows, columns=["lang", "n", "vector"])

    return means


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = 1000,
    centroids: int = 4,
    rounds: int = 8,
    dims: int = 4096,
    slack: float = 0.6,
) -> Model:
    """Fit on about ``sample`` rows of each language of ``labelled``."""
    prepare(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit(5), F.col(id_col)).alias("draw"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((0, dims), np.float32), np.ones(dims, np.float32), np.zeros(21), dims)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int((1 << 30) * min(1.0, sample / n)))])
    chosen = rows.filter(F.pmod("draw", F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")))
    vectors = chosen.select("lang", "text").mapInPandas(_vectors(dims), VECTOR)
    made = vectors.groupBy("lang").applyInPandas(_means(centroids, rounds, dims), VECTOR).collect()
    made = sorted(made, key=lambda r: (r["lang"], bytes(r["vector"])))
    total = sum(-r["n"] for r in made if r["n"] < 0)
    seen = sum(np.frombuffer(r["vector"], np.float32) for r in made if r["n"] < 0)
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + 1
    c = np.stack([np.frombuffer(r["vector"], np.float32) for r in made if r["n"] > 0]) * idf
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    model = Model([r["lang"] for r in made if r["n"] > 0], c, idf, np.zeros(21), dims)

    low = chosen.mapInPandas(_lowest(model), "n int, cos double").groupBy("n").agg(F.min("cos").alias("cos")).collect()
    model.bounds = bounds_of({r["n"]: slack * r["cos"] for r in low})
    return model


def bounds_of(lowest: dict[int, float]) -> np.ndarray:
    """Bound of every length class: the least of its own and those of longer texts, or else of the longest fitted class."""
    bounds = np.full(21, np.inf)
    for n, value in lowest.items():
        bounds[n] = value
    bounds = np.minimum.accumulate(bounds[::-1])[::-1]
    return np.where(np.isfinite(bounds), bounds, lowest[max(lowest)] if lowest else 0.0)


def _lowest(model: Model):
    """Cosine of training texts with the best centroid of their own language."""

    def lowest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = np.array(model.languages)
        for frame in frames:
            for k in range(0, len(frame), 256):
                part = frame.iloc[k : k + 256]
                folded = [letters(t) for t in part["text"]]
                cos = model.vectors(folded) @ model.centroids.T
                own = np.where(names[None, :] == part["lang"].to_numpy()[:, None], cos, 0).max(axis=1)
                out = pd.DataFrame({"n": np.array([length_class(len(t)) for t in folded], np.int32), "cos": own.astype(float)})
                yield out[[bool(t) for t in folded]]

    return lowest


def classify(docs: DataFrame, model: Model, text_col: str = "text", name: str = "language") -> DataFrame:
    """All columns of ``docs`` plus the struct ``name (lang, score, rejected)``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(texts.where(texts.notna(), None).tolist())

    return docs.withColumn(name, predicted(F.col(text_col)))


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out()))
    rows = classify(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return rows.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected")


QUERIES = {"op5_language_id": op5_language_id}
SQL: dict[str, str] = {}
