"""Language identification by the nearest of several centroids per language.

A text is a vector of character n-grams (one to three code points of the lower-cased text, each run
of what is no letter read as one space), hashed to a fixed number of places, weighted by TF-IDF and scaled to length one. Document frequencies
count every training document. Centroids come from spherical k-means over at most
``SAMPLE_DOCS`` documents of each language, those whose hashed ids are least; that bound is the only
one. The language of the centroid with the largest cosine is predicted, over the whole text. A text is
rejected if that cosine is further from one than that of nearly all training texts of its
length, by octaves of n-grams.

NULL texts and texts without a letter are ``und`` with score 0 and rejected. Rows without ``lang`` or
``doc_id`` train nothing. Without training rows every text is ``und``. Texts are judged one by
one, so ids may be NULL or repeat; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces

PLACES = 4096
CENTROIDS = 4
SAMPLE_DOCS = 400
ROUNDS = 8
READ_BYTES = 4_000_000
STEP = 1 << 18
# Of the training texts of a length, the share that may lie beyond the rejection bound, and how much
# further than those a text may lie.
OUTSIDE = 0.002
SLACK = 0.75
OCTAVES = 32
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
OTHERS = re.compile(r"[\W\d_]+")
# Odd multipliers that hash a code point by its place in the n-gram.
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # inverse document frequency of each place
    centroids: np.ndarray  # a row per centroid, of length one
    owner: np.ndarray  # the language of each centroid
    bounds: np.ndarray  # least cosine by octave of n-grams


def counts(text: str, places: int = PLACES) -> np.ndarray:
    """Number of n-grams of the whole text in each place; read in steps, so that memory is bounded."""
    total = np.zeros(places, np.int64)
    lowered = f" {OTHERS.sub(' ', text.lower())} "
    bits = np.uint64(64 - int(places).bit_length() + 1)
    with np.errstate(over="ignore"):
        for start in range(0, len(lowered), STEP):
            # Two characters more, so that n-grams across the border are counted once.
            part = lowered[start : start + STEP + 2]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            held = min(STEP, len(lowered) - start)
            gram = codes * FACTORS[0]
            for n in (1, 2, 3):
                if n > 1:
                    gram = (gram[:-1] ^ (gram[:-1] >> np.uint64(29))) * FACTORS[n - 1] + codes[n - 1 :] * FACTORS[0]
                if not len(gram):
                    break
                total += np.bincount(((gram * FACTORS[2])[:held] >> bits).astype(np.int64), minlength=places)
    return total


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def vector(tally: np.ndarray, weights: np.ndarray) -> np.ndarray:
    weighted = np.log1p(tally) * weights
    length = np.sqrt(weighted @ weighted)
    return (weighted / length if length else weighted).astype(np.float32)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows with a language that are not held out."""
    return docs.filter(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang")


def held_out():
    """Whether the crc32 of the id leaves 2 by 4; rows without an id are held out as well."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def document_frequencies(rows: DataFrame, places: int) -> tuple[int, np.ndarray]:
    """Training texts with a letter, and how many of them have an n-gram in each place."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(places, np.int64), 0
        for batch in pieces(batches, READ_BYTES):
            for text in batch.column("text").to_pylist():
                if has_letter(text):
                    seen += counts(text, places) > 0
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.record_batch(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], n))], names=["place", "n"]
        )

    found = rows.select("text").mapInArrow(tally, "place int, n bigint").groupBy("place").agg(F.sum("n"))
    total, frequencies = 0, np.zeros(places, np.int64)
    for place, n in found.collect():  # a row per place
        if place < 0:
            total = n
        else:
            frequencies[place] = n
    return total, frequencies


def sampled(rows: DataFrame, size: int) -> DataFrame:
    """About ``size`` training rows of each language, those whose hashed ids are least."""
    share = {lang: min(1.0, 2.0 * size / n) for lang, n in rows.groupBy("lang").count().collect()}
    if not share:
        return rows.limit(0)
    bound = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(place < F.try_element_at(bound, F.col("lang")))


def fit(
    docs: DataFrame, places: int = PLACES, centroids: int = CENTROIDS, size: int = SAMPLE_DOCS
) -> Model:
    """Fit on the training rows of ``docs``."""
    rows = training_rows(docs)
    total, frequencies = document_frequencies(rows, places)
    weights = np.log((1 + total) / (1 + frequencies)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            keep = [i for i, text in enumerate(batch.column("text").to_pylist()) if has_letter(text)]
            tallies = [counts(batch.column("text")[i].as_py(), places) for i in keep]
            yield pa.record_batch(
                [
                    pa.array([batch.column("lang")[i].as_py() for i in keep], pa.string()),
                    pa.array([batch.column("doc_id")[i].as_py() for i in keep], pa.int64()),
                    pa.array([int(t.sum()) for t in tallies], pa.int64()),
                    pa.array([vector(t, weights).tobytes() for t in tallies], pa.binary()),
                ],
                names=["lang", "doc_id", "n", "vector"],
            )

    def cluster(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(_h=[hash_of(d) for d in group.doc_id]).sort_values(["_h", "doc_id", "n"])
        stack = np.stack([np.frombuffer(v, np.float32) for v in group.vector])
        found = spherical_means(stack[: size], centroids)
        near = (stack @ found.T).max(axis=1)
        octave = np.array([int(n).bit_length() for n in group.n])
        return pd.DataFrame(
            {
                "lang": key[0],
                "centroid": [c.tobytes() for c in found] + [None] * len(near),
                "octave": [-1] * len(found) + octave.tolist(),
                "cosine": [1.0] * len(found) + near.astype(float).tolist(),
            }
        )

    sample = sampled(rows, size).mapInArrow(vectors, "lang string, doc_id bigint, n bigint, vector binary")
    fitted = sample.groupBy("lang").applyInPandas(
        cluster, "lang string, centroid binary, octave int, cosine double"
    ).collect()  # bounded by the sample
    means = sorted((r.lang, r.centroid) for r in fitted if r.centroid is not None)
    languages = sorted({lang for lang, _ in means})
    return Model(
        languages,
        weights,
        np.stack([np.frombuffer(c, np.float32) for _, c in means]) if means else np.zeros((0, places), np.float32),
        np.array([languages.index(lang) for lang, _ in means], np.int64),
        rejection_bounds([(r.octave, r.cosine) for r in fitted if r.octave >= 0]),
    )


def hash_of(value: int) -> int:
    return (value * 0x9E3779B97F4A7C15) % (1 << 64) >> 16


def spherical_means(rows: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` unit centroids, from rows far from each other as the first ones."""
    chosen = [rows.mean(axis=0)]
    while len(chosen) < min(k, len(rows)):
        near = np.max(np.stack([rows @ (c / max(np.linalg.norm(c), 1e-9)) for c in chosen]), axis=0)
        chosen.append(rows[int(near.argmin())])
    means = np.stack([c / max(np.linalg.norm(c), 1e-9) for c in chosen])
    for _ in range(ROUNDS):
        owner = (rows @ means.T).argmax(axis=1)
        for j in range(len(means)):
            mine = rows[owner == j]
            if len(mine):
                mean = mine.mean(axis=0)
                means[j] = mean / max(np.linalg.norm(mean), 1e-9)
    return means.astype(np.float32)


def rejection_bounds(points: list[tuple[int, float]]) -> np.ndarray:
    """Least cosine by octave: below nearly all of the octave and of those shorter or longer by one,
    and never above that of a longer octave."""
    bounds = np.zeros(OCTAVES + 1)
    for octave in range(OCTAVES + 1):
        near = [cosine for at, cosine in points if abs(at - octave) <= 1]
        if near:
            bounds[octave] = SLACK * np.quantile(near, OUTSIDE)
    return np.minimum.accumulate(bounds[::-1])[::-1] if points else bounds


def predict(docs: DataFrame, model: Model, output: str = "language") -> DataFrame:
    """Rows with ``output``, a struct of ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``,
    which replaces an input column of that name."""
    docs = docs.drop(output)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            names, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                name, cosine, outside = UNDETERMINED, 0.0, True
                if has_letter(text) and len(model.owner):
                    tally = counts(text, model.centroids.shape[1])
                    near = model.centroids @ vector(tally, model.weights)
                    best = int(near.argmax())
                    name, cosine = model.languages[model.owner[best]], float(np.clip(near[best], 0, 1))
                    outside = cosine < model.bounds[min(int(tally.sum()).bit_length(), OCTAVES)]
                names.append(name)
                scores.append(cosine)
                rejected.append(bool(outside))
            found = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )
            yield pa.record_batch([*batch.columns, found], names=[*batch.schema.names, output])

    return docs.mapInArrow(
        score, f"{fields}, `{output}` struct<lang_pred:string,score:double,rejected:boolean>"
    )
