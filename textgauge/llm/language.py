"""Language identification by nearest centroid.

A text becomes counts of its letter bigrams and trigrams inside words (lower case, words marked at
both ends), hashed to DIMENSIONS; counts are damped by a logarithm, weighted by inverse document
frequency and normalised. Each language has several centroids, found by spherical k-means, and a text gets the
language of the centroid with the largest cosine. A text is rejected if its distance, 1 less the
cosine, is over FARTHEST, or more than DEVIATIONS robust deviations over the median distance of all labelled documents of the
language from their nearest own centroid. Clusters of less than FEWEST of a sample, such as mislabelled
or garbled documents, make no centroid.

Document frequencies are counted over all labelled documents to learn from. So are the distances that a language allows. The
centroids alone are fitted on a sample of SAMPLE documents for each language: those with the smallest hashes of id and text, exactly
that many if ids and texts repeat too. A language is fitted in a task of its own; the driver holds its centroids,
CLUSTERS vectors of DIMENSIONS numbers, so there may be thousands of languages, not millions.

Null texts and texts without a letter are `und`, score 0, and rejected; so is every text if there is
nothing to learn from. Rows with a null lang or a null doc_id are predicted but not learned from. Ties
go to the language that sorts first. Repeated rows are predicted alike. An empty table gives an
empty table. Other columns are ignored, but for those named in `carry`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.llm.common import ROW, give_back, slices, stored, with_row_id

DIMENSIONS, CLUSTERS, SAMPLE, DEVIATIONS, FARTHEST, FEWEST = 4096, 3, 600, 6.0, 0.97, 0.05
# A deviation is at least this: documents of a language may all be equally far.
LEAST_DEVIATION = 0.02
UNKNOWN = "und"

# Texts, and bytes of text, whose counts are held in memory at once.
_ROWS, _BYTES = 256, 512 << 10

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, if it is a letter; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed bigrams and trigrams, a row for each text."""
    lower = [t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lower])
    is_letter = _letters()[codes]
    kept = is_letter | np.append(False, is_letter[:-1])
    # Words with a 0 before and after each; the 0 after a text's last word also opens the next text.
    c = np.append(np.uint32(0), np.where(is_letter, codes, 0)[kept]).astype(np.uint32)
    owner = np.append(0, owner[kept])
    mixed = c * np.uint32(0x9E3779B1)
    two = (mixed[:-1] + c[1:] * np.uint32(0x85EBCA77)) ^ np.uint32(0x5BD1E995)
    three = (mixed[:-2] + c[1:-1] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
    inside = c[1:-1] != 0
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    rows = np.concatenate([owner[1:], owner[2:][inside]])
    places = np.concatenate([two * np.uint32(0x9E3779B1) >> shift, three[inside] * np.uint32(0x9E3779B1) >> shift])
    cells = np.bincount(rows * DIMENSIONS + places, minlength=len(texts) * DIMENSIONS)
    return cells.reshape(len(texts), DIMENSIONS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors out of counts; texts without letters stay zero."""
    vectors = np.log1p(counts.astype(np.float32)) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def centroids(vectors: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from the mean direction and then the farthest vectors; no empty clusters."""
    picked = [int(np.argmax(vectors @ vectors.sum(axis=0)))]
    while len(picked) < min(clusters, len(vectors)):
        picked.append(int(np.argmin((vectors @ vectors[picked].T).max(axis=1))))
    found = vectors[picked]
    for _ in range(rounds):
        nearest = np.argmax(vectors @ found.T, axis=1)
        sums = np.stack([vectors[nearest == k].sum(axis=0) for k in sorted(set(nearest.tolist()))])
        found = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return found


def common_centroids(vectors: np.ndarray) -> np.ndarray:
    """Centroids of clusters that hold FEWEST of the vectors or more; smaller ones are left out and the rest cut again."""
    kept = vectors
    while True:
        found = centroids(kept, CLUSTERS)
        nearest = np.argmax(kept @ found.T, axis=1)
        common = (np.bincount(nearest, minlength=len(found)) >= FEWEST * len(vectors))[nearest]
        if common.all() or 2 * common.sum() < len(vectors):
            return found
        kept = kept[common]


def learnable(held_out: Column) -> Column:
    return F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out


def _learn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of sampled texts, and a last row with the document frequencies of the task."""
    seen, total = np.zeros(DIMENSIONS, dtype=np.int64), 0
    kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
    names = ["label", "place", "n", "total"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        labels, sampled = batch.column("label").to_pylist(), batch.column("sampled").to_pylist()
        at = 0
        for texts in slices(batch.column("text"), _BYTES):
            rows = []
            for start in range(0, len(texts), _ROWS):
                for counts in gram_counts(texts[start : start + _ROWS]):
                    places = np.flatnonzero(counts)
                    seen[places] += 1
                    total += len(places) > 0
                    if sampled[at] and len(places):
                        rows.append((labels[at], places.astype(np.int32), counts[places], 1))
                    at += 1
            yield out(rows)
    give_back()
    used = np.flatnonzero(seen)
    yield out([(None, used.astype(np.int32), seen[used], total)])


def _sampled(rows: DataFrame) -> DataFrame:
    """lang, text and sampled of the rows (with row ids): true for the SAMPLE smallest hashes of a language."""
    order = F.struct(F.xxhash64("doc_id", "text").alias("hash"), F.col(ROW).alias("row"))
    # Each task hands on the smallest of its own rows only, without texts; a few hundred tasks meet before all do.
    smallest = rows.select("lang", order.alias("o"), (F.spark_partition_id() % F.lit(256)).alias("part"))
    for key in (["lang", "part"], ["lang"]):
        ranked = smallest.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("o")))
        smallest = ranked.filter(F.col("rank") <= SAMPLE).drop("rank")
    last = smallest.groupBy("lang").agg(F.max("o").alias("last"))
    # One row per language, which the driver holds anyway.
    return rows.join(F.broadcast(last), "lang").select("lang", "text", (order <= F.col("last")).alias("sampled"))


def _fitter(idf: np.ndarray):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
        for i, (places, n) in enumerate(zip(rows["place"], rows["n"])):
            counts[i, places] = n
        # The order of a shuffle must not tell in the centroids.
        counts = counts[np.lexsort(counts.T[np.flatnonzero(counts.any(axis=0))])]
        points = common_centroids(weighted(counts, idf))
        return pd.DataFrame({"label": rows["label"].iloc[0], "point": [p.tolist() for p in points]})

    return fit


def learn(docs: DataFrame, held_out: Column) -> dict:
    """Languages, centroids, reach of each centroid and idf, from the labelled documents."""
    needed = docs.filter(learnable(held_out)).select("doc_id", "text", "lang")
    rows = with_row_id(needed)
    found = stored(
        _sampled(rows).select(F.col("lang").alias("label"), "text", "sampled").mapInArrow(
            _learn_rows, "label string, place array<int>, n array<long>, total long"
        ),
        "language-counts",
    )
    frequent = found.filter("label IS NULL")
    documents = frequent.agg(F.sum("total")).first()[0] or 0
    df = np.zeros(DIMENSIONS)
    pairs = frequent.select(F.explode(F.arrays_zip("place", "n")).alias("p"))
    for r in pairs.groupBy("p.place").agg(F.sum("p.n").alias("n")).collect():
        df[r["place"]] = r["n"]
    idf = np.log((1 + documents) / (1 + df)).astype(np.float32) + np.float32(0.05)
    # A group is the sample of one language, SAMPLE rows at most.
    fitted = found.filter("label IS NOT NULL").groupBy("label").applyInPandas(
        _fitter(idf), "label string, point array<float>"
    )
    table = fitted.toArrow().to_pandas().sort_values("label", kind="stable")
    if not len(table):
        return {}
    model = {"labels": table["label"].tolist(), "points": np.stack(table["point"].to_list()).astype(np.float32), "idf": idf}
    allowed = _reach(rows, model)
    return model | {"reach": np.array([allowed[label] for label in model["labels"]])}


def own_distances(model: dict, labels: list[str], texts: list[str]) -> list[float | None]:
    """The distance of each text from the nearest centroid of its own language; null without letters or centroid."""
    names = np.array(model["labels"], dtype=object)
    counts = gram_counts(texts)
    vectors, far = weighted(counts, model["idf"]), np.full(len(texts), np.nan)
    wanted = np.array(labels, dtype=object)
    for label in set(labels):
        a, b = np.searchsorted(names, label), np.searchsorted(names, label, side="right")
        own = np.flatnonzero((wanted == label) & counts.any(axis=1))
        if b > a:
            far[own] = 1 - (vectors[own] @ model["points"][a:b].T).max(axis=1)
    return [None if np.isnan(f) else float(f) for f in far]


def _reach(rows: DataFrame, model: dict) -> dict[str, float]:
    """The distance that each language allows, from all of its rows."""

    @F.arrow_udf(T.DoubleType())
    def own_distance(langs: pa.Array, texts: pa.Array) -> pa.Array:
        wanted, found = langs.to_pylist(), []
        for some in slices(texts, _BYTES):
            for start in range(0, len(some), _ROWS):
                part = some[start : start + _ROWS]
                found += own_distances(model, wanted[len(found) : len(found) + len(part)], part)
        give_back()
        return pa.array(found, pa.float64())

    # Filtered as it is read: before, the filter would call for every distance again, in one more Python worker per task.
    far = stored(rows.select("lang", own_distance("lang", "text").alias("far")), "own-distances").filter("far IS NOT NULL")
    medians = far.groupBy("lang").agg(F.percentile_approx("far", 0.5, 1000).alias("middle"))
    spread = (
        far.join(F.broadcast(medians), "lang")
        .groupBy("lang")
        .agg(F.max("middle").alias("middle"), F.percentile_approx(F.abs(F.col("far") - F.col("middle")), 0.5, 1000).alias("mad"))
    )
    return {
        r["lang"]: min(r["middle"] + DEVIATIONS * max(1.4826 * r["mad"], LEAST_DEVIATION), FARTHEST) for r in spread.collect()
    }


def predictor(model: dict) -> Callable[[Column], Column]:
    """A column function: text to struct(lang_pred, score, rejected)."""
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]

    @F.arrow_udf(T.StructType([T.StructField(*f) for f in fields]))
    def predict(texts: pa.Array) -> pa.Array:
        names, scores, gone = [], [], []
        for some in slices(texts, _BYTES):
            for at in range(0, len(some), _ROWS):
                part = some[at : at + _ROWS]
                counts = gram_counts(part)
                known = counts.any(axis=1) & bool(model)
                if not model:
                    cosine, nearest = np.zeros((len(part), 1)), np.zeros(len(part), dtype=int)
                else:
                    cosine = weighted(counts, model["idf"]) @ model["points"].T
                    nearest = np.argmax(cosine, axis=1)
                best = cosine[np.arange(len(part)), nearest]
                names += [model["labels"][k] if ok else UNKNOWN for k, ok in zip(nearest, known)]
                scores.append(np.where(known, np.clip(best, 0, 1), 0).astype(np.float64))
                far = 1 - best > (model["reach"][nearest] if model else 0)
                gone.append(~known | far)
        give_back()
        none: list = [np.zeros(0)]
        return pa.StructArray.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(np.concatenate(scores or none)),
                pa.array(np.concatenate(gone or none).astype(bool)),
            ],
            [f for f, _ in fields],
        )

    return predict


def identify(docs: DataFrame, model: dict, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score, rejected and the carried columns, for every row."""
    found = docs.select(F.col("doc_id").cast("long"), *carry, predictor(model)(F.col("text")).alias("p"))
    return found.select("doc_id", "p.lang_pred", "p.score", "p.rejected", *carry)
