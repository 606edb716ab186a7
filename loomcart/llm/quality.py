"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Random indexing gives every word a sparse index vector of +1 and -1 at a few of DIMS
places and sums, over all documents, the index vectors of each word's neighbours. Words
are hashed into WORD_SLOTS slots, so the table of vectors is bounded whatever the
vocabulary. A document is the mean of its words' vectors, rare words weighing more than
frequent ones; a small network trained on labelled rows scores it, with a temperature
fitted on labelled rows kept aside from training.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomcart.llm.common import give_back, stored

WORD_SLOTS = 8192
DIMS = 64
NONZERO = 4  # places of an index vector
NEIGHBOURS = 2  # words to either side
FREQUENT = 1e-2  # share of all words at which a word's weight has halved
TRAIN_ROWS = 20_000  # labelled rows that the network is fitted on, at most
HIDDEN = 32
EPOCHS = 60
CALIBRATION = 5  # one labelled row in so many fits the temperature, not the network
CUT = 0.3
TOKENS_AT_ONCE = 500_000
STRIPE = 128  # slots in one row of partial sums
FAN_IN = 1024  # partial sums added in one group
CACHED_WORDS = 200_000
AGAIN = 0
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each slot's index vector, from a fixed generator."""
    made = np.random.default_rng(20240607)
    places = np.argsort(made.random((WORD_SLOTS, DIMS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), made.choice(np.array([-1.0, 1.0]), (WORD_SLOTS, NONZERO))


class Slots:
    """Words to slots; a word that repeats the one before is the word AGAIN. Keeps the
    slots of words it has seen, up to a limit."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = _TOKEN.findall(text)
        known = self.known
        missing = set(words).difference(known)
        if missing:
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
                missing = set(words)
            for word in missing:
                known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % (WORD_SLOTS - 1) + 1
        ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        ids[1:][ids[1:] == ids[:-1]] = AGAIN
        return ids


def _add_neighbours(total: np.ndarray, counts: np.ndarray, texts: list[np.ndarray], places, signs) -> None:
    # Texts stand apart by as many empty words as a neighbourhood is wide.
    gap = np.full(NEIGHBOURS, WORD_SLOTS, np.int32)
    ids = np.concatenate([part for text in texts for part in (text, gap)]).astype(np.int64)
    counts += np.bincount(ids, minlength=WORD_SLOTS + 1)[:WORD_SLOTS]
    flat = total.reshape(-1)
    for offset in range(1, NEIGHBOURS + 1):
        a, b = ids[:-offset], ids[offset:]
        real = (a < WORD_SLOTS) & (b < WORD_SLOTS)
        a, b = a[real], b[real]
        for k in range(NONZERO):
            flat += np.bincount(a * DIMS + places[b, k], signs[b, k], len(flat))
            flat += np.bincount(b * DIMS + places[a, k], signs[a, k], len(flat))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """WORD_SLOTS unit vectors from all rows of ``docs``, each times its slot's weight.

    A task sends one sum per stripe of slots; they are added in two rounds of bounded
    groups. What reaches the driver is one table of fixed size.
    """

    def partial(batches):
        places, signs = index_vectors()
        slots, total = Slots(), np.zeros((WORD_SLOTS, DIMS))
        counts = np.zeros(WORD_SLOTS, np.int64)
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(slots(text.as_py()))
                n += len(held[-1])
                if n >= TOKENS_AT_ONCE:
                    _add_neighbours(total, counts, held, places, signs)
                    held, n = [], 0
        if held:
            _add_neighbours(total, counts, held, places, signs)
        if counts.any():
            stripes = range(0, WORD_SLOTS, STRIPE)
            yield pa.RecordBatch.from_pydict({
                "stripe": pa.array([s // STRIPE for s in stripes], pa.int32()),
                "total": [total[s:s + STRIPE].astype("<f8").tobytes() for s in stripes],
                "counts": [counts[s:s + STRIPE].tobytes() for s in stripes]})

    def add(key, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<f8") for x in group["total"])
        counts = sum(np.frombuffer(x, "<i8") for x in group["counts"])
        return pd.DataFrame({"stripe": [key[0]], "total": [total.astype("<f8").tobytes()],
                             "counts": [counts.astype("<i8").tobytes()]})

    schema = "stripe int, total binary, counts binary"
    sums = (docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(give_back(partial), schema)
            .withColumn("part", F.floor(F.spark_partition_id() / FAN_IN).cast("int")))
    first = sums.groupBy("stripe", "part").applyInPandas(add, schema)
    vectors, counts = np.zeros((WORD_SLOTS, DIMS)), np.zeros(WORD_SLOTS)
    for row in first.groupBy("stripe").applyInPandas(add, schema).collect():
        at = slice(row["stripe"] * STRIPE, (row["stripe"] + 1) * STRIPE)
        vectors[at] = np.frombuffer(row["total"], "<f8").reshape(-1, DIMS)
        counts[at] = np.frombuffer(row["counts"], "<i8")
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    weight = FREQUENT / (FREQUENT + counts / max(1.0, counts.sum()))
    # An own direction beside that of the neighbours tells words of like contexts apart.
    places, signs = index_vectors()
    own = np.zeros_like(vectors)
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), axis=1)
    return np.hstack([vectors * weight[:, None], own * weight[:, None], weight[:, None]]).astype(np.float32)


def pooled(texts, vectors: np.ndarray, slots: Slots) -> np.ndarray:
    """Weighted mean vector of each text, its mean weight and the logarithm of its number
    of words; zeros for one without words."""
    out = np.zeros((len(texts), vectors.shape[1] + 1), np.float32)
    for i, text in enumerate(texts):
        ids = slots(text or "")
        if len(ids):
            used, n = np.unique(ids, return_counts=True)
            sums = n.astype(np.float32) @ vectors[used]
            out[i, :-1] = sums / max(float(sums[-1]), 1e-9)
            out[i, -2:] = sums[-1] / len(ids), np.log1p(len(ids))
    return out


class Network:
    """Tanh layer and logistic output, trained by Adam; the score is calibrated."""

    def __init__(self, x: np.ndarray, y: np.ndarray, aside: np.ndarray, seed: int = 7) -> None:
        made = np.random.default_rng(seed)
        fit_x, fit_y = x[~aside], y[~aside]
        self.mean, self.scale = fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-6
        fit_x = (fit_x - self.mean) / self.scale
        n = x.shape[1]
        self.layers = [made.normal(0, 1 / np.sqrt(n), (n, HIDDEN)), np.zeros(HIDDEN),
                       made.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        first = [np.zeros_like(p) for p in self.layers]
        second = [np.zeros_like(p) for p in self.layers]
        step = 0
        for _ in range(EPOCHS):
            order = made.permutation(len(fit_x))
            for at in range(0, len(order), 128):
                rows = order[at:at + 128]
                bx, by = fit_x[rows], fit_y[rows]
                hidden = np.tanh(bx @ self.layers[0] + self.layers[1])
                error = (self._chance(hidden @ self.layers[2] + self.layers[3]) - by) / len(rows)
                back = np.outer(error, self.layers[2]) * (1 - hidden ** 2)
                grads = [bx.T @ back + 1e-4 * self.layers[0], back.sum(axis=0),
                         hidden.T @ error + 1e-4 * self.layers[2], np.array([error.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.layers[k] -= 0.003 * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        self.temperature = 1.0
        if aside.any():
            raw, truth = self.logit(x[aside]), y[aside]
            grid = np.exp(np.linspace(-1.5, 2.5, 81))
            loss = [np.mean(np.logaddexp(0, raw / t) - truth * raw / t) for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    @staticmethod
    def _chance(logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def logit(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        return np.tanh(x @ self.layers[0] + self.layers[1]) @ self.layers[2] + self.layers[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return self._chance(self.logit(x) / self.temperature)


class Model:
    def __init__(self, vectors: np.ndarray, network: Network | None, share: float) -> None:
        self.vectors, self.network, self.share = vectors, network, share

    def score(self, texts, slots: Slots) -> np.ndarray:
        if self.network is None:  # one class or no label at all
            return np.full(len(texts), self.share)
        return self.network.score(pooled(texts, self.vectors, slots))


def held_out(doc_id) -> F.Column:
    """Rows never learnt from: crc32 of the doc_id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Vectors from all documents; the network from at most ``train_rows`` labelled rows
    that are not held out, those first by digest of the doc_id. Rows with a null doc_id,
    text or label, or an id with two different labels, are not learnt from; a repeated
    row counts once."""
    vectors = word_vectors(docs)
    known = (labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .where("quality = other").where(~held_out(F.col("doc_id")))
             .select(F.col("doc_id").alias("label_id"), "quality"))
    chosen = known.orderBy(F.md5(F.col("label_id").cast("string")), "label_id").limit(train_rows)
    chosen = F.broadcast(stored(chosen, "labels"))  # bounded by train_rows
    rows = docs.where("text is not null").select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("label_id"))

    def pool(batches):
        slots = Slots()
        for batch in batches:
            features = pooled(batch.column(1).to_pylist(), vectors, slots)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "quality": batch.column(2),
                "features": pa.array([f.tobytes() for f in features], pa.binary())})

    table = (rows.select(F.col("doc_id").cast("long"), "text", F.col("quality").cast("int"))
             .mapInArrow(give_back(pool), "doc_id long, quality int, features binary")
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("features").alias("features"))
             .toPandas().sort_values("doc_id", ignore_index=True))
    y = table["quality"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return Model(vectors, None, float(y.mean()) if len(y) else 0.5)
    x = np.frombuffer(b"".join(table["features"]), np.float32).reshape(len(table), -1).astype(float)
    aside = np.arange(len(y)) % CALIBRATION == 0
    if len(np.unique(y[~aside])) < 2:
        aside[:] = False
    return Model(vectors, Network(x, y, aside), float(y.mean()))


def scorer(model: Model):
    """A function of the text column that gives the score. The model goes along with it:
    a few megabytes, by the parameters above."""

    @give_back
    def scores(batches):
        slots = Slots()
        for texts in batches:
            yield pd.Series(model.score(texts.tolist(), slots), dtype="float64")

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from scores(batches)

    return F.pandas_udf(score, DoubleType())


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score at
    least CUT).

    Null and empty texts are scored as texts without words. A null doc_id is not held out.
    Without labels of both classes every score is the share of label 1 (0.5 without any).
    An empty table gives no rows; columns other than doc_id and text are not read.
    """
    model = fit(docs, labels)
    score = scorer(model)(F.col("text"))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))
