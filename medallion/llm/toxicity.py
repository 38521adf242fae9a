"""A convolutional text classifier for toxicity, trained in numpy and applied to whole texts by Spark.

A word is the sum of the embeddings of its hash and of the hashes of its first bytes, so inflected
forms share what their stem taught. Filters of several widths run over the words, the largest few
activations of each filter are kept (so two insults weigh more than one quoted word), and a logistic
unit scores them. Features that the training sample never showed have a zero embedding. Thresholds are
calibrated per language, guessed from function words of the text alone, and moved to one cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import is_held_out, map_arrow, sampled
from medallion.llm.text import LETTER_TABLE, hash_spans, slices, word_spans

CUT = 0.7
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 16
LARGEST = 3
PREFIXES = (4, 5)
#: Bounds of the training sample: rows of each label, characters of a text in it.
MOST_TOXIC, MOST_CLEAN, MOST_CHARS = 1000, 2000, 30_000
#: A feature needs this many sampled texts to get an embedding.
LEAST_TEXTS = 5
#: ... and its share among toxic and clean texts must differ by so many standard deviations.
LEAST_DEVIATION = 4.0
#: After training, embeddings with less than this share of the largest effect on a score are dropped.
LEAST_EFFECT = 0.05
_INDEX_BITS = 22
# Common function words of four languages.
FUNCTION_WORDS = {
    "en": "the of and to in is that for with was are this be by not from",
    "de": "der die und das ist zu den von mit sich auf nicht ein eine im dem",
    "fr": "le la les des et un une est dans pour que qui sur avec pas au",
    "es": "el los las del y que en un una por con para su es lo como",
}
LANGUAGES = sorted(FUNCTION_WORDS)


def _function_words() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the function words of one language only, and their language."""
    words = [(w, k) for k, n in enumerate(LANGUAGES) for w in FUNCTION_WORDS[n].split()]
    texts = pa.array([w for w, _ in words])
    hashes = np.concatenate([h[:, 0] for h, _, _ in features(texts)])
    own = [k for k, (w, _) in enumerate(words) if sum(w == v for v, _ in words) == 1]
    order = np.argsort(hashes[own])
    return hashes[own][order], np.array([words[k][1] for k in own])[order]


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(hashes of word and prefixes of every word, first word of each text, first row) of each slice."""
    for first, _, data, offsets in slices(column):
        start, end, begin = word_spans(data, offsets, LETTER_TABLE)
        hashes = [hash_spans(data, start, end, LETTER_TABLE)]
        for size in PREFIXES:
            cut = hash_spans(data, start, np.minimum(end, start + size), LETTER_TABLE)
            hashes.append(np.where(end - start >= size, cut ^ np.uint64(size), np.uint64(0)))
        yield np.stack(hashes, 1), begin, first


@dataclass
class Model:
    """Parameters; row 0 of the embeddings stands for every unknown feature."""

    hashes: np.ndarray
    embeddings: np.ndarray
    taps: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.first = np.zeros(1 << _INDEX_BITS, np.int32)
        self.first[(self.hashes >> np.uint64(64 - _INDEX_BITS)).astype(np.int64)] = np.arange(len(self.hashes))
        self.words, self.languages = _function_words()

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        found = self.first[(hashes >> np.uint64(64 - _INDEX_BITS)).astype(np.int64)]
        return np.where(self.hashes[found] == hashes, found, 0)

    def guess(self, words: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Index into LANGUAGES of each text, len(LANGUAGES) if no function word tells."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == words)
        text = np.searchsorted(begin, hit, side="right") - 1
        kinds = len(LANGUAGES)
        counts = np.bincount(text * kinds + self.languages[at[hit]], minlength=(len(begin) - 1) * kinds)
        counts = counts.reshape(-1, kinds)
        return np.where(counts.max(1, initial=0) > 0, counts.argmax(1), kinds)

    def pooled(self, rows: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest activations (text, filter, k), where they are, and the word vectors."""
        count = np.diff(begin)
        starts = begin[:-1] + np.arange(len(count)) * LARGEST
        slot = np.arange(len(rows)) + np.repeat(starts - begin[:-1], count)
        vectors = np.zeros((len(rows) + LARGEST * len(count) + max(WIDTHS), DIMENSIONS), np.float32)
        vectors[slot] = self.embeddings[rows].sum(1)
        out = vectors @ self.taps.transpose(1, 0, 2).reshape(DIMENSIONS, -1)
        out = out.reshape(len(vectors), -1, FILTERS)
        size, at, acts = len(vectors) - max(WIDTHS), 0, []
        for width in WIDTHS:
            acts.append(sum(out[k : k + size, at + k] for k in range(width)))
            at += width
        acts = np.concatenate(acts, 1) + self.bias
        top = np.zeros((len(count), acts.shape[1], LARGEST), np.float32)
        where = np.zeros(top.shape, np.int64)
        for k, (a, n) in enumerate(zip(starts.tolist(), count.tolist(), strict=True)):
            part = acts[a : a + n + LARGEST]
            place = np.argpartition(part, -LARGEST, axis=0)[-LARGEST:]
            values = np.take_along_axis(part, place, 0)
            order = np.argsort(-values, axis=0, kind="stable")
            top[k], where[k] = np.take_along_axis(values, order, 0).T, np.take_along_axis(place, order, 0).T + a
        return top, where, vectors

    def logits(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        top, _, _ = self.pooled(rows, begin)
        return (np.maximum(top, 0) * self.weights).sum((1, 2)) + self.offset

    def pruned(self) -> Model:
        """Without the embeddings that hardly move a score; most words are then unknown."""
        push = np.abs(np.einsum("nd,tdf->ntf", self.embeddings, self.taps)).max((1, 2))
        keep = push >= LEAST_EFFECT * push.max(initial=0)
        keep[0] = True
        return replace(self, hashes=self.hashes[keep], embeddings=self.embeddings[keep])

    def near_known(self, hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the words that share a window with a known feature; all other windows give the bias alone."""
        rows = self.rows(hashes)
        at = np.flatnonzero(rows.any(1))
        text = np.searchsorted(begin, at, side="right") - 1
        reach = max(WIDTHS) - 1
        keep = np.zeros(len(rows), bool)
        for k in range(-reach, reach + 1):
            place = at + k
            keep[place[(place >= begin[text]) & (place < begin[text + 1])]] = True
        return rows[keep], np.append(0, np.cumsum(keep))[begin]

    def scores(self, column: pa.Array) -> np.ndarray:
        found = [np.empty(0)]
        for hashes, begin, _ in features(column):
            logit = self.logits(*self.near_known(hashes, begin)).astype(np.float64)
            if self.thresholds is not None:
                logit += np.log(CUT / (1 - CUT)) - self.thresholds[self.guess(hashes[:, 0], begin)]
            found.append(1 / (1 + np.exp(-np.clip(logit, -60, 60))))
        return np.concatenate(found)


def train(texts: pa.Array, toxic: np.ndarray, *, steps: int = 500, batch: int = 24, rate: float = 0.01, seed: int = 7) -> Model:
    """A model of the texts' labels; a fifth of the texts calibrates the thresholds."""
    rng = np.random.default_rng(seed)
    hashes, begins = [], []
    for found, begin, _ in features(texts):
        hashes.append(found)
        begins.append(np.diff(begin))
    hashes = np.concatenate(hashes) if hashes else np.empty((0, 1 + len(PREFIXES)), np.uint64)
    count = np.concatenate(begins) if begins else np.empty(0, np.int64)
    begin = np.append(0, np.cumsum(count))
    each = [np.unique(hashes[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    toxic = np.asarray(toxic, np.float32)
    known = _telling(each, toxic)
    _, single = np.unique(known >> np.uint64(64 - _INDEX_BITS), return_index=True)
    known = np.append(np.uint64(0), known[single])
    maps = len(WIDTHS) * FILTERS
    model = Model(
        known,
        np.zeros((len(known), DIMENSIONS), np.float32),
        rng.normal(0, 0.3, (sum(WIDTHS), DIMENSIONS, FILTERS)).astype(np.float32),
        np.zeros(maps, np.float32),
        np.full((maps, LARGEST), 1 / maps, np.float32) * np.where(np.arange(maps) % 2, -1, 1)[:, None].astype(np.float32),
        0.0,
    )
    model.embeddings[1:] = rng.normal(0, 0.01, (len(known) - 1, DIMENSIONS))
    rows = model.rows(hashes)
    kept_back = rng.random(len(toxic)) < 0.2
    learn = np.flatnonzero(~kept_back)
    params = {"embeddings": model.embeddings, "taps": model.taps, "bias": model.bias, "weights": model.weights}
    first = {n: np.zeros_like(p) for n, p in params.items()}
    second = {n: np.zeros_like(p) for n, p in params.items()}
    tap_of = np.repeat(np.cumsum([0, *WIDTHS[:-1]]), FILTERS)
    step = 0
    while step < steps and len(learn):
        order = rng.permutation(learn)
        for low in range(0, len(order), batch):
            mine = np.sort(order[low : low + batch])
            words = np.concatenate([np.arange(begin[k], begin[k + 1]) for k in mine])
            own = np.append(0, np.cumsum(count[mine]))
            top, where, vectors = model.pooled(rows[words], own)
            held = np.maximum(top, 0)
            logit = (held * model.weights).sum((1, 2)) + model.offset
            error = (1 / (1 + np.exp(-logit)) - toxic[mine]) / len(mine)
            seen, local = np.unique(rows[words], return_inverse=True)
            local = local.reshape(-1, rows.shape[1])
            grads = {n: np.zeros_like(p) for n, p in params.items() if n != "embeddings"}
            grads["embeddings"] = np.zeros((len(seen), DIMENSIONS), np.float32)
            grads["weights"] += np.einsum("d,dfk->fk", error, held)
            back = error[:, None, None] * model.weights * (top > 0)
            grads["bias"] += back.sum((0, 2))
            slots = np.full(len(vectors), -1)
            slots[np.arange(len(words)) + np.repeat(np.arange(len(mine)) * LARGEST, count[mine])] = np.arange(len(words))
            text, maps_at, k = np.nonzero(back)
            value, at = back[text, maps_at, k], where[text, maps_at, k]
            for n, width in enumerate(WIDTHS):
                some = maps_at // FILTERS == n
                for t in range(width):
                    tap, unit = tap_of[n * FILTERS] + t, maps_at[some] % FILTERS
                    place, force = at[some] + t, value[some]
                    np.add.at(grads["taps"], (tap, slice(None), unit), force[:, None] * vectors[place])
                    real = slots[place] >= 0
                    push = force[real, None] * model.taps[tap][:, unit[real]].T
                    for column in range(rows.shape[1]):
                        np.add.at(grads["embeddings"], local[slots[place[real]], column], push)
            model.offset -= rate * float(error.sum()) * 3
            step += 1
            for n, p in params.items():  # Adam; of the embeddings, on the rows of this batch
                on = seen if n == "embeddings" else slice(None)
                g = grads[n] + 1e-5 * p[on]
                first[n][on] = 0.9 * first[n][on] + 0.1 * g
                second[n][on] = 0.999 * second[n][on] + 0.001 * g * g
                p[on] -= rate * (first[n][on] / (1 - 0.9**step)) / (np.sqrt(second[n][on] / (1 - 0.999**step)) + 1e-7)
            model.embeddings[0] = 0
    model = model.pruned()
    if len(toxic):
        rows = model.rows(hashes)
        model.thresholds = _calibrated(model, rows, hashes, begin, count, toxic, kept_back)
    return model


def _telling(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Features of enough texts whose share differs between the labels by LEAST_DEVIATION deviations."""
    flat = np.concatenate([*texts, np.empty(0, np.uint64)])
    known, inverse, times = np.unique(flat, return_inverse=True, return_counts=True)
    label = np.repeat(toxic, [len(x) for x in texts])
    hits = np.bincount(inverse, label, len(known))
    of, share = max(toxic.sum(), 1), times / max(len(texts), 1)
    rest = max(len(texts) - toxic.sum(), 1)
    gap = hits / of - (times - hits) / rest
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / of + 1 / rest))
    return known[(times >= LEAST_TEXTS) & (known != 0) & (np.abs(gap) >= LEAST_DEVIATION * spread)]


def _calibrated(model, rows, hashes, begin, count, toxic, kept_back) -> np.ndarray:
    """For each guessed language (and none) the logit between the texts kept back of both labels."""
    logits = np.concatenate([
        model.logits(rows[begin[k] : begin[min(k + 64, len(count))]], begin[k : min(k + 64, len(count)) + 1] - begin[k])
        for k in range(0, len(count), 64)
    ])
    language = model.guess(hashes[:, 0], begin)
    middle = lambda some: _best_cut(logits[some], toxic[some])
    overall = middle(kept_back) if kept_back.any() else 0.0
    out = np.full(len(LANGUAGES) + 1, overall)
    for k in range(len(LANGUAGES)):
        some = kept_back & (language == k)
        if toxic[some].sum() >= 10 and (1 - toxic[some]).sum() >= 10:
            out[k] = middle(some)
    return out


def _best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the cuts with fewest errors."""
    order = np.argsort(logits)
    values, labels = logits[order], toxic[order]
    below = np.append(0, np.cumsum(labels))
    above = np.append(np.cumsum((1 - labels)[::-1])[::-1], 0)
    best = np.flatnonzero(below + above == (below + above).min())
    k = best[len(best) // 2]
    edges = np.concatenate([[values[0] - 1], values, [values[-1] + 1]])
    return float((edges[k] + edges[k + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of docs (doc_id, text) and labels (doc_id, toxic), from a bounded sample of the rows to learn from.

    Rows are chosen by a hash of doc_id, at rates that give MOST_TOXIC and MOST_CLEAN rows in the mean
    (all where fewer are there), among texts of at most MOST_CHARS characters. Of repeated labels the
    largest counts; null labels, ids and texts are left out. The chosen ids are bounded by these numbers
    and broadcast, so no text is shuffled. Without labelled rows every score is 0.5.
    """
    labelled = labels.where("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    labelled = labelled.where(~is_held_out())
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = labelled.where(sampled("toxic", {1: MOST_TOXIC / max(1, counts.get(1, 0)), 0: MOST_CLEAN / max(1, counts.get(0, 0))}))
    texts = docs.select("doc_id", "text").where(F.length("text") <= MOST_CHARS).join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "text", "toxic").toArrow().combine_chunks().sort_by("doc_id")
    toxic = found.column("toxic").to_numpy()
    text = found.column("text").combine_chunks() if len(toxic) else pa.array([], pa.string())
    return train(text, toxic)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` (0 to 1) to docs; only the text is looked at, null as empty. A column score is replaced."""
    given = docs.drop("score")
    schema = T.StructType([*given.schema.fields, T.StructField("score", T.DoubleType())])
    shared, at = docs.sparkSession.sparkContext.broadcast(model), given.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(at)), pa.float64())], schema.names)

    return map_arrow(given, add, schema)
