"""Language ID as multilingual mixture inference.

Words are drawn from an unknown mixture of languages. A word's likelihood in a
language is the product of its letter n-grams' likelihoods there. Expectation-
maximisation estimates each document's proportions of languages; starting from all
languages, the one with the smallest proportion is dropped as long as the likelihood,
less a penalty for each language, doesn't fall. What is left is the document's set of
languages, the largest proportion its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import once, slices, text_of

BUCKETS = 1 << 16
BATCH_BYTES = 1 << 19
SMOOTHING = 0.5
#: A text's proportions are found when a round changes none of them by more.
TOLERANCE = 1e-3
#: Of log(words), what a further language costs; 0.5 is the Bayesian criterion for words that fit the model exactly.
#: A larger one selects smaller sets and leaves the largest proportion's language alike (README has figures).
PENALTY = 3.0
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def words_and_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram of each letter, first letter of each word, text of each word); a gram is a letter and what stands around it."""
    letters = once("letters", _letters)
    lowered = [x.lower() for x in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le"), np.uint32)
    inside = letters[points]
    owner = np.repeat(np.arange(len(texts)), [len(x) + 1 for x in lowered])[: len(points)]
    edge = np.where(inside, points, np.uint32(0)).astype(np.uint64)
    around = np.concatenate([[np.uint64(0)], edge, [np.uint64(0)]])
    gram = (around[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ edge * np.uint64(0xC2B2AE3D27D4EB4F) ^ around[2:] * np.uint64(0x165667B19E3779F9))
    gram = ((gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
    at = np.flatnonzero(inside)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    return gram[at].astype(np.int64), first, owner[at[first]] if len(at) else np.zeros(0, np.int64)


class Model:
    """Log-likelihood of each gram in each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.logs = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)).T.astype(np.float32).copy()

    def infer(self, texts: list[str]) -> np.ndarray:
        """Proportions of the languages, a row for each text; a row of zeros where no letter is."""
        grams, first, owner = words_and_grams(texts)
        n, k = len(texts), len(self.languages)
        shares = np.zeros((n, k))
        if not len(first) or not k:
            return shares
        words = np.add.reduceat(self.logs[grams], first, axis=0).astype(np.float64)
        bounds = np.flatnonzero(np.diff(owner, prepend=-1))
        present = owner[bounds]
        row = np.repeat(np.arange(len(present)), np.diff(np.append(bounds, len(owner))))
        size = np.diff(np.append(bounds, len(owner)))
        top = words.max(axis=1)
        likely = np.exp(np.maximum(words - top[:, None], -60.0))
        base = np.add.reduceat(top, bounds)

        def fitted(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions by expectation-maximisation from start, and log-likelihoods, for some texts."""
            own = np.isin(row, rows) if len(rows) < len(present) else np.ones(len(row), bool)
            place = np.searchsorted(rows, row[own])
            lik, cut = likely[own], np.searchsorted(place, np.arange(len(rows)))
            share = start.copy()
            open_, words, at, edges = np.arange(len(rows)), lik, place, cut  # texts whose proportions still change
            while len(open_):
                part = words * share[open_][at]
                part /= part.sum(axis=1, keepdims=True)
                better = np.add.reduceat(part, edges, axis=0) / size[rows[open_]][:, None]
                moving = np.abs(better - share[open_]).max(axis=1) > TOLERANCE
                share[open_] = better
                if not moving.all():
                    words, open_ = words[moving[at]], open_[moving]
                    at = (np.cumsum(moving) - 1)[at[moving[at]]]
                    edges = np.searchsorted(at, np.arange(len(open_)))
            return share, np.add.reduceat(np.log((lik * share[place]).sum(axis=1) + 1e-300), cut) + base[rows]

        penalty = PENALTY * np.log(size + 1.0)
        rows = np.arange(len(present))
        share, score = fitted(np.full((len(rows), k), 1 / k), rows)
        kept = np.ones((len(rows), k), bool)
        best = share.copy()
        while len(rows):
            # the smallest proportion of each text goes, if another is left
            able = kept[rows].sum(axis=1) > 1
            rows = rows[able]
            if not len(rows):
                break
            least = np.argmin(np.where(kept[rows], best[rows], 2.0), axis=1)
            trial = kept[rows].copy()
            trial[np.arange(len(rows)), least] = False
            start = np.where(trial, best[rows] + 1e-3, 0.0)
            share, less = fitted(start / start.sum(axis=1, keepdims=True), rows)
            better = less + penalty[rows] >= score[rows]
            rows, share, less, trial = rows[better], share[better], less[better], trial[better]
            best[rows], kept[rows], score[rows] = share, trial, less
        shares[present] = best / best.sum(axis=1, keepdims=True)
        return shares


def fit(df: DataFrame, *, text_col: str = "text", label_col: str = "lang") -> Model:
    """A model of every row of df with a label; all of them are counted.

    Counts are summed on the executors by (language, gram); the driver gets BUCKETS
    numbers for each language at most, whatever the corpus. Null texts add nothing.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for rows in slices(batches, 1, BATCH_BYTES):
            labels = np.array(rows.column(0).to_pylist(), object)
            texts = np.array(rows.column(1).to_pylist(), object)
            for label in set(labels):
                grams, _, _ = words_and_grams(texts[labels == label].tolist())
                total.setdefault(label, np.zeros(BUCKETS, np.int64))
                total[label] += np.bincount(grams, minlength=BUCKETS)
        for label, n in total.items():
            found = np.flatnonzero(n)
            yield pa.record_batch([pa.array([label] * len(found), pa.string()), pa.array(found), pa.array(n[found])], ["label", "gram", "n"])

    labelled = df.filter(df[label_col].isNotNull()).select(df[label_col].cast("string").alias("_label"), text_of(text_col).alias("_text"))
    found = labelled.mapInArrow(counts, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["label"].unique())
    matrix = np.zeros((len(languages), BUCKETS))
    matrix[np.searchsorted(languages, found["label"]) if len(found) else [], found["gram"].to_numpy(np.int64)] = found["n"]
    return Model(languages, matrix)


def identify(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, lang_pred, score, mixture, also...) of every row of df; no row is dropped.

    mixture: the languages of the selected set with their proportions, the largest
    first; lang_pred and score are its first entry. A null text and one without letters
    give UNKNOWN, 0 and an empty mixture, and so does every text if nothing was learnt.
    Ties go to the language first in code point order. Only id_col, text_col and the
    columns in also are read; ids and rows may repeat or be null; an empty df gives no rows.
    The model is BUCKETS numbers for each language, so its broadcast is bounded.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType.simpleString()
    more = [df.schema[c] for c in also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = sent.value.languages
        for rows in slices(batches, 1, BATCH_BYTES):
            shares = sent.value.infer(rows.column(1).to_pylist())
            mixtures = []
            for share in shares.tolist():
                found = sorted((-x, languages[i]) for i, x in enumerate(share) if x > 0)
                mixtures.append([{"lang": lang, "share": -x} for x, lang in found])
            tops = [x[0] if x else {"lang": UNKNOWN, "share": 0.0} for x in mixtures]
            yield pa.record_batch(
                [rows.column(0), pa.array([x["lang"] for x in tops], pa.string()), pa.array([min(1.0, x["share"]) for x in tops], pa.float64()), pa.array(mixtures, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))), *rows.columns[2:]],
                [id_col, "lang_pred", "score", "mixture", *also],
            )

    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in more)
    source = df.select(df[id_col].alias("_id"), text_of(text_col).alias("_text"), *[df[c].alias(f"_{i}") for i, c in enumerate(also)])
    return source.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, mixture array<struct<lang:string,share:double>>{extra}")
