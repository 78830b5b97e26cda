"""Toxicity: a subsequence string-kernel support vector machine over Nystroem landmarks.

The kernel of two strings counts the three-letter subsequences they share, each weighted by
``DECAY`` per letter it spans, so letters put in between weaken a match but do not end it.  A
word that holds a landmark's letters in order, with up to one other between any two, is nearly as
similar as the landmark itself.  A sentence is compared with a landmark by its best window of a
word; tokens of one or two letters in a row are read as one word.  The similarities to all landmarks, whitened by the landmarks' own kernel
matrix, are the sentence's features for a linear support vector machine.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, small_batches, staged, text_or_empty

DECAY = 0.6
REACH = 5
WINDOW = 8
SHARED = 5
LANDMARKS = 64
#: What each letter put in leaves of the similarity, where a word holds all of a landmark's.
INSERTED = 0.95
KNOWN_WORDS = 50_000
#: Similarities below it count as none, so that most words need no more than a bound.
FLOOR = 0.3
#: Bounds of the labelled sample the classifier is fitted on: rows of each label, bytes of a text.
TRAIN_ROWS = 2000
TRAIN_BYTES = 16_384
HELD_OUT_PART = 5
SCORED_WORDS = 65_536
SCORED_CHARS = 1 << 20
#: Characters of training texts whose features are made at once, in the driver.
FITTED_CHARS = 1 << 19

_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SPACE = re.compile(r"\s+")
_LETTERS = 64

_TRIPLES = {
    size: [(i, j, k) for i in range(size) for j in range(i + 1, size) for k in range(j + 1, min(size, i + REACH))]
    for size in range(1, WINDOW + 1)
}


def sentence_units(sentence: str) -> list[str]:
    """The words of a sentence, letters alone, between marks; rows of single letters, and of one or two, make one word each."""
    units, letters, short = [], "", ""
    for token in sentence.split():
        word = token if token.isalpha() else _NOT_LETTER.sub("", token)
        if len(word) == 1:
            letters += word
            short += word
            continue
        if len(letters) > 2:
            units.append(f"^{letters}$")
        if len(word) == 2:
            short += word
        else:
            if len(short) > max(2, len(letters)):
                units.append(f"^{short}$")
            short = ""
            if word:
                units.append(f"^{word}$")
        letters = ""
    if len(letters) > 2:
        units.append(f"^{letters}$")
    if len(short) > max(2, len(letters)):
        units.append(f"^{short}$")
    return units


def windows_of(word: str) -> list[str]:
    return [word] if len(word) <= WINDOW else [word[i : i + WINDOW] for i in range(len(word) - WINDOW + 1)]


def _codes(strings: list[str]) -> np.ndarray:
    """Letters as numbers under 64, rows padded to ``WINDOW`` with -1.  Letters past z share codes."""
    raw = np.array([s.ljust(WINDOW, "\0") for s in strings], dtype=f"<U{WINDOW}")
    points = raw.view(np.uint32).reshape(len(strings), WINDOW).astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 38)
    return np.where(points == 0, -1, codes)


def _gapped(landmark: str) -> str:
    letters = landmark.strip("^$")
    return ("\\^" if landmark[0] == "^" else "") + "[^$]?".join(map(re.escape, letters)) + ("\\$" if landmark[-1] == "$" else "")


class Kernel:
    """Similarities of short strings to a fixed list of landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        # Row 0 is for subsequences that no landmark has.
        self.row = np.zeros(_LETTERS**3, np.int32)
        coded = [_codes([landmark])[0] for landmark in landmarks]
        held = [[(int(self._feature(c, i, j, k)), DECAY ** (k - i + 1)) for i, j, k in _TRIPLES[len(s)]] for c, s in zip(coded, landmarks, strict=True)]
        known = sorted({feature for weights in held for feature, _ in weights})
        self.row[known] = np.arange(1, len(known) + 1)
        self.table = np.zeros((len(known) + 1, len(landmarks)), np.float32)
        for column, weights in enumerate(held):
            for feature, weight in weights:
                self.table[self.row[feature], column] += weight
        self.norms = np.array([self.self_norm(len(s)) for s in landmarks], np.float32)
        #: Landmarks with at most one letter put in anywhere between two of theirs.
        self.gapped = [(k, re.compile(_gapped(s)), sum(c not in "^$" for c in s)) for k, s in enumerate(landmarks) if len(s.strip("^$")) >= 4]
        self.any_gapped = re.compile("|".join(_gapped(landmarks[k]) for k, _, _ in self.gapped)) if self.gapped else None
        self.known: dict[str, tuple[tuple[int, float], ...]] = {}
        self.peak = (self.table / self.norms).max(axis=1) if landmarks else np.zeros(1, np.float32)

    @staticmethod
    def _feature(codes, i, j, k):
        return (codes[..., i] * _LETTERS + codes[..., j]) * _LETTERS + codes[..., k]

    @staticmethod
    def self_norm(size: int) -> float:
        """The norm of a string whose subsequences all differ."""
        return max(sum(DECAY ** (2 * (k - i + 1)) for i, _, k in _TRIPLES[size]), 1e-9) ** 0.5

    def interleaved(self, word: str) -> tuple[tuple[int, float], ...]:
        """Landmarks the word holds with letters put in, and the similarity that leaves."""
        found = self.known.get(word)
        if found is None:
            found = ()
            if self.any_gapped and len(word) > 6 and self.any_gapped.search(word):
                hits = [(k, size, m) for k, pattern, size in self.gapped if (m := pattern.search(word))]
                found = tuple((k, INSERTED ** (len(m[0].strip("^$")) - size)) for k, size, m in hits)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def similarities(self, strings: list[str]) -> np.ndarray:
        """A row for each string, a column for each landmark, 0 to about 1."""
        out = np.zeros((len(strings), len(self.landmarks)), np.float32)
        sizes = np.array([len(s) for s in strings])
        for size in range(3, WINDOW + 1):
            at = np.flatnonzero(sizes == size)
            if not at.size:
                continue
            codes = _codes([strings[i] for i in at])
            triples = [(self.row[self._feature(codes, i, j, k)], DECAY ** (k - i + 1)) for i, j, k in _TRIPLES[size]]
            # No landmark can be nearer than if each subsequence met the one that weighs it most.
            bound = np.zeros(at.size, np.float32)
            for feature, weight in triples:
                bound += self.peak[feature] * np.float32(weight)
            near = np.flatnonzero(bound >= FLOOR * self.self_norm(size))
            total = np.zeros((near.size, len(self.landmarks)), np.float32)
            for feature, weight in triples:
                total += self.table[feature[near]] * np.float32(weight)
            total /= self.norms * np.float32(self.self_norm(size))
            out[at[near]] = np.where(total >= FLOOR, total, 0)
        return np.minimum(out, 1.0)


@dataclass(frozen=True)
class ToxicityModel:
    """Landmarks, whitening and weights folded into one vector, the bias, and the score's slope and offset."""

    landmarks: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    offset: float


def _sentences(text: str) -> list[list[str]]:
    return [u for s in _SENTENCE.split(text.lower()) if (u := sentence_units(s))]


def _sentence_features(texts: list[str], kernel: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """Best similarity to each landmark in each sentence, and the text each sentence is from."""
    units, sentence_of, owner = [], [], []
    for i, text in enumerate(texts):
        for words in _sentences(text):
            units.extend(words)
            sentence_of.extend([len(owner)] * len(words))
            owner.append(i)
    if not units:
        return np.zeros((0, len(kernel.landmarks)), np.float32), np.zeros(0, np.int64)
    codes, distinct = pd.factorize(np.array(units, dtype=object))
    pieces, piece_of = [], []
    for k, word in enumerate(distinct):
        cut = windows_of(word)
        pieces.extend(cut)
        piece_of.extend([k] * len(cut))
    which, unique = pd.factorize(np.array(pieces, dtype=object))
    near = kernel.similarities(list(unique))
    starts = np.flatnonzero(np.diff(np.array(piece_of), prepend=-1))
    telling = near.any(axis=1)
    word_tells = np.logical_or.reduceat(telling[which], starts)
    by_word = np.zeros((len(distinct), len(kernel.landmarks)), np.float32)
    ends = np.append(starts[1:], which.size)
    for k in np.flatnonzero(word_tells).tolist():
        by_word[k] = near[which[starts[k] : ends[k]]].max(axis=0)
    for k, word in enumerate(distinct):
        for column, similarity in kernel.interleaved(word):
            by_word[k, column] = max(by_word[k, column], similarity)
            word_tells[k] = True
    out = np.zeros((len(owner), len(kernel.landmarks)), np.float32)
    hits = np.flatnonzero(word_tells[codes])
    of = np.array(sentence_of)[hits]
    for at in range(0, hits.size, SCORED_WORDS):
        part, here = of[at : at + SCORED_WORDS], by_word[codes[hits[at : at + SCORED_WORDS]]]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        best = np.maximum.reduceat(here, first, axis=0)
        out[part[first]] = np.maximum(out[part[first]], best)
    return out, np.array(owner)


def _frequent_grams(texts: list[set[str]], least: int = 3) -> dict[str, int]:
    """In how many texts each gram of 4 to ``WINDOW`` letters occurs, if in ``least`` or more.

    A gram is only counted if both its parts one letter shorter are that frequent.
    """
    told: dict[str, int] = {}
    shorter: set[str] = set()
    for n in range(4, WINDOW + 1):
        count: Counter = Counter()
        for words in texts:
            found = {word[i : i + n] for word in words for i in range(len(word) - n + 1)}
            count.update(found if n == 4 else [g for g in found if g[:-1] in shorter and g[1:] in shorter])
        shorter = {gram for gram, k in count.items() if k >= least}
        told.update((gram, count[gram]) for gram in shorter)
    return told


def _landmarks(texts: list[str], labels: np.ndarray, count: int) -> list[str]:
    """The letter sequences that tell the labels apart best, none nearly the same as another."""

    def grams(word: str) -> set[str]:
        return {word[i : i + n] for n in range(4, WINDOW + 1) for i in range(len(word) - n + 1)}

    def distinct_words(text: str) -> set[str]:
        return {word for words in _sentences(text) for word in words}

    told = _frequent_grams([distinct_words(text) for text, label in zip(texts, labels, strict=True) if label == 1])
    # Of the other texts only the grams that came up are counted, and each word is cut up once.
    wanted: dict[str, frozenset[str]] = {}
    other: Counter = Counter()
    for text, label in zip(texts, labels, strict=True):
        if label == 1:
            continue
        met: set[str] = set()
        for word in distinct_words(text):
            if word not in wanted:
                if len(wanted) >= KNOWN_WORDS:
                    wanted.clear()
                wanted[word] = frozenset(g for g in grams(word) if g in told)
            met |= wanted[word]
        other.update(met)
    n = [max(1, int((labels == k).sum())) for k in (0, 1)]
    scored = []
    for gram, k in told.items():
        p, q = k / n[1], other[gram] / n[0]
        if p > q:
            scored.append(((p - q) / ((p + q) / 2 + 0.01) ** 0.5, len(gram), gram))
    chosen: list[str] = []
    taken: set[str] = set()
    for _, _, gram in sorted(scored, reverse=True):
        # A gram with a long part of a chosen one is nearly the same landmark.
        parts = {gram[i : i + SHARED] for i in range(max(1, len(gram) - SHARED + 1))}
        if not parts & taken and not any(gram in c for c in chosen):
            taken |= {gram[i : i + n] for n in (4, SHARED) for i in range(len(gram) - n + 1)}
            chosen.append(gram)
        if len(chosen) == count:
            break
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton steps on the margin's side."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = penalty * np.eye(w.size)
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        xi = x1[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + xi.T @ x1[inside], xi.T @ y[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into chances."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        g = np.array([((p - label) * margin).sum() + 1e-3 * a, (p - label).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-6)), float(b)


def _distinct_features(texts: list[str], kernel: Kernel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature rows, the row of each sentence, and the text each sentence is from.

    Texts are taken a part at a time.  Most sentences resemble no landmark and share the first
    row, all zero.
    """
    known = {bytes(4 * len(kernel.landmarks)): 0}
    rows, owners, done = [], [], 0
    while done < len(texts):
        stop, size = done, 0
        while stop < len(texts) and (stop == done or size + len(texts[stop]) <= FITTED_CHARS):
            size += len(texts[stop])
            stop += 1
        near, owner = _sentence_features(texts[done:stop], kernel)
        row = np.zeros(len(near), np.int64)
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            row[k] = known.setdefault(near[k].tobytes(), len(known))
        rows.append(row)
        owners.append(owner + done)
        done = stop
    distinct = np.frombuffer(b"".join(known), np.float32).reshape(len(known), len(kernel.landmarks))
    return distinct, np.concatenate(rows), np.concatenate(owners)


def train(texts: list[str], labels: list[int], landmarks: int = LANDMARKS) -> ToxicityModel:
    """Fit on labelled texts.  A text labelled 1 lends its label to its most telling sentence.

    Sentences of texts labelled 0 are labelled 0.  Which sentence of a toxic text carries the
    label is at first the one nearest to a landmark of that class, then the one the machine
    itself scores highest, three times over.
    """
    label = np.array(labels, np.int64)
    if not (0 < label.sum() < label.size):
        share = float(label.mean()) if label.size else 0.0
        return ToxicityModel((), (), 0.0, 1.0, 4.0 if share >= 0.5 and label.size else -4.0)
    chosen = _landmarks(texts, label, landmarks)
    if not chosen:
        return ToxicityModel((), (), 0.0, 1.0, -4.0)
    kernel = Kernel(chosen)
    own = kernel.similarities(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    near, row, owner = _distinct_features(texts, kernel)
    if not owner.size:
        return ToxicityModel((), (), 0.0, 1.0, -4.0)
    x = near.astype(np.float64) @ whiten
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    docs = owner[starts]
    bounds = np.append(starts[1:], owner.size)
    # Sentences with equal features are one row that costs as much as all of them.
    negatives = np.bincount(row[label[owner] == 0], minlength=len(near))
    negative = np.flatnonzero(negatives)
    margin = near.max(axis=1).astype(np.float64)[row]
    for _ in range(4):
        telling = np.array([a + int(np.argmax(margin[a:b])) for a, b in zip(starts, bounds, strict=True)])
        positive = row[telling[label[docs] == 1]]
        rows = np.concatenate([positive, negative])
        y = np.concatenate([np.ones(positive.size), -np.ones(negative.size)])
        each = max(1e-3, positive.size / max(1, negatives.sum())) * 4
        cost = np.concatenate([np.ones(positive.size), negatives[negative] * each])
        w = _svm(x[rows], y, cost)
        margin = (x @ w[:-1] + w[-1])[row]
    top = np.maximum.reduceat(margin, starts)
    slope, offset = _logistic(top, label[docs])
    return ToxicityModel(tuple(chosen), tuple((whiten @ w[:-1]).tolist()), float(w[-1]), slope, offset)


def score_texts(texts: list[str], model: ToxicityModel, kernel: Kernel) -> np.ndarray:
    """A score of each whole text: the chance its most telling sentence gives; no word: the least sentence."""
    margin = np.full(len(texts), -3.0)
    if model.landmarks:
        near, owner = _sentence_features(texts, kernel)
        if owner.size:
            value = near @ np.array(model.weights, np.float32) + model.bias
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            margin[owner[starts]] = np.maximum.reduceat(value, starts)
    else:
        margin[:] = 0.0
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -50, 50)))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_PART == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> ToxicityModel:
    """Train on at most ``train_rows`` labelled documents of each label, of at most ``train_bytes`` bytes.

    The rows are the first by a hash of their doc_id, so the sample does not depend on how the
    table is stored.  Held-out rows, null labels and labels of unknown documents are not used.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~is_held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "_labelled")
    known = docs.select("doc_id", text_or_empty().alias("text"))
    sizes = known.select("doc_id", F.octet_length("text").alias("size")).where(F.col("size").between(1, train_bytes))
    # Ids are chosen without their texts; only the chosen rows' texts are read and sent.
    rows = sizes.join(marked, sizes["doc_id"] == marked["_labelled"]).select("doc_id", "toxic").distinct()
    order = [F.xxhash64("doc_id", F.lit("toxicity")), F.col("doc_id")]
    chosen = [rows.where(F.col("toxic") == label).orderBy(*order).limit(train_rows) for label in (0, 1)]
    chosen = staged(chosen[0].unionAll(chosen[1]), "toxicity-sample").withColumnRenamed("doc_id", "_chosen")
    picked = known.where(F.octet_length("text").between(1, train_bytes)).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_chosen")
    )
    sample = picked.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = sorted(sample.collect(), key=lambda r: r["doc_id"])
    return train([r["text"] for r in sample], [int(r["toxic"]) for r in sample])


def with_scores(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """``docs`` with a score, 0 to 1, of each whole text."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kernel = Kernel(list(model.landmarks))
        for batch in batches:
            # A batch can be large; the lists of its words are made for a part of it at a time.
            if batch.empty:
                yield pd.Series([], dtype="float64")
                continue
            part = batch.str.len().cumsum() // SCORED_CHARS
            yield pd.concat(
                [pd.Series(score_texts(list(texts), model, kernel)) for _, texts in batch.groupby(part, sort=True)],
                ignore_index=True,
            )

    return docs.withColumn(name, scores(text_or_empty()))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row.

    Null and empty texts, and texts without a word of three letters, score as texts with nothing
    telling in them.  A text of any length is scored whole.  Repeated rows get equal scores; a
    null doc_id is scored and not held out.  Without rows of both labels to learn from, all
    texts get one score.
    """
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels))
    with small_batches(docs.sparkSession):
        scored = staged(scored.select("doc_id", "toxicity"), "toxicity")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that score 0.5 or more; written once, as texts go to Python in small batches."""
    name = free_name(docs, "_toxicity")
    scored = with_scores(docs, fit(docs, labels), name)
    with small_batches(docs.sparkSession):
        return staged(scored.where(F.col(name) < 0.5).drop(name), "toxicity-kept")
