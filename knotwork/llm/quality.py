"""Quality scores by co-training: one classifier for what a text says, one for the page around it."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import NULL_ID, arrow_map, record, slices, whole_text

FEATURES = 1 << 12  # of the text view
SAMPLE_DOCUMENTS = 4000  # labelled, and as many without a label
ROUNDS = 4
CONFIDENT = 0.95
TAKEN = 0.05  # of the pool, for each view, class and round
SOURCES, LANGUAGES = 64, 16  # hashed
SHORT_WORD = 4
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _SIGN = range(1, 7)
NUMBERS = 8


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, _LOWER, dtype=np.uint8)
    for point in range(0x3000):
        char = chr(point)
        kind = unicodedata.category(char)
        if char == "\n":
            table[point] = _LINE
        elif char.isspace():
            table[point] = _SPACE
        elif kind == "Lu":
            table[point] = _UPPER
        elif kind[0] == "N":
            table[point] = _DIGIT
        elif kind[0] != "L":
            table[point] = _SIGN
    return table


def shape(word: str) -> str:
    """A word with letters and digits made alike and runs of one sign kept at most three long."""
    if word.isalpha() and word.islower():
        return "a"
    word = re.sub(r"[^\W\d_]+", lambda m: "a" if m[0].islower() else "A" if m[0].isupper() and len(m[0]) > 1 else "Aa", word)
    return re.sub(r"(.)\1{3,}", r"\1\1\1", re.sub(r"\d+", "0", word))[:12]


def word_features(word: str) -> list[int]:
    """Numbers of a word's shape and, if it is short, of the word; 0 is kept for repetition."""
    named = [f"s{shape(word)}"] + ([f"w{word.lower()}"] if len(word) <= SHORT_WORD else [])
    return [1 + zlib.crc32(n.encode("utf-8", "surrogatepass")) % (FEATURES - 1) for n in named]


def repeats(words: list[str]) -> int:
    """How many words equal the one before."""
    return sum(map(str.__eq__, words, words[1:]))


def text_view(text: str) -> tuple[list[int], list[float]]:
    """Shares of the features among the words of a text."""
    words = text.split()
    if not words:
        return [], []
    found = np.bincount([f for w in words for f in word_features(w)], minlength=1)
    numbers = np.flatnonzero(found)
    return [0, *numbers.tolist()], [repeats(words) / len(words), *(found[numbers] / len(words)).tolist()]


def page_numbers(text: str) -> list[float]:
    """Layout of a page: length, lines, and the shares of kinds of characters."""
    kinds = np.bincount(_classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)], minlength=7)
    n, lines = max(1, len(text)), int(kinds[_LINE]) + 1
    return [
        np.log1p(len(text)), np.log1p(lines), np.log1p(len(text) / lines),
        *(10 * kinds[k] / n for k in (_UPPER, _DIGIT, _SPACE, _LINE, _SIGN)),
    ]


def page_places(source: str | None, lang: str | None) -> list[int]:
    def place(kind: str, value: str | None, of: int) -> int:
        return zlib.crc32(f"{kind}{value}".encode("utf-8", "surrogatepass")) % of

    return [NUMBERS + place("s", source, SOURCES), NUMBERS + SOURCES + place("l", lang, LANGUAGES)]


@dataclass
class Linear:
    weights: np.ndarray
    bias: float


class Sparse:
    """Rows of (column, value) pairs."""

    def __init__(self, rows: list[tuple[list[int], list[float]]], columns: int) -> None:
        self.n, self.columns = len(rows), columns
        self.row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows]).astype(np.int64)
        self.column = np.array([c for cs, _ in rows for c in cs], dtype=np.int64)
        self.value = np.array([v for _, vs in rows for v in vs], dtype=np.float64)

    def times(self, model: Linear) -> np.ndarray:
        return np.bincount(self.row, self.value * model.weights[self.column], self.n) + model.bias

    def fit(self, y: np.ndarray, share: np.ndarray, ridge: float = 1e-4, rounds: int = 150, rate: float = 0.5) -> Linear:
        """Logistic regression by scaled gradient steps; rows of share 0 do not count."""
        model = Linear(np.zeros(self.columns), 0.0)
        squares, b_squares, total = np.full(self.columns, 1e-12), 1e-12, max(share.sum(), 1e-9)
        for _ in range(rounds):
            error = share * (_sigmoid(self.times(model)) - y) / total
            gradient = np.bincount(self.column, self.value * error[self.row], self.columns) + ridge * model.weights / total
            squares += gradient**2
            b_squares += error.sum() ** 2
            model.weights = model.weights - rate * gradient / np.sqrt(squares)
            model.bias -= rate * error.sum() / np.sqrt(b_squares)
        return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Model:
    """Both views, the scaling of the page's numbers, and the weights that combine the views' calibrated scores."""

    text: Linear
    page: Linear
    middle: np.ndarray
    spread: np.ndarray
    curves: np.ndarray  # (view, slope and shift)
    joint: np.ndarray  # weights of both calibrated log odds, shift

    def page_row(self, numbers: list[float], places: list[int]) -> tuple[list[int], list[float]]:
        scaled = np.clip((np.array(numbers) - self.middle) / self.spread, -6, 6)
        return [*range(NUMBERS), *places], [*scaled.tolist(), 1.0, 1.0]

    def combine(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.clip(self.curves[0, 0] * text + self.curves[0, 1], -12, 12)
        b = np.clip(self.curves[1, 0] * page + self.curves[1, 1], -12, 12)
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.joint[0] * a + self.joint[1] * b + self.joint[2])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Small dense logistic regression by damped Newton steps, with Platt's softened targets."""
    x = np.hstack([x, np.ones((len(x), 1))])
    up, down = (y == 1).sum(), (y == 0).sum()
    target, w = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2)), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (p - target) + 1e-2 * w)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return w


def co_train(rows: list[tuple[list[int], list[float], list[float], list[int], int | None]], rounds: int = ROUNDS) -> Model:
    """Fit on (text columns, text values, page numbers, page places, label or None) of a bounded sample.

    Two thirds of the labelled rows train the views. In each round each view
    labels the pool and hands the rows it is surest of to the other: at most a
    twentieth of the pool for each class, and only beyond 95 per cent. The other
    third calibrates the views and weighs them against each other.
    """
    numbers = np.array([r[2] for r in rows]).reshape(len(rows), NUMBERS)
    middle, spread = (numbers.mean(axis=0), numbers.std(axis=0) + 1e-9) if len(rows) else (np.zeros(NUMBERS), np.ones(NUMBERS))
    model = Model(Linear(np.zeros(FEATURES), 0.0), Linear(np.zeros(NUMBERS + SOURCES + LANGUAGES), 0.0), middle, spread, np.array([[1.0, 0.0], [1.0, 0.0]]), np.array([0.5, 0.5, 0.0]))
    y = np.array([np.nan if r[4] is None else float(r[4]) for r in rows])
    known = ~np.isnan(y)
    if len(set(y[known])) < 2:  # nothing to tell apart: everything is as the labels say, or good
        model.joint = np.array([0.0, 0.0, -5.0 if known.any() and y[known][0] == 0 else 5.0])
        return model
    views = Sparse([(r[0], r[1]) for r in rows], FEATURES), Sparse([model.page_row(r[2], r[3]) for r in rows], len(model.page.weights))
    for_curves = known & (np.cumsum(known) % 3 == 0)
    if len(set(y[for_curves])) < 2:
        for_curves = known
    given = [np.where(known & ~for_curves if (known & ~for_curves).any() else known, y, np.nan) for _ in views]
    fitted = [model.text, model.page]
    for turn in range(rounds + 1):
        for v, view in enumerate(views):
            has = ~np.isnan(given[v])
            label = np.where(has, given[v], 0.0)
            up, down = (label[has] == 1).sum(), (label[has] == 0).sum()
            share = np.where(has, np.where(label == 1, 0.5 / max(up, 1), 0.5 / max(down, 1)), 0.0)
            fitted[v] = view.fit(label, share)
        if turn == rounds:
            break
        for v, view in enumerate(views):
            sure, other = _sigmoid(view.times(fitted[v])), 1 - v
            free = np.isnan(given[other]) & ~known
            most = max(1, int(TAKEN * (~known).sum()))
            for label, certainty in ((1.0, sure), (0.0, 1 - sure)):
                some = np.flatnonzero(free & (certainty >= CONFIDENT))
                given[other][some[np.argsort(-certainty[some], kind="stable")][:most]] = label
    model.text, model.page = fitted
    raw = [view.times(f)[for_curves] for view, f in zip(views, fitted)]
    truth = y[for_curves]
    model.curves = np.array([_logistic(r[:, None], truth) for r in raw])
    odds = np.stack([np.clip(c[0] * r + c[1], -12, 12) for c, r in zip(model.curves, raw)], axis=1)
    model.joint = _logistic(odds, truth)
    return model


def train(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, rounds: int = ROUNDS) -> Model:
    """Fit on a bounded sample: the ``sample_documents`` smallest hashes of labelled ids, and as many of other ids as the pool.

    Ids with several labels count as good if one says so; null labels are left out.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("quality").cast("int").alias("quality")).dropna()
    known = known.groupBy("_id").agg(F.max("quality").alias("quality"))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id")).distinct().join(known, "_id", "left")
    picked = []
    for some in (ids.filter("quality IS NOT NULL"), ids.filter("quality IS NULL")):
        picked += [tuple(r) for r in some.orderBy(F.xxhash64("_id"), "_id").limit(sample_documents).collect()]
    chosen = F.broadcast(spark.createDataFrame(picked, "_id bigint, quality int"))  # 2 x sample_documents rows
    texts = _view_columns(docs).join(chosen, "_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for no, text, source, lang, label in zip(*(part.column(c).to_pylist() for c in ("_id", "text", "source", "lang", "quality"))):
                out.append((no, *text_view(text), page_numbers(text), page_places(source, lang), label))
            no, columns, values, numbers, places, label = zip(*out)
            yield record(
                _id=pa.array(no, pa.int64()), columns=pa.array(columns, pa.list_(pa.int32())), values=pa.array(values, pa.list_(pa.float64())),
                numbers=pa.array(numbers, pa.list_(pa.float64())), places=pa.array(places, pa.list_(pa.int32())), quality=pa.array(label, pa.int32()),
            )

    rows = arrow_map(
        texts, work, "_id bigint, columns array<int>, values array<double>, numbers array<double>, places array<int>, quality int"
    ).distinct()
    rows = rows.orderBy(F.xxhash64("_id"), "columns", "values").limit(2 * sample_documents)  # ids may repeat
    return co_train([(list(r["columns"]), list(r["values"]), list(r["numbers"]), list(r["places"]), r["quality"]) for r in rows.collect()], rounds)


def _view_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"), whole_text().alias("text"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
    )


class _Scorer:
    """Scores of batches, with the weight of each word kept from text to text."""

    def __init__(self, model: Model, limit: int = 500_000) -> None:
        self.model, self.limit = model, limit
        self.words, self.shapes = {}, {}

    def weight(self, word: str) -> float:
        if len(self.words) >= self.limit:
            self.words.clear()
        found = float(sum(self.model.text.weights[f] for f in word_features(word)))
        self.words[word] = found
        return found

    def text(self, text: str) -> float:
        words, known = text.split(), self.words
        if not words:
            return self.model.text.bias
        for w in set(words).difference(known):
            self.weight(w)
        total = sum(known[w] if w in known else self.weight(w) for w in words) + repeats(words) * self.model.text.weights[0]
        return float(total) / len(words) + self.model.text.bias

    def scores(self, texts: list[str], sources: list[str | None], langs: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        page = []
        for text, source, lang in zip(texts, sources, langs):
            columns, values = self.model.page_row(page_numbers(text), page_places(source, lang))
            page.append(float(self.model.page.weights[columns] @ np.array(values)) + self.model.page.bias)
        return self.model.combine(np.array([self.text(t) for t in texts]), np.array(page))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, text_score, page_score, score, predicted)`` of every document; scores are chances of good quality.

    Null texts count as empty, null sources and languages as values of their
    own. Null and repeated ids are scored row by row; extra columns are ignored;
    an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(held.value)
        for part in slices(batches):
            text, page, both = scorer.scores(*(part.column(c).to_pylist() for c in ("text", "source", "lang")))
            yield record(_id=part.column("_id"), text_score=text, page_score=page, score=both)

    found = arrow_map(_view_columns(docs), work, "_id bigint, text_score double, page_score double, score double")
    return found.select(
        F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id"), "text_score", "page_score", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_poor(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(held.value)
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = scorer.scores(texts, *(part.column(c).cast(pa.string()).to_pylist() for c in ("source", "lang")))[2]
            yield part.filter(pa.array(found >= threshold))

    return arrow_map(docs, work, docs.schema)
