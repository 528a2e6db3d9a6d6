"""Toxicity scores from a subsequence string kernel with Nyström landmarks and a linear support vector machine."""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, slices, whole_text

LETTERS = 4  # of a subsequence
SPAN = 7  # characters that a subsequence may stretch over
DECAY = 0.7  # for each character left out
WINDOW = 12  # first letters of subsequences that one score adds up
LANDMARKS = 96  # for each class
SAMPLE_DOCUMENTS = 3000  # for each class
SAMPLE_CHARACTERS = 20_000  # of a document in the training sample
PHRASE = 16
CLEAN_PHRASES = 8_000
CHUNK = 1 << 18
HELD_OUT_OF = 5
FEW_TEXTS = 1500

_OFFSETS = [(c, DECAY ** (c[-1] - LETTERS + 1)) for c in combinations(range(1, SPAN), LETTERS - 1)]
_SENTENCE = re.compile(r"[^.!?\n]+")


@lru_cache(maxsize=1)
def _alphabet() -> np.ndarray:
    """Code of each code point: Latin letters without accents and case 1 to 26, space 27, other letters 28 to 31, the rest 0."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for point in range(0x2000):
        char = chr(point)
        if char.isspace():
            table[point] = 27
        elif char.isalpha():
            plain = unicodedata.normalize("NFKD", "ss" if char == "ß" else char.lower())[0]
            table[point] = ord(plain) - 96 if "a" <= plain <= "z" else 28 + point % 4
    table[0x2C00:0xD800] = 28 + np.arange(0x2C00, 0xD800) % 4
    return table


def codes(text: str) -> np.ndarray:
    return _alphabet()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def _places(code: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each way to leave out characters: the subsequence that begins at each place, as a number, and its weight."""
    n = len(code)
    c = np.concatenate([code, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    first, second, third = c[:n] << 15, c << 10, c << 5
    for (j, k, end), weight in _OFFSETS:
        yield first | second[j : j + n] | third[k : k + n] | c[end : end + n], weight


def _whole(numbers: np.ndarray) -> np.ndarray:
    """Which numbers stand for four real symbols."""
    return ((numbers & 31) > 0) & ((numbers >> 5 & 31) > 0) & ((numbers >> 10 & 31) > 0) & ((numbers >> 15) > 0)


def subsequences(phrase: str) -> tuple[np.ndarray, np.ndarray]:
    """The kernel's features of a short string: gapped subsequences and their decayed counts."""
    numbers, weights = [], []
    for found, weight in _places(codes(phrase)):
        found = found[_whole(found)]
        numbers.append(found)
        weights.append(np.full(len(found), weight))
    numbers, at = np.unique(np.concatenate(numbers), return_inverse=True)
    return numbers, np.bincount(at, np.concatenate(weights), len(numbers))


class Landmarks:
    """Nyström map: kernel values against normalised landmarks, whitened by their own kernel matrix."""

    def __init__(self, phrases: list[str]) -> None:
        features = [subsequences(p) for p in phrases]
        self.numbers = np.unique(np.concatenate([n for n, _ in features]))
        self.table = np.zeros((len(self.numbers), len(phrases)), dtype=np.float32)
        for j, (numbers, counts) in enumerate(features):
            self.table[np.searchsorted(self.numbers, numbers), j] = counts / (np.linalg.norm(counts) or 1.0)
        values, vectors = np.linalg.eigh(self.table.T @ self.table)
        keep = values > 1e-4 * values.max()
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])

    def embed(self, phrases: list[str]) -> np.ndarray:
        out = np.zeros((len(phrases), self.whiten.shape[1]))
        for i, phrase in enumerate(phrases):
            numbers, counts = subsequences(phrase)
            at = np.searchsorted(self.numbers, numbers)
            at[at == len(self.numbers)] = 0
            known = self.numbers[at] == numbers
            if known.any():
                out[i] = (counts[known] @ self.table[at[known]]) @ self.whiten
        return out

    def collapse(self, weights: np.ndarray) -> np.ndarray:
        """A linear function of the map as one weight for each subsequence."""
        table = np.zeros(1 << 20, dtype=np.float32)
        table[self.numbers] = self.table @ (self.whiten @ weights)
        return table


def _support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Squared hinge loss with class weights, by Newton steps over the margin violators."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, ridge = np.zeros(x1.shape[1]), np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        a, s = x1[active], share[active][:, None] * cost
        new = np.linalg.solve(ridge + a.T @ (a * s), a.T @ (s[:, 0] * y[active])) if active.any() else w
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * (w + new) if _ > 10 else new
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Weights of subsequences, and the logistic curve that turns a document's largest score into a probability."""

    table: np.ndarray
    slope: float
    shift: float

    def largest(self, texts: Iterable[str]) -> np.ndarray:
        """The largest window score of each whole text."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(codes(text))
            size += len(held[-1])
            if size >= CHUNK:
                out.append(self._largest(held))
                held, size = [], 0
        if held:
            out.append(self._largest(held))
        return np.concatenate(out) if out else np.zeros(0)

    def _largest(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts lie one after the other with gaps that no window crosses; long texts are taken in overlapping stretches."""
        gap = np.zeros(WINDOW + SPAN, np.uint8)
        stretches, owner = [], []
        for i, text in enumerate(texts):
            for start in range(0, max(len(text), 1), CHUNK):
                stretches += [text[start : start + CHUNK + WINDOW + SPAN], gap]
                owner.append(i)
        lengths = np.array([len(s) for s in stretches])
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1:2]
        code = np.concatenate(stretches)
        at_place = np.zeros(len(code), dtype=np.float32)
        for numbers, weight in _places(code):
            at_place += np.float32(weight) * self.table[numbers]
        sums = np.concatenate([[0.0], np.cumsum(at_place, dtype=np.float64)])
        windows = sums[np.minimum(np.arange(len(code)) + WINDOW, len(code))] - sums[:-1]
        for start, length in zip(starts, lengths[::2]):
            windows[start + length : start + length + len(gap)] = 0.0  # these begin outside the text
        best = np.maximum.reduceat(windows, starts)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, np.array(owner), best)
        return out

    def strongest(self, text: str) -> tuple[float, str]:
        """The largest window score of a text, and the characters it comes from."""
        code = codes(text)
        at_place = sum((np.float32(weight) * self.table[numbers] for numbers, weight in _places(code)), np.zeros(len(code), np.float32))
        sums = np.concatenate([[0.0], np.cumsum(at_place, dtype=np.float64)])
        windows = sums[np.minimum(np.arange(len(code)) + WINDOW, len(code))] - sums[:-1]
        i = int(windows.argmax()) if len(windows) else 0
        return (float(windows[i]) if len(windows) else 0.0), text[i : i + WINDOW + LETTERS]

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.largest(texts) + self.shift, -35, 35)))


def phrases(text: str) -> list[str]:
    """Words of each sentence with the spaces around them."""
    return [f" {w} "[:PHRASE] for sentence in _SENTENCE.findall(text) for w in sentence.lower().split()]


def _gapped(phrase: str, chance: random.Random) -> str:
    """A copy with characters put between letters."""
    sign = chance.choice([".", "-", "*", " ", "_", chance.choice("aeiou"), "1"])
    letters = list(phrase.strip())
    for place in sorted(chance.sample(range(1, len(letters)), min(len(letters) - 1, chance.choice([1, 1, 2]))), reverse=True):
        letters.insert(place, sign)
    return f" {''.join(letters)} "[: PHRASE + 2]


def fit(examples: list[tuple[str, int]]) -> Model:
    """Train on labelled texts, and fit the curve on scores of texts that the machine was not trained on.

    With few texts that is done crosswise, and the machine then learns from all of them.
    """
    examples = sorted(examples)
    chance = random.Random(11)
    chance.shuffle(examples)
    if len({y for _, y in examples}) < 2:  # nothing to tell apart
        return Model(np.zeros(1 << 20, dtype=np.float32), 0.0, -5.0 if not examples or examples[0][1] == 0 else 5.0)
    halves = examples[::2], examples[1::2]
    if any(len({y for _, y in half}) < 2 for half in halves):
        halves = examples, examples
    first = machine(halves[0])
    parts = [(first.largest(t for t, _ in halves[1]), halves[1])]
    if len(examples) < FEW_TEXTS:
        parts.append((machine(halves[1]).largest(t for t, _ in halves[0]), halves[0]))
        first = machine(examples)
    found, y = np.concatenate([f for f, _ in parts]), np.array([y for _, half in parts for _, y in half])
    first.slope, first.shift = _curve(found, y)
    return first


def machine(train: list[tuple[str, int]], rounds: int = 4) -> Model:
    """The support vector machine without its curve.

    A clean text's phrases are all clean. Of a toxic text it is not known which
    phrase is toxic: at first the one that speaks most for the class, then in
    each round the one that the machine scores highest. Gapped copies of the
    toxic phrases are learned too, and the windows of clean texts that score
    worst are added to the clean phrases.
    """
    chance = random.Random(13)
    bags = [(sorted(set(phrases(t))), y) for t, y in train]
    toxic, clean = (Counter(p for bag, y in bags if y == k for p in bag) for k in (1, 0))
    n_toxic, n_clean = (sum(y == k for _, y in bags) for k in (1, 0))

    def speaks(p: str) -> float:
        odds = math.log((toxic[p] + 0.5) / (n_toxic + 1)) - math.log((clean[p] + 0.5) / (n_clean + 1))
        return odds * math.sqrt(toxic[p])

    strong = sorted(toxic, key=lambda p: (-speaks(p), p))[:LANDMARKS]
    common = [p for p, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0]))][:LANDMARKS]
    landmarks = Landmarks(list(dict.fromkeys(strong + common)))
    plain = sorted(clean)
    plain = sorted(set(chance.sample(plain, min(len(plain), CLEAN_PHRASES))) | set(common))
    x_clean = landmarks.embed(plain)
    odds = {p: speaks(p) for p in toxic}
    candidates = sorted(p for p in odds if odds[p] > 0 and not clean[p])
    candidates = sorted(sorted(candidates, key=lambda p: (-odds[p], p))[:CLEAN_PHRASES])
    x_candidates = landmarks.embed(candidates)
    value = np.array([odds[p] for p in candidates])
    number = {p: i for i, p in enumerate(candidates)}
    w, bias = np.zeros(landmarks.whiten.shape[1]), 0.0
    for turn in range(rounds):
        chosen = []
        for bag, y in bags:
            if y and (own := [number[p] for p in bag if p in number]):
                chosen.append(max(own, key=lambda i: (value[i], -i)))
        chosen = sorted(set(chosen))
        bent = landmarks.embed([_gapped(candidates[i], chance) for i in chosen for _ in range(2) if len(candidates[i].strip()) > 3])
        x = np.vstack([x_clean, x_candidates[chosen], bent])
        y = np.concatenate([-np.ones(len(x_clean)), np.ones(len(chosen) + len(bent))])
        w, bias = _support_vector_machine(x, y)
        value = x_candidates @ w + bias
        if turn + 1 < rounds:  # what clean texts look worst
            model = Model(landmarks.collapse(w), 1.0, 0.0)
            found = sorted({model.strongest(t) for t, label in train if not label and t}, reverse=True)
            x_clean = np.vstack([x_clean, landmarks.embed([p for value_of, p in found if value_of + bias > -1])])
    return Model(landmarks.collapse(w), 1.0, 0.0)


def _curve(found: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Logistic regression on one number with Platt's softened targets."""
    spread = found.std() or 1.0
    x = np.stack([(found - found.mean()) / spread, np.ones(len(found))], axis=1)
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * found.mean() / spread)


def held_out(doc_id: Column, of: int = HELD_OUT_OF) -> Column:
    """Documents that no label is learned from; null ids belong to the others."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fifth.

    The ``sample_documents`` labelled ids of each class with the smallest hashes
    are taken, and of these the texts of up to 20,000 characters. Ids with
    several labels count as toxic if one says so; null labels are left out.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = []
    for kind in (0, 1):
        ids += known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_documents).collect()
    chosen = F.broadcast(spark.createDataFrame([tuple(r) for r in ids], "doc_id bigint, toxic int"))  # 2 x sample_documents rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    rows = texts.join(chosen, "doc_id").filter(F.length("text") <= SAMPLE_CHARACTERS).select("text", "toxic").distinct()
    rows = rows.orderBy(F.xxhash64("text"), "text").limit(2 * sample_documents)
    return fit([(r["text"], r["toxic"]) for r in rows.collect()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every whole text; null texts count as empty.

    Only the text is looked at. Null and repeated ids are scored row by row;
    extra columns are ignored; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = held.value.scores(part.column("text").to_pylist())
            yield record(doc_id=part.column("doc_id"), score=pa.array(found, pa.float64()))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    found = arrow_map(rows, work, "doc_id bigint, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = held.value.scores(t or "" for t in part.column("text").to_pylist())
            yield part.filter(pa.array(found < threshold))

    return arrow_map(docs, work, docs.schema)
