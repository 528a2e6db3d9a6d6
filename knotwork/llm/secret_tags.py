"""Secret scanning: base patterns and a linear-chain conditional random field that adds spans they miss."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import NULL_ID, arrow_map, record, slices, whole_text

# The base patterns, their order and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs that are long enough
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: What a text with any base span must hold, for a vectorised first look.
_MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}"

OUTSIDE, BEGIN, INSIDE = range(3)
FEATURES = 1 << 15
WINDOW = 48  # tokens of a training sequence
WORD_LETTERS = 12
SEEN_LEAST = 3  # times that a word must occur in the training sequences to be a feature by itself
SAMPLE_DOCUMENTS = 20_000
PARTS = 5  # feature vectors of a token: itself, as first, second and third before, as next
_TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
_HEXADECIMAL = re.compile(r"[0-9a-f]+")
_KEYWORD = re.compile(r"password|passwd|secret|token|api|key", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def secret_part(text: str, span: tuple[int, str, int]) -> tuple[int, int]:
    """The secret itself: of an assignment, its value."""
    start, kind, end = span
    if kind == "assign":
        found = _ASSIGN.match(text, start)
        return found.span(2)
    return start, end


def _charset(token: str) -> str:
    if _HEXADECIMAL.fullmatch(token) and not token.isalpha():
        return "digits" if token.isdigit() else "hex"
    if token.isalpha():
        return "upper" if token.isupper() else "letters"
    if token.isalnum():
        return "upper-digits" if token.upper() == token else "mixed"
    return "sign" if len(token) == 1 else "other"


def _word(token: str, words: frozenset[str]) -> str:
    """What stands for a token: the word if training knows it, the sign, or else its character set."""
    if len(token) > WORD_LETTERS:
        return _charset(token)
    word = token.lower()
    return word if word in words or not word.isalpha() else "?"


def own_features(token: str, words: frozenset[str]) -> list[str]:
    """Shape, length, character set and, of short tokens, the word."""
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", re.sub(r"\d", "0", token)))[:8]
    length, charset = min(len(token), 48) // 4, _charset(token)
    digits = sum(map(str.isdigit, token)) * 4 // len(token)
    return [f"s{shape}", f"l{length}", f"c{charset}", f"cl{charset}{length}", f"cd{charset}{digits}", f"p{token[:4] if len(token) >= 16 and not token.isalpha() else ''}", f"w{_word(token, words)}"]


def file_features(text: str) -> list[str]:
    """How much a text looks like settings: signs of assignment, quotes and braces, by magnitude."""
    return [f"f{sign}{min(text.count(sign), 255).bit_length()}" for sign in "=\"{"]


def _place(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % FEATURES


def token_places(token: str, words: frozenset[str]) -> list[list[int]]:
    """Feature numbers a token gives to itself and to its neighbours."""
    word = _word(token, words)
    return [[_place(f) for f in own_features(token, words)], *([_place(f"{side}{word}")] for side in ("b1", "b2", "b3", "n1"))]


@dataclass
class Tagger:
    """Weights of features (feature, tag) and of transitions (tag, tag), and the words that are features."""

    weights: np.ndarray
    transitions: np.ndarray
    words: frozenset[str]

    @property
    def slack(self) -> float:
        """What transitions can add to each token of a secret at most, against staying outside."""
        gain = self.transitions - self.transitions[OUTSIDE, OUTSIDE]
        gain = np.delete(gain.ravel(), 0)
        most = float(gain.max())
        return 2 * most if most > 0 else most

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi path over (token, tag) scores."""
        steps, best = [], scores[0] + self.transitions[OUTSIDE]
        for row in scores[1:]:
            ways = best[:, None] + self.transitions
            steps.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        path = [int(best.argmax())]
        for step in reversed(steps):
            path.append(int(step[path[-1]]))
        return path[::-1]


def training_sequences(text: str, keep_plain: bool, kinds: tuple[str, ...] = KINDS) -> list[tuple[list[str], list[int], list[str]]]:
    """Windows of tokens with tags from the base patterns of some kinds; one plain window if there are none and ``keep_plain``.

    A plain window lies around the token that looks most like a secret, the
    longest that mixes digits with other characters, so that such tokens are learned to be none.
    """
    spans = [secret_part(text, s) for s in base_spans(text) if s[1] in kinds]
    if not spans and not keep_plain:
        return []
    at = [m.span() for m in _TOKEN.finditer(text)]
    if not at:
        return []
    tags = [OUTSIDE] * len(at)
    centres = []
    for start, end in spans:
        inside = [i for i, (s, e) in enumerate(at) if s < end and e > start]
        for i in inside:
            if tags[i] == OUTSIDE:
                tags[i] = BEGIN if i == inside[0] else INSIDE
        centres += inside[:1]
    if not centres:
        mixed = [i for i, (s, e) in enumerate(at) if not text[s:e].isalpha() and any(map(str.isdigit, text[s:e]))]
        centres = [max(mixed, key=lambda i: at[i][1] - at[i][0])] if mixed else [zlib.crc32(text.encode("utf-8", "surrogatepass")) % len(at)]
    centres = centres[:3]
    files, out = file_features(text), []
    for centre in centres:
        first = max(0, centre - WINDOW // 2)
        some = slice(first, first + WINDOW)
        out.append(([text[s:e] for s, e in at[some]], tags[some], files))
    return out


def _varied(tokens: list[str], tags: list[int], chance: random.Random) -> list[str]:
    """The sequence with its secrets rewritten in another alphabet, so that the tagger does not learn one format by heart."""
    alphabet = chance.choice(["0123456789abcdef", "ABCDEFGHJKLMNPQRSTUVWXYZ23456789", "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789"])
    prefix = chance.choice(["", "", "".join(chance.choice("abcdefghijklmnoprstuvwxyz") for _ in range(chance.randint(2, 7))) + chance.choice("_-")])
    return [
        prefix + "".join(chance.choice(alphabet) for _ in range(chance.randint(16, 56))) if tag == BEGIN else token
        for token, tag in zip(tokens, tags)
    ]


def _unnamed(tokens: list[str], tags: list[int], chance: random.Random, ordinary: list[str]) -> list[str]:
    """The sequence with the keywords and signs before its secrets replaced by ordinary words, so that form alone must tell."""
    out = list(tokens)
    for i, tag in enumerate(tags):
        if tag != BEGIN:
            continue
        keep_sign = chance.random() < 0.5
        for j in range(max(0, i - 4), i):
            if tags[j] == OUTSIDE and (_KEYWORD.search(tokens[j]) or tokens[j] in "\"':=" and not keep_sign):
                out[j] = chance.choice(ordinary)
    return out


def fit(sequences: list[tuple[list[str], list[int], list[str]]], rounds: int = 40, rate: float = 0.25, ridge: float = 1e-4) -> Tagger:
    """Maximum likelihood of the tag sequences by gradient steps over all of them; forward and backward run over padded arrays."""
    chance = random.Random(7)
    sequences = sorted(sequences, key=repr)
    held = [(t, y, f) for t, y, f in sequences if BEGIN in y]
    ordinary = sorted({t for tokens, tags, _ in sequences for t, y in zip(tokens, tags) if y == OUTSIDE and t.isalpha() and not _KEYWORD.search(t)}) or ["so"]
    # other alphabets with the keyword, and without it the same and other ones: neither format nor keyword is learned by heart
    sequences += [(_varied(t, y, chance), y, f) for t, y, f in held]
    sequences += [(_unnamed(x, y, chance, ordinary), y, f) for t, y, f in held for x in (t, *(_varied(t, y, chance) for _ in range(3)))]
    n = len(sequences)
    forbidden = np.zeros((3, 3))
    forbidden[OUTSIDE, INSIDE] = -1e4
    weights, transitions = np.zeros((FEATURES, 3)), forbidden.copy()
    seen = Counter(t.lower() for tokens, _, _ in sequences for t in tokens if len(t) <= WORD_LETTERS and t.isalpha())
    words = frozenset(w for w, n_seen in seen.items() if n_seen >= SEEN_LEAST)
    if not any(BEGIN in y for _, y, _ in sequences):
        weights[:, 1:] = -1.0
        return Tagger(weights, transitions, words)
    known: dict[str, list[list[int]]] = {}
    row, place, gold, mask = array("i"), array("i"), np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), bool)
    for s, (tokens, tags, files) in enumerate(sequences):
        places = []
        for token in tokens:
            if token not in known:
                known[token] = token_places(token, words)
            places.append(known[token])
        shared = [_place(f) for f in files]
        for i in range(len(tokens)):
            own = [*places[i][0], *shared]
            for back in (1, 2, 3):
                if i >= back:
                    own += places[i - back][back]
            if i + 1 < len(tokens):
                own += places[i + 1][4]
            row.extend([s * WINDOW + i] * len(own))
            place.extend(own)
        gold[s, : len(tags)], mask[s, : len(tags)] = tags, True
    row, place = (np.frombuffer(x, dtype=np.intc) for x in (row, place))
    hot = np.eye(3)[gold] * mask[:, :, None]
    moves = np.zeros((3, 3))
    np.add.at(moves, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    np.add.at(moves, (np.zeros(n, int), gold[:, 0]), 1)
    squares, t_squares = np.full_like(weights, 1e-6), np.full_like(transitions, 1e-6)
    lengths = mask.sum(axis=1)
    for _ in range(rounds):
        scores = np.stack([np.bincount(row, weights[place, y], n * WINDOW) for y in range(3)], axis=1).reshape(n, WINDOW, 3)
        _, chance_of, pair = marginals(scores, transitions, lengths)
        gradient = np.stack([np.bincount(place, (hot - chance_of)[:, :, y].ravel()[row], FEATURES) for y in range(3)], axis=1) - ridge * n * weights
        expected = pair.sum(axis=(0, 1))
        expected[OUTSIDE] += chance_of[:, 0].sum(axis=0)
        t_gradient = np.where(forbidden < 0, 0.0, moves - expected - ridge * n * transitions)
        squares += gradient**2
        t_squares += t_gradient**2
        weights += rate * gradient / np.sqrt(squares)
        transitions += rate * t_gradient / np.sqrt(t_squares)
    return Tagger(weights, transitions, words)


def marginals(scores: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of padded sequences: log of the sum over all paths, probability of each (place, tag), and of each (place, tag, next tag)."""
    n, most = scores.shape[:2]
    mask = np.arange(most) < lengths[:, None]
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + transitions[OUTSIDE]
    for t in range(1, most):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + transitions, 1) + scores[:, t]
    for t in range(most - 2, -1, -1):
        to = (back[:, t + 1] + scores[:, t + 1])[:, None, :] + transitions
        back[:, t] = np.where((t + 1 < lengths)[:, None], _log_sum(to, 2), 0.0)
    total = _log_sum(ahead[np.arange(n), lengths - 1], 1)
    single = np.exp(np.where(mask[:, :, None], ahead + back - total[:, None, None], -np.inf))
    pair = ahead[:, :-1, :, None] + transitions + (scores[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    return total, single, np.exp(np.where(mask[:, 1:, None, None], pair, -np.inf))


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (np.log(np.exp(values - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Tagger:
    """Fit the tagger on a bounded sample: the documents with the smallest ``sample_documents`` hashes of their ids.

    Each gives at most three windows of 48 tokens around its base spans, one in
    ten of the others gives one plain window; that is all that comes to the driver.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id")).distinct()
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(sample_documents).collect()
    chosen = F.broadcast(spark.createDataFrame([(r["_id"],) for r in ids], "_id bigint"))  # at most sample_documents rows
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"), whole_text().alias("text"))
    texts = texts.join(chosen, "_id", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = []
            for no, text in zip(part.column("_id").to_pylist(), part.column("text").to_pylist()):
                found += training_sequences(text, zlib.crc32(str(no).encode()) % 10 == 0)
            if found:
                tokens, tags, files = zip(*found)
                yield record(
                    tokens=pa.array(tokens, pa.list_(pa.string())), tags=pa.array(tags, pa.list_(pa.int32())),
                    files=pa.array(files, pa.list_(pa.string())),
                )

    rows = arrow_map(texts, work, "tokens array<string>, tags array<int>, files array<string>").distinct()
    rows = rows.orderBy(F.xxhash64("tokens", "files"), "tokens").limit(sample_documents)
    return fit([(list(r["tokens"]), list(r["tags"]), list(r["files"])) for r in rows.collect()])


class _Vectors(dict):
    """Row of each token in a table of summed weights; row 0 is nothing."""

    def __init__(self, tagger: Tagger, limit: int = 200_000) -> None:
        super().__init__()
        self.tagger, self.limit = tagger, limit
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.plain = {}
        self.rows = np.zeros((1024, PARTS, 3), dtype=np.float64)
        self.used = 1

    def __missing__(self, token: str) -> int:
        if token.isalpha() and (len(token) > WORD_LETTERS or token.lower() not in self.tagger.words):
            case = "a" if token.islower() else "Aa" if len(token) > 1 and token[0].isupper() and token[1:].islower() else token.isupper() and "A"
            if case:  # all such words of about one length have the same features
                key = (case, min(len(token), 48) // 4, len(token) > WORD_LETTERS, len(token) == 1)
                if key not in self.plain:
                    self.plain[key] = self.add(token)
                self[token] = self.plain[key]
                return self[token]
        self[token] = self.add(token)
        return self[token]

    def add(self, token: str) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        weights = self.tagger.weights
        self.rows[self.used] = [weights[p].sum(axis=0) for p in token_places(token, self.tagger.words)]
        self.used += 1
        return self.used - 1


def added_spans(texts: list[str], tagger: Tagger, vectors: _Vectors) -> list[list[tuple[int, int]]]:
    """Spans of code points that the tagger marks, for each text.

    A path leaves the outside only where some token gains by it, even with the
    best transitions; texts without such a token need no decoding.
    """
    if len(vectors) > vectors.limit:
        vectors.empty()
    pad = [0, 0, 0]
    codes, bounds = [], []
    for text in texts:
        codes += pad
        start = len(codes)
        codes += map(vectors.__getitem__, _TOKEN.findall(text))
        bounds.append((start, len(codes)))
    code = np.array(codes + pad, dtype=np.int64)
    rows = vectors.rows
    scores = rows[code, 0]
    for back in (1, 2, 3):
        scores[back:] += rows[code[:-back], back]
    scores[:-1] += rows[code[1:], 4]
    slack, out = tagger.slack, []
    gains = scores[:, 1:].max(axis=1) - scores[:, OUTSIDE] + slack
    for text, (start, stop) in zip(texts, bounds):
        found = []
        if stop > start:
            shared = tagger.weights[[_place(f) for f in file_features(text)]].sum(axis=0)
            if gains[start:stop].max() + shared[1:].max() - shared[OUTSIDE] >= 0:
                path = tagger.decode(scores[start:stop] + shared)
                at = [m.span() for m in _TOKEN.finditer(text)] if any(path) else []
                for i, tag in enumerate(path):
                    if tag == BEGIN or tag == INSIDE and not found:
                        found.append(at[i])
                    elif tag == INSIDE:
                        found[-1] = (found[-1][0], at[i][1])
        out.append(found)
    return out


def find(texts: list[str], tagger: Tagger, vectors: _Vectors) -> list[tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]]:
    """(base spans, all spans) of each text; an added span that touches a base span is part of it and not repeated."""
    maybe = pc.match_substring_regex(pa.array(texts, pa.string()), _MAYBE).to_pylist()
    out = []
    for text, look, more in zip(texts, maybe, added_spans(texts, tagger, vectors)):
        base = base_spans(text) if look else []
        new = [(s, "tagged", e) for s, e in more if not any(s < end and e > start for start, _, end in base)]
        out.append((base, sorted(base + new, key=lambda x: (x[0], (*KINDS, "tagged").index(x[1]), x[2]))))
    return out


def as_text(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every whole text.

    Null texts count as empty and have no spans. Null ids, repeated rows and
    texts of any length are scanned like others; extra columns are ignored; an
    empty table gives no rows. Offsets are code points, ends exclusive.
    """
    tagger = tagger or train(docs)
    held = docs.sparkSession.sparkContext.broadcast(tagger)  # fixed size: features x tags

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _Vectors(held.value)
        for part in slices(batches):
            both = find(part.column("text").to_pylist(), held.value, vectors)
            counts = [[sum(s[1] == kind for s in base) for base, _ in both] for kind in KINDS]
            yield record(
                doc_id=part.column("doc_id"), n_assign=pa.array(counts[0], pa.int64()), n_access=pa.array(counts[1], pa.int64()),
                n_hex=pa.array(counts[2], pa.int64()),
                base_sha256=[hashlib.sha256(as_text(base).encode()).hexdigest() for base, _ in both],
                spans=[as_text(spans) for _, spans in both],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return arrow_map(rows, work, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def mask(docs: DataFrame, tagger: Tagger | None = None, sign: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``sign``, and ``n_chars`` counted anew; null texts stay null."""
    tagger = tagger or train(docs)
    held = docs.sparkSession.sparkContext.broadcast(tagger)
    place = {name: i for i, name in enumerate(docs.columns)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _Vectors(held.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            out = []
            for text, (_, spans) in zip(texts, find([t or "" for t in texts], held.value, vectors)):
                at, clean = 0, []
                for start, _, end in spans:
                    if start >= at:
                        clean += [text[at:start], sign]
                    at = max(at, end)
                out.append(text if not spans else "".join(clean) + text[at:])
            part = part.set_column(place["text"], "text", pa.array(out, part.schema.field("text").type))
            if "n_chars" in place:
                old = part.column("n_chars").to_pylist()
                new = [len(t) if t is not None and t != was else n for t, was, n in zip(out, texts, old)]
                part = part.set_column(place["n_chars"], "n_chars", pa.array(new, part.schema.field("n_chars").type))
            yield part

    return arrow_map(docs, work, docs.schema)
