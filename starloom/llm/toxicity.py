"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks (operator 7).

The kernel of two words counts their common subsequences of `ORDER` bytes; a subsequence counts less the wider
it is spread (`DECAY` for each byte of its span), so a word with inserted characters or gaps still resembles
the plain one. It is scaled to 1 for the landmark itself and never exceeds 1. A text meets a landmark as well as its best word does:
the kernel map of a text is the vector of these maxima over the landmark words, turned by the inverse root of
the landmarks' own kernel matrix (Nyström), and a linear machine with squared hinge loss is trained on it.

Landmarks are words of labelled toxic texts, chosen from the training rows. A word is held against a landmark
only if it has all but one of the landmark's distinct bytes; similarities under `FLOOR` count as none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import LOWER, give_back, hashes, lean, text_slices, words

ORDER = 3
DECAY = 0.75
FLOOR = 0.4
OWN_SHARE = 0.3  # how much a word's own kernel counts in the scaling; less forgives more inserted characters
LONGEST = 48  # longer words are read in overlapping pieces
PIECE_STEP = 24
LANDMARK_BYTES = 24
MOST_KNOWN = 1_000_000  # words whose similarities a worker remembers; more are computed again
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def subsequence_kernel(s: np.ndarray, s_len: np.ndarray, t: np.ndarray, t_len: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """The gap-weighted kernel of s[i] and t[i], for rows of bytes padded with zeros.

    The usual recursion over prefixes, for all rows at once: `before` holds, for each pair of prefixes, the
    common subsequences of one byte less, each weighted by its distance to the ends of both prefixes.
    """
    rows, n = s.shape
    m = t.shape[1]
    decay = np.float32(decay)
    square = decay * decay
    s, t = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)
    t_in = np.arange(m)[:, None] < t_len[None, :]
    s_in = np.arange(n)[:, None] < s_len[None, :]
    before = np.ones((n + 1, m + 1, rows), np.float32)
    total = np.zeros(rows, np.float32)
    for p in range(1, order + 1):
        last = p == order
        now = before if last else np.zeros((n + 1, m + 1, rows), np.float32)
        for a in range(n):
            equal = before[a, :m] * ((s[a][None, :] == t) & t_in & s_in[a][None, :])
            if last:
                total += equal.sum(0)
                continue
            equal *= square
            run = np.zeros(rows, np.float32)
            for b in range(m):
                run *= decay
                run += equal[b]
                np.multiply(now[a, b + 1], decay, out=now[a + 1, b + 1])
                now[a + 1, b + 1] += run
        before = now
    return total * square


def _masks(b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The set of a word's bytes as 64 bits (bytes modulo 64)."""
    bits = np.where(np.arange(b.shape[1])[None, :] < length[:, None], np.uint64(1) << (b & 63).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1) if b.shape[1] else np.zeros(len(b), np.uint64)


def _count(x: np.ndarray) -> np.ndarray:
    return sum(_POPCOUNT[(x >> np.uint64(k)).astype(np.uint16)] for k in (0, 16, 32, 48))


def padded(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(x) for x in items], np.int64)
    out = np.zeros((len(items), int(length.max()) if len(items) else 0), np.uint8)
    for i, x in enumerate(items):
        out[i, : len(x)] = np.frombuffer(x, np.uint8)
    return out, length


class Landmarks:
    """Words to hold other words against."""

    def __init__(self, items: list[bytes]):
        self.items = items
        self.bytes, self.length = padded(items)
        self.masks = _masks(self.bytes, self.length)
        self.need = _count(self.masks).astype(np.int16) - 1
        self.own = subsequence_kernel(self.bytes, self.length, self.bytes, self.length)

    def similar(self, b: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, similarity) wherever the similarity is above FLOOR."""
        found = []
        masks = _masks(b, length)
        for lo in range(0, len(b), 8192):
            part = masks[lo : lo + 8192]
            for j in range(len(self.items)):
                i = np.flatnonzero(_count(part & self.masks[j]) >= self.need[j])
                if len(i):
                    found.append((i + lo, np.full(len(i), j)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        out = np.zeros(len(i), np.float32)
        width = -(-length[i] // 8) * 8  # pairs of about one width together
        for w in np.unique(width):
            for at in np.array_split(np.flatnonzero(width == w), -(-int((width == w).sum()) // 2048)):
                s, n, t, m = b[i[at], :w], length[i[at]], self.bytes[j[at]], self.length[j[at]]
                s = np.pad(s, ((0, 0), (0, max(0, w - s.shape[1]))))
                norm = subsequence_kernel(s, n, s, n) ** OWN_SHARE * self.own[j[at]] ** (1 - OWN_SHARE)
                out[at] = np.minimum(subsequence_kernel(s, n, t, m) / np.maximum(norm, 1e-12), 1)
        on = out > FLOOR
        return i[on], j[on], out[on]


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in lower case, those over LONGEST bytes as overlapping pieces: starts, ends, rows."""
    start, end, row = words(data, offsets)
    long = np.flatnonzero(end - start > LONGEST)
    if not len(long):
        return start, end, row
    more = [(np.arange(start[k], end[k] - LONGEST + PIECE_STEP, PIECE_STEP), end[k], row[k]) for k in long]
    s = np.concatenate([x[0] for x in more])
    e = np.concatenate([np.minimum(x[0] + LONGEST, x[1]) for x in more])
    r = np.concatenate([np.full(len(x[0]), x[2]) for x in more])
    rest = np.setdiff1d(np.arange(len(start)), long)
    s, e, r = np.append(start[rest], s), np.append(end[rest], e), np.append(row[rest], r)
    order = np.argsort(s, kind="stable")
    return s[order], e[order], r[order]


class TextMap:
    """The best similarity of each text's words to each landmark; remembers the words it has seen."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.forget()

    def forget(self) -> None:
        self.seen = np.zeros(0, np.uint64)  # hashes of seen words, sorted
        self.hot = np.zeros(0, np.uint64)  # of those that resemble a landmark, sorted
        self.first = np.zeros(1, np.int64)  # where the similarities of each begin
        self.which = np.zeros(0, np.int64)
        self.value = np.zeros(0, np.float32)

    def _learn(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(self.seen) + len(h) > MOST_KNOWN:
            self.forget()
        self.seen = np.sort(np.append(self.seen, h), kind="stable")
        for part in np.array_split(np.argsort(end - start, kind="stable"), -(-len(h) // 8192)):
            length = (end - start)[part]
            width = int(length.max())
            at = start[part][:, None] + np.arange(width)[None, :]
            b = np.where(np.arange(width)[None, :] < length[:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
            i, j, v = self.landmarks.similar(b, length)
            if not len(i):
                continue
            owner = np.append(np.repeat(self.hot, np.diff(self.first)), h[part][i])
            by = np.argsort(owner, kind="stable")
            self.which, self.value = np.append(self.which, j)[by], np.append(self.value, v)[by]
            self.hot, counts = np.unique(owner, return_counts=True)
            self.first = np.append(0, np.cumsum(counts))

    def __call__(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), len(self.landmarks.items)), np.float32)
        for first, data, offsets in text_slices(column):
            data = LOWER[data]
            start, end, row = pieces(data, offsets)
            if not len(start):
                continue
            h = hashes(data, start, end)
            order = np.argsort(h)
            unique = np.append(True, h[order][1:] != h[order][:-1])
            one = order[unique]
            new = one if not len(self.seen) else one[self.seen[np.minimum(np.searchsorted(self.seen, h[one]), len(self.seen) - 1)] != h[one]]
            if len(self.seen) + len(new) > MOST_KNOWN:
                self.forget()
                new = one
            if len(new):
                self._learn(h[new], data, start[new], end[new])
            if not len(self.hot):
                continue
            at = np.minimum(np.searchsorted(self.hot, h[one]), len(self.hot) - 1)
            is_hot = self.hot[at] == h[one]
            group = np.cumsum(unique) - 1  # of each word in hash order
            on = is_hot[group]
            w, r = at[group[on]], row[order[on]] + first
            n = np.diff(self.first)[w]
            pos = np.repeat(self.first[w] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            np.maximum.at(out, (np.repeat(r, n), self.which[pos]), self.value[pos])
        return out


@dataclass
class Model:
    landmarks: list[bytes]
    turn: np.ndarray  # landmark kernel to the power -1/2
    weights: np.ndarray
    bias: float
    slope: float

    def margin(self, k: np.ndarray) -> np.ndarray:
        return k @ (self.turn @ self.weights) + self.bias

    def probability(self, k: np.ndarray) -> np.ndarray:
        """0.5 at the separating plane, growing with the margin."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(k), -50, 50)))


def choose_landmarks(columns: list[pa.Array], toxic: np.ndarray, most: int) -> list[bytes]:
    """Words of toxic rows with the largest signed root of the likelihood ratio; of equals the smaller in byte order."""
    seen: dict[int, bytes] = {}
    sets, row0 = [], 0
    for column in columns:
        for first, data, offsets in text_slices(column):
            data = LOWER[data]
            start, end, row = words(data, offsets)
            fit = (end - start >= 4) & (end - start <= LANDMARK_BYTES)
            start, end, row = start[fit], end[fit], row[fit]
            h = hashes(data, start, end)
            _, one = np.unique(np.stack([h, row.astype(np.uint64)]), axis=1, return_index=True)
            bad = one[toxic[row0 + first + row[one]]]
            for k in bad:
                if int(h[k]) not in seen:
                    seen[int(h[k])] = data[start[k] : end[k]].tobytes()
            sets.append((h[one], toxic[row0 + first + row[one]]))
        row0 += len(column)
    if not sets:
        return []
    h, bad = (np.concatenate(x) for x in zip(*sets, strict=True))
    if not len(h):
        return []
    order = np.argsort(h)
    h, bad = h[order], bad[order]
    edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    unique = h[edge]
    a = np.add.reduceat(bad, edge, dtype=np.int64).astype(float)
    b = np.diff(np.append(edge, len(h))) - a
    n1, n0 = float(toxic.sum()), float((~toxic).sum())
    share = (a + b) / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(a > 0, a * np.log(a / (n1 * share)), 0) + np.where(b > 0, b * np.log(b / (n0 * share)), 0)
    gain = np.where((a / n1 > b / max(n0, 1)) & (a >= 2), gain, 0)
    scored = sorted((-gain[k], seen[int(unique[k])]) for k in np.argsort(-gain)[: 4 * most] if gain[k] > 2)
    return [w for _, w in scored[:most]]


def train_svm(phi: np.ndarray, y: np.ndarray, cost: float = 0.5, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps; the rarer class weighs more, by the ratio of their sizes."""
    x = np.hstack([phi, np.ones((len(phi), 1))])
    c = np.where(y > 0, cost * (y < 0).sum() / max((y > 0).sum(), 1), cost)
    keep = np.eye(x.shape[1])
    keep[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ w) < 1
        new = np.linalg.solve(keep + (x[on] * c[on, None]).T @ x[on], (x[on] * c[on, None]).T @ y[on])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def fit(texts: list[str | None], toxic: list[int], most_landmarks: int = 128) -> Model:
    """Train on labelled texts. With one class only, or no word that tells them apart, every score is that class's side."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", toxic[i]))
    bad = np.array([toxic[i] == 1 for i in order], bool)
    columns = [pa.array([texts[i] for i in order[k : k + 2000]], pa.large_string()) for k in range(0, len(order), 2000)]
    items = choose_landmarks(columns, bad, most_landmarks) if bad.any() and (~bad).any() else []
    if not items:
        side = 1.0 if len(bad) and bad.mean() > 0.5 else -1.0
        return Model([], np.zeros((0, 0)), np.zeros(0), side, 2.0)
    marks = Landmarks(items)
    text_map = TextMap(marks)
    k = np.vstack([text_map(c) for c in columns]).astype(float)
    own = np.zeros((len(items), len(items)))
    i, j, v = marks.similar(marks.bytes, marks.length)
    own[i, j] = v
    own = (own + own.T) / 2
    np.fill_diagonal(own, 1.0)
    value, vector = np.linalg.eigh(own)
    turn = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    weights, bias = train_svm(k @ turn, np.where(bad, 1.0, -1.0))
    return Model(items, turn, weights, bias, 2.0)


def fit_frame(labelled: DataFrame, text_col: str, label_col: str, most_rows: int = 8_000, **options) -> Model:
    """Train on at most `most_rows` rows with a label (0 or 1), those with the smallest hash of the text.

    The bound is on the training sample only; every text is scored. Rows without a label are left out.
    """
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("label")
    )
    n = rows.count()
    if n > most_rows:  # a share by hash, so that no task sorts the texts
        share = most_rows / n
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = rows.toArrow()
    texts, toxic = found["text"].to_pylist(), found["label"].to_pylist()
    del found  # else the sample is held twice during the fit
    try:
        return fit(texts, toxic, **options)
    finally:  # the driver goes on, without the sample
        del texts, toxic
        give_back()


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of `df` and `score_col`, a double between 0 and 1. Nulls count as empty, which is scored too.

    Raises ValueError if the name is taken.
    """
    if score_col in df.columns:
        raise ValueError(f"column {score_col} is in the frame already")
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most most_landmarks words and numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_map = TextMap(Landmarks(shared.value.landmarks)) if shared.value.landmarks else None
        for batch in batches:
            column = batch.column(names.index(text_col))
            k = text_map(column) if text_map else np.zeros((len(column), 0), np.float32)
            p = shared.value.probability(k.astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*names, score_col])

    return df.mapInArrow(lambda batches: lean(run(batches)), T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())]))
