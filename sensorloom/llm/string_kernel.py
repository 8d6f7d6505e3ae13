"""Toxicity by a support vector machine on a subsequence string kernel.

A text is a stream of letters, digits and one mark between words. Two windows of text are alike by the subsequences of three symbols
that they share; one spread over ``n`` symbols counts DECAY ** n, so gaps and inserted characters weaken a likeness and don't
end it, and subsequences run across words. Landmark windows span the Nyström features on which the machine is trained. A label holds for
a whole text, so the machine is trained in rounds: on the windows of marked texts that look worst to the round before, and on
windows of clean texts. The feature map of a window is a sparse count of subsequences, so machine and landmarks fold into
one weight per subsequence, and scoring a text is a pass of look-ups. A machine for short windows and one for long ones
tell how bad a text's worst window is and how much of the text is guilty, and a line through these gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.blocks import text_or_empty

DECAY = 0.85
# Distances between the three symbols: up to two more between any two of them.
GAPS = tuple((a, b) for a in (1, 2, 3) for b in (1, 2, 3))
_REACH = 6
# Subsequences that begin at so many symbols in a row make a window: a short one for a word, a long one for several.
WINDOWS = (6, 14)
_CLASSES = 64
_MARK = 63
# The length of the feature vector of one symbol's subsequences.
_NORM = float(np.sqrt(sum(DECAY ** (2 * (a + b + 1)) for a, b in GAPS)))


def _classes() -> np.ndarray:
    """Letters a to z and digits have a class each, other letters share 26; white space is the mark, all else is left out (0)."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x80, 0x110000):
        if chr(i).isalnum():
            out[i] = 37 + i % 26
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789"):
        out[ord(c)] = i + 1
    out[[9, 10, 11, 12, 13, 32]] = _MARK
    return out


_CLASS: np.ndarray | None = None


def streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each behind a mark and before a mark and ``_REACH`` zeros, and where each begins (and the last ends).

    Signs are left out, and so is the mark between two lone letters: a spelled-out or dotted word is one word.
    """
    global _CLASS
    if _CLASS is None:
        _CLASS = _classes()
    ends = "\0" * _REACH
    low = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer(ends.join([*low, ""]).encode("utf-32-le", "replace"), np.uint32)
    code = _CLASS[points]
    size = np.array([len(t) + _REACH for t in low], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    # Zeros of a text itself are signs; those put in end it.
    put = np.zeros(len(code), bool)
    for k in range(_REACH):
        put[start[1:] - 1 - k] = True
    kept = (code != 0) | put
    symbols = code[kept]
    begin = np.concatenate([[0], np.cumsum(kept)])[start]
    # Marks in a row are one.
    again = np.zeros(len(symbols), bool)
    again[1:] = (symbols[1:] == _MARK) & (symbols[:-1] == _MARK)
    symbols, begin = symbols[~again], begin - np.concatenate([[0], np.cumsum(again)])[begin]
    letter = (symbols != _MARK) & (symbols != 0)
    lone = letter.copy()
    lone[1:] &= ~letter[:-1]
    lone[:-1] &= ~letter[1:]
    between = np.zeros(len(symbols), bool)
    between[1:-1] = (symbols[1:-1] == _MARK) & lone[:-2] & lone[2:]
    return symbols[~between], begin - np.concatenate([[0], np.cumsum(between)])[begin]


def subsequences(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way of spacing: numbers of the subsequences along the last axis (0 where a text ends), and their weight."""
    n = symbols.shape[-1] - _REACH
    c = symbols.astype(np.int32)
    first = c[..., :n]
    for a, b in GAPS:
        second, third = c[..., a : n + a], c[..., a + b : n + a + b]
        number = (first * _CLASSES + second) * _CLASSES + third
        number[(first == 0) | (second == 0) | (third == 0)] = 0
        yield number, DECAY ** (a + b + 1) / _NORM


def window_values(symbols: np.ndarray, table: np.ndarray, window: int) -> np.ndarray:
    """The decision value, without its offset, of the window at each symbol."""
    value = np.zeros(max(len(symbols) - _REACH, 0))
    for number, weight in subsequences(symbols):
        value += table[number] * weight
    total = np.concatenate([[0.0], np.cumsum(value)])
    upto = np.minimum(np.arange(len(value)) + window, len(value))
    return (total[upto] - total[:-1]) / np.sqrt(window)


@dataclass(frozen=True)
class Machine:
    """A weight per subsequence for windows of one length, and an offset; a window is guilty above 0."""

    window: int
    table: np.ndarray
    offset: float

    def facts(self, symbols: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Per text its worst window's value, and the logarithm of what all its windows are guilty of."""
        f = np.append(window_values(symbols, self.table, self.window), np.full(_REACH, -np.inf)) + self.offset
        f[symbols == 0] = -np.inf
        worst = np.maximum.reduceat(f, begin[:-1])
        return np.stack([worst, np.log1p(np.add.reduceat(np.maximum(f, 0), begin[:-1]) / self.window)], axis=1)


def kernel(windows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Likeness of each window to each landmark; rows are symbols, the last _REACH of them begin nothing."""
    def sparse(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [(number, np.full(number.shape, weight, np.float32)) for number, weight in subsequences(d)]
        number, value = (np.concatenate([p[i] for p in parts], axis=1) for i in (0, 1))
        row = np.broadcast_to(np.arange(len(d))[:, None], number.shape)
        ok = number != 0
        return row[ok], number[ok], value[ok]

    row, number, value = sparse(landmarks)
    used, col = np.unique(number, return_inverse=True)
    base = np.zeros((len(landmarks), len(used)), np.float32)
    np.add.at(base, (row, col), value)
    place = np.full(_CLASSES**3, -1, np.int32)
    place[used] = np.arange(len(used))
    out, norm = [], windows.shape[1] - _REACH
    for i in range(0, len(windows), 500):
        row, number, value = sparse(windows[i : i + 500])
        col = place[number]
        ok = col >= 0
        m = np.zeros((min(500, len(windows) - i), len(used)), np.float32)
        np.add.at(m, (row[ok], col[ok]), value[ok])
        out.append(m @ base.T / norm)
    return np.concatenate(out) if out else np.zeros((0, len(landmarks)), np.float32)


def train_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.concatenate([z, np.ones((len(z), 1), z.dtype)], axis=1)
    del z
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        m = np.maximum(0, 1 - y * (x @ w))
        return float((weight * m * m).sum() + (penalty * w * w).sum())

    for _ in range(steps):
        inside = np.flatnonzero(y * (x @ w) < 1)
        grad, curve = 2 * penalty * w, 2 * np.diag(penalty)
        # Some rows at a time, so that no copy of them all is made.
        for i in range(0, len(inside), 4096):
            part = inside[i : i + 4096]
            a, s = x[part].astype(float), weight[part]
            grad = grad - 2 * (a.T @ (s * (y[part] - a @ w)))
            curve = curve + 2 * (a.T * s) @ a
        step = np.linalg.solve(curve, grad)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Model:
    """The machines, and the line from their facts to the log odds of a text's label."""

    machines: tuple[Machine, ...]
    slopes: np.ndarray
    offset: float

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), float(self.offset))
        at, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if self.machines and (held > 1_000_000 or i == len(texts) - 1):
                out[at : i + 1] += facts(self.machines, *streams(texts[at : i + 1])) @ self.slopes
                at, held = i + 1, 0
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def facts(machines: tuple[Machine, ...], symbols: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.concatenate([m.facts(symbols, begin) for m in machines], axis=1)


_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0x2545F491], np.uint64)


def _weights(rows: list[np.ndarray]) -> np.ndarray:
    """One over the number of near copies: texts that agree in two of their three pairs of smallest hashes of eight symbols."""
    first: dict[tuple, int] = {}
    group = []
    for i, s in enumerate(rows):
        s = s.astype(np.uint64)
        h = np.zeros(max(len(s) - 8, 1), np.uint64)
        for k in range(8):
            h = h * np.uint64(131) + (s[k : len(s) - 8 + k] if len(s) > 8 else np.uint64(i))
        h = (h ^ (h >> np.uint64(31))) & np.uint64(0xFFFFFFFF)
        low = [int(((h * o) % np.uint64(2**31 - 1)).min()) for o in _ODD]
        keys = [(k, low[k], low[k + 1]) for k in (0, 2, 4)]
        seen = [first[k] for k in keys if k in first]
        g = min(seen) if len(seen) >= 2 else i
        for k in keys:
            first.setdefault(k, g)
        group.append(g)
    size = np.bincount(group)
    return 1.0 / size[group]


def _suspicion(rows: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A first guess: how much oftener a subsequence of neighbours is in marked texts than clean ones would have it, as a logarithm."""
    counts, length = np.zeros((2, _CLASSES**3)), np.zeros(2)
    for s, y, w in zip(rows, toxic, weight):
        number, _ = next(subsequences(s))
        found, n = np.unique(number, return_counts=True)
        counts[y, found] += w * np.minimum(n, 3)
        length[y] += w * len(number)
    expected = counts[0] * (length[1] / max(length[0], 1))
    out = np.log((counts[1] + 3) / (expected + 3))
    out[0] = 0
    return out


def _cut(rows: list[np.ndarray], of: list[int], at: list[int], width: int) -> np.ndarray:
    """Windows as rows of ``width`` symbols."""
    out = np.zeros((len(of), width), np.uint8)
    for k, (i, start) in enumerate(zip(of, at)):
        piece = rows[i][start : start + width]
        out[k, : len(piece)] = piece
    return out


def _varied(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Variants with a letter put in at one place or between all symbols, or one left out."""
    n, width = windows.shape
    if not n:
        return windows
    letters = rng.integers(1, 27, (n, width)).astype(np.uint8)
    place = rng.integers(2, width - _REACH - 1, n)[:, None]
    at = np.arange(width)[None, :]
    one = np.where(at < place, windows, np.where(at == place, letters, np.roll(windows, 1, axis=1)))
    every = np.where(at % 2 == 0, windows[:, np.arange(width) // 2], letters)
    less = np.where(at < place, windows, np.roll(windows, -1, axis=1))
    return np.concatenate([one, every, less])


def _spread(windows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` windows, each the least like those before it."""
    some = np.unique(windows, axis=0)
    some = some[rng.permutation(len(some))[:1500]]
    if len(some) <= n:
        return some
    like = kernel(some, some)
    near, picked = like[0].copy(), [0]
    while len(picked) < n:
        k = int(np.argmin(near / np.sqrt(np.maximum(np.diag(like), 1e-9))))
        picked.append(k)
        near = np.maximum(near, like[k])
        near[k] = np.inf
    return some[picked]


def fit(texts: list[str], toxic: list[int], share: float, *, landmarks: int = 320, negatives: int = 8000, rounds: int = 4, seed: int = 3) -> Model:
    """Train on labelled texts. ``share`` is the share of toxic texts among all labelled rows, which the sample need not have.

    Each round takes the worst windows of every marked text (those that the machine finds guilty, at least the worst one) with variants of
    them, and of clean texts the worst windows of all rounds so far and others at random, at most ``negatives``.
    ``landmarks`` windows, three quarters of them guilty ones as unlike each other as can be, span the features. Near copies
    share the weight of one text.
    """
    pairs = list(dict(zip(texts, toxic)).items())
    y = np.array([int(v) for _, v in pairs])
    if not len(y) or y.min() == y.max():
        return Model((), np.zeros(0), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    rows = [streams([t])[0] for t, _ in pairs]
    weight = _weights(rows)
    suspicion = _suspicion(rows, y, weight)
    machines = tuple(_machine(rows, y, weight, suspicion, window, landmarks, negatives, rounds, np.random.default_rng(seed)) for window in WINDOWS)
    x = np.concatenate([facts(machines, s, np.array([0, len(s)])) for s in rows])
    own = weight * np.where(y == 1, share / (weight * y).sum(), (1 - share) / (weight * (1 - y)).sum()) * len(y)
    slopes, offset = _line(x, y, own)
    return Model(machines, slopes, offset)


def _line(x: np.ndarray, y: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps."""
    d = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(d.shape[1]), np.append(np.full(x.shape[1], 0.05), 1e-6)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (own * (p - y)) + ridge * w
        hess = (d.T * (own * p * (1 - p))) @ d + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def _machine(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, table: np.ndarray, window: int, landmarks: int, negatives: int, rounds: int, rng: np.random.Generator) -> Machine:
    clean, marked, width = np.flatnonzero(y == 0), np.flatnonzero(y == 1), window + _REACH
    held, offset = np.empty((0, width), np.uint8), None
    for _ in range(rounds):
        of, at = [], []
        for i in marked:
            value = window_values(rows[i], table, window)
            # Up to three windows apart from each other.
            least = 0.5 * value.max() if offset is None else -offset
            for k in range(3):
                j = int(value.argmax())
                if k and value[j] < least:
                    break
                of.append(i)
                at.append(j)
                value[max(0, j - window) : j + window] = -np.inf
        guilty = _cut(rows, of, at, width)
        hard = _cut(rows, list(clean), [int(window_values(rows[i], table, window).argmax()) for i in clean], width)
        anywhere = rng.choice(clean, negatives // 4)
        by_chance = _cut(rows, list(anywhere), [int(rng.integers(0, max(len(rows[i]) - _REACH, 1))) for i in anywhere], width)
        held = np.unique(np.concatenate([held, hard]), axis=0)
        held = held[rng.permutation(len(held))[: negatives * 3 // 4]]
        variants = _varied(guilty, rng)
        variants = variants[rng.permutation(len(variants))[: 2 * len(guilty)]]
        shown = np.concatenate([_spread(guilty, landmarks * 3 // 4, rng), _spread(np.concatenate([hard, by_chance]), landmarks // 4, rng)])
        value, vector = np.linalg.eigh(kernel(shown, shown).astype(float) + 1e-6 * np.eye(len(shown)))
        root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        z = kernel(np.concatenate([guilty, variants, held, by_chance]), shown) @ root.astype(np.float32)
        sign = np.concatenate([np.ones(len(guilty) + len(variants)), -np.ones(len(held) + len(by_chance))])
        cost = np.concatenate([weight[of], np.full(len(variants), weight[of].mean() / 4), np.ones(len(held) + len(by_chance))])
        for side in (1, -1):
            cost[sign == side] *= 500 / cost[sign == side].sum()
        w, offset = train_svm(z, sign, cost, ridge=0.03)
        table = np.zeros(_CLASSES**3)
        for number, amount in subsequences(shown):
            np.add.at(table, number, np.broadcast_to((root @ w)[:, None] * amount / np.sqrt(window), number.shape))
        table[0] = 0
    return Machine(window, table, offset)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, sample: int = 3000, longest: int = 100_000, **options) -> Model:
    """Fit on at most ``sample`` labelled rows of either label, those with the smallest hashes of their ids, and of texts of at most ``longest`` characters.

    The sample meets in the driver; its ids are bounded, so they are broadcast to the texts.
    Rows whose label is null or no document's are left out. Without toxic labels every text scores the share of toxic rows.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_of"), F.col(label_col).cast("int").alias("_toxic"))
    n = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for value in (0, 1):
        part = known.where(F.col("_toxic") == value).orderBy(F.md5(F.col("_of").cast("string"))).limit(sample)
        picked = part if picked is None else picked.union(part)
    ids = [(r["_of"], r["_toxic"]) for r in picked.collect()]
    small = docs.sparkSession.createDataFrame(ids, picked.schema)
    rows = docs.join(F.broadcast(small), F.col(id_col) == F.col("_of")).select("_of", text_or_empty(text_col).alias("t"), "_toxic").where(F.length("t") <= longest).collect()
    rows = sorted(((r["_of"], r["t"], r["_toxic"]) for r in rows), key=lambda r: r[:2])
    texts, toxic = [r[1] for r in rows], [r[2] for r in rows]
    del rows
    share = n.get(1, 0) / max(sum(n.values()), 1)
    return fit(texts, toxic, share, **options)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``score``, ``predicted``) per row; ``predicted`` is 1 from a score of 0.5 on.

    Null and empty texts score as a text of one mark. Repeated rows score alike. The model, tables of fixed size, goes to every worker once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            s = shared.value.score([t if isinstance(t, str) else "" for t in d["text"]])
            yield pd.DataFrame({"id": d["id"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema).withColumnRenamed("id", id_col)


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def is_clean(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([t if isinstance(t, str) else "" for t in texts]) < 0.5)

    return docs.where(is_clean(text_or_empty(text_col)))
