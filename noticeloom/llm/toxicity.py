"""Operator 10, toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is cut into windows of ``WORDS`` words; a
window's distance is the number of bytes it costs with the ordinary dictionary less those it costs with the toxic one. How
many windows lie above the thresholds ``STEPS``, and how far, is calibrated on labelled texts that no dictionary has seen.

Encoding: of every word of letters, lower-cased, each of the first ``STEM`` letters becomes two hashed bytes of the word's
beginning up to it. Two words so share bytes exactly as far as they begin alike: derived and inflected forms meet, and
nothing matches inside a word or is cheaper because its letters are frequent. Plain letters gave an AUC of 0.75 to 0.85.

Training, by zstandard's own dictionary builder and on two thirds of the sample: the words of toxic texts whose beginnings recur there,
and far more often than in ordinary ones, train the toxic dictionary; windows of the other words of ordinary texts train the ordinary
one, whose content also stands behind the toxic one, so that common words cost the same with both. A toxic text is mostly ordinary
words: dictionaries of unfiltered text differ by chance and gave an AUC of 0.7 to 0.8. On the other third, the calibration rows, the size of the toxic dictionary is chosen from ``TOXIC_BYTES``, a logistic regression on the
windows' distances is fitted, and the operating point is set: the least value above which at most ``FALSE_ALARMS`` of the ordinary
calibration texts lie. The score is stretched so that this point is ``THRESHOLD``.

Training sample, as documented parameters: at most ``N_TOXIC`` and ``N_ORDINARY`` labelled ids, chosen by the lowest hash of the id,
one text for each (the least of at most ``TRAIN_CHARS`` characters). Prediction reads every whole text.

Defined results: null and empty texts, and texts without letters, have no window and get the calibration's score for none; without
labels of both kinds every score is the share of toxic labels (0 without labels); a text of any length is coded in pieces of
``PIECE`` characters, cut between words where there is one; equal texts get equal scores, whatever their id, and repeated rows and
rows without an id are scored each for itself; an id labelled both ways counts as toxic; columns other than id and text are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import id_bucket, map_rows, table
from noticeloom.llm.zdict import compressor

STEM, WORDS, LEVEL = 8, 12, 6
N_TOXIC, N_ORDINARY, TRAIN_CHARS = 2000, 4500, 20_000
ORDINARY_BYTES, TOXIC_BYTES = 32 << 10, (2 << 10, 4 << 10, 8 << 10)
#: Lengths in letters of the beginnings by which words are told to recur in toxic texts.
BEGINNINGS, LEAST, RATIO = (3, 4, 5, 6), 3, 4
#: Windows of the ordinary texts that its dictionary is trained on.
TRAIN_WINDOWS = 60_000
#: Distances in bytes from which a window counts.
STEPS = (2, 4, 6)
THRESHOLD, FALSE_ALARMS = 0.7, 0.01
PIECE = 1 << 16
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_ODD = 0x9E3779B97F4A7C15


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoder:
    """Texts as bytes in which words share exactly what they begin with."""

    def __init__(self, stem: int = STEM):
        self.stem = stem
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(PIECE, _ODD, np.uint64)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(PIECE, pow(_ODD, -1, 1 << 64), np.uint64)])

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):
                blank = text.rfind(" ", at, end)
                end = blank if blank > at else end
            yield text[at:end].strip(" ")
            at = end

    def words(self, raw: bytes | None) -> list[bytes]:
        """The code of each word."""
        out: list[bytes] = []
        for s in self._pieces(_NOT_LETTERS.sub(" ", (raw or b"").decode("utf-8", "replace").lower())):
            if not s:
                continue
            letters = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            n, blank = len(letters), letters == 32
            begins = np.flatnonzero(np.append(True, blank[:-1]))
            start = np.repeat(begins, np.diff(np.append(begins, n)))
            sums = np.append(np.uint64(0), np.cumsum(_scramble(letters * np.uint64(_ODD)) * self.up[:n]))
            hashes = _scramble((sums[1:] - sums[start]) * self.down[start])
            keep = ~blank & (np.arange(n) - start < self.stem)
            code = (hashes[keep] >> np.uint64(48)).astype("<u2").tobytes()
            ends = np.append(2 * (np.cumsum(keep) - keep)[begins], len(code)).tolist()
            out += [code[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out


def in_windows(words: list[bytes], n: int = WORDS) -> list[bytes]:
    return [b"".join(words[i : i + n]) for i in range(0, len(words), n)]


@dataclass
class Model:
    """What training gives: two dictionaries, the calibration's mean, scale and weights, and its operating point."""

    ordinary: bytes = b""
    toxic: bytes = b""
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    point: float = THRESHOLD
    prior: float = 0.0

    def start(self) -> tuple:
        return Encoder(), compressor(self.ordinary, LEVEL), compressor(self.toxic, LEVEL)


def distances(windows: list[bytes], ordinary, toxic) -> np.ndarray:
    """Bytes that each window saves with the toxic dictionary."""
    return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows] or [0])


def features(gains: np.ndarray) -> list[float]:
    top, n = np.sort(gains), len(gains)
    over = [int((gains >= s).sum()) for s in STEPS]
    return [top[-1], top[-2:].sum(), np.maximum(gains - 1, 0).sum() / (n + 3), *over, *(k / (n + 3) for k in over), math.log(n)]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 5.0) -> tuple:
    """Weighted logistic regression on standardised features, by Newton's steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    b = np.zeros(a.shape[1])
    penalty = ridge * np.r_[0.0, np.ones(len(b) - 1)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(b)), a.T @ (w * (y - p)) - penalty * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return mean.tolist(), scale.tolist(), b.tolist()


def _probability(x: list[float], model: Model) -> float:
    s = model.weights[0] + sum(w * (f - m) / d for w, f, m, d in zip(model.weights[1:], x, model.mean, model.scale, strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))


def _ranking(p: np.ndarray, y: np.ndarray) -> float:
    """Share of (toxic, ordinary) pairs in the right order."""
    a, b = np.sort(p[y == 0]), p[y == 1]
    return float((np.searchsorted(a, b, "left") + np.searchsorted(a, b, "right")).mean() / (2 * len(a)))


def _point(clean: np.ndarray) -> float:
    """The least value with at most FALSE_ALARMS of the ordinary texts above it; where they are too few to show that share, half way
    from the highest of them to 1."""
    clean, allowed = np.sort(clean), int(FALSE_ALARMS * (len(clean) + 1))
    point = clean[-allowed] + 1e-6 if allowed else (1 + clean[-1]) / 2
    return float(min(max(point, 1e-3), 1 - 1e-3))


def _trained(size: int, samples: list[bytes], segment: int) -> bytes:
    """zstandard's builder; where it finds too little to choose from, the samples' own end."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def recurring(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> set[bytes]:
    """Beginnings of words that stand in ``LEAST`` toxic texts or more, and in a ``RATIO`` times larger share of them than of ordinary ones."""
    begun = lambda texts: Counter(b for ws in texts for b in {w[: 2 * n] for w in ws for n in BEGINNINGS if len(w) >= 2 * n})
    there, here = begun(ordinary), begun(toxic)
    return {b for b, n in here.items() if n >= LEAST and n * len(ordinary) >= RATIO * (there[b] + 0.5) * len(toxic)}


def fit(rows: list[tuple[int, str]], n_toxic: int, n_ordinary: int) -> Model:
    """``rows``: the sample's (label, text); ``n_toxic`` and ``n_ordinary``: how many labels there are in all."""
    prior = n_toxic / max(1, n_toxic + n_ordinary)
    encoder, draw = Encoder(), random.Random(0)
    texts = {k: [encoder.words(t.encode("utf-8", "replace")) for y, t in rows if y == k] for k in (0, 1)}
    for k in texts:
        draw.shuffle(texts[k])
    cut = {k: -(-2 * len(v) // 3) for k, v in texts.items()}
    if any(len(texts[k]) - cut[k] < 1 for k in texts):
        return Model(prior=prior)
    first = {k: v[: cut[k]] for k, v in texts.items()}
    chosen = recurring(first[1], first[0])
    recurs = lambda w: any(w[: 2 * n] in chosen for n in BEGINNINGS)
    # each word once for a text, so that the builder counts texts
    toxic_words = [t for ws in first[1] if len(t := b"".join(sorted({w for w in ws if recurs(w)}))) >= 8] or [bytes(8)]
    samples = [p for ws in first[0] for p in in_windows([w for w in ws if not recurs(w)])]
    draw.shuffle(samples)
    base = _trained(ORDINARY_BYTES, samples[:TRAIN_WINDOWS], 64)
    ordinary = compressor(base, LEVEL)
    rest = [(k, in_windows(ws)) for k in (0, 1) for ws in texts[k][cut[k] :]]
    y = np.array([k for k, _ in rest], float)
    w = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    best, best_rank = Model(prior=prior), -1.0
    for size in TOXIC_BYTES:
        model = Model(base, _trained(size, toxic_words, 16) + base, prior=prior)
        toxic = compressor(model.toxic, LEVEL)
        x = np.array([features(distances(pieces, ordinary, toxic)) for _, pieces in rest], float)
        model.mean, model.scale, model.weights = _logistic(x, y, w)
        p = np.array([_probability(f, model) for f in x.tolist()])
        if (rank := _ranking(p, y)) > best_rank:
            model.point, best, best_rank = _point(p[y == 0]), model, rank
    return best


def train(docs: DataFrame, labels: DataFrame, learn: Column, n_toxic: int = N_TOXIC, n_ordinary: int = N_ORDINARY, train_chars: int = TRAIN_CHARS) -> Model:
    """Fit on the labelled rows for which ``learn`` (of doc_id) holds."""
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    first = lambda kind, n: known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    # of bounded size: n_toxic + n_ordinary ids, the first of each partition meeting in one place
    chosen = first(1, n_toxic).unionByName(first(0, n_ordinary))
    usable = F.col("text").isNotNull() & (F.length("text") <= train_chars)
    # one text for each id before anything is collected, so that repeated rows add nothing
    rows = docs.where(usable).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return fit([(r.toxic, r.text) for r in sorted(rows, key=lambda r: r.doc_id)], counts.get(1, 0), counts.get(0, 0))


def score_text(raw: bytes | None, model: Model, state: tuple) -> tuple[float, int]:
    """Score and prediction of one text."""
    if not model.weights:
        return model.prior, int(model.prior >= THRESHOLD)
    encoder, ordinary, toxic = state
    p = _probability(features(distances(in_windows(encoder.words(raw)), ordinary, toxic)), model)
    # the operating point becomes THRESHOLD, and what is on either side is stretched to it
    s = THRESHOLD * p / model.point if p < model.point else THRESHOLD + (1 - THRESHOLD) * (p - model.point) / (1 - model.point)
    return s, int(s >= THRESHOLD)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, score and predicted of every text: one pass, no shuffle; the model is some 70 KB."""
    return map_rows(docs, "score double, predicted int", lambda raw, state: score_text(raw, model, state), keep=keep, setup=model.start)


def is_held_out() -> Column:
    return F.coalesce(id_bucket(F.col("doc_id"), 3) == 1, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~is_held_out())
    return score(docs, model).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
