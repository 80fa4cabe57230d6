"""Toxicity by a support vector machine over a subsequence string kernel of sentences, with Nystroem landmarks.

The kernel of two words sums, over common subsequences of three letters, DECAY to the power of the lengths that their
occurrences span, normalised by its value for each word with itself and raised to POWER. Gaps cost a factor, so an
insult with a letter put in, taken out or doubled stays close to it. Letters are told apart by 64 classes: a to z, and
37 for all others by their code. The kernel of two sentences is the sum of the kernels of their distinct words (a
convolution kernel), in lower case and without signs, and of the runs of single letters that spaced-out writing leaves,
joined. Nothing is cut off: every word of any length has its exact value with every landmark.

Landmarks are the words that training documents of label 1 hold most more often than those of label 0. A sentence's map
is the vector of its kernels with the landmarks, whitened by their own kernel matrix (Nystroem); a linear SVM (squared
hinge loss) is fitted to the maps of labelled sentences: of each training document the sentence that is nearest to the
landmarks in all, and PUT_IN times more with one or two letters put into each of its words, at places of their own. As the kernel of a sentence is a sum over its
words, so is its margin, and each distinct word of a batch is held against the landmarks once. A document's margin is
the largest of its sentences'; a logistic calibration makes it a score.

Training uses labelled rows of the training folds. Of these, the SAMPLE rows of each label with the smallest hashes of
their id are taken, a bound that is a parameter. Their words are counted and their maps are made by executors; the
machine and its calibration are fitted on the driver to the maps, LANDMARKS numbers for each of the sentences of a row of
the sample. Each text of the table is scored whole, in one pass without a shuffle; a worker keeps the margins of KEPT
words at most for its next texts.

Defined results: null and empty texts get the score of a text that resembles no landmark; repeated rows are scored
alike; a null label is no label, of several labels of an id the largest counts; without labels of both kinds every
score is 1 if there is label 1 alone, and 0 if there is label 0 alone or none. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import written
from strandline.llm.text import whole

DECAY = 0.8
POWER = 4
LANDMARKS = 64
SAMPLE = 6000
KEPT = 400_000
#: Letters put into each word of a training sentence: once as it stands, three times one letter, twice two.
PUT_IN = (0, 1, 1, 1, 2, 2)
SLACK = 10.0  # of the machine: weight of the loss
LEAST_GAIN = 12.0  # of a landmark: documents of label 1 times the log of its ratio of shares
SHORT = 24  # letters of words whose subsequences are listed one by one; the kernel of longer ones comes from running sums, with the same value
SCORES = "id bigint, held_out boolean, score double"
_LETTERS = re.compile(r"[^\W_]+", re.UNICODE)
_END = re.compile(r"(?<=[.!?…])\s+|\n")
_SPACED = re.compile(r"(?<!\S)[^\w\s]*[^\W_][^\w\s]*(?:\s+[^\w\s]*[^\W_][^\w\s]*(?!\S)){2,}")


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence, as they stand, in lower case; spaced-out writing is one more word."""
    out = []
    for part in _END.split(text.lower()):
        words = part.split()
        if words:
            for run in _SPACED.finditer(part):
                words.append("".join(_LETTERS.findall(run[0])))
            out.append(words)
    return out


def letters(word: str) -> str:
    return word if word.isalnum() else "".join(_LETTERS.findall(word))


def classes(words: list[str]) -> np.ndarray:
    """Letters' classes of words of one length, a row each."""
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)
    return np.where((c >= 97) & (c <= 122), c - 96, 27 + c % 37).astype(np.int32)


def _listed(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the subsequences of a word of this length, and their weights."""
    i, j, k = np.array(list(itertools.combinations(range(length), 3)), np.int64).reshape(-1, 3).T
    return i, j, k, (DECAY ** (k - i + 1)).astype(np.float32)


def running(c: np.ndarray) -> np.ndarray:
    """Weights of all subsequences of one word of any length, [third, first, second] letter."""
    one, two, three = np.zeros(64), np.zeros((64, 64)), np.zeros((64, 64, 64))
    for x in c.tolist():
        one *= DECAY
        two *= DECAY
        three[x] += two
        two[:, x] += one
        one[x] += DECAY
    return three


def self_kernel(c: np.ndarray) -> np.ndarray:
    """Kernel of each row of classes with itself."""
    rows, n = c.shape
    same = (c[:, :, None] == c[:, None, :]).astype(np.float32)
    reach = np.ones((rows, n + 1, n + 1), np.float32)
    for q in (1, 2, 3):
        hit = DECAY * DECAY * same * reach[:, :-1, :-1]
        if q == 3:
            return hit.sum((1, 2))
        reach = np.zeros_like(reach)
        for i in range(1, n + 1):
            along = np.zeros(rows, np.float32)
            for j in range(1, n + 1):
                along = DECAY * along + hit[:, i - 1, j - 1]
                reach[:, i, j] = DECAY * reach[:, i - 1, j] + along
    raise ValueError


class Landmarks:
    """Landmark words, and similarities to them."""

    def __init__(self, words: list[str]):
        self.words = words
        features = [running(classes([w])[0]).ravel() for w in words]
        some = np.flatnonzero(np.logical_or.reduce([f > 0 for f in features]))
        self.table = np.full(64**3, -1, np.int32)
        self.table[some] = np.arange(len(some))
        self.weight = np.stack([f[some] / np.sqrt(f @ f) for f in features], axis=1).astype(np.float32)

    def similarities(self, words: list[str]) -> np.ndarray:
        """Kernels of words with the landmarks, a row each; words of fewer than three letters have none."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, own in by_length.items():
            if n > SHORT:
                for i in own:
                    f = running(classes([words[i]])[0]).ravel()
                    at = np.flatnonzero(f * (self.table >= 0))
                    out[i] = (f[at] / np.sqrt(f @ f)) @ self.weight[self.table[at]]
            elif n > 2:
                listed = _listed(n)
                for k in range(0, len(own), 2048):
                    part = own[k : k + 2048]
                    out[part] = self._short(classes([words[i] for i in part]), *listed)
        return out**POWER

    def _short(self, own: np.ndarray, a, b, c, weight) -> np.ndarray:
        out, some = np.empty((len(own), len(self.words)), np.float32), self.weight.shape[0]
        step = max(1, min(512, 200_000 // len(weight)))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            place = self.table[(part[:, c] << 12) | (part[:, a] << 6) | part[:, b]]
            hit = place >= 0
            flat = (place + (np.arange(len(part), dtype=np.int32) * some)[:, None])[hit]
            out[k : k + step] = np.bincount(flat, np.broadcast_to(weight, hit.shape)[hit], len(part) * some).astype(np.float32).reshape(len(part), some) @ self.weight
        return out / np.sqrt(self_kernel(own))[:, None]


def stretched(word: str, draw: int, times: int) -> str:
    """The word with so many letters put in, which its own hash and the draw choose."""
    for k in range(times):
        h = zlib.crc32(f"{draw} {k} {word}".encode("utf-8", "replace"))
        at = 1 + h % max(1, len(word) - 1)
        word = word[:at] + chr(97 + (h >> 8) % 26) + word[at:]
    return word


def witnesses(texts: list[str], landmarks: Landmarks) -> np.ndarray:
    """For each text the maps of the sentence nearest to the landmarks in all, with the letters of PUT_IN put into each word."""
    each = [[sorted({letters(w) for w in s}) for s in sentences(t)] for t in texts]
    known: dict[str, int] = {}
    for w in itertools.chain.from_iterable(itertools.chain.from_iterable(each)):
        known.setdefault(w, len(known))
    total = landmarks.similarities(list(known)).sum(1)
    best = [sorted(max(own, key=lambda s: float(total[[known[w] for w in s]].sum()))) if own else [] for own in each]
    drawn = {w: k for k, w in enumerate(sorted({w for s in best for w in s}))}
    out = np.zeros((len(texts), len(PUT_IN), len(landmarks.words)), np.float32)
    for draw, times in enumerate(PUT_IN):
        rows = landmarks.similarities([stretched(w, draw, times) for w in drawn])
        for k, own in enumerate(best):
            if own:
                out[k, draw] = rows[[drawn[w] for w in own]].sum(0)
    return out


def string_counts(texts: list[str], labels: np.ndarray) -> dict[str, list[int]]:
    """For each word of three letters and more the numbers of texts with label 0 and with label 1 that hold it."""
    count: dict[str, list[int]] = {}
    for text, label in zip(texts, labels.tolist()):
        for w in {letters(w) for s in sentences(text) for w in s}:
            if len(w) > 2:
                count.setdefault(w, [0, 0])[label] += 1
    return count


def gain(zero, one, n, log=np.log):
    """How much a word tells for label 1: texts that hold it times the log of the ratio of its shares."""
    return one * log((one / n[1]) / ((zero + 0.5) / n[0]))


def telling(count: dict[str, list[int]], n, most: int = LANDMARKS) -> list[str]:
    """Words that tell label 1 from label 0, the most telling first. n: numbers of texts of each label."""
    gains = {s: gain(zero, one, n) for s, (zero, one) in count.items() if one / n[1] > 3 * (zero + 0.5) / n[0]}
    return sorted((s for s, g in gains.items() if g >= LEAST_GAIN), key=lambda s: (-gains[s], s))[:most]


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, classes weighed alike, by accelerated gradient steps."""
    sign = np.where(y == 1, 1.0, -1.0)
    weight = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum()))) * c / len(y)
    z = np.column_stack([x, np.ones(len(x))])
    step = 1 / (1e-3 + 2 * np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2)
    w = v = np.zeros(z.shape[1])
    for k in range(rounds):
        gap = np.maximum(0, 1 - sign * (z @ v))
        new = v - step * (1e-3 * v - 2 * z.T @ (weight * sign * gap))
        v, w = new + k / (k + 3) * (new - w), new
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y over the margin, by Newton steps on smoothed targets."""
    one, zero = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (one + 1) / (one + 2), 1 / (zero + 2))
    z, w = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-6 * np.eye(2)
        w = w - np.linalg.solve(hessian, z.T @ (p - target) + 1e-6 * w)
    return float(w[0]), float(w[1])


class Model:
    """Scores texts between 0 and 1."""

    def __init__(self, words: list[str], prior: float):
        self.prior, self.landmarks = prior, Landmarks(words) if words else None
        self.bare, self.known = {}, {}
        if words:
            own = self.landmarks.similarities(words)
            value, vector = np.linalg.eigh((own + own.T) / 2)
            keep = value > 1e-3 * value.max()
            self.white = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)

    def fit(self, maps: np.ndarray, labels: np.ndarray) -> Model:
        """maps: witnesses of the training texts."""
        x, y = maps.reshape(-1, maps.shape[2]) @ self.white, np.repeat(labels, maps.shape[1])
        w, self.b = fit_svm(x, y, SLACK)
        self.beta = self.white @ w  # a sentence's margin is the sum of beta over its words' kernels with the landmarks
        self.slope, self.offset = calibrate(x @ w + self.b, y)
        return self

    @classmethod
    def of(cls, texts: list[str], labels: np.ndarray) -> Model:
        """Fitted to a few texts, without Spark."""
        words = telling(string_counts(texts, labels), np.bincount(labels, minlength=2))
        out = cls(words, float(labels.mean()))
        return out.fit(witnesses(texts, out.landmarks), labels) if words else out

    def _learn(self, words: set[str]) -> None:
        """Notes the letters of words as they stand, and the margins of these."""
        if len(self.bare) > KEPT:
            self.bare, self.known = {}, {}
        if new := [w for w in words if w not in self.bare]:
            self.bare.update(zip(new, map(letters, new)))
            distinct = sorted({self.bare[w] for w in new} - self.known.keys())
            self.known.update(zip(distinct, (self.landmarks.similarities(distinct) @ self.beta).tolist()))

    def margins(self, texts: list[str]) -> np.ndarray:
        each = [sentences(t) for t in texts]
        self._learn(set().union(*itertools.chain.from_iterable(each)))
        bare, known = self.bare.__getitem__, self.known.__getitem__
        return np.array([max((math.fsum(map(known, set(map(bare, s)))) for s in own), default=0.0) for own in each]) + self.b

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.landmarks is None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def _fold(id_col: str, folds: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def _by_text(schema_names, make):
    """A mapInArrow function over rows of (label, text), some hundred at a time."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.record_batch(make(part.column("text").to_pylist(), part.column("label").to_numpy()), schema_names)

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int, sample: int = SAMPLE) -> Model:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")).where(_fold("id", folds) != held)
    order = F.xxhash64(F.lit(17), "id")
    chosen = known.where("label = 1").orderBy(order, "id").limit(sample).union(known.where("label = 0").orderBy(order, "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(F.broadcast(chosen), "id")  # 2 * sample rows at most
    texts = written(texts.groupBy("label", F.md5("text").alias("copy")).agg(F.min("text").alias("text")).repartition(32, "copy"), "toxicity-sample").select("label", "text")  # copies count once
    n = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = (n.get(0, 0), n.get(1, 0))
    if not all(n):
        return Model([], float(n[1] > 0))

    def counted(batch_texts, batch_labels):
        count = string_counts(batch_texts, batch_labels)
        return [pa.array(list(count), pa.string()), pa.array([c[0] for c in count.values()], pa.int64()), pa.array([c[1] for c in count.values()], pa.int64())]

    counts = texts.mapInArrow(_by_text(["s", "zero", "one"], counted), "s string, zero bigint, one bigint").groupBy("s").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    told = counts.withColumn("gain", gain(F.col("zero"), F.col("one"), n, F.ln)).where((F.col("one") / n[1] > 3 * (F.col("zero") + 0.5) / n[0]) & (F.col("gain") >= LEAST_GAIN))
    model = Model([r["s"] for r in told.orderBy(F.desc("gain"), "s").limit(LANDMARKS).collect()], n[1] / sum(n))
    if model.landmarks is None:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def mapped(batch_texts, batch_labels):
        return [pa.array(batch_labels), pa.array([m.tobytes() for m in witnesses(batch_texts, shared.value.landmarks)], pa.binary())]

    rows = texts.mapInArrow(_by_text(["label", "map"], mapped), "label int, map binary").collect()  # 2 * sample rows of len(PUT_IN) * LANDMARKS numbers at most
    rows = sorted((r["label"], bytes(r["map"])) for r in rows)  # the order of tasks does not show in the sums
    return model.fit(np.stack([np.frombuffer(m, np.float32).reshape(len(PUT_IN), -1) for _, m in rows]), np.array([y for y, _ in rows], np.int64))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 4, held: int = 2) -> DataFrame:
    """Per row of docs: id, held_out (its crc32 modulo folds is held), score."""
    model = train(docs, labels, id_col, text_col, label_col, folds, held)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield pa.record_batch([part.column("id"), part.column("held_out"), pa.array(shared.value.scores(part.column("text").to_pylist()).astype(float))], ["id", "held_out", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), (_fold(id_col, folds) == held).alias("held_out"), whole(text_col).alias("text"))
    return slim.mapInArrow(score, SCORES).withColumnRenamed("id", id_col)
