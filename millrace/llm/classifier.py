"""Operator 2: graded quality by ordinal regression over hashed text."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that are used for fitting; those with the smallest hashed ids.
FIT_ROWS = 12_000
#: Hashed features.
BUCKETS = 1 << 18

#: A feature weighs only if its share in one grade is off from its share in all by so many standard errors
#: and by so large an effect (errors per root of the rows); the many words that say nothing about grades then
#: add no noise. Chosen on held-out labels.
ERRORS, EFFECT = 4.0, 0.11

_EDGE = ".,;:!?\"'()[]#*$%&|<>-"
_MARKS = "#*$%&|<>!{}=;@"
#: Shares are cut at these borders; a document has the feature of its step.
_STEPS = (0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _share(name: str, part: int, whole: int) -> int:
    x = part / whole if whole else 0.0
    return _bucket(f"\x00{name}:{sum(x > s for s in _STEPS)}")


def features(text: str | None, known: dict[str, int]) -> np.ndarray:
    """The distinct hashed features of a whole text: its words without their edges' punctuation, in
    lower case, and steps of a few shares (capital words, marks, repeats). ``known`` caches buckets."""
    text = text or ""
    words = text.split()
    found = set()
    if len(known) > 200_000:
        known.clear()
    for w in set(words):
        at = known.get(w)
        if at is None:
            at = known[w] = _bucket(w.lower().strip(_EDGE))
        found.add(at)
    n = len(words)
    lines = text.split("\n")
    found.add(_share("capital", sum(map(str.isupper, words)), n))
    found.add(_share("echo", sum(map(eq, words, words[1:])), n))
    found.add(_share("lines", len(lines) - len(set(lines)), len(lines)))
    for c in _MARKS:
        found.add(_share(c, text.count(c), n))
    return np.fromiter(sorted(found), np.int32, len(found))


@dataclass(frozen=True)
class Ordinal:
    """P(grade >= k) = sigmoid(score - thresholds[k - 1]); one score for all thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: float) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, classes: int, rounds: int = 200, rate: float = 0.3, decay: float = 2e-4) -> Ordinal:
    """Maximum likelihood by full gradient steps with per-weight scaling; thresholds stay ordered
    because their gaps are exponentials. Without labels of two grades all grades are as likely."""
    weights = np.zeros(BUCKETS, np.float32)
    if len(rows) == 0 or len(set(grades.tolist())) < 2:
        return Ordinal(weights, np.arange(classes - 1, dtype=np.float64) - (classes - 2) / 2)
    columns = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, columns = np.unique(columns, return_inverse=True)
    count = np.bincount(columns, minlength=len(used)).astype(float)
    mean = count / len(rows)
    often = np.zeros(len(used), bool)
    for k in range(classes):
        own = int((grades == k).sum())
        if own:
            part = np.bincount(columns[(grades == k)[owner]], minlength=len(used)) / own
            least = max(ERRORS, EFFECT * np.sqrt(len(rows)))
            often |= (np.abs(part - mean) >= least * np.sqrt(mean * (1 - mean) / own + 1e-12)) & (count >= 3)
    telling = often[columns]
    owner, columns, used = owner[telling], np.cumsum(often)[columns[telling]] - 1, used[often]
    share = np.array([(grades >= k).mean() for k in range(1, classes)]).clip(1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    theta = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    # rare grades weigh as much as common ones
    per = np.bincount(grades, minlength=classes)
    weight = (len(grades) / np.maximum(per, 1) / max((per > 0).sum(), 1))[grades]
    w = np.zeros(len(used))
    seen_w, seen_t = np.full(len(used), 1e-8), np.full(classes - 1, 1e-8)
    n = weight.sum()
    for _ in range(rounds):
        cut = np.concatenate([[-1e9], theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:])), [1e9]])
        score = np.bincount(owner, w[columns], len(rows))
        up = 1 / (1 + np.exp(np.clip(cut[grades] - score, -40, 40)))
        down = 1 / (1 + np.exp(np.clip(cut[grades + 1] - score, -40, 40)))
        chance = np.maximum(up - down, 1e-9)
        slope_up, slope_down = up * (1 - up) / chance * weight, down * (1 - down) / chance * weight
        g = np.bincount(columns, (slope_up - slope_down)[owner], len(used)) / n - decay * w
        by_cut = np.array([slope_down[grades == k].sum() - slope_up[grades == k + 1].sum() for k in range(classes - 1)]) / n
        gt = np.concatenate([[by_cut.sum()], [by_cut[i:].sum() * np.exp(theta[i]) for i in range(1, classes - 1)]])
        seen_w += g * g
        seen_t += gt * gt
        w += rate * g / np.sqrt(seen_w)
        theta += rate * gt / np.sqrt(seen_t)
    weights[used] = w
    return Ordinal(weights, np.concatenate([theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:]))]))


def labelled_features(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """``grade`` and hashed ``at`` of at most ``limit`` graded documents, chosen by the hash of the id.

    The chosen labels are at most ``limit`` rows and are broadcast; the texts are read once and
    only the chosen ones become features. Of rows that share an id the least text stands for all,
    so that there are no more rows than labels."""
    chosen = (
        grades.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(limit)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def turn(batches):
        known: dict[str, int] = {}
        for b in batches:
            at = [features(t, known) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"grade": b.column(0).cast(pa.int32()), "at": pa.array([x.tobytes() for x in at], pa.binary())})

    one = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "grade").agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text"))
    return one.select("grade", "_text").mapInArrow(turn, "grade int, at binary")


def train(docs: DataFrame, grades: DataFrame, classes: int, id_col: str = "doc_id", text_col: str = "text", limit: int = FIT_ROWS) -> Ordinal:
    """Fit on at most ``limit`` graded documents; their hashed features, a few kilobytes each, reach the driver."""
    rows = labelled_features(docs, grades, id_col, text_col, limit).collect()
    at = sorted((r.grade, bytes(r["at"])) for r in rows if 0 <= r.grade < classes)
    return fit([np.frombuffer(a, np.int32) for _, a in at], np.array([g for g, _ in at], np.int64), classes)


def select(docs: DataFrame, model: Ordinal, at_least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose chance of the best grade is ``at_least``; a filter beside the scan.

    NULL and empty texts have no features and are judged by the thresholds alone. Rows that repeat are
    judged alike, an empty table stays empty, and other columns may have any name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def turn(batches):
        known: dict[str, int] = {}
        m = shared.value
        for b in batches:
            best = [m.tails(float(m.weights[features(t, known)].sum()))[-1] for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([x >= at_least for x in best], pa.bool_()))

    return docs.mapInArrow(turn, docs.schema)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, ``expected_grade`` and ``tails``, P(grade >= k) for k from 1 up.

    One pass without a shuffle over whole texts; the model is 1 MB, whatever the corpus. NULL and
    empty texts have the features of no words. Rows that repeat stay; an empty table gives an empty
    one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def turn(batches):
        known: dict[str, int] = {}
        m = shared.value
        for b in batches:
            tails = np.array([m.tails(float(m.weights[features(t, known)].sum())) for t in b.column(1).to_pylist()])
            tails = tails.reshape(-1, len(m.thresholds))
            yield pa.RecordBatch.from_pydict(
                {"_id": b.column(0), "expected_grade": tails.sum(1), "tails": pa.array(list(tails), pa.list_(pa.float64()))}
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(turn, f"_id {kind}, expected_grade double, tails array<double>").withColumnRenamed("_id", id_col)


def grade_labels(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 toxic, 1 clean but poor, 2 clean and good. A NULL label gives no grade."""
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.when(F.col("quality") == 1, 2).otherwise(1))
    return labels.select("doc_id", F.when(known, grade).alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, at_least: float = 0.3) -> DataFrame:
    """Scores and the verdict: kept when the chance of the best grade is ``at_least``."""
    model = train(docs, grade_labels(labels), 3)
    scored = score(docs, model)
    return scored.select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("p_clean"), F.col("tails")[1].alias("p_good"), (F.col("tails")[1] >= at_least).alias("kept")
    )
