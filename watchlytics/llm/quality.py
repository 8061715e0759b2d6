"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

``features`` turns each whole text into a fixed number of statistics on log scales, inside map tasks. ``fit``
sums counts, values and products of them per class in one aggregation (some hundred numbers reach the
driver, whatever the size of the data), shrinks each class covariance towards the pooled one and its diagonal, as far as the
numbers of rows and the covariances themselves say, and factors it. ``score`` takes the difference of the Gaussian log densities, each from its cached Cholesky factor: half the
squared Mahalanobis length plus the log of the diagonal.

Labels other than 0 and 1 and labels without a document do not count; a document labelled several times counts as
often. Very long texts are read whole, in time and memory in proportion to their length; an empty table gives no rows;
columns named like the added ones are replaced. Null and empty texts have the statistics of an empty text and get a score like any other. If one class has
no rows, every score is the share of label 1, or 0.5 without labels. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from watchlytics.llm.common import bound_batches, fold_of

#: From this score on a document is predicted to be of quality.
THRESHOLD = 0.7
#: At most about so many labelled documents are fitted by ``train_texts``.
MOST_LABELLED = 40_000
#: Smallest standard deviation a statistic is taken to have.
LEAST_DEVIATION = 0.05

FEATURES = (
    "log_words",
    "upper",
    "marks",
    "bars",
    "shouts",
    "digits",
    "repeats",
    "top_word",
    "distinct",
    "word_length",
    "repeated_lines",
    "marked_words",
    "ended_lines",
    "bytes_a_character",
    "compressed",
)
#: Marks that prose has, besides letters, digits and white space.
PROSE = frozenset(".,;:?'\"-()")
#: A run of marks up to the next white space. It begins where no mark precedes and never gives one back: linear time.
MARKED = re.compile(r"(?<![^\w\s.,;:?!'\")])[^\w\s.,;:?!'\")]{2,}+(?=\s|\Z)")
#: Signs a line of prose ends with.
ENDS = tuple(".!?:;\"'")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``FEATURES``."""
    text = text or ""
    words = text.split()
    n = len(words)
    chars = Counter(text)
    letters = upper = marks = digits = 0
    for c, count in chars.items():
        if c.isalpha():
            letters += count
            if c.isupper():
                upper += count
        elif c.isdigit():
            digits += count
        elif not c.isspace() and c not in PROSE:
            marks += count
    counts = Counter(words)
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    raw = text.encode("utf-8", "replace")

    def share(part: float, whole: float) -> float:
        return math.log((part + 0.5) / (whole + 1.0))

    return [
        math.log1p(n),
        share(upper, letters),
        share(marks, len(text)),
        share(chars["|"], n),
        share(chars["!"], n),
        share(digits, len(text)),
        share(repeats, n),
        share(max(counts.values(), default=0), n),
        share(n - len(counts), n),
        math.log1p(letters / n) if n else 0.0,
        share(len(lines) - len(set(lines)), len(lines)),
        share(len(MARKED.findall(text)), n),
        share(sum(line.rstrip().endswith(ENDS) for line in lines), len(lines)),
        share(len(raw) - len(text), len(text)),
        share(len(zlib.compress(raw, 1)), len(raw)),
    ]


def features(docs: DataFrame, name: str = "features") -> DataFrame:
    """``docs`` without its text, with the array of its statistics."""
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("text", name.lower())]
    given = docs.select(*(F.col(f"`{c}`") for c in kept), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, pa.list_(pa.float64()))], names=[*kept, name])

    return given.mapInArrow(make, docs.select(*(F.col(f"`{c}`") for c in kept)).schema.add(name, ArrayType(DoubleType())))


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, half log determinants and log priors of the two classes."""

    means: np.ndarray
    whiten: np.ndarray
    half_logs: np.ndarray
    log_priors: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            logs.append(self.log_priors[k] - self.half_logs[k] - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def shrinkage(n: float, own: np.ndarray) -> tuple[float, float]:
    """Weights of the pooled covariance and of the diagonal, from a class's rows and covariance alone.

    The pooled covariance weighs as much as the rows it takes to estimate one, a row a parameter. The diagonal weighs what
    oracle-approximating shrinkage gives for the correlations, whose target it is.
    """
    d = len(own)
    parameters = d * (d + 1) / 2
    deviations = np.sqrt(np.maximum(np.diag(own), LEAST_DEVIATION**2))
    squares = float(((own / np.outer(deviations, deviations)) ** 2).sum())
    gap = (n + 1 - 2 / d) * (squares - d)
    diagonal = min(1.0, ((1 - 2 / d) * squares + d * d) / gap) if gap > 0 else 1.0
    return parameters / (n + parameters), diagonal


def discriminant(
    counts: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float | None = None, diagonal: float | None = None
) -> Discriminant:
    """From counts (2), sums (2, d) and sums of products (2, d, d) of the classes; weights not given follow ``shrinkage``."""
    d = sums.shape[1]
    total = counts.sum()
    if not counts.all():
        empty = np.zeros((2, d))
        return Discriminant(empty, np.zeros((2, d, d)), np.zeros(2), np.zeros(2), float(counts[1] / total) if total else 0.5)
    means = sums / counts[:, None]
    scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    common = scatter.sum(axis=0) / total
    whiten, half_logs = [], []
    for k in (0, 1):
        chosen = shrinkage(counts[k], scatter[k] / counts[k])
        toward_all, toward_diagonal = (c if w is None else w for w, c in zip((pooled, diagonal), chosen))
        own = (1 - toward_all) * scatter[k] / counts[k] + toward_all * common
        own = (1 - toward_diagonal) * own + toward_diagonal * np.diag(np.diag(own))
        own += np.eye(d) * LEAST_DEVIATION**2
        factor = np.linalg.cholesky(own)
        whiten.append(np.linalg.inv(factor))
        half_logs.append(np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(whiten), np.array(half_logs), np.log(counts / total))


def fit(labelled: DataFrame, name: str = "features", label: str = "label") -> Discriminant:
    """Fit to rows with an array of statistics and a label; one aggregation with a fixed number of sums."""
    d = len(FEATURES)
    x = [F.col(name)[i] for i in range(d)]
    sums = [F.sum(v) for v in x]
    products = [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    rows = labelled.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count("*").alias("n"), F.array(*sums).alias("s"), F.array(*products).alias("p"))
    counts, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    upper = np.triu_indices(d)
    for k, n, s, p in rows.collect():
        counts[k], first[k] = n, s
        second[k][upper] = p
        second[k] += np.triu(second[k], 1).T
    return discriminant(counts, first, second)


def score(featured: DataFrame, model: Discriminant, name: str = "features", out: str = "score") -> DataFrame:
    """``featured`` with the column ``out``; the statistics go."""
    bound_batches(featured.sparkSession)
    kept = [c for c in featured.columns if c.lower() not in (name.lower(), out.lower())]
    given = featured.select(*(F.col(f"`{c}`") for c in kept), name)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(len(kept)).to_pylist(), dtype=np.float64).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(model.scores(x))], names=[*kept, out])

    return given.mapInArrow(make, featured.select(*(F.col(f"`{c}`") for c in kept)).schema.add(out, "double"))


def learnt_labels(labels: DataFrame) -> DataFrame:
    """``id`` and ``label`` of the rows outside fold 2."""
    wanted = labels.where("quality in (0, 1)").where(fold_of(F.col("doc_id")) != 2)
    return wanted.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))


def train(featured: DataFrame, labels: DataFrame, name: str = "features") -> Discriminant:
    """Fit ``quality`` on the labelled rows of ``featured`` (doc_id and statistics) outside fold 2."""
    rows = featured.select("doc_id", F.col(f"`{name}`").alias("features")).join(learnt_labels(labels), F.col("doc_id") == F.col("id"))
    return fit(rows.select("features", "label"))


def train_texts(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Discriminant:
    """The same from texts, of which only those that are fitted get statistics.

    Up to about ``most`` labelled documents are fitted: all of them, or those whose id a hash picks. The labels picked, one row per
    document and label with its number, are then small enough to go to every task.
    """
    wanted = learnt_labels(labels).groupBy("id", "label").agg(F.count("*").alias("times"))
    n = wanted.count()
    if n > most:
        wanted = wanted.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    picked = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("id")).select("text", "label", "times")
    return fit(features(picked).select("features", "label", F.explode(F.sequence(F.lit(1), "times"))))


def score_texts(docs: DataFrame, model: Discriminant, out: str) -> DataFrame:
    """``docs`` with the score of each text as column ``out``; rows stay where they are."""
    bound_batches(docs.sparkSession)
    text = docs.columns.index("text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(text)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(x))], names=[*batch.schema.names, out])

    return docs.mapInArrow(make, StructType([*docs.schema.fields, StructField(out, DoubleType())]))

