"""A quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import Scratch, as_bytes, kept, spare

LETTERS = bytes(b for b in range(256) if chr(b).isascii() and not chr(b).isalpha())
UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
SIGNS = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b).isspace())
MARKS = bytes(b for b in range(256) if b not in b".,;:!?'\"-")
WORD_END = re.compile(rb"[^\x20\x09-\x0D.,;:!?'\"()\x80-\xffA-Za-z0-9-][\x20\x09-\x0D]")
FEATURES = 15


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a text: logarithms of sizes, log-odds of shares."""
    words, n = text.split(), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    count, kinds = len(words), len(set(words))
    letters, upper = len(text.translate(None, LETTERS)), len(text.translate(None, UPPER))
    signs, marks = text.translate(None, SIGNS), len(text.translate(None, MARKS))
    odd, kind_of_signs = len(signs) - marks, len(set(signs))
    spaces = n - sum(map(len, words))

    def odds(part: float, whole: float) -> float:
        return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))

    log = lambda x: float(np.log1p(x))
    return [
        log(n), log(count), log(n / max(count, 1)), log(count / max(len(lines), 1)), odds(letters, n), odds(upper, letters),
        odds(marks, n), odds(max(odd, 0), n), log(kind_of_signs), odds(kinds, count),
        odds(len(set(lines)), len(lines)), odds(len(WORD_END.findall(text)), count), odds(spaces, n),
        odds(text.count(b". ") + text.count(b".\n"), count), odds(sum(w[:1].islower() for w in words[:1]) + text.count(b" | "), count)]


class Discriminant:
    """Class means and Cholesky factors of shrunken covariances, from sums over rows.

    ``sums[k]`` is the sum of ``(1, x) (1, x)'`` over class k. A class
    covariance is drawn to the pooled one by ``pooled`` and then to a multiple
    of the identity by ``ridge``, on features scaled by the pooled deviations.
    """

    def __init__(self, sums: np.ndarray, pooled: float, ridge: float):
        n = sums[:, 0, 0]
        self.known = bool((n > 0).all())
        if not self.known:
            self.share = float((n[1] + 0.5) / (n.sum() + 1.0))
            return
        self.mean = sums[:, 0, 1:] / n[:, None]
        scatter = sums[:, 1:, 1:] - n[:, None, None] * self.mean[:, :, None] * self.mean[:, None, :]
        common = scatter.sum(axis=0) / n.sum()
        self.scale = np.sqrt(np.maximum(np.diag(common), 1e-9))
        both = np.outer(self.scale, self.scale)
        self.factor, self.offset = [], []
        for k in range(2):
            cov = ((1 - pooled) * scatter[k] / n[k] + pooled * common) / both
            cov = (1 - ridge) * cov + ridge * np.trace(cov) / len(cov) * np.eye(len(cov)) + 1e-9 * np.eye(len(cov))
            lower = np.linalg.cholesky(cov)
            self.factor.append(np.linalg.inv(lower))
            self.offset.append(float(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 from the difference of log densities."""
        if not self.known:
            return np.full(len(x), self.share)
        density = [off - 0.5 * ((((x - m) / self.scale) @ f.T) ** 2).sum(axis=1) for m, f, off in zip(self.mean, self.factor, self.offset)]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   folds: int = 4, held: int = 2, threshold: float = 0.7, pooled: float = 0.75, ridge: float = 0.02) -> DataFrame:
    """The rows of ``df`` with ``held_out``, ``score`` and ``predicted``.

    Rows whose ``crc32(id as text) mod folds`` is ``held`` are held out; class
    moments come from all other rows that have a label of 0 or 1, summed in
    the tasks, so that (features + 1) squared numbers per class reach the driver.
    Only the text enters a score. Labels that are null or of another value are
    not learned from; an id labelled both ways counts for both. A null text
    scores as an empty one. A null id is not held out and never learned from.
    Without rows of both classes every row scores the smoothed share of label 1.
    ``df`` keeps all its columns; those named like an added one are replaced.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    held_out = F.coalesce(fold == held, F.lit(False))
    known = labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("int").alias("_label")).filter(
        "_label in (0, 1)").distinct()
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"), held_out.alias("_held")).filter("not _held")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("quality")
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                x = np.array([[1.0, *statistics(t)] for t in as_bytes(batch.column(1))])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(x.ravel(), FEATURES + 1).cast(pa.list_(pa.float64()))],
                                                 ["id", "x"])

    scratch = Scratch(df.sparkSession)
    measured = rows.select("_id", "_text").withColumn("_id", F.col("_id").cast("string")).mapInArrow(moments, "id string, x array<double>")
    learned = measured.join(known.withColumn("id", F.col("_label_id").cast("string")), "id").select("_label", "x")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FEATURES + 1, FEATURES + 1))
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES + 1)
            for k in range(2):
                own = x[label == k]
                total[k] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

    got = learned.mapInArrow(sums, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(2 * (FEATURES + 1) ** 2)
    for row in got:
        total[row.cell] = row.value
    model = Discriminant(total.reshape(2, FEATURES + 1, FEATURES + 1), pooled, ridge)
    scratch.free()

    def score(batches: Iterator) -> Iterator:
        kept("quality")
        for texts in batches:
            x = np.array([statistics(b"" if t is None else t) for t in texts.to_pylist()]).reshape(-1, FEATURES)
            yield pa.array(model.score(x))

    scored = F.arrow_udf(score, "double", F.ArrowUDFType.SCALAR_ITER)
    name, = spare(df, "_score")
    out = df.withColumn(name, scored(F.col(text_col).cast("binary")))
    return out.withColumns({"held_out": held_out, "score": F.col(name), "predicted": (F.col(name) >= threshold).cast("int")}).drop(name)
