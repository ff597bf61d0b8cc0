"""Quality scores from gradient-boosted trees over document statistics.

Statistics are counted on the bytes of whole texts. The trees are trained by Spark on all
labelled rows: features are binned once, and each level of a tree is one distributed aggregation of
histograms. The fitted trees become flat arrays, and scoring walks all rows of a batch
down a tree together in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from staylytics.llm.common import column_type, utf8
from staylytics.sources import materialize, scratch_path

FEATURES = (
    "log_bytes log_words log_lines mean_word longest_word letters digits upper spaces stops commas marks pipes wide "
    "distinct_words top_word repeated_lines ended_lines mean_line short_words upper_words marked_words digit_words bigram_top"
).split()

_CLASSES = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "spaces": b" \t\n\r\x0b\x0c",
    "stops": b".!?",
    "commas": b",;:",
    "marks": b"#$%&*+/<=>@[\\]^_`{}~!",
    "pipes": b"|",
}


def text_statistics(text: bytes | None) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; all 0 for a null, empty or blank text."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    shares = [float(counts[list(members)].sum()) / len(text) for members in _CLASSES.values()]
    wide = float(counts[128:].sum()) / len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    often = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        float(sizes.mean()),
        float(sizes.max()),
        *shares,
        wide,
        len(often) / n,
        max(often.values()) / n,
        1.0 - len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines),
        len(text) / len(lines),
        float((sizes <= 2).mean()),
        sum(k for w, k in often.items() if w.isupper()) / n,
        sum(k for w, k in often.items() if w[-1:] in b"#$%&*+/<=>@[\\]^_`{}~!|") / n,
        sum(k for w, k in often.items() if w.isdigit()) / n,
        max(pairs.values()) / (n - 1) if n > 1 else 0.0,
    ]


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, stats array<double>) per row, written once, so training and scoring read texts one time."""
    names = [id_column, *carry]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [text_statistics(x.as_py()) for x in batch.column(len(names))]
            arrays = [*batch.columns[: len(names)], pa.array(stats, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "stats"])

    schema = ", ".join(f"`{n}` {column_type(docs, n)}" for n in names)
    rows = docs.select(*names, utf8(text_column).alias("__text"))
    return materialize(rows.mapInArrow(run, f"{schema}, stats array<double>"), "statistics")


@dataclass
class Trees:
    """Trees as arrays: node ``i`` goes left where ``feature[i]`` is at most ``threshold[i]``; a leaf is its own child."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        margin = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = rows[every, self.feature[at]] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            margin += self.value[at]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def constant(share: float) -> Trees:
    """No trees: every row gets this probability."""
    none = np.zeros(0, dtype=np.int64)
    clipped = min(max(share, 1e-6), 1 - 1e-6)
    return Trees(0.5 * float(np.log(clipped / (1 - clipped))), none, none, np.zeros(0), none, none, np.zeros(0), 0)


def fit(
    stats: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label_column: str = "quality",
    trees: int = 30,
    depth: int = 4,
    bins: int = 64,
    step: float = 0.2,
    seed: int = 11,
) -> Trees:
    """Train on every row of ``stats`` whose id has a label; null labels and null ids teach nothing.

    Several labels of an id count by their mean (0.5 or more is 1). Without labelled rows every score is 0.5; with
    labels of one kind it is near that label.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(id_column).agg((F.avg(F.col(label_column).cast("double")) >= 0.5).cast("double").alias("__label"))
    rows = stats.select(id_column, "stats").join(known, id_column).select(array_to_vector("stats").alias("features"), "__label")
    rows = materialize(rows, "training")
    kinds = {r[0]: r[1] for r in rows.groupBy("__label").agg(F.count("*")).collect()}
    if len(kinds) < 2:
        return constant(next(iter(kinds), 0.5))
    learner = GBTClassifier(labelCol="__label", maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=step, seed=seed)
    return flatten(learner.fit(rows), stats.sparkSession)


def flatten(model: GBTClassificationModel, spark: SparkSession) -> Trees:
    """Arrays of a fitted ensemble, from the node table of its saved form (at most trees x 2^(depth+1) rows)."""
    path = scratch_path(spark, "quality-trees")
    model.write().save(path)
    node = F.col("nodeData")
    saved = spark.read.parquet(f"{path}/data").select(
        "treeID",
        node["id"].alias("id"),
        node["prediction"].alias("value"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
    )
    nodes = sorted(saved.collect(), key=lambda r: (r["treeID"], r["id"]))
    place = {(r["treeID"], r["id"]): i for i, r in enumerate(nodes)}
    weights = model.treeWeights

    def child(r: Row, side: str) -> int:
        return place[r["treeID"], r[side] if r[side] >= 0 else r["id"]]

    return Trees(
        base=0.0,
        roots=np.array([place[t, 0] for t in range(len(weights))]),
        feature=np.array([max(r["feature"], 0) for r in nodes]),
        threshold=np.array([r["threshold"] if r["left"] >= 0 else 0.0 for r in nodes], dtype=np.float64),
        left=np.array([child(r, "left") for r in nodes]),
        right=np.array([child(r, "right") for r in nodes]),
        value=np.array([r["value"] * weights[r["treeID"]] for r in nodes]),
        depth=max(t.depth for t in model.trees),
    )


def score(stats: DataFrame, model: Trees, id_column: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, score) per row; a text without words is scored like any other, by its features of 0."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    names = [id_column, *carry]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(shared.value.scores(rows))], names=[*names, "score"])

    schema = ", ".join(f"`{n}` {column_type(stats, n)}" for n in names)
    return stats.select(*names, "stats").mapInArrow(run, f"{schema}, score double")
