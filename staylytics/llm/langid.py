"""Language identification by word-first backoff.

A known word scores its log frequency in each language. An unseen word falls back to
its longest character n-grams that are known, shorter and shorter; its score is the
mean of their log frequencies, one word's worth of evidence. Known words, n-grams
and their counts come from Spark aggregations over a sample of labelled rows whose size
is a parameter, so the model that tasks get has a bounded size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylytics.llm.common import column_type
from staylytics.sources import materialize

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; other numerals that the class lets through are not words."""
    found = _LETTERS.findall((text or "").lower())
    return found if all(map(str.isalpha, found)) else [w for w in found if w.isalpha()]


@dataclass
class Model:
    """Log frequencies by word and by n-gram (one row each, a column per language)."""

    languages: list[str]
    prior: np.ndarray
    word_rows: dict[str, int]
    word_scores: np.ndarray
    gram_rows: dict[str, int]
    gram_scores: np.ndarray
    orders: tuple[int, ...]
    evidence: int
    seen: dict[str, np.ndarray | None] = field(default_factory=dict, repr=False)

    def backoff(self, word: str) -> np.ndarray | None:
        """Mean score of the longest known n-grams of an unseen word; None if not even a letter is known."""
        get = self.gram_rows.get
        for n in self.orders:
            letters = f" {word} " if n > 1 else word
            rows = [r for r in (get(letters[i : i + n]) for i in range(len(letters) - n + 1)) if r is not None]
            if rows:
                return self.gram_scores[rows].mean(axis=0)
        return None

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; ``und`` and 0 without a letter. Ties go to the first language in order."""
        tokens = words(text)
        if not tokens or not self.languages:
            return UNDETERMINED, 0.0
        get = self.word_rows.get
        rows = [get(t, -1) for t in tokens]
        known = np.array(rows)
        known = known[known >= 0]
        total = self.word_scores[known].sum(axis=0, dtype=np.float64)
        if len(known) < len(tokens):
            for t, r in zip(tokens, rows, strict=True):
                if r < 0:
                    if t not in self.seen:
                        if len(self.seen) >= 50_000:
                            self.seen.clear()
                        self.seen[t] = self.backoff(t)
                    if (score := self.seen[t]) is not None:
                        total = total + score
        weight = min(1.0, self.evidence / len(tokens))
        logits = total * weight + self.prior
        best = int(np.argmax(logits))
        return self.languages[best], float(1.0 / np.exp(logits - logits[best]).sum())


def _counts(rows: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """(lang, word, n) of all words of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: Counter[tuple[str, str]]) -> pa.RecordBatch:
            langs, tokens = zip(*found, strict=True) if found else ((), ())
            arrays = [pa.array(langs, pa.string()), pa.array(tokens, pa.string()), pa.array(list(found.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

        found: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                name = lang.as_py()
                for token, n in Counter(words(text.as_py())).items():
                    found[name, token] += n
                if len(found) > 200_000:
                    yield out(found)
                    found = Counter()
        yield out(found)

    parts = rows.select(F.col(lang_column), F.col(text_column)).mapInArrow(run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _scores(rows: list, languages: list[str], totals: dict[str, float], alpha: float) -> tuple[dict[str, int], np.ndarray]:
    index: dict[str, int] = {}
    column = {x: i for i, x in enumerate(languages)}
    for r in rows:
        index.setdefault(r[1], len(index))
    counts = np.zeros((len(index), len(languages)), dtype=np.float32)
    for lang, token, n in rows:
        counts[index[token], column[lang]] += n
    base = np.array([totals.get(x, 0) + alpha * (len(index) + 1) for x in languages], dtype=np.float64)
    return index, np.log((counts + alpha) / base).astype(np.float32)


def fit(
    docs: DataFrame,
    labelled: Column,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
    sample_rows: int = 12_000,
    max_words: int = 100_000,
    max_grams: int = 40_000,
    orders: tuple[int, ...] = (5, 4, 3, 2, 1),
    alpha: float = 0.1,
    evidence: int = 40,
) -> Model:
    """Learn from the rows where ``labelled`` holds and the language is not null.

    ``sample_rows`` bounds the labelled rows used, an equal share for each language: each row is in with
    a probability by the hash of its id, so the number is that bound up to chance and reruns agree.
    ``max_words`` and ``max_grams`` are the size of the model. Each language has an equal part of either, so that none crowds out one of
    shorter texts; what a language cannot fill stays empty. Its most frequent entries come first, ties by code point.
    ``evidence``: words beyond this number are averaged down, so scores of long texts stay below 1.
    """
    rows = docs.where(labelled & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_column).agg(F.count("*")).collect()}
    if not sizes:
        return Model([], np.zeros(0), {}, np.zeros((0, 0)), {}, np.zeros((0, 0)), orders, evidence)
    languages = sorted(sizes)
    share = sample_rows / len(languages)
    chance = F.pmod(F.xxhash64(F.lit("langid"), F.col(id_column)), F.lit(1 << 30)) / float(1 << 30)
    bound = F.lit(1.0)
    for lang in languages:
        bound = F.when(F.col(lang_column) == lang, share / sizes[lang]).otherwise(bound)
    counts = materialize(_counts(rows.where(chance < bound), text_column, lang_column), "words")

    def grams(n: int) -> Column:
        letters = F.concat(F.lit(" "), "word", F.lit(" ")) if n > 1 else F.col("word")
        found = F.transform(F.sequence(F.lit(1), F.length(letters) - n + 1), lambda i: F.substring(letters, i, F.lit(n)))
        return F.when(F.length(letters) >= n, found).otherwise(F.array().cast("array<string>"))

    every = F.concat(*[grams(n) for n in orders])
    parts = counts.select("lang", "n", F.explode(every).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def top(df: DataFrame, token: str, limit: int) -> tuple[list, dict[str, float]]:
        # ranks of a bounded sample; each task hands on no more than a language's part
        first = Window.partitionBy("lang").orderBy(F.desc("n"), token)
        kept = df.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= max(1, limit // len(languages)))
        kept = kept.orderBy(F.desc("n"), "lang", token).select("lang", token, "n")
        totals = {r[0]: float(r[1]) for r in df.groupBy("lang").agg(F.sum("n")).collect()}
        table = kept.toArrow()
        return list(zip(*[c.to_pylist() for c in table.columns], strict=True)), totals

    word_rows, word_scores = _scores(*_with(top(counts, "word", max_words), languages, alpha))
    gram_rows, gram_scores = _scores(*_with(top(materialize(parts, "grams"), "gram", max_grams), languages, alpha))
    prior = np.array([math.log(sizes[x] / sum(sizes.values())) for x in languages])
    return Model(languages, prior, word_rows, word_scores, gram_rows, gram_scores, orders, evidence)


def _with(found: tuple[list, dict[str, float]], languages: list[str], alpha: float) -> tuple:
    return found[0], languages, found[1], alpha


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, lang_pred, score) per row, over whole texts.

    A text that is null or has no letter is ``und`` with score 0, and so is every text under a model
    without languages. Repeated rows are scored each; ties go to the first language by code point.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [id_column, *carry]
    # a carried text goes to the workers once
    at = names.index(text_column) if text_column in names else len(names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(x.as_py()) for x in batch.column(at)]
            arrays = [*batch.columns[: len(names)], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"`{n}` {column_type(docs, n)}" for n in names)
    rows = docs.select(*names, *([] if at < len(names) else [F.col(text_column).alias("__text")]))
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
