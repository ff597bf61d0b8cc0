"""From raw documents to shards: language ID, near-duplicates, decontamination, mixing, sharding.

Each stage gets (spark, docs, sf_dir) and works on every row its predecessor kept. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.llm import decontam, langid, mixing, near_copies, sharding
from staylytics.llm.common import held_out
from staylytics.llm.decontam import few
from staylytics.sources import materialize, scratch_path

#: A document is rejected where no language is likelier than all others together, or where it has no letter.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without an identified language; ``lang`` stays as given, so clean rows come back unchanged."""
    model = langid.fit(docs, ~held_out())
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names that no added column can have
    text = own.columns[docs.columns.index("text")]
    found = langid.identify(own, model, id_column="c0", text_column=text, carry=tuple(own.columns[1:]))
    kept = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*own.columns).toDF(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with the columns ``k`` and ``row``: ``k`` is (no id, id, digest of the text), the same for rows of one id and one text.

    ``k`` is never null; its least value is one with an id where there is one, then the smallest id.
    """
    text = F.coalesce(F.concat(F.lit("+"), F.col("text")), F.lit("-")).cast("binary")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(text).alias("digest"))
    return docs.select(key.alias("k"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def _digest(rows: DataFrame) -> Column:
    """``k`` as one string, as null fields don't join."""
    return F.concat_ws(":", F.coalesce(F.col("k.id").cast("string"), F.lit("-")), F.when(F.col("k.none"), "0").otherwise("1"), F.col("k.digest"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-copies, the one with the smallest id; rows without an id come last.

    Near-copies share 0.8 or more of their five-word shingles; SimHash and MinHash propose them, the exact share decides.
    A decision holds for an id and a text: other texts of an id stand for themselves, and of rows that share both, one stays.
    """
    keyed = _keyed(docs)
    found = near_copies.near_duplicates(keyed.select("k", F.col("row.text").alias("text")), id_column="k")
    found = materialize(found, "groups")
    gone = materialize(found.where("not k <=> component").select(_digest(found).alias("key")).distinct(), "copies")
    again = found.where("k <=> component").groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    again = materialize(again.select(_digest(again).alias("key")), "again")
    rows = keyed.select(_digest(keyed).alias("key"), "row")
    once = rows.join(few(materialize(gone.union(again), "others")), "key", "left_anti").select("row.*")
    return once.union(rows.join(few(again), "key", "left_semi").dropDuplicates(["key"]).select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, with or without an id; other texts of their id stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    rows = keyed.select(_digest(keyed).alias("key"), "row")
    found = decontam.contaminated(rows.select("key", F.col("row.text").alias("text")), benchmark, id_column="key")
    gone = few(materialize(found.select("key").distinct(), "leaks"))
    return rows.join(gone, "key", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a document occurs as often as it is taken, and not at all where it isn't."""
    mixed = mixing.mix(docs).where("taken > 0")
    times = F.expr("sequence(1, cast(taken div size as int))")
    return mixed.select("row", F.explode(times).alias("n")).select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shards", shards),
]

#: Hashes of shingles and a learned language model have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, name)
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    return out
