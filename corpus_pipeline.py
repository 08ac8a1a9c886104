"""A training-data pipeline: quality, near-duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read
again as the next stage's docs. Decisions take effect: rejected, duplicate and
contaminated documents go, repeated passages leave the text. All stages but the
last return the columns of documents; a text that changes gets its n_chars anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.llm import bpe, decontam, neardup, quality, substring
from sigloom.session import materialise, ship, table


def _packed(docs: DataFrame) -> DataFrame:
    """text, doc_id and n_chars (where docs has it) beside `_row`, all columns but the text; whatever their names are, none clashes with an operator's."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select("text", "doc_id", *[c for c in ("n_chars",) if c in docs.columns], row.alias("_row"))


def _unpacked(out: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    return out.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns], *more)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3. The model learns from the labels of the documents at hand.

    Null and empty texts are scored by their structure, rows without doc_id like all others; of repeated rows all stay or go.
    """
    ship(spark)
    rows = _packed(docs)
    model = quality.fit(rows, table(spark, sf_dir, "labels"))
    return _unpacked(quality.score(rows, model, ["_row"], with_text=True).where("score >= 0.3"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8): the least doc_id, once.

    Rows without words stay. Rows without doc_id stay, equal ones once, unless they are linked to one that has it.
    """
    ship(spark)
    rows = _packed(docs).withColumn("_h", F.xxhash64("text"))
    groups = neardup.group(rows, ["doc_id", "_h"], shingle=5)
    chosen = groups.where("kept or n_shingles = 0 or component_id is null").select(F.col("doc_id").alias("_d"), F.col("_h").alias("_k"), (F.col("n_shingles") > 0).alias("_once")).distinct()
    found = rows.join(materialise(chosen, "kept").hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_k")))
    turn = Window.partitionBy("doc_id", "_h").orderBy("_h")
    first = found.where("_once").withColumn("_n", F.row_number().over(turn)).where("_n = 1").drop("_n")
    return _unpacked(first.unionByName(found.where("not _once")), docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; a text that loses nothing stays as it is."""
    ship(spark)
    out = substring.deduplicate(_packed(docs), ["_row"], with_text=True).withColumnRenamed("kept_text", "text")
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
        out = out.withColumn("_row", F.col("_row").withField("n_chars", n_chars))
    return _unpacked(out, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found. Null and empty texts stay, as do all rows of a repeated one."""
    ship(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the text as decoded from its tokens, and the tokens' number, ids and digests.

    Null texts stay null and have no tokens, as empty ones; repeated rows get a row each.
    """
    ship(spark)
    out = bpe.encode(_packed(docs), ["_row"], ids=True).withColumnRenamed("decoded", "text")
    own = ["n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]
    return _unpacked(out, docs, *[c for c in own if c not in docs.columns])


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("bpe", token_stage),
]

#: Models and sketches can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
