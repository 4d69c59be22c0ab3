"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet into the
folder that ``spark.checkpoint.dir`` names and read again as the next stage's documents; a lost
executor costs at most tasks of the running stage. All but the last return the columns of the
documents they got. Other columns than ``doc_id``, ``text`` and ``n_chars`` pass through unread.

Cases: each row is a document of its own, and stages decide by row (id and text), also for NULL and
repeated ids; NULL, empty and wordless texts are clean, link with nothing and pass all stages, each row
of them; rows that repeat an id and its words are copies of each other, and one of them stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, jaccard, toxicity, windows
from strata.llm.exchange import uncarried, written
from strata.session import checkpoint_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    weights = toxicity.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_documents(docs, weights, carry=docs.columns)
    clean = scored.where(F.col("score") < 0.5)
    return clean.select(*uncarried(clean, docs.columns))


def row_key() -> Column:
    """What tells rows apart: the id and a hash of the whole text. Equal texts get equal verdicts."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))


def drop_rows(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """The rows of docs whose keys are not among ``keys`` (id, text_hash), a written table; with left_semi, those whose keys are."""
    gone = keys.select(F.struct("id", "text_hash").alias(free_name(docs)))
    name = gone.columns[0]
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(f"{name}.id")) & (F.xxhash64("text") == F.col(f"{name}.text_hash")), how)


def free_name(docs: DataFrame) -> str:
    """A column name that docs have not, whatever the case of letters."""
    taken = {c.lower() for c in docs.columns}
    return next(name for k in range(len(taken) + 1) if (name := f"gone{k}") not in taken)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id (NULL ids last, then by the text's hash)."""
    found = jaccard.grouped_rows(docs).where("n_shingles > 0")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    stays = found.groupBy("component").agg(F.min(order).alias("first")).select("component", "first.id", "first.text_hash")
    rows = found.groupBy("id", "text_hash", "component").agg(F.count("*").alias("rows"))
    same = rows["id"].eqNullSafe(stays["id"]) & (rows["text_hash"] == stays["text_hash"])
    rows = rows.join(stays, "component").select(rows["id"], rows["text_hash"], "rows", same.alias("stays"))
    rows = written(rows.where("NOT stays OR rows > 1"))
    left = drop_rows(docs, rows.where("NOT stays"))
    again = rows.where("stays")
    if again.isEmpty():
        return left
    once = drop_rows(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return drop_rows(left, again).unionByName(once)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of 20 words repeat from earlier documents or places; the kept
    words joined by one space."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = windows.drop_repeated_windows(docs, carry=others)
    out = out.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("kept_text").alias("text"), *uncarried(out, others))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    keyed = docs.select(row_key().alias("row"), "text")
    found = decontaminate.contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    return drop_rows(docs, written(found.select("id.id", "id.text_hash").distinct()))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) with their digest and that of the decoded text."""
    coded = bpe.encode_and_decode(docs, bpe.tokenizer_path())
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    folder = f"{checkpoint_root(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
