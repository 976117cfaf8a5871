"""The documents' way into a training corpus: toxic ones, copies, repeats and benchmark passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last
return the columns of ``documents``. Scores, repeats and benchmark passages are judged row by row, also of
rows that share a doc_id or have none; rows without a doc_id have no copies, and rows that share one are
one node among the copies, so that they stay or go together.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.llm import byte_bpe, decontaminate, near_duplicates, repeats, toxicity
from rawloom.llm.frames import broadcastable, stored, table, vocabulary

#: Keys that a broadcast may hold; more are joined by a shuffle.
SMALL = 1_000_000
#: Similarity of word shingles, in percent, from which two documents are copies.
SIMILAR = 80


def _without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    gone = stored(gone.select("doc_id").distinct(), label)
    return docs.join(F.broadcast(gone) if broadcastable(gone, SMALL) else gone, "doc_id", "left_anti").select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    lexicon = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.toxicity(docs.select(F.struct(*docs.columns).alias("row"), "text"), lexicon)
    return scored.where("predicted = 0").select("row.*")


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return _without(docs, near_duplicates.near_duplicates(docs, SIMILAR).where("NOT kept"), "copies")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller doc_id has go from the texts."""
    cut = repeats.remove_repeats(docs, texts=True)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words at least a twentieth lies in windows of benchmark items."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = decontaminate.op3_columns(decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), "row"), "row")
    return found.where("NOT contaminated").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of each text, and the digest of what they decode to."""
    return byte_bpe.round_trip(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", copies),
    ("suffix_array_dedup", passages),
    ("decontamination", benchmarks),
    ("byte_bpe", tokens),
]

#: No SQL expresses a learned lexicon or byte-pair merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
