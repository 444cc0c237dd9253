"""A corpus made ready for training, stage by stage; each stage's rows are written as Parquet and read by the next.

1. language: each text's language is found; texts without one go.
2. near_copies: of texts that share four fifths of their five-word shingles, directly or over others, one stays.
3. private_data: personal data is replaced by pseudonyms.
4. mixture: the documents of each source are repeated or left out towards the sources' target weights.
5. sequences: what is left is cut and packed into training sequences.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.llm import jaccard_join, language, mixing, packing, pseudonyms
from passerby.llm.rows import carry, put_down
from passerby.session import run_folder

#: A text whose best language has less than this share of the likelihoods has no language.
LEAST_SHARE = 0.5


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that have a language, with it as their ``lang``; null texts and texts without a letter go."""
    needed = ("doc_id", "text", "lang")
    found = language.identify(carry(docs, *needed), language.learn(docs))
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return put_down(kept.withColumn("lang", F.col("lang_pred")), docs, *needed)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return jaccard_join.one_of_each(docs, jaccard_join.Rule(words=5, percent=80))


def hide_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text."""
    needed = ("text", *(["n_chars"] if "n_chars" in docs.columns else []))
    hidden = pseudonyms.pseudonymise(carry(docs, *needed))
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return put_down(hidden, docs, *needed)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the sequences they lie in."""
    return packing.pack(docs)


STAGES = [
    ("language", find_language),
    ("near_copies", drop_near_copies),
    ("private_data", hide_private_data),
    ("mixture", mix_sources),
    ("sequences", pack_sequences),
]

#: SQL cannot express the likelihoods, the keyed permutations or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents to the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = run_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
