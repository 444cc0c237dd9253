"""The registered queries of the subpackage: each applies one operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from passerby.llm import alignment, centroids, decontamination, jaccard_join, language, mixing, neighbours, packing, pseudonyms, quality_rules, quality_votes, url_rules, warc
from passerby.llm.rows import table


def op1_prefix_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of_every_twentieth(table(spark, sf_dir, "embeddings"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op3_piece_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonyms(table(spark, sf_dir, "documents"))


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_fragment_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=3, percent=90))


def op7_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op9_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_nearest_label_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op13_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
    return own | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op2_source_mixing": mixing.ORACLE, "op6_fragment_jaccard_join": jaccard_join.ORACLE, "op7_splittable_warc": warc.ORACLE,
            "op11_rotated_centroids": centroids.ORACLE, "op13_wu_manber_decontamination": decontamination.ORACLE}
