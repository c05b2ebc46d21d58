"""Documents to training tokens: toxic ones go, one of each near-duplicate group stays, sources
are mixed to target weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.  All but
the last return the columns of ``docs``, whatever others they have besides ``doc_id``, ``text``
and ``source``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedarb.llm import byte_bpe, mixing, near_copies, toxicity
from feedarb.llm.shared import bounded_batches, table, word_count
from feedarb.plans.storage import durable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 stay; the labels of the held-out fifth are not learned from.

    Null and empty texts have the score of no words; without labels all documents stay.
    """
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    return docs.where(toxicity.scored(docs, toxicity.fit(docs, labels)) < 0.5)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id stays of each group, once if its row comes twice.

    Near duplicates have SimHash fingerprints within two bits, as in ``op3_simhash``; or, where
    fingerprints leave them apart, a five-word Jaccard similarity of 0.8 or more, see
    ``llm/near_copies.py``.
    Documents without an id cannot be told apart from each other and stay as they are.
    """
    bounded_batches(spark)
    groups = near_copies.near_copies(docs.where("doc_id is not null"), distance=2)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    known = docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return known.unionByName(docs.where("doc_id is null"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them: not at all, once or twice."""
    bounded_batches(spark)
    sizes = durable(mixing.sized(docs), "sizes")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        word_count(F.col("text")).alias("size"),
    )
    taken = mixing.mixed(rows, mixing.mix(sizes)).where("copies > 0")
    return taken.select("document", F.explode(F.sequence(F.lit(1), "copies"))).select("document.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and digests of them and of the bytes they decode to."""
    import public_tokenizers

    bounded_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("simhash", without_near_duplicates),
    ("mixing", to_target_weights),
    ("byte_bpe", encoded),
]
#: No SQL: hashes, a learned model and merges are not to be had there; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; what each of them keeps is written for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
