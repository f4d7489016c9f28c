"""The training-text pipeline: its stages in order, each over all its predecessor kept.

Rows are told apart by ``doc_id``; rows under one id stay or go together, but in
the near-copy stage, which looks at id and text. Null ids stay
wherever an id decides; null texts count as empty and stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import boosted_toxicity, packing, shingle_join, string_tiling, unit_dedup
from tallyframe.plans.tables import load
from tallyframe.staging import stage, stage_side

TOKENIZER = "byte_bpe_50k.json"
TOXIC_FROM = 0.3
#: The operator's defaults are those of the query op10_jaccard_join alone.
NEAR = shingle_join.Similarity(size=5, percent=80)


def _without(docs: DataFrame, ids: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows of some ids; the ids are broadcast when counted to be few."""
    gone = stage_side(ids.select(F.col(key).alias("_gone")).distinct(), label)
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; all stay where the labels are too few to grow trees."""
    model = boosted_toxicity.fit_toxicity(docs, load(spark, sf_dir, "labels").select("doc_id", "toxic"))
    if model.trees is None:
        return docs
    return boosted_toxicity.accepted(docs, model, TOXIC_FROM)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies stays: that of the least id, then of the least text hash.

    Several texts under one id are told apart; of rows equal in id and text one
    stays. Rows without words or without an id stay. Other columns may have any
    names; an empty table stays empty.
    """
    names = [f"_column{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    id_, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    named = F.struct(F.col(id_).alias("id"), F.xxhash64(text).alias("hash"))
    keyed = rows.withColumn("_key", F.when(F.col(id_).isNotNull(), named))
    found = stage(shingle_join.jaccard_components(keyed, "_key", text, like=NEAR), "near-copies")
    kept = _without(keyed, found.where("component_id <> _key"), "copies", "_key")
    counted = found.where("_key is not null and n_shingles > 0").groupBy("_key").agg(F.count("*").alias("n"))
    repeated = stage(counted.where("n > 1"), "repeated-rows")
    if repeated.isEmpty():
        return kept.select(names).toDF(*docs.columns)
    doubled = kept.join(repeated.select("_key"), "_key", "left_semi")
    once = doubled.withColumns({"_id": F.col("_key.id"), "_hash": F.col("_key.hash")}).dropDuplicates(["_id", "_hash"])
    others = _without(kept, repeated, "repeated", "_key")
    return others.select(names).unionByName(once.select(names)).toDF(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of earlier documents are cut out; documents that were nothing else go.

    Null and empty texts stay, other columns may have any names, an empty table
    stays empty.
    """
    cut = unit_dedup.remove_repeats(docs)
    removed = cut.columns[-2]
    emptied = (F.size(removed) > 0) & (F.trim(F.regexp_replace("text", "\\s+", "")) == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(
        *(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns)
    )


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose words cover half of a benchmark text; those without an id or text stay."""
    leaks = string_tiling.find_leaks(docs, load(spark, sf_dir, "benchmark"))
    return _without(docs, leaks.where("doc_id is not null"), "leaks")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of whole texts, as the packing operator returns them; an empty table gives none."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", keep_one_of_group),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("packing", pack),
]

# Token ids, trained trees and greedy tiles have no SQL form; tests hold near
# copies and leaks against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what a stage returns is written and read again for the next."""
    docs = load(spark, sf_dir, "documents")
    for position, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}", compression="zstd")
    return docs
