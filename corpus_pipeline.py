"""From raw documents to packed token sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from spokeframe.llm import linededup, minhash, mixing, packing, toxicity
from spokeframe.session import through_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier does not reject, unchanged."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = docs.where(~toxicity.held_out("doc_id"))
    model = toxicity.learn(learned.select("doc_id", "text"), labels)
    scored = toxicity.with_scores(docs, model, score="__toxicity")
    return scored.where(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark, docs, sf_dir):
    """Documents without the lines that an earlier one, or an earlier place of it, has."""
    return linededup.dedup_lines(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return minhash.first_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of token sequences."""
    return packing.pack(docs, TOKENIZER, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A fitted classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
