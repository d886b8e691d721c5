"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept. All but the last
return the columns of ``documents``; ``n_chars`` follows the text it belongs to.

For every stage: an empty table gives an empty result. Columns that ``docs`` has beside ``doc_id``
and ``text`` come back as they were, with their names and types, also where an operator has a column
of that name. Repeated rows are rows of their own. Very long texts are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    ngram_join,
    packing,
    secret_scan,
    substring_dedup,
    toxicity,
)
from millrace.llm.shared import forget, forget_since, small_batches, staged, staged_so_far, table

# Near-duplicates of the pipeline: five-word shingles, a similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but ``doc_id`` and ``text`` under names that no operator uses."""
    return docs.select(
        *[
            F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"_user{i}")
            for i, c in enumerate(docs.columns)
        ]
    )


def _back(rows: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` under their own names; with ``text`` another text and its length."""
    out = []
    for i, c in enumerate(docs.columns):
        own = F.col(c if c in ("doc_id", "text") else f"_user{i}")
        if text is not None and c == "text":
            own = text
        elif text is not None and c == "n_chars":
            own = F.length(text).cast(docs.schema["n_chars"].dataType)
        out.append(own.alias(c))
    return rows.select(*out)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on all given labels, predicts as toxic go.

    Null and empty texts have no features and stay, unless the model predicts every text without
    evidence as toxic. A null id, or one without a label, teaches nothing and is judged like others.
    A model that learned nothing, for want of labels of both kinds, rejects nothing.
    """
    small_batches(spark)
    apart = _apart(docs)
    model = toxicity.train_model(apart, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    if not len(model.keys):
        return docs
    scored = toxicity.score_texts(apart, apart.columns, model)
    return _back(scored.filter("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of least id.

    Of rows with that id the first one read stays. Texts without words, null ones among them, are
    near nothing and stay. A row with a null id stays only if its group has no other.
    """
    apart = _apart(docs)
    grouped = ngram_join.jaccard_components(
        apart, apart.columns, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT
    )
    return _back(grouped.filter("kept"), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go from the texts; a text that loses none stays as it is.

    A text that loses words has its others joined by single spaces. Every row stays, also one that
    loses all its words and null texts; ids may be null or repeat.
    """
    apart = _apart(docs)
    cut = substring_dedup.remove_repeats(apart, apart.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _back(cut, docs, text)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays, and null texts stay null."""
    apart = _apart(docs)
    found = secret_scan.find_secrets(apart, [c for c in apart.columns if c != "text"])
    return _back(found, docs, F.col("redacted"))


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every kept document in token-budget batches of like length.

    A null or empty text is one piece of one token, its end. Rows of the same id are packed each.
    """
    return packing.pack(packing.count_tokens(docs, ["doc_id"]))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack_lengths),
]

# The first stage is a trained model, which SQL does not state; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage read and staged goes once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before = staged_so_far()
        result = staged(stage(spark, docs, sf_dir), name)
        forget_since(before, result)
        if i:
            forget(docs)
        docs = result
    return docs
