"""Corpus pipeline: language ID, line dedup, near-duplicate join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages are
written as Parquet and the next one reads that table.  All but the last
return the columns of ``documents``.

1. language id: a network trained on the given rows labels them.  Rows without
   a letter go, and rows whose predicted language is not in ``LANGUAGES`` or
   whose score is below ``LEAST_SCORE``.  Without any labelled training row
   there is no prediction; then all texts with a letter stay.
2. line dedup: repeated runs of lines leave the texts, no rows go.
3. near duplicates: of every component of linked texts the row of the smallest doc_id stays.
4. decontamination: rows that hold a window of a ``benchmark`` text go.
5. packing: the rest as pieces in sequences of at most 4096 tokens.
"""

from __future__ import annotations

from lendlens.llm.common import column, materialize, table
from lendlens.llm.decontaminate import drop_contaminated
from lendlens.llm.jaccard_join import keep_one_per_group
from lendlens.llm.language_id import UNDEFINED, predicted, train
from lendlens.llm.line_dedup import dedup_lines
from lendlens.llm.memory import small_batches
from lendlens.llm.packing import pack
from lendlens.llm.queries import tokenizer_file
from lendlens.llm.shipping import ship


#: Languages of the corpus that stay; None: every language the network learnt.
LANGUAGES = ("de", "en", "es", "fr")
#: Least mean probability of the predicted language: it must outweigh all others together.
LEAST_SCORE = 0.5


def prepare(spark):
    ship(spark)
    small_batches(spark)


def language_stage(spark, docs, sf_dir, languages=LANGUAGES, least_score=LEAST_SCORE):
    prepare(spark)
    network = train(docs)
    if network is None:
        return docs.filter(column(docs, "text", "string").rlike("\\p{L}"))
    labelled = predicted(docs, network)
    fits = (labelled["lang_pred"] != UNDEFINED) & (labelled["score"] >= least_score)
    if languages is not None:
        fits &= labelled["lang_pred"].isin(*languages)
    return labelled.filter(fits).select("row.*")


def line_stage(spark, docs, sf_dir):
    prepare(spark)
    return dedup_lines(docs).select(docs.columns)


def near_duplicate_stage(spark, docs, sf_dir):
    prepare(spark)
    return keep_one_per_group(docs)


def decontamination_stage(spark, docs, sf_dir):
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark, docs, sf_dir):
    prepare(spark)
    return pack(docs, tokenizer_file())


STAGES = [("language id", language_stage), ("line dedup", line_stage), ("near duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
