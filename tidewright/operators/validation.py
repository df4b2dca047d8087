"""Checking transcripts against predictions that are given, and error rates from token ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import arrays
from ..functions.text import clean_transcript, normalise_for_scoring
from ..store import col, free_name
from . import filters, metrics

#: Seconds between which a recording can be checked.
LEAST, MOST = 0.25, 3600.0


def add_validations(df: DataFrame, text: str, audio: str, prediction: str, rate: int, model_id: str, keep: Iterable[str], max_cer: float, lower_case: bool = True) -> DataFrame:
    """The usable rows whose transcript differs from the prediction by less than max_cer.

    Five more columns: asr_prediction and asr_label, the two cleaned texts,
    asr_validation_model, asr_cer and asr_wer, of each row. The prediction, which a
    model made elsewhere, is cleaned in lower case and with numerals as words. Rows
    whose cleaned label is empty have no rate and go. The given prediction column
    is not kept.
    """
    keep = "".join(keep)
    usable = filters.examples(df, audio, rate, text, LEAST, MOST)
    out = usable.withColumn("asr_prediction", clean_transcript(col(prediction), keep=keep, numerals=True)).withColumn("asr_label", clean_transcript(col(text), lower_case=lower_case, keep=keep)).withColumn("asr_validation_model", F.lit(model_id))
    # alignments are made by Python, so each is a column of its own that is made once
    c, w = (free_name(x, out.columns) for x in ("char_edits", "word_edits"))
    out = out.withColumn(c, metrics.char_edits(F.col("asr_label"), F.col("asr_prediction"))).withColumn(w, metrics.word_edits(F.col("asr_label"), F.col("asr_prediction")))
    out = out.withColumn("asr_cer", metrics.row_rate(col(c))).withColumn("asr_wer", metrics.row_rate(col(w)))
    return out.where(filters.below_rate(F.col("asr_cer"), max_cer)).drop(c, w, prediction)


def decoded(ids: Column, vocabulary: Mapping[int, str], pad: int, group: bool = False) -> Column:
    """The text of ids; the padding says nothing. With group, neighbours that are alike count once, as in CTC."""
    known = F.create_map(*[x for k, v in vocabulary.items() for x in (F.lit(k).cast("bigint"), F.lit(v))])
    ids = ids.cast("array<bigint>")
    if group:
        before = F.concat(F.array(F.lit(None).cast("bigint")), ids)
        ids = F.filter(ids, lambda x, i: ~x.eqNullSafe(F.get(before, i)))
    return F.array_join(F.transform(F.filter(ids, lambda x: x != pad), lambda x: F.coalesce(F.try_element_at(known, x), F.lit(""))), "")


def token_error_rates(df: DataFrame, predictions: str, labels: str, vocabulary: Mapping[int, str], pad: int, by: list[str] | None = None, group_labels: bool = False) -> DataFrame:
    """(by, cer, wer) of predictions against labels, both of token ids.

    predictions: ids of each position, or logits, of which the likeliest ids are taken
    and neighbours that are alike count once. Ignored ids count as padding. Arrays
    of any other depth are an error before anything is read.
    """
    kind, depth = df.schema[predictions].dataType, 0
    while isinstance(kind, ArrayType):
        kind, depth = kind.elementType, depth + 1
    if depth not in (1, 2):
        raise ValueError(f"predictions must be arrays of ids or of logits, not {df.schema[predictions].dataType.simpleString()}")
    ids = arrays.replace_ignored(col(predictions), pad) if depth == 1 else arrays.logits_to_ids(col(predictions), pad)
    said = normalise_for_scoring(decoded(ids, vocabulary, pad, depth == 2))
    meant = normalise_for_scoring(decoded(arrays.replace_ignored(col(labels), pad), vocabulary, pad, group_labels))
    rows = df.select(*[col(x) for x in by or []], meant.alias("meant_"), said.alias("said_"))
    rows = rows.withColumn("c_", metrics.char_edits(F.col("meant_"), F.col("said_"))).withColumn("w_", metrics.word_edits(F.col("meant_"), F.col("said_")))
    rates = [metrics.rate(*[F.sum(f"{e}.{x}") for x in "sdih"]).alias(name) for e, name in (("c_", "cer"), ("w_", "wer"))]
    return rows.groupBy(*by or []).agg(*rates)
