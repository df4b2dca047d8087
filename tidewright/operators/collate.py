"""Whole collators: each row of a table padded to its batch, by window functions over the batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays
from ..store import col, free_name

MOST_LABELS = 512


def _fits(condition: Column, value: Column, message: str) -> Column:
    """value where the condition holds; an error of that message where it doesn't or is null."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("int"))


def ctc_batch(df: DataFrame, batch: str, audio: str, labels: str, rate: int, max_seconds: float, model_max_length: int, padding: str = "longest") -> DataFrame:
    """df with audio and labels padded to their batch, and input_mask and labels_mask.

    padding: "longest", "max_length" (int(rate * max_seconds) samples and
    min(model_max_length, MOST_LABELS) labels) or "do_not_pad". Padded labels are
    IGNORED. Nothing is cut.
    """
    over = Window.partitionBy(col(batch))
    masks = [free_name(x, df.columns) for x in ("input_mask", "labels_mask")]
    out, limits = df, (int(rate * max_seconds), min(model_max_length, MOST_LABELS))
    widths = [free_name(f"width_{i}", df.columns) for i in range(2)]
    for column, width, mask, limit in zip((audio, labels), widths, masks, limits, strict=True):
        n = F.size(col(column))
        to = n if padding == "do_not_pad" else F.greatest(n, arrays.batch_width(n, over, padding, limit if padding == "max_length" else None))
        out = out.withColumn(width, to).withColumn(mask, arrays.attention_mask(n, col(width)))
    padded = {audio: arrays.fit_length(col(audio).cast("array<double>"), col(widths[0]), F.lit(0.0)), labels: arrays.pad_labels(col(labels), col(widths[1]))}
    return out.select(*[padded.get(c, col(c)).alias(c) for c in df.columns], *masks)


def mel_batch(df: DataFrame, batch: str, features: str, length: str) -> DataFrame:
    """df with [mel, time] features padded along time to their batch; an error if a batch's rows differ in mel bins."""
    over = Window.partitionBy(col(batch))
    mel, time = F.size(col(features)), F.size(F.get(col(features), F.lit(0)))
    least, most, width = (free_name(x, df.columns) for x in ("mel_least", "mel_most", "mel_width"))
    out = df.withColumn(least, F.min(mel).over(over)).withColumn(most, F.max(mel).over(over)).withColumn(width, F.max(time).over(over))
    to = _fits(col(least) == col(most), col(width), "the rows of a batch must share mel bins")
    padded = arrays.pad_frames(col(features).cast("array<array<double>>"), to)
    return out.select(*[(padded if c == features else col(c).cast("bigint") if c == length else col(c)).alias(c) for c in df.columns])


def transducer_batch(df: DataFrame, batch: str, labels: str, blank: int, pad: int, family: str, decoder: str | None = None, padding: str = "longest") -> DataFrame:
    """df with labels, and decoder inputs where there are any, padded to their batch.

    family: "rnnt", whose labels are padded with the blank, or "ctc" or "tdt", whose
    labels are padded with ``pad``, as are decoder inputs. Errors: padding to
    "max_length", a batch in which some rows have decoder inputs and others don't,
    and decoder inputs that aren't the blank followed by the labels.
    """
    if padding == "max_length":
        raise ValueError("frames have no greatest length to pad to: pad to the longest")
    if family not in ("ctc", "rnnt", "tdt"):
        raise ValueError(f"unknown family {family!r}")
    over = Window.partitionBy(col(batch))
    wide, given, deep = (free_name(x, df.columns) for x in ("label_width", "with_decoder", "decoder_width"))
    out = df.withColumn(wide, F.max(F.size(col(labels))).over(over))
    filler = F.lit(blank if family == "rnnt" else pad).cast("bigint")
    ids = {labels: col(labels).cast("array<bigint>")}
    if padding != "do_not_pad":
        ids[labels] = arrays.fit_length(ids[labels], col(wide), filler)
    if decoder is not None:
        has = col(decoder).isNotNull().cast("int")
        out = out.withColumn(given, F.when(F.min(has).over(over) == F.max(has).over(over), F.min(has).over(over))).withColumn(deep, F.max(F.size(col(decoder))).over(over))
        width = _fits(col(given).isNotNull(), col(deep), "every row of a batch must have decoder inputs, or none")
        width = _fits(arrays.transducer_is_valid(col(decoder), col(labels), blank), width, "decoder inputs must be the blank followed by the labels")
        if padding == "do_not_pad":
            width = F.when(width.isNotNull(), F.size(col(decoder)))
        ids[decoder] = F.when(col(decoder).isNotNull() | width.isNull(), arrays.fit_length(col(decoder).cast("array<bigint>"), width, F.lit(pad).cast("bigint")))
    return out.select(*[ids.get(c, col(c)).alias(c) for c in df.columns])


def prompted(df: DataFrame, prompt: list[int], labels: str | None = None, max_length: int | None = None) -> DataFrame:
    """df with decoder_input_ids, the same prompt in each row, and its labels as whole numbers, cut to max_length."""
    name = free_name("decoder_input_ids", df.columns)
    out = df.withColumn(name, F.array(*[F.lit(x).cast("bigint") for x in prompt]))
    if labels is None:
        return out
    ids = col(labels).cast("array<bigint>")
    return out.withColumn(labels, ids if max_length is None else F.slice(ids, 1, max_length))
