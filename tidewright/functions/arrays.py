"""Arrays as waveforms, labels and batches: all on the JVM's side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The label that a loss ignores.
IGNORED = -100


def peak_normalise(a: Column) -> Column:
    """Scaled so that the greatest absolute value is 1; silence stays as it is."""
    peak = F.array_max(F.transform(a, F.abs))
    return F.when(peak > 0, F.transform(a, lambda x: x / peak)).otherwise(a)


def down_mix(channels: Column) -> Column:
    """The mean of channels, an array of arrays of one length."""
    n = F.size(channels)
    total = F.aggregate(F.slice(channels, 2, F.greatest(n - 1, F.lit(0))), F.element_at(channels, 1), lambda s, c: F.zip_with(s, c, lambda x, y: x + y))
    return F.transform(total, lambda x: x / n)


def num_seconds(a: Column, rate: Column | int) -> Column:
    return F.size(a) / (F.lit(rate) if isinstance(rate, int) else rate)


def fit_length(a: Column, n: Column | int, pad: Column) -> Column:
    """Cut or padded at the end to n items."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(F.slice(a, F.lit(1), n), F.array_repeat(pad, F.greatest(n - F.size(a), F.lit(0))))


def batch_width(lengths: Column, over, mode: str = "longest", max_length: int | None = None) -> Column | None:
    """The width that the items of a batch are padded to: "longest", "max_length", or none for "do_not_pad"."""
    if mode == "do_not_pad":
        return None
    if mode == "max_length":
        if max_length is None:
            raise ValueError("max_length is needed to pad to it")
        return F.lit(max_length)
    if mode != "longest":
        raise ValueError(f"unknown padding {mode!r}")
    widest = F.max(lengths).over(over)
    return widest if max_length is None else F.least(widest, F.lit(max_length))


def attention_mask(length: Column, width: Column) -> Column:
    ones = F.least(length, width)
    return F.concat(F.array_repeat(F.lit(1), ones), F.array_repeat(F.lit(0), width - ones))


def pad_labels(labels: Column, width: Column) -> Column:
    return fit_length(labels.cast("array<bigint>"), width, F.lit(IGNORED).cast("bigint"))


def drop_common_first(labels: Column, bos: int, over) -> Column:
    """Without the first label if every row of the batch begins with bos."""
    every = F.min((F.get(labels, F.lit(0)) == bos).cast("int")).over(over) == 1
    return F.when(every, F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))).otherwise(labels)


def prompt_batch_row(prompt: Column, transcript: Column, eos: int, max_length: int | None = None) -> tuple[Column, Column]:
    """(decoder ids, labels): the prompt is not learned, and the transcript ends with eos.

    With max_length the transcript is cut to what the prompt leaves; no room is an error.
    """
    prompt, transcript = prompt.cast("array<bigint>"), transcript.cast("array<bigint>")
    if max_length is not None:
        room = F.lit(max_length) - F.size(prompt)
        room = F.when(room > 0, room).otherwise(F.raise_error(F.lit("the prompt leaves no room for a transcript")).cast("int"))
        transcript = F.slice(transcript, F.lit(1), room)
    ignored = F.array_repeat(F.lit(IGNORED).cast("bigint"), F.greatest(F.size(prompt) - 1, F.lit(0)))
    return F.concat(prompt, transcript), F.concat(ignored, transcript, F.array(F.lit(eos).cast("bigint")))


def pad_frames(frames: Column, width: Column, pad: float = 0.0) -> Column:
    """[mel, time] padded along time."""
    return F.transform(frames, lambda row: fit_length(row, width, F.lit(float(pad))))


def transducer_inputs(labels: Column, blank: int) -> Column:
    return F.concat(F.array(F.lit(blank).cast("bigint")), labels.cast("array<bigint>"))


def transducer_is_valid(decoder_ids: Column, labels: Column, blank: int) -> Column:
    """Whether decoder ids, where given, are the blank followed by the labels."""
    return decoder_ids.isNull() | decoder_ids.cast("array<bigint>").eqNullSafe(transducer_inputs(labels, blank))


def blank_id(model: Column, processor: Column, tokenizer: Column, converted: Column) -> Column:
    """The first that is known, in this order; none is an error."""
    return F.coalesce(model, processor, tokenizer, converted, F.raise_error(F.lit("no blank id")).cast("bigint"))


def prompt_ids(tokens: list[str], vocabulary: Mapping[str, int]) -> Column:
    """The ids of a prompt's tokens; an unknown token is an error at once."""
    missing = [t for t in tokens if t not in vocabulary]
    if missing:
        raise ValueError(f"no such token: {', '.join(missing)}")
    return F.array(*[F.lit(vocabulary[t]).cast("bigint") for t in tokens])


def language_prompt(language: str, punctuation: bool, languages: list[str]) -> list[str]:
    """The ten tokens before a transcript; the language stands in it twice."""
    if language not in languages:
        raise ValueError(f"no such language: {language}")
    # The control tokens of the prompt.
    return ["▁", "<|startofcontext|>", "<|startoftranscript|>", "<|emo:undefined|>", f"<|{language}|>", f"<|{language}|>", "<|pnc|>" if punctuation else "<|nopnc|>", "<|noitn|>", "<|notimestamp|>", "<|nodiarize|>"]


def char_labels(text: Column, vocabulary: Mapping[str, int], unknown: int) -> Column:
    """The ids of a text's characters; spaces are the word mark |."""
    known = F.create_map(*[x for k, v in vocabulary.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    chars = F.filter(F.split(F.replace(text, F.lit(" "), F.lit("|")), ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.coalesce(F.try_element_at(known, c), F.lit(unknown).cast("bigint")))


def replace_ignored(ids: Column, pad: int) -> Column:
    return F.transform(ids.cast("array<bigint>"), lambda x: F.when(x == IGNORED, F.lit(pad).cast("bigint")).otherwise(x))


def argmax(a: Column) -> Column:
    """The index of the greatest item; the first one on ties."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("bigint")


def logits_to_ids(logits: Column, pad: int) -> Column:
    """The likeliest id of each position; the padding's where all logits are the ignored value."""
    return F.transform(logits, lambda a: F.when(F.forall(a, lambda x: x == IGNORED), F.lit(pad).cast("bigint")).otherwise(argmax(a)))
