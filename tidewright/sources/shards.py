"""Pinned shard ranges, dataset coordinates and cache identities: checked before any plan is built."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

MOST_SHARDS = 100_000
_REVISION = re.compile(r"[0-9a-fA-F]{40}\Z")
_FIELD = re.compile(r"(0?\d*d)?\Z")


def validate_revision(revision: object, label: str = "revision") -> str:
    """A full commit; anything that can move is an error."""
    if not isinstance(revision, str) or not _REVISION.match(revision):
        raise ValueError(f"{label} must be a full commit of 40 hexadecimals")
    return revision


def _whole(value: object, name: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be a whole number")
    return value


def select_shards(selection: Mapping[str, object], listing: Iterable[str], revision: str) -> list[str]:
    """The files of {template, start, end}, both ends included, that the listing has, in order.

    The template is a relative path with one field, {shard} or one with a width, like {shard:05d}.
    """
    validate_revision(revision)
    if set(selection) != {"template", "start", "end"}:
        raise ValueError("a selection has the keys template, start and end")
    template, start, end = selection["template"], _whole(selection["start"], "start"), _whole(selection["end"], "end")
    if not isinstance(template, str) or template.startswith("/") or re.search(r"[?#]|://|(^|/)\.\.(/|$)", template):
        raise ValueError("the template must be a relative path")
    fields = [(name, spec, conv) for _, name, spec, conv in Formatter().parse(template) if name is not None]
    if len(fields) != 1 or fields[0][0] != "shard" or not _FIELD.match(fields[0][1] or "") or fields[0][2]:
        raise ValueError("the template must have one field, {shard} or {shard:0Nd}")
    if not 0 <= start <= end:
        raise ValueError("0 <= start <= end is needed")
    if end - start >= MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} candidates")
    there = set(listing)
    found = [f for f in (template.format(shard=i) for i in range(start, end + 1)) if f in there]
    if not found:
        raise ValueError("no file of the selection is there")
    if len(set(found)) != len(found):
        raise ValueError("the template names a file twice")
    return found


def read_shards(spark: SparkSession, root: str, selection: Mapping[str, object], listing: Iterable[str], revision: str) -> DataFrame:
    """The selected Parquet files, and only these."""
    return spark.read.parquet(*[f"{root.rstrip('/')}/{f}" for f in select_shards(selection, listing, revision)])


def parse_name(name: str) -> tuple[str, str | None, str | None]:
    """(id, subset, revision) of id[::subset][@revision], in either order of the last two; a single colon will do where there is no double one."""
    cut = re.split("(::|@)", name if "::" in name else name.replace(":", "::"))
    found = dict(zip(cut[1::2], cut[2::2], strict=True))
    if not cut[0] or len(found) != len(cut) // 2 or not all(found.values()):
        raise ValueError(f"not a dataset name: {name!r}")
    return cut[0], found.get("::"), found.get("@")


def cache_identity(dataset_id: str, subset: str | None, split: str, revision: str | None, purpose: str, max_samples: int | None = None, **options: object) -> str:
    """A name for a materialisation that any coordinate or option changes: the id and a SHA-256 of all."""
    facts = {"id": dataset_id, "subset": subset, "split": split, "revision": revision, "purpose": purpose, "max_samples": max_samples, **options}
    text = json.dumps(facts, sort_keys=True, separators=(",", ":"), ensure_ascii=True)
    return f"{dataset_id.replace('/', '--')}-{hashlib.sha256(text.encode()).hexdigest()}"


def corpus_file(folder: str, names: Iterable[str]) -> str:
    """Where the sentences of these datasets are kept: named by the MD5 of their joined names."""
    return f"{folder.rstrip('/')}/ngram-sentences-{hashlib.md5(','.join(names).encode()).hexdigest()}.txt"


def cached(spark: SparkSession, folder: str, identity: str, build) -> DataFrame:
    """The Parquet table of that identity, built and written on the first use."""
    path = f"{folder.rstrip('/')}/{identity}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
