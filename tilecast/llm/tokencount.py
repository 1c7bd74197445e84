"""Token counts with a digest cache.

A text is known by the digest of its normalised content and of the tokenizer. Counts of known
digests come from a stored table; one text of every other digest is encoded, and its count is
appended. The tokenizer is the library's; within a task it is asked once per distinct chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.llm.common import map_text
from tilecast.runtime import MAX_BROADCAST_ROWS, materialize

#: Chunk counts kept in each half of a worker's cache.
CACHE = 400_000

#: White space that the normal form collapses; the tokenizer drops it.
SPACE = r"[\x20\x09-\x0D]+"

CACHE_SCHEMA = "digest binary, n_tokens bigint"


def normal_form(text: Column) -> Column:
    """Equal normal forms have equal counts: runs of ASCII white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))


def content_digest(text: Column, version: str) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(version), normal_form(text)), 256))


class Counter:
    """Counts tokens as the library does for the whole text, by chunks between white space.

    The tokenizer must drop white space before it forms pieces and treat its own special strings
    as a part of a chunk, which holds as they have no white space.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def __call__(self, texts: Sequence[str]) -> list[int]:
        cut = [re.split(r"[\x20\x09-\x0D]+", t) if "\t" in t or "\x0b" in t else t.replace("\n", " ").split(" ") for t in texts]
        used = set().union(*cut)
        if len(self.known) > CACHE:
            self.old, self.known = self.known, {}
        fresh = used.difference(self.known)
        again = fresh.intersection(self.old)
        self.known.update((c, self.old[c]) for c in again)
        missing = list(fresh.difference(again))
        encoded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.known.update(zip(missing, map(len, encoded)))
        of = self.known.__getitem__
        return [sum(map(of, parts)) for parts in cut]


def stored(docs: DataFrame, path: str) -> DataFrame:
    """The cache at ``path``, or an empty one."""
    try:
        return docs.sparkSession.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return docs.sparkSession.createDataFrame([], CACHE_SCHEMA)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, one row per document.

    Args:
        docs: has ``doc_id, text``; a null text counts as empty (0 bytes, 0 tokens).
        tokenizer: path of the tokenizer's definition, read on the driver.
        cache: folder of the stored counts, which all executors share. Created if missing. Two
            jobs may append at once: a digest that both add has the same count twice, and is
            read as one.

    Only digests, ids and sizes are shuffled. Which rows to encode is decided from them: one
    row of each distinct missing digest. The texts themselves stay where they are read, as long
    as the rows to leave out (or those to encode) are few enough to be broadcast.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    version = hashlib.sha256(definition.encode()).hexdigest()
    digest = content_digest(F.col("text"), version)
    keyed = materialize(
        docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), digest.alias("digest")),
        "token-digests",
    )
    distinct = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"))
    misses = materialize(distinct.join(stored(docs, cache).select("digest"), "digest", "left_anti"), "token-misses")
    counted = _encode(docs, keyed, misses, digest, definition).dropDuplicates(["digest"])
    counted.write.mode("append").parquet(cache)
    known = stored(docs, cache).dropDuplicates(["digest"])
    return keyed.join(known, "digest").select("doc_id", "n_bytes", "n_tokens")


def _encode(docs: DataFrame, keyed: DataFrame, misses: DataFrame, digest: Column, definition: str) -> DataFrame:
    """``digest, n_tokens`` of one row per missing digest."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), digest.alias("_digest"))
    chosen = (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("first"))
    others = (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    # Rows to leave out: copies, and what the cache holds.
    skip = materialize(
        keyed.join(misses.select(F.col("digest").alias("_digest"), F.col("first").alias("_first")),
                   (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_first")), "left_anti")
        .select("digest", "doc_id").distinct(),
        "token-skip",
    )
    if skip.count() <= MAX_BROADCAST_ROWS:
        todo = rows.join(F.broadcast(skip), others, "left_anti")
    elif misses.count() <= MAX_BROADCAST_ROWS:
        todo = rows.join(F.broadcast(misses), chosen, "left_semi")
    else:
        todo = rows.join(misses, chosen, "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast({"definition": definition})

    def make():
        held = shared.value  # kept by a worker from task to task
        counter = held.get("counter") or held.setdefault("counter", Counter(held["definition"]))
        return lambda texts, _: [pa.array(counter([t.decode("utf-8", "replace") for t in texts]), pa.int64())]

    return map_text(todo.withColumnRenamed("_digest", "digest"), ["digest"], "_text", "n_tokens bigint", make)
