"""Line dedup: lines that many documents share stay in one of them (operator 12).

A text is split at ``\\n``; a line's *key* is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. Keys of at least ``least_chars`` code points that at least ``least_docs`` documents hold
lose all their lines, except in the largest id that holds them. The method:

1. texts are exploded into lines, and the lines long enough become (hash of the key, id, text's hash,
   line numbers); hashes are 128 bits of SHA-256, so only equal keys share one;
2. documents are counted per hash. Spark combines both counts on the map side, so a line of a third of
   all documents meets its hash as one row per task; the (hash, id) rows are dealt by both columns;
3. the lines of hashes over the threshold are collected as line numbers of their text (the join on a hot
   hash is one that Spark splits), and the text is reassembled from the others in order.

Only a text's own lines are ever gathered in one row: memory is bounded by the longest text. The text
itself is shuffled once.

Cases: a null or empty text has one empty line. Rows without an id are no documents: they count for
nothing and keep all lines. Rows that share an id are one document in the counts, and each is returned
with its own text. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import hand_off

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _hash(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def line_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_lines`` before dropping, ``n_dropped``, and ``kept``, the text of the other lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), _hash(text).alias("row"), F.split(text, "\n", -1).alias("lines"))

    lines = texts.where("doc_id is not null").select("doc_id", "row", F.posexplode("lines").alias("at", "line"))
    keys = lines.select("doc_id", "row", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    held = keys.groupBy(_hash(F.col("key")).alias("hash"), "doc_id", "row").agg(F.collect_set("at").alias("at"))
    held = hand_off(held, "lines")

    shared = held.groupBy("hash").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_id")).where(F.col("n_docs") >= least_docs)
    shared = hand_off(shared.select("hash", "last_id"), "shared")  # so that the join deals both sides anew and Spark can split a hot hash
    gone = held.join(shared, "hash").where("doc_id <> last_id").groupBy("doc_id", "row").agg(F.flatten(F.collect_list("at")).alias("gone"))

    joined = texts.join(gone, ["doc_id", "row"], "left")
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.array_except(numbers, F.coalesce("gone", F.array().cast("array<int>")))
    return joined.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n").alias("kept"))
