"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: after ``min_chars`` the next sentence or line end
closes a chunk, ``max_chars`` closes it in any case. Each chunk gets a 64-bit identifier that is
*verified*: over all chunks of the table every identifier must stand for one (length, SHA-256)
only. Should one stand for two, all recipes switch to the wide identifier (64-bit value and
SHA-256), so a collision can't join different texts. Equal texts have equal ordered identifier
lists; only those short lists move, the text is read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, drop_ids, drop_texts, materialize, scratch, text_hash, whole_text


def chunk_pattern(min_chars: int, max_chars: int) -> str:
    return rf"(?s).{{{min_chars},{max_chars}}}?(?:[.!?。！？]\s|\n)|.{{1,{max_chars}}}"


def chunk_table(docs: DataFrame, min_chars: int = 512, max_chars: int = 4096, id_bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, chunks: ordered list of (id, digest, bytes)), one row for each row of docs."""
    chunks = F.regexp_extract_all(F.col("t"), F.lit(chunk_pattern(min_chars, max_chars)), F.lit(0))
    ident = F.xxhash64 if id_bits == 64 else (lambda c: F.pmod(F.xxhash64(c), F.lit(1 << id_bits)))
    return docs.select("doc_id", whole_text().alias("t")).select(
        "doc_id",
        F.sha2(F.col("t"), 256).alias("text_sha256"),
        F.transform(
            chunks, lambda c: F.struct(ident(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("digest"), F.octet_length(c).alias("bytes"))
        ).alias("chunks"),
    )


def ambiguous_ids(chunked: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk content."""
    content = chunked.select(F.explode("chunks").alias("c")).select("c.*").distinct()
    return content.groupBy("id").count().where("count > 1").select("id")


def exact_groups(docs: DataFrame, min_chars: int = 512, max_chars: int = 4096, id_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, and all empty texts are one group. Of equal texts the largest
    doc_id stays; rows that repeat a doc_id are one document and share its flags. A null doc_id
    never wins against a number; if a group has none but nulls, keep_id is null and they stay.
    A text of any length is read whole. Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(grouped(docs, min_chars, max_chars, id_bits), "groups")


def grouped(docs: DataFrame, min_chars: int, max_chars: int, id_bits: int) -> DataFrame:
    chunked = materialize(chunk_table(docs, min_chars, max_chars, id_bits), "chunks")
    if ambiguous_ids(chunked).isEmpty():
        recipe = F.col("chunks.id")
    else:
        recipe = F.transform("chunks", lambda c: F.concat_ws(":", c["id"], F.hex(c["digest"]), c["bytes"]))
    recipes = chunked.select("doc_id", "text_sha256", recipe.alias("recipe"))
    # The verified recipe alone decides. Partial sums before the shuffle: a group with a third of the rows costs one row per task.
    groups = materialize(recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "groups")
    # Most texts are alone and need no partner. Read from a table, so that a recipe with very many rows can be split over tasks.
    found = recipes.join(checked_broadcast(groups), "recipe", "left")
    keep_id = F.coalesce("keep_id", "doc_id")
    return found.select("doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies, also those under one doc_id; other texts of that doc_id and rows with a null doc_id are kept."""
    groups = exact_groups(docs).where("doc_id is not null and group_size > 1").select("doc_id", "text_sha256", "kept")
    left = drop_texts(docs, groups.where(~F.col("kept")), "copies")
    twice = groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    if twice.isEmpty():
        return left
    ids = materialize(twice.select("doc_id").distinct(), "twice")
    once = left.join(checked_broadcast(ids), "doc_id", "left_semi").withColumn("_sha", text_hash()).dropDuplicates(["doc_id", "_sha"])
    return drop_ids(left, ids, "repeated").unionByName(once.select(docs.columns))
