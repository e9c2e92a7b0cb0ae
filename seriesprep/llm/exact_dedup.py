"""Exact deduplication by chunk recipes, with DataFrame functions only.

A text is cut where its content says so: a chunk ends at the first boundary (a stop, a line end, or a blank after certain
letter pairs) after ``LEAST`` characters, at the latest after ``MOST``. A chunk's identifier is a digest that has been
verified: all contents seen under one digest were compared, and if two differ, the whole table is done with the next,
wider digest. A text's recipe is the ordered list of its identifiers; texts are equal when their recipes are. Only
chunks move, each distinct one once per task; long texts as such never do.

Defined results: null counts as the empty text. A row with a null id is never preferred; if all ids of a group are null,
its ``keep_id`` is null and one of its rows stays. Of rows repeated with one id and text exactly one stays. Empty
tables give empty results; columns other than id and text play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage

LEAST, MOST = 512, 4096
CUT = rf"(?s).{{{LEAST},{MOST - 2}}}?(?:[.!?\n]|[aeiou][nrst] )|.{{1,{MOST}}}"

Digest = Callable[[Column], Column]


def short_digest(chunk: Column) -> Column:
    return F.unhex(F.substring(F.sha2(chunk, 256), 1, 32))


def wide_digest(chunk: Column) -> Column:
    return F.unhex(F.concat(F.sha2(chunk, 512), F.md5(chunk)))


DIGESTS: tuple[Digest, ...] = (short_digest, wide_digest)


def chunks(text: Column) -> Column:
    """The content-defined chunks of a text, in order; none for an empty one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CUT), F.lit(0))


def chunk_table(docs: DataFrame, digest: Digest = short_digest, text_col: str = "text") -> DataFrame:
    """Distinct chunks by digest: ``digest``, ``uses``, and whether all contents under it are the same (``verified``)."""
    cut = docs.select(F.explode(chunks(F.col(text_col))).alias("chunk")).select(digest(F.col("chunk")).alias("digest"), "chunk")
    return cut.groupBy("digest").agg(
        F.count("*").alias("uses"), (F.min("chunk") == F.max("chunk")).alias("verified"))


def verified_digest(docs: DataFrame, digests: Sequence[Digest] = DIGESTS, text_col: str = "text") -> Digest:
    """The first digest under which no two different chunks of the table meet."""
    for digest in digests:
        if chunk_table(docs, digest, text_col).filter("NOT verified").isEmpty():
            return digest
    raise ValueError("different chunks share every digest offered")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: Sequence[Digest] = DIGESTS,
) -> DataFrame:
    """Every row's group of equal texts: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``same_id``.

    The row with the largest id stays; ``same_id`` counts the rows of the group that have this id.
    """
    digest = verified_digest(docs, digests, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(docs.select(
        F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.sha2(text, 256).alias("text_sha256"),
        F.transform(chunks(F.col(text_col)), digest).alias("recipe")), "recipes")
    ids = rows.groupBy("recipe", "_id").agg(F.max("_row").alias("_row"), F.count("*").alias("same_id"))
    # written, so that the join below deals its rows itself and a large group's rows can be split
    groups = stage(ids.groupBy("recipe").agg(
        F.max(F.struct("_id", "_row", "same_id")).alias("_keep"), F.sum("same_id").alias("group_size")), "recipe-groups")
    return rows.join(groups, "recipe").select(
        F.col("_id").alias(id_col), F.col("_keep._id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"), "text_sha256", F.col("_keep.same_id").alias("same_id"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stay = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"), (F.col("same_id") > 1).alias("again"))
    mine = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)

    def rows(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, docs[id_col].eqNullSafe(chosen["id"]) & (mine == chosen["sha"]), "left_semi")

    once, repeated = rows(stay.filter("NOT again")), rows(stay.filter("again"))
    mark = "_".join(["content", *docs.columns])  # a name that no column has
    repeated = repeated.withColumn(mark, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).dropDuplicates([id_col, mark]).drop(mark)
    return once.unionByName(repeated)
