"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are hashed; windows found more than once anywhere keep their first occurrence
(smallest document id, then earliest line) and lose the later ones. The lines that later occurrences cover are merged
and removed. Built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, let

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, removed): for each row that loses lines, their sorted positions from 0."""
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`"), F.lit(LAST_ID)).alias("__order"), row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("__key"), _lines(F.col(f"`{text_col}`")).alias("__lines")
    ).filter(F.size("__lines") >= WINDOW)
    # windows of blank lines only carry no content and are left alone
    digests = let(
        F.col("__lines"),
        lambda x: F.transform(
            F.sequence(F.lit(1), F.size(x) - WINDOW + 1),
            lambda i: let(
                F.array_join(F.slice(x, i, WINDOW), "\n"), lambda s: F.when(s.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(s)))
            ),
        ),
    )
    windows = rows.select("__order", "__key", F.posexplode(digests).alias("p", "h")).filter(F.col("h").isNotNull())
    first = windows.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("__order", "__key", "p")).alias("first"))
    later = windows.join(first.filter("n > 1").select("h", "first"), "h").filter(
        (F.col("__order") != F.col("first.__order")) | (F.col("__key") != F.col("first.__key")) | (F.col("p") != F.col("first.p"))
    )
    covered = later.select("__key", F.explode(F.sequence("p", F.col("p") + WINDOW - 1)).alias("line"))
    return covered.groupBy("__key").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def row_key(id_: Column, text: Column) -> Column:
    """Knows a row by id and text: rows equal in both have the same result."""
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text, n_lines, removed, kept) of every row; the row itself is packed, so no column of it can clash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), F.col(f"`{text_col}`").alias("text"), row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"))
    cut = removed_lines(docs, id_col, text_col).select(F.col("__key").alias("cut_key"), F.col("removed").alias("gone"))
    lines = _lines(F.col("text"))
    left = let(
        F.struct(lines.alias("x"), F.coalesce("gone", F.array().cast("array<int>")).alias("r")),
        # array_except looks positions up by hash: linear also where a long text loses most of its lines
        lambda s: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(s["x"]) - 1), s["r"]), lambda i: F.get(s["x"], i)), "\n"),
    )
    return rows.join(cut, F.col("key") == F.col("cut_key"), "left").select(
        "doc",
        "text",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("gone", F.array()).cast("array<int>").alias("removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("kept"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their number of lines, the sorted positions of removed ones and the text left, as __n_lines, __removed, __kept.

    A null or empty text is one empty line and has no window. Among rows with the same id and text only the occurrence
    inside a document can be later; both rows get the same result. A null id is ordered after every other. An empty table
    gives no rows. Columns of ``docs`` with one of the three names are replaced.
    """
    added = {"__n_lines": "n_lines", "__removed": "removed", "__kept": "kept"}
    own = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in added]
    return _judged(docs, id_col, text_col).select(*own, *[F.col(c).alias(name) for name, c in added.items()])


def replace_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with the text left by dedup_lines, and its length in ``chars_col`` if there is such a column; other columns unchanged.

    Null and short texts stay as they are, repeated rows stay repeated, an empty table gives no rows.
    """
    changed = F.size("removed") > 0
    now = {text_col: F.col("kept"), chars_col: F.when(changed, F.length("kept").cast("long")).otherwise(F.col(f"doc.`{chars_col}`"))}
    return _judged(docs, id_col, text_col).select(*[now.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
