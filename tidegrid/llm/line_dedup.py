"""Line dedup: lines that many documents share go, except where the largest document id holds them.

Native: DataFrame functions only.  Keys travel as 128-bit hashes; texts are shuffled once, by
document, and no key's rows are gathered (counts combine before the shuffle, the join back is
one that adaptive execution splits, and dropped positions go back by document).

Defined results: a null text is an empty one and has one empty line; a null id counts as smaller
than every other id and rows with it are one document; rows with the same id are one document;
rows that repeat in id and text get the same result; an empty table gives an empty result; a very long text is split in its row, whose lines
are all held at once.  Ids must be whole numbers or cast to one.  Other columns are kept as they are, but for n_lines and
n_dropped, which the operator's own replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.runtime import settle

BLANKS = "\t\n\x0b\x0c\r "


def ascii_lower(text: Column) -> Column:
    """A column that is equal for two strings just when they are equal after lower-casing A-Z alone.

    An ASCII string is lower-cased as it is.  Else its UTF-8 bytes are read as Latin-1 and lower-cased:
    this maps A-Z to a-z and lead bytes to other lead bytes with as many or fewer trailing bytes, one to one
    on well-formed UTF-8, and is much faster than a table of characters.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.lower(F.decode(text.cast("binary"), "ISO-8859-1")))


def line_key(line: Column, min_chars: int) -> Column:
    """128 bits for a line's key, null for lines that are too short to count."""
    bare = F.btrim(line, F.lit(BLANKS))
    low = ascii_lower(bare)
    return F.when(F.char_length(bare) >= min_chars, F.struct(F.xxhash64(low).alias("h1"), F.xxhash64(F.lit(7), low).alias("h2")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """``docs`` with its texts replaced by what is left, and the columns n_lines and n_dropped.

    A line counts by its key: blanks stripped at both ends and A-Z lower-cased.  Keys of at least ``min_chars``
    characters that at least ``min_docs`` documents hold lose all their lines but those in the largest id.
    """
    own, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    least = F.coalesce(own.cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(least.alias("_id"), F.xxhash64(text).alias("_same"), F.split(text, "\n").alias("_lines"))
    lines = rows.select("_id", "_same", F.posexplode(F.transform("_lines", lambda x: line_key(x, min_chars))).alias("_at", "_key")).where("_key IS NOT NULL").select("_id", "_same", "_at", "_key.h1", "_key.h2")
    drop = lines.groupBy("h1", "h2").agg(F.count_distinct("_id").alias("_n"), F.max("_id").alias("_last")).where(F.col("_n") >= min_docs).select("h1", "h2", "_last")
    # Written out, so that both sides of the join come straight from a shuffle: only then can a hot line's rows be split among tasks.
    drop = settle(drop)
    gone = lines.join(drop.hint("merge"), ["h1", "h2"]).where("_id < _last").groupBy("_id", "_same").agg(F.sort_array(F.collect_set("_at")).alias("_gone"))
    # The row travels as a struct, so that no column of the table clashes with one of the operator's.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("_row") if len(docs.columns) > 1 else F.struct(F.lit(0)).alias("_row"), text.alias("_text"), least.alias("_id"), F.xxhash64(text).alias("_same"))
    joined = whole.join(gone.hint("merge"), ["_id", "_same"], "left").withColumn("_lines", F.split("_text", "\n"))
    # The stretches between dropped positions, in order: linear in the number of lines.
    edges = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_lines")))
    between = F.flatten(F.transform(F.sequence(F.lit(1), F.size("_gone") + 1), lambda i: F.slice("_lines", F.element_at("_edges", i) + 2, F.element_at("_edges", i + 1) - F.element_at("_edges", i) - 1)))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(between, "\n"))
    out = joined.withColumn("_edges", F.when(F.col("_gone").isNotNull(), edges)).withColumn("_kept", kept)
    return out.select(
        *(F.col("_kept").alias(text_col) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")),
        F.size("_lines").cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """The query's columns, from the operator's texts."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT doc_id, text, line, pos,
             translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
d AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE d.key IS NOT NULL AND doc_id < last) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT (d.key IS NOT NULL AND doc_id < last)), '')) AS kept_sha256
FROM k LEFT JOIN d ON k.key = d.key GROUP BY doc_id, text
"""
