"""Line deduplication with DataFrame functions only: lines that many documents hold keep one place.

Lines are exploded, normalised and hashed; distinct documents are counted per hash; positions to drop are joined back
and the text is put together from what lies between them. Only hashes are exploded and shuffled, each text once.

Nulls: a null text is one empty line; rows with a null doc_id count as one document that sorts last.
Repeated rows: rows with the same doc_id count as one document, each row is returned once. Empty table: empty result.
Very long texts: one row each, linear in their lines. Other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import LAST, spread

BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case; other letters stay."""
    bare = F.btrim(line, F.lit(BLANK))
    folded = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(folded)


def drop_repeated_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows as ``row`` (a struct of the input's columns) with n_lines, n_dropped and kept_text.

    A line whose key has at least min_chars code points and is found in at least min_docs documents is dropped
    everywhere but in the largest doc_id that holds it.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                       F.coalesce(F.col("text"), F.lit("")).alias("body"))
    rows = rows.withColumn("th", F.xxhash64("body"))
    places = (rows.select("doc", "th", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
              .select("doc", "th", "pos", line_key(F.col("line")).alias("key"))
              .where(F.char_length("key") >= min_chars)
              .select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")))
    common = (places.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
              .groupBy("h1", "h2").agg(F.count("*").alias("holders"), F.max("doc").alias("keeper"))
              .where(F.col("holders") >= min_docs).select("h1", "h2", "keeper"))
    dropped = (places.join(spread(common), ["h1", "h2"]).where(F.col("doc") != F.col("keeper"))
               .groupBy("doc", "th").agg(F.array_sort(F.collect_set("pos")).alias("drop")))
    joined = rows.join(dropped, ["doc", "th"], "left")
    lines = F.split("body", "\n", -1)
    # The split text is bound once as x; what stays are the slices between dropped positions.
    ends = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size(lines)))
    kept = F.transform(F.array(F.struct(lines.alias("l"), ends.alias("e"))), lambda x: F.concat_ws("\n", F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("drop")),
        lambda i: F.slice(x["l"], F.get(x["e"], i) + 2, F.get(x["e"], i + 1) - F.get(x["e"], i) - 1)))))
    return joined.select(
        "row", F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("body")).otherwise(F.get(kept, F.lit(0))).alias("kept_text"))


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text, a row for each row of docs."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


DIGEST_SQL = r"""
WITH split_up AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split_up),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def without_repeated_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with text cut to what ``drop_repeated_lines`` keeps; n_chars, where there is one, follows. Null texts stay null."""
    kept = drop_repeated_lines(docs, min_chars=min_chars, min_docs=min_docs)
    fields = {f.name: f.dataType for f in docs.schema}
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text"))}
    if "n_chars" in fields:
        new["n_chars"] = F.when(changed, F.char_length("kept_text").cast(fields["n_chars"])).otherwise(F.col("row.n_chars"))
    return kept.select(*[(new[n] if n in new else F.col(f"row.`{n}`")).alias(n) for n in docs.columns])
