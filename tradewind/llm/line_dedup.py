"""Drop lines that many documents share, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import LOWER, UPPER, fresh
from tradewind.session import stage

#: ``\x20`` and ``\x09`` to ``\x0D``
BLANKS = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    """The lines of a text; one empty line for a null or empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column, min_chars: int) -> Column:
    """Two 64-bit hashes of the normalised line; null below ``min_chars`` code points."""
    bare = F.btrim(line, F.lit(BLANKS))
    low = F.translate(bare, UPPER, LOWER)
    key = F.struct(F.xxhash64(low).alias("a"), F.xxhash64(F.lit(20), low).alias("b"))
    return F.when(F.char_length(bare) >= min_chars, key)


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                      name: str = "line_dedup") -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``; adds n_lines and n_dropped.

    A line counts by its key: blanks stripped at both ends, A-Z lower-cased. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines
    except in the largest ``doc_id`` that holds them. Keys are compared by 128 bits of hash.

    * Null and empty texts are one empty line; the text comes back as an empty string.
    * Rows with the same ``doc_id`` count as one document, each with its own lines;
      rows without ``doc_id`` neither count nor lose lines.
    * Other columns pass through; an added column whose name is taken gets a ``_`` suffix.

    Lines are counted after one row per (key, document), and the counts are summed before
    they meet, so a line in every document is no hot key. Texts move once, on ``doc_id``.
    """
    n_lines, n_dropped, all_lines, gone, ident = (
        fresh(docs, x) for x in ("n_lines", "n_dropped", "_lines", "_gone", "_id"))
    held = (docs.where("doc_id is not null")
            .select(F.col("doc_id").alias("d"), F.posexplode(lines(F.col("text"))).alias("p", "l"))
            .select("d", "p", line_key(F.col("l"), min_chars).alias("k")).where("k is not null")
            .select("d", "p", "k.a", "k.b"))
    held = stage(held, f"{name}_held")
    shared = (held.select("a", "b", "d").distinct().groupBy("a", "b")
              .agg(F.count("*").alias("n"), F.max("d").alias("keep"))
              .where(F.col("n") >= min_docs).drop("n"))
    # written, so that both sides of the join come straight out of a shuffle and a hot line can be split
    shared = stage(shared, f"{name}_shared")
    drops = (held.join(shared, ["a", "b"]).where("d <> keep")
             .groupBy(F.col("d").alias(ident)).agg(F.collect_list(F.struct("p", "a", "b")).alias(gone)))
    kept = _without(F.col(all_lines), F.col(gone), min_chars)
    out = (docs.join(drops, F.col("doc_id") == F.col(ident), "left")
           .withColumn(all_lines, lines(F.col("text"))))
    out = out.select(*[kept.alias(c) if c == "text" else F.col(c) for c in docs.columns],
                     F.size(all_lines).cast("long").alias(n_lines), F.size(kept).cast("long").alias(n_dropped))
    return (out.withColumn(n_dropped, F.col(n_lines) - F.col(n_dropped))
            .withColumn("text", F.array_join("text", "\n")))


def _without(all_lines: Column, gone: Column, min_chars: int) -> Column:
    """The lines whose position is not in ``gone``.

    The key is compared again at each position, as another row may have the same ``doc_id``.
    """
    here = F.filter(F.coalesce(gone, F.array()), lambda g: F.coalesce(
        line_key(F.get(all_lines, g.p), min_chars) == F.struct(g.a.alias("a"), g.b.alias("b")), F.lit(False)))
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.transform(here, lambda g: g.p))
    return F.transform(left, lambda i: F.get(all_lines, i))
