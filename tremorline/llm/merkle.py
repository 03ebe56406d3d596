"""Document fingerprints: Merkle trees over the sections and paragraphs of a text.

Sections are divided by an empty line, paragraphs by a line break, and paragraphs into
pieces of up to ``WORDS`` words. A node's hash is the SHA-256 of its children's hashes,
so equal roots mean equal texts. A fingerprint is text of this form, hashes in hex:

    root/section:paragraph piece piece;paragraph piece/section:paragraph piece

Only the root is kept whole; the branches (16, 12 and 8 digits) serve to find where two
texts differ. The likeness of two fingerprints is the Dice coefficient of their sets of
pieces, and 1 for equal roots.

Everything is an expression of Spark SQL; no Python runs on executors.

Defined cases: a null text is empty; an empty text's fingerprint has one section and one
paragraph without pieces; very long words count as several words. Rows that repeat one
id and text are one document for the order, and each gets its result; a null id comes
first in it. With one document, the next one is itself. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import running_start, written

#: Words in a piece, and characters after which a word counts as another one.
WORDS = 4
LONG_WORD = 24
SECTION_DIGITS, PARAGRAPH_DIGITS, PIECE_DIGITS = 16, 12, 8
# Covers a paragraph from end to end: words with the blanks after them, or blanks alone.
_PIECE = rf"(?:[^ ]{{1,{LONG_WORD}}}+ *+){{1,{WORDS}}}+| ++"


# Stands for a null id, below all others.
_ID, _NO_ID = "decimal(20,0)", str(-(1 << 63) - 1)


def _sha(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""

    def paragraph(text: Column) -> Column:
        hashes = F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: F.sha2(p, 256))
        short = F.transform(hashes, lambda h: F.left(h, F.lit(PIECE_DIGITS)))
        return F.struct(_sha(hashes).alias("hash"), F.concat_ws(" ", short).alias("leaves"))

    def section(text: Column) -> Column:
        paragraphs = F.transform(F.split(text, "\n"), paragraph)
        # A transform over a transform's result would compute it once for each use.
        return F.struct(
            _sha(F.transform(paragraphs, lambda p: p["hash"])).alias("hash"),
            F.array_join(
                F.transform(
                    paragraphs,
                    lambda p: F.concat_ws(" ", F.left(p["hash"], F.lit(PARAGRAPH_DIGITS)), p["leaves"]),
                ),
                ";",
            ).alias("branches"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), section)


def _assembled(sections: str) -> Column:
    parts = F.transform(
        sections,
        lambda s: F.concat_ws(":", F.left(s["hash"], F.lit(SECTION_DIGITS)), s["branches"]),
    )
    return F.concat_ws("/", _sha(F.transform(sections, lambda s: s["hash"])), F.array_join(parts, "/"))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of column ``text`` as column ``name``."""
    rows = rows.withColumn("_sections", fingerprint(F.col(text)))
    return rows.withColumn(name, _assembled("_sections")).drop("_sections")


def pieces_of(fingerprint: Column) -> Column:
    """The distinct piece hashes of a fingerprint."""
    parts = F.split(fingerprint, "[/:; ]")
    return F.array_distinct(F.filter(parts, lambda h: F.length(h) == PIECE_DIGITS))


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, from 0 to 1."""
    mine, others = pieces_of(a), pieces_of(b)
    both = F.size(mine) + F.size(others)
    shared = 2.0 * F.size(F.array_intersect(mine, others)) / F.greatest(both, F.lit(1))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), 1.0).otherwise(shared)


def changed_branches(a: Column, b: Column) -> Column:
    """Paragraphs of ``a``, as (section, paragraph, hash), that ``b`` does not have."""
    hashes = F.filter(F.split(b, "[/:; ]"), lambda h: F.length(h) == PARAGRAPH_DIGITS)
    sections = F.slice(F.split(a, "/"), 2, 1 << 30)
    each = F.transform(
        sections,
        lambda s, i: F.transform(
            F.split(F.element_at(F.split(s, ":"), 2), ";"),
            lambda p, j: F.struct(
                i.alias("section"), j.alias("paragraph"), F.left(p, F.lit(PARAGRAPH_DIGITS)).alias("hash")
            ),
        ),
    )
    return F.filter(F.flatten(each), lambda p: ~F.array_contains(hashes, p["hash"]))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, and of the document after it in the order of ids
    next_fingerprint and next_part: as many of its first characters as half of the text has.

    Only ids, hashes and lengths are put in order. A text moves once, to meet what the next
    document sends to it: its fingerprint and the part that is asked for.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Null ids come first. Nothing but these three columns is dealt out, for both sides.
    rid = F.coalesce(F.col("doc_id").cast(_ID), F.lit(_NO_ID).cast(_ID))
    keyed = docs.select(rid.alias("rid"), text.alias("text")).withColumn("key", F.xxhash64("text"))

    ids = keyed.groupBy("rid", "key").agg(
        F.max(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("copies"), F.lit(1).alias("one")
    )
    ids = ids.withColumn("all", F.lit(0))
    order = written(running_start(ids, ["all"], ["rid", "key"], "one").drop("one", "all"), "order")
    n, repeated = order.agg(F.count(F.lit(1)), F.max("copies")).first()
    asked = order.select(
        ((F.col("start") + 1) % F.lit(max(n, 1))).alias("start"),
        F.col("rid").alias("to_rid"), F.col("key").alias("to_key"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("half"),
    )
    asked = written(order.select("start", "rid", "key", "copies").join(asked, "start").drop("start"), "asked")

    def sent(asked: DataFrame) -> DataFrame:
        rows = keyed.join(asked, ["rid", "key"])
        rows = rows.select("to_rid", "to_key", F.left("text", F.col("half")).alias("next_part"), "text")
        return with_fingerprint(rows, "text", "next_fingerprint").drop("text")

    parts = sent(asked.where("copies = 1")) if (repeated or 0) > 1 else sent(asked)
    if (repeated or 0) > 1:
        # Rows that repeat an id and a text send the same to the same document.
        parts = parts.union(sent(asked.where("copies > 1")).dropDuplicates(["to_rid", "to_key"]))
    parts = parts.withColumnsRenamed({"to_rid": "rid", "to_key": "key"})
    doc_id = F.when(F.col("rid") != F.lit(_NO_ID).cast(_ID), F.col("rid").cast("long"))
    return keyed.join(parts, ["rid", "key"]).select(
        doc_id.alias("doc_id"), "text", F.length("text").cast("long").alias("n_chars"), "next_part", "next_fingerprint"
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and what they are like.

    The edited text has the second half (rounded down) of the text's characters replaced
    by as many of the next document's first ones.
    """
    rows = with_next(docs)
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left(F.col("text"), kept), "next_part"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows, "text", "fingerprint")
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
