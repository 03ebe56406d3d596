"""The queries of this subpackage, with their production parameters, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.llm import (
    backoff,
    chat,
    concatenation,
    jaccard,
    language,
    merkle,
    mixing,
    neighbours,
    packing,
    quality,
    repair,
    repeats,
    toxicity,
)
from tremorline.llm.common import WORD, table, word_list


def tokenizer_path() -> str:
    """The public vocabulary file that the packing query tokenizes with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer_path() -> str:
    """The public byte-level vocabulary file that the concatenating query tokenizes with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


def op2_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(table(spark, sf_dir, "documents"))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edits(table(spark, sf_dir, "documents"))


def op6_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_transcript_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op10_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth text, by the hash of its id, goes round from one word on."""
    turn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(turn / 10)

    def around(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        of = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int")),
        )
        return F.array_join(of, " ")

    # The one-element list keeps the words from being split again for each place.
    changed = F.get(F.transform(F.array(word_list(F.col("text"))), around), F.lit(0))
    chosen = (turn % 10 == 0) & F.col("text").rlike(WORD)
    return docs.withColumn("text", F.when(chosen, changed).otherwise(F.col("text")))


def op11_suffix_automaton_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.find_runs(with_planted_repeats(docs))
    longest = F.sort_array(
        F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    )
    best = F.get(longest, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["col1"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-1000 * best["col1"] / best["period"]).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of conversations, damaged as the hash of id and turn says."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    )
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = rows.withColumn("_kind", kind).where("_kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("_kind") == 1, "")
        .when(F.col("_kind") == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digests(turns: DataFrame) -> DataFrame:
    """conv and repaired_sha256 of the turns' ``role:text``, joined by line breaks. Turns of a
    conversation go through the hash in order, a batch at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != held:
                    if state:
                        done.append((held, state.hexdigest()))
                    held, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield made(done)
        yield made([(held, state.hexdigest())] if state else [])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 2
        arrays = [pa.array(column, pa.string()) for column in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["conv", "repaired_sha256"])

    ordered = turns.repartition("conv").sortWithinPartitions("conv", "position")
    lines = ordered.select("conv", F.concat_ws(":", "role", "text").alias("line"))
    return lines.mapInArrow(digest, "conv string, repaired_sha256 string")


def op12_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    summary, turns = repair.repair(with_damage(rows))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select("conv_id").distinct().withColumn("conv", repair.key_of(F.col("conv_id")))
    found = every.join(summary, "conv", "left").join(_digests(turns), "conv", "left")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concatenation.pack(table(spark, sf_dir, "documents"), byte_tokenizer_path())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_collision_counting,
        op2_backoff_automaton,
        op3_pattern_packing,
        op4_attention_quality,
        op5_merkle_fingerprints,
        op6_rank_order_language,
        op7_curriculum_mix,
        op8_recurrent_toxicity,
        op9_transcript_roles,
        op10_size_aware_join,
        op11_suffix_automaton_runs,
        op12_interval_repair,
        op13_concatenate_and_cut,
        pipeline,
    )
}

_TREE = """
list_transform(string_split({text}, chr(10) || chr(10)), lambda s:
  list_transform(string_split(s, chr(10)), lambda p:
    list_transform(regexp_extract_all(p, '(?:[^ ]{{1,24}} *){{1,4}}| +'), lambda w: sha256(w))))
"""
_PRINT = """
sha256(array_to_string(list_transform({tree}, lambda s:
  sha256(array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, ''))), ''))), ''))
|| '/' || array_to_string(list_transform({tree}, lambda s:
  substr(sha256(array_to_string(list_transform(s, lambda p: sha256(array_to_string(p, ''))), '')), 1, 16)
  || ':' || array_to_string(list_transform(s, lambda p:
    array_to_string(list_prepend(substr(sha256(array_to_string(p, '')), 1, 12),
      list_transform(p, lambda h: substr(h, 1, 8))), ' ') || CASE WHEN len(p) = 0 THEN ' ' ELSE '' END), ';')), '/')
"""
_PIECES = "list_distinct(list_filter(string_split_regex({f}, '[/:; ]'), lambda h: len(h) = 8))"
_LIKE = """
CASE WHEN substr({a}, 1, 64) = substr({b}, 1, 64) THEN 1.0
ELSE 2.0 * len(list_intersect({pa}, {pb})) / greatest(len({pa}) + len({pb}), 1) END
"""


def _like(a: str, b: str) -> str:
    return _LIKE.format(a=a, b=b, pa=_PIECES.format(f=a), pb=_PIECES.format(f=b))


_MERKLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents
), n AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM d
), e AS (
  SELECT *, substr(text, 1, n_chars - n_chars // 2) || substr(next_text, 1, n_chars // 2) AS edited FROM n
), t AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_TREE.format(text="text")} AS own,
    {_TREE.format(text="edited")} AS changed, {_TREE.format(text="next_text")} AS next_one FROM e
), f AS (
  SELECT doc_id, n_chars, edited_sha256, {_PRINT.format(tree="own")} AS fingerprint,
    {_PRINT.format(tree="changed")} AS edited_fingerprint, {_PRINT.format(tree="next_one")} AS next_fingerprint FROM t
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_like("fingerprint", "edited_fingerprint")} AS near_edited,
  {_like("fingerprint", "next_fingerprint")} AS near_next
FROM f
"""

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM w, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS g(i) WHERE len(words) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a
)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# crc32 of a text, bit by bit: DuckDB has none.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''),
  lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b:
  list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""

# Equal groups of six words make islands of words that repeat at one distance.
_RUNS_SQL = rf"""
WITH h AS (
  SELECT doc_id, {_CRC32.format(text="CAST(doc_id AS VARCHAR)")} AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), p AS (
  SELECT *, len(words) AS n, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM h
), d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
    ELSE words END AS words FROM p
), g AS (
  SELECT doc_id, x, array_to_string(words[x + 1:x + 6], ' ') AS gram FROM d, unnest(range(n - 5)) AS t(x)
), e AS (
  SELECT a.doc_id, a.x, b.x - a.x AS q FROM g a JOIN g b
  ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.gram = b.gram AND a.x < b.x
), i AS (
  SELECT doc_id, q, x, x - row_number() OVER (PARTITION BY doc_id, q ORDER BY x) AS island FROM e
), c AS (
  SELECT doc_id, q, min(x) AS s, max(x) + q + 5 AS e FROM i GROUP BY doc_id, q, island
  HAVING max(x) + q + 6 - min(x) >= greatest(12, 2 * q)
), r AS (
  SELECT doc_id, s, e - s + 1 AS l, q FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c o WHERE o.doc_id IS NOT DISTINCT FROM c.doc_id AND o.q < c.q AND o.s <= c.s AND o.e >= c.e)
), f AS (
  SELECT doc_id, count(*) AS n_runs, list([-l, s, q] ORDER BY [-l, s, q])[1] AS best,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    list({{'low': s + q, 'high': s + l}}) AS gone FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period,
  (-1000 * best[1]) // best[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(list_transform(list_filter(range(n),
    lambda i: len(list_filter(gone, lambda w: i >= w.low AND i < w.high)) = 0), lambda i: words[i + 1]), ' ') END)
    AS collapsed_sha256
FROM d LEFT JOIN f ON d.doc_id IS NOT DISTINCT FROM f.doc_id
"""

ORACLE: dict[str, str] = {
    "op11_suffix_automaton_runs": _RUNS_SQL,
    "op5_merkle_fingerprints": _MERKLE_SQL,
    "op10_size_aware_join": _JACCARD_SQL,
}
