"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kcflow.llm.chat import format_chats
from kcflow.llm.common import documents, id_back, id_key
from kcflow.llm.conversation_repair import damaged, repair_turns, summaries
from kcflow.llm.decontaminate import contaminated
from kcflow.llm.jaccard_join import similar_groups
from kcflow.llm.langid import identify
from kcflow.llm.licenses import scan_licences
from kcflow.llm.line_dedup import dedup_lines
from kcflow.llm.mixing import plan_mix, taken
from kcflow.llm.packing import pack
from kcflow.llm.prefix_trie import build_trie, rebuilt, turn_symbols
from kcflow.llm.quality import judge_quality
from kcflow.llm.registry import register
from kcflow.llm.sharding import assign_shards
from kcflow.llm.suffix_dedup import dedup_substrings
from kcflow.session import ensure_checkpoint_dir
from kcflow.sources.tables import table

# DuckDB counts code points with length(); trim() takes the characters to strip.
_SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
first_doc AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
flagged AS (
  SELECT keyed.*, coalesce(doc_id > first_id, false) AS gone
  FROM keyed LEFT JOIN first_doc USING (k))
SELECT doc_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM flagged GROUP BY doc_id
"""


@register("op1_line_dedup", LINE_DEDUP_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept per document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped",
                                    F.sha2(kept, 256).alias("kept_sha256"))


@register("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shards by jump consistent hashing of doc_id."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return assign_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


CHAT_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                               text NULLS FIRST) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n,
         coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)) AS body
  FROM turns),
prefixes AS (
  SELECT conv_id, pos, n, string_agg(body, chr(3)) OVER (PARTITION BY conv_id ORDER BY pos) AS p
  FROM numbered),
own AS (SELECT p, n, min(conv_id) AS conv_id FROM prefixes WHERE pos = n GROUP BY p, n),
kept AS (
  SELECT conv_id, n FROM own
  WHERE NOT EXISTS (SELECT 1 FROM prefixes q WHERE q.p = own.p AND q.pos = own.n AND q.pos < q.n))
SELECT numbered.conv_id, CAST((pos - 1) // 512 AS INTEGER) AS part, max(kept.n) AS n_turns,
       count(*) AS turns,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
                  || '<|im_end|>', chr(10) ORDER BY pos) AS text
FROM numbered JOIN kept USING (conv_id) GROUP BY 1, 2
"""


@register("op5_chat_formatting", CHAT_SQL)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered conversations that no other logged conversation continues."""
    ensure_checkpoint_dir(spark)
    return format_chats(table(spark, sf_dir, "conversations"))


@register("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted rules and compression bands per document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return judge_quality(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio", "bad_chunks")


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that nothing is learned from (a null id belongs to no fold)."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2,
                      F.lit(False))


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify(docs, ~held_out()).select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes kept per document once strings of 50 bytes of earlier documents are gone."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_substrings(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans",
                                         F.sha2("kept", 256).alias("kept_sha256"))


DECONTAMINATION_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark),
items AS (SELECT item_id, w, len(w) AS size FROM item_words WHERE len(w) >= 5),
item_shingles AS (
  SELECT item_id, size, i AS ofs, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, size, w, unnest(range(1, size - 3)) AS i FROM items)),
doc_shingles AS (
  SELECT doc_id, len(w) AS n, i AS pos, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)),
windows AS (
  SELECT DISTINCT doc_id, item_id, size, n,
         greatest(0, least(pos - ofs, n - size)) AS start
  FROM doc_shingles JOIN item_shingles USING (s)),
in_window AS (
  SELECT v.doc_id, v.item_id, v.start, v.size, d.s, count(*) AS weight
  FROM windows v JOIN doc_shingles d
    ON d.doc_id = v.doc_id AND d.pos > v.start AND d.pos <= v.start + v.size - 4
  GROUP BY ALL),
item_weights AS (SELECT item_id, s, count(*) AS item_weight FROM item_shingles GROUP BY ALL),
scored AS (
  SELECT doc_id, item_id, start, x.size, sum(weight) AS n,
         sum(least(weight, coalesce(item_weight, 0))) AS least_sum
  FROM in_window x LEFT JOIN item_weights USING (item_id, s) GROUP BY ALL),
judged AS (
  SELECT doc_id, item_id, start, size, least_sum / (n + (size - 4) - least_sum) AS similarity,
         row_number() OVER (PARTITION BY doc_id, item_id
                            ORDER BY least_sum / (n + (size - 4) - least_sum) DESC, start) AS best
  FROM scored)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start,
       CAST(round(similarity, 6) AS DOUBLE) AS similarity
FROM judged WHERE best = 1 AND similarity >= 0.75
"""


@register("op2_decontamination", DECONTAMINATION_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best window of each."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "start", F.round("similarity", 6).alias("similarity"))


JACCARD_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.node)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(node) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@register("op4_jaccard_join", JACCARD_SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return similar_groups(docs).select("row.doc_id", "n_shingles",
                                       id_back("component").alias("component_id"))


@register("op9_license_scans")
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document; its path is source/lang/doc_id."""
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.concat_ws("/", "source", "lang", "doc_id").alias("path"))
    return scan_licences(docs).select(
        "row.doc_id", "licence", "cosine", "basis", F.col("source").alias("licence_path"))


@register("op11_source_mixing")
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % takes of every document, sources weighing 3, 1, 2 by turns."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return taken(plan_mix(docs))


@register("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage by a checksum."""
    ensure_checkpoint_dir(spark)
    turns = table(spark, sf_dir, "conversations")
    repaired = summaries(repair_turns(damaged(turns))).withColumnRenamed("conv_id", "_conv")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    convs = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = convs.join(repaired, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return found.select(  # all turns may have been dropped
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.encode(F.lit(""), "UTF-8"), 256))
        .alias("repaired_sha256"))


# DuckDB has no crc32(): bytes and shifts of the decimal id, one after the other.
TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            coalesce(text, '')) AS d
  FROM conversations),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''),
           lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                             ELSE c >> 1 END), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
unnumbered AS (
  SELECT c.conv_id, 0 AS part, t.d AS p, role, text FROM convs c JOIN turns t
    ON t.conv_id = c.base AND t.d <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.d, role, text FROM convs c JOIN turns t
    ON t.conv_id = c.conv_id AND t.d > c.h
  UNION ALL SELECT conv_id, 1, d, role, text FROM turns WHERE conv_id IS NULL),
numbered AS (
  SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d,
         role || chr(2) || text AS body
  FROM unnumbered),
rows AS (
  SELECT conv_id, d, length(text) AS chars,
         string_agg(body, chr(3)) OVER (PARTITION BY conv_id ORDER BY d) AS node,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM numbered
  UNION ALL
  SELECT DISTINCT conv_id, 0, 0, '', (SELECT count(*) FROM numbered m
                                      WHERE m.conv_id IS NOT DISTINCT FROM c.conv_id)
  FROM conversations c),
nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends
  FROM rows GROUP BY d, node),
lines AS (
  SELECT DISTINCT u.d, u.node, l.d AS below_d, l.node AS below
  FROM rows u JOIN rows l ON u.conv_id IS NOT DISTINCT FROM l.conv_id AND u.d <= l.d),
children AS (
  SELECT d, node, count(*) AS n FROM lines WHERE below_d = d + 1 GROUP BY d, node)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, any_value(p.conv_id) AS parent_conv_id,
       any_value(v.n_convs) AS n_convs, coalesce(any_value(own.n), 0) AS n_children,
       count(*) FILTER (WHERE c.n IS NULL) AS n_leaves,
       CAST(sum((w.n_convs - 1) * w.chars) AS BIGINT) AS saved_tokens,
       sha256(coalesce(any_value(v.ends), '')) AS ends_sha256
FROM nodes v JOIN lines l ON l.d = v.d AND l.node = v.node
JOIN nodes w ON w.d = l.below_d AND w.node = l.below
LEFT JOIN children c ON c.d = w.d AND c.node = w.node
LEFT JOIN children own ON own.d = v.d AND own.node = v.node
LEFT JOIN lines up ON up.below_d = v.d AND up.below = v.node AND up.d = v.d - 1
LEFT JOIN nodes p ON p.d = up.d AND p.node = up.node
GROUP BY v.conv_id, v.d, v.node
"""


@register("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that begin like others."""
    ensure_checkpoint_dir(spark)
    turns = table(spark, sf_dir, "conversations")
    convs = turns.select(id_key("conv_id").alias("conv")).distinct()
    return build_trie(rebuilt(turn_symbols(turns), convs), convs)
