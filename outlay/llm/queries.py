"""Registered queries of the operators: op1 .. op13 and the pipeline, with oracle SQL where SQL can say it.

Each query applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit_packing, chat_format, content_sort, context_tree, curriculum_mix, feistel_shard, itq_dedup,
               merkle_manifest, prefix_trie, quality_rules, simhash_pivot, substring_dedup, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, d: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet").select(*columns)


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    rows = quality_rules.ledger(_read(spark, d, "documents", "doc_id", "text"))
    failed = ~quality_rules.verdict(quality_rules.BASE)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"),
                       (~failed & quality_rules.verdict(quality_rules.CURRENT)).alias("kept"),
                       "n_lines", "n_upper", "n_dup_words", "fail_bits",
                       F.lit(quality_rules.CURRENT.version).alias("policy_version"))


def quality_ablations(spark: SparkSession, d: str) -> DataFrame:
    """Per policy version and rule: documents kept, failing it, failing it alone, and kept without it."""
    return quality_rules.ablations(quality_rules.ledger(_read(spark, d, "documents", "doc_id", "text")))


LEDGER_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM t),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM win),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
             length(regexp_replace(text, '[^\p{Lu}]', '', 'g'))::BIGINT AS n_upper,
             (len(ws) - len(regexp_extract_all(array_to_string(list_distinct(ls), chr(10)), '[^\x20\x09-\x0D]+')))::BIGINT
               AS n_dup_words
      FROM w LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
             + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (10 * n_dup_lines > 3 * n_lines)::BIGINT
             + 16 * (5 * n_upper > 2 * word_chars)::BIGINT
             + 32 * (word_chars > 20 * n_words OR word_chars < 2 * n_words)::BIGINT
             + 64 * (10 * n_dup_words > 3 * n_words)::BIGINT AS fail_bits FROM m)
"""
OP1_SQL = LEDGER_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits % 4 <> 0 AS base_failed,
       fail_bits & 119 = 0 AS kept, n_lines, n_upper, n_dup_words, fail_bits, 3 AS policy_version FROM f
"""
ABLATIONS_SQL = LEDGER_SQL + """,
r AS (SELECT * FROM (VALUES (1, 'few_words'), (2, 'repeated_windows'), (4, 'symbols'), (8, 'repeated_lines'), (16, 'shouting'),
                            (32, 'word_length'), (64, 'repeated_line_words')) x(bit, rule)),
p AS (SELECT * FROM (VALUES (1, 'base', 3), (2, 'full', 63), (3, 'weighed', 119)) x(version, policy, mask))
SELECT version, policy, rule, count(*) FILTER (fail_bits & mask = 0) AS kept, count(*) FILTER (fail_bits & mask & bit <> 0) AS failing,
       count(*) FILTER (fail_bits & mask = bit) AS failing_alone,
       count(*) FILTER (fail_bits & mask IN (0, bit)) AS kept_without
FROM f JOIN p ON true JOIN r ON mask & bit <> 0 GROUP BY version, policy, rule
"""

SPOOF = r"\### Assistant: </turn> ok"


def op2_chat_format(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SPOOF).alias("text"))
    turns = chat_format.text_turns(rows.unionByName(extra))
    return chat_format.digest(chat_format.format_chats(turns))


OP2_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + length(role || text) - length(replace(role || text, '\', ''))
             + (length(role) - length(replace(role, '<|', ''))) / 2 + (length(text) - length(replace(text, '<|', ''))) / 2
             + 24 AS shown FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op3_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = substring_dedup.dedup(_read(spark, d, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
                      F.size("spans").alias("n_spans"))


OP3_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS g FROM s),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS lo FROM g) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM rep, (SELECT unnest(range(0, 13)) AS k)),
spans AS (SELECT doc_id, count(*) AS n_spans FROM gone g WHERE NOT EXISTS (
            SELECT 1 FROM gone o WHERE o.doc_id = g.doc_id AND o.p = g.p - 1) GROUP BY 1),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p)
         GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256, coalesce(n_spans, 0)::INT AS n_spans
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""


def op4_itq_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = itq_dedup.link(_read(spark, d, "embeddings", "vec_id", "embedding", "label"))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL
                       AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
                       AND len([c for c in embedding if c <> 0]) > 0),
e AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.x) = len(b.x)
      AND list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98),
reach(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u)
SELECT m.vec_id, (SELECT count(*) FROM e WHERE e.u = m.vec_id)::BIGINT AS n_links,
       least(m.vec_id, coalesce((SELECT min(v) FROM reach r WHERE r.u = m.vec_id), m.vec_id)) AS component_id,
       m.vec_id = least(m.vec_id, coalesce((SELECT min(v) FROM reach r WHERE r.u = m.vec_id), m.vec_id)) AS kept
FROM embeddings m
"""


def op5_curriculum_mix(spark: SparkSession, d: str) -> DataFrame:
    rows = curriculum_mix.mix(_read(spark, d, "documents", "doc_id", "source", "text"))
    taken = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["words"])
    rows = rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                       F.round(F.get("parts", F.lit(0))["position"], 9).alias("position"))
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


OP5_SQL = r"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
k AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM s),
w AS (SELECT *, [3.0, 1.0, 2.0][class + 1]::DOUBLE AS w, (2 * source_size)::DOUBLE AS cap FROM k),
o AS (SELECT *, row_number() OVER z AS rank, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
             coalesce(sum(cap) OVER (z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
             sum(w) OVER (z ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
      FROM w WINDOW z AS (ORDER BY cap / w, source NULLS LAST)),
l AS (SELECT *, (budget - given) / w_left AS level FROM o),
f AS (SELECT arg_min(level, rank) AS level, min(rank) AS rank FROM l WHERE level * w <= cap),
p AS (SELECT l.source, source_size, class, CASE WHEN l.rank >= f.rank THEN least(f.level * w, cap) ELSE cap END AS target
      FROM l LEFT JOIN f ON true),
c AS (SELECT t.doc_id, t.size, p.source_size, p.target, p.class, round(p.target)::BIGINT AS demand,
             (sum(size) OVER (PARTITION BY t.source ORDER BY h, doc_id NULLS FIRST, size
                              ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
      FROM t JOIN p ON t.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, least(greatest(demand - before, 0), size) AS first,
             least(greatest(demand - before - source_size, 0), size) AS second,
             least(before::DOUBLE / greatest(demand, 1), 1.0) AS sh FROM c)
SELECT doc_id, size, source_size, target, (first + second)::BIGINT AS taken,
       CASE WHEN first = 0 THEN NULL WHEN sh = 0 THEN 0.0
            ELSE round(least(CASE class WHEN 0 THEN 2 * sh / (1.5 + sqrt(greatest(2.25 - 2 * sh, 0)))
                                        WHEN 1 THEN 2 * sh / 2
                                        ELSE 2 * sh / (0.5 + sqrt(0.25 + 2 * sh)) END, 1.0), 9) END AS position
FROM r
"""


def op6_context_tree(spark: SparkSession, d: str) -> DataFrame:
    return context_tree.score(_read(spark, d, "documents", "doc_id", "text"))


def op7_feistel_shard(spark: SparkSession, d: str) -> DataFrame:
    out = feistel_shard.assign(_read(spark, d, "documents", "doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_no", "position")


def op8_simhash_pivot(spark: SparkSession, d: str) -> DataFrame:
    out = simhash_pivot.near_duplicates(_read(spark, d, "documents", "doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return best_fit_packing.pack(_read(spark, d, "documents", "doc_id", "source", "text"))


def op10_warc(spark: SparkSession, d: str) -> DataFrame:
    out = warc.round_trip(_read(spark, d, "pages", "page_id", "url", "html"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, h, octet_length(encode(html))::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top,
             array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111',
               4 * strpos('0123456789abcdef', substr(h, i + 1, 1))::INT - 3, 4) for i in range(40)], '') AS bits FROM p)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i::INT + 1, 1)::INT
         + 8 * substr(bits, 5 * i::INT + 2, 1)::INT + 4 * substr(bits, 5 * i::INT + 3, 1)::INT
         + 2 * substr(bits, 5 * i::INT + 4, 1)::INT + substr(bits, 5 * i::INT + 5, 1)::INT, 1) for i in range(32)], '')
         AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM b
"""


def op11_content_sort(spark: SparkSession, d: str) -> DataFrame:
    return content_sort.dedup(_read(spark, d, "documents", "doc_id", "text"), keep="largest")


OP11_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
           FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY x)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g ON t.x = g.x
"""

#: Unsigned CRC-32 of a VARCHAR of ASCII characters: the register takes a byte, then eight shifts.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
  for c in string_split({0}, '')])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
  WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""


def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = _read(spark, d, "documents", "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = lambda n: merkle_manifest.leaf_of(*map(F.col, ("doc_id", "source", "lang")), n, F.col("text"))
    honest = leaf(F.col("n_chars"))
    out = merkle_manifest.manifest(docs, "doc_id", "lang", honest, F.when(tampered, leaf(F.col("n_chars") + 1)))
    folded = merkle_manifest.fold(F.coalesce("claim", "leaf"), F.col("path"))
    return out.withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR END"


def _leaf_sql(n: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', n, 'text')))})"


OP12_SQL = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql('n_chars')} AS leaf,
       CASE WHEN {CRC32_SQL.format('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')}
       END AS claim FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
low(lv, grp, pos, h, n) AS (
  SELECT 0, grp, pos, leaf, count(*) OVER (PARTITION BY grp) FROM p
  UNION ALL
  SELECT * FROM (SELECT lv + 1, grp, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2)
                 FROM low WHERE n > 1 GROUP BY lv, grp, pos // 2)),
sub AS MATERIALIZED (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos FROM low WHERE n = 1),
up(lv, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT * FROM (SELECT lv + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2)
                 FROM up WHERE n > 1 GROUP BY lv, pos // 2)),
root AS (SELECT h FROM up WHERE n = 1),
steps AS MATERIALIZED (
  SELECT p.grp, p.pos, a.lv AS s, a.pos % 2 AS slot, coalesce(b.h, '') AS sib FROM p
  JOIN low a ON a.grp = p.grp AND a.pos = p.pos >> a.lv AND a.n > 1
  LEFT JOIN low b ON b.grp = a.grp AND b.lv = a.lv AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT p.grp, p.pos, 1000 + a.lv, a.pos % 2, coalesce(b.h, '') FROM p JOIN sub USING (grp)
  JOIN up a ON a.pos = sub.pos >> a.lv AND a.n > 1 LEFT JOIN up b ON b.lv = a.lv AND b.pos = xor(a.pos, 1)),
path AS (SELECT grp, pos, string_agg(sib, '' ORDER BY s) AS proof, list((slot::VARCHAR || sib) ORDER BY s) AS xs
         FROM steps GROUP BY grp, pos),
o AS (SELECT p.doc_id, p.leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_prepend(claim, coalesce(xs, [])), lambda a, x: sha256(
               CASE WHEN x[1] = '1' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
      FROM p JOIN sub ON sub.grp = p.grp LEFT JOIN path ON path.grp = p.grp AND path.pos = p.pos CROSS JOIN root)
SELECT *, folded_root = root AS verified FROM o
"""


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    rows = prefix_trie.turns(_read(spark, d, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie.trie(prefix_trie.grafted(rows, group=5, heads=9))


OP13_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
           WHERE conv_id IS NOT NULL),
o AS MATERIALIZED (SELECT conv_id, octet_length(encode(text)) AS size,
            sha256(octet_length(encode(role))::VARCHAR || ':' || role || text) AS x,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
c AS MATERIALIZED (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {CRC32_SQL.format('conv_id::VARCHAR')} % 9 AS h FROM o),
r AS (SELECT c.conv_id, 0 AS own, o.pos, x, size FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
      UNION ALL SELECT c.conv_id, 1, o.pos, x, size FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
s AS (SELECT conv_id, x, size, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d FROM r),
k AS MATERIALIZED (SELECT conv_id, d, size, sha256(string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY d)) AS k,
            count(*) OVER (PARTITION BY conv_id) AS len FROM s
      UNION ALL SELECT c.conv_id, 0, 0, '', (SELECT count(*) FROM s WHERE s.conv_id = c.conv_id) FROM c),
n AS MATERIALIZED (SELECT k, min(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, max(len) = min(d) AS leaf,
            (count(*) - 1) * max(size) AS saved,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends_sha256
      FROM k GROUP BY k),
p AS (SELECT n.k, q.k AS up FROM n JOIN k q ON q.conv_id = n.conv_id AND q.d = n.d - 1),
w AS (SELECT q.k, sum(n.leaf::INT) AS n_leaves, sum(n.saved) AS saved_tokens FROM n JOIN k q ON q.conv_id = n.conv_id AND q.d <= n.d
      GROUP BY q.k)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       (SELECT count(*) FROM p x WHERE x.up = n.k)::BIGINT AS n_children, w.n_leaves::BIGINT AS n_leaves,
       w.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN w ON w.k = n.k LEFT JOIN p ON p.k = n.k LEFT JOIN n u ON u.k = p.up
"""


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_rules, op2_chat_format, op3_substring_dedup, op4_itq_dedup, op5_curriculum_mix, op6_context_tree,
    op7_feistel_shard, op8_simhash_pivot, op9_best_fit_packing, op10_warc, op11_content_sort, op12_merkle_manifest,
    op13_prefix_trie, quality_ablations, pipeline)}
ORACLE: dict[str, str] = {"op1_quality_rules": OP1_SQL, "quality_ablations": ABLATIONS_SQL, "op2_chat_format": OP2_SQL, "op3_substring_dedup": OP3_SQL,
                          "op4_itq_dedup": OP4_SQL, "op5_curriculum_mix": OP5_SQL, "op10_warc": OP10_SQL,
                          "op11_content_sort": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_prefix_trie": OP13_SQL}
