"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.llm.ann import nearest
from wharf.llm.chat import format_chat, read_back
from wharf.llm.langid import label, train
from wharf.llm.merkle import manifest, verified
from wharf.llm.mixing import mix
from wharf.llm.neardup import near_duplicates
from wharf.llm.packing import pack, pieces
from wharf.llm.quality import quality_rules
from wharf.llm.repair import audits, damage, digested, repaired
from wharf.llm.suffix_dedup import remove_repeats
from wharf.llm.token_counts import token_counts
from wharf.llm.toxicity import severity, train as train_toxicity
from wharf.llm.url_filter import FIXED_RULES, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file; it is on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return severity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "partition_bins", "partition_bound"]
    return pack(found).select(*columns)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label(docs.select("doc_id", "text"), train(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(FIXED_RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


# Fixed value: a text that says what marks turns and what escapes marks.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema)
    path = tokenizer_path("byte_bpe_50k.json")
    return read_back(format_chat(turns.unionByName(more), path), path)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(table(spark, sf_dir, "conversations"))
    found = digested(repaired(rows, audits(rows)))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = verified(manifest(table(spark, sf_dir, "documents"), other={"text": text}))
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select("doc_id", *digests, "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_repetition": op7_repetition,
    "op8_url_filter": op8_url_filter,
    "op9_minhash": op9_minhash,
    "op10_suffix_array": op10_suffix_array,
    "op11_chat": op11_chat,
    "op12_repair": op12_repair,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op8_url_filter": """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), q AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM p
), r(rv, rh, rp) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), m AS (
  SELECT q.page_id, q.host, q.path, rh || rp AS rule, rv,
    row_number() OVER (PARTITION BY q.page_id, q.host, q.path ORDER BY length(rh || rp) DESC) AS n
  FROM q LEFT JOIN r ON (q.host = rh OR ends_with(q.host, '.' || rh)) AND starts_with(q.path, rp)
)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM m WHERE n = 1
""",
    "op11_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), s AS (
  SELECT *, length(role) + length(text) + 14
    + len(regexp_extract_all(role || ' ' || text, '\\')) + len(regexp_extract_all(role || ' ' || text, '#'))
    - len(regexp_extract_all(role || ' ' || text, '#+')) + len(regexp_extract_all(role || ' ' || text, '<[/|]'))
    + len(regexp_extract_all(role, ': ')) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
""",
    "op12_repair": r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [ord(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS codes
  FROM conversations
), h AS (
  SELECT *, xor(list_reduce(codes, lambda s, b:
      list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(s, b)),
      4294967295::BIGINT), 4294967295) % 20 AS f
  FROM c
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE f <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged
), rows AS (
  SELECT conv_id, i, turn, role, text, role[1] AS ch,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM placed
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank,
    count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
    count(*) FILTER (WHERE i > 1 AND prev || ch NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows GROUP BY conv_id
), nxt(s, t, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
keep(s, ch, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(s, t, cost, letters, added) AS (
  SELECT s, s, 0, '', []::VARCHAR[] FROM nxt
  UNION ALL SELECT s, t, 3, 'I', [role || ':'] FROM nxt
  UNION ALL SELECT s, 3, 6, 'II', ['user:', 'assistant:'] FROM nxt WHERE s < 2
), dp AS (
  SELECT conv_id, n, 0::BIGINT AS i, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS rep FROM stats
  UNION ALL
  SELECT conv_id, n, i, s, cost, audit, rep FROM (
    SELECT d.conv_id, d.n, r.i, e.t AS s, d.cost + ins.cost + e.cost AS cost, d.audit || ins.letters || e.letter AS audit,
      list_concat(list_concat(d.rep, ins.added), e.added) AS rep,
      row_number() OVER (PARTITION BY d.conv_id, e.t ORDER BY d.cost + ins.cost + e.cost, d.audit || ins.letters || e.letter) AS best
    FROM dp d JOIN ins ON ins.s = d.s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1
    JOIN LATERAL (
      SELECT ins.t AS t, 4 AS cost, 'D' AS letter, []::VARCHAR[] AS added
      UNION ALL SELECT k.t, CASE WHEN r.fault = 3 THEN 3 ELSE 0 END, 'K', [r.role || ':' || r.text] FROM keep k WHERE k.s = ins.t AND k.ch = r.ch AND r.fault IN (0, 3)
      UNION ALL SELECT x.t, CASE WHEN r.fault = 3 THEN 6 ELSE 3 END, 'R', [x.role || ':' || r.text] FROM nxt x WHERE x.s = ins.t AND r.fault IN (0, 3)
    ) e ON true
  ) WHERE best = 1
), done AS (
  SELECT d.conv_id, d.cost + ins.cost AS cost, d.audit || ins.letters AS audit, list_concat(d.rep, ins.added) AS rep,
    row_number() OVER (PARTITION BY d.conv_id ORDER BY d.cost + ins.cost, d.audit || ins.letters) AS best
  FROM dp d JOIN ins ON ins.s = d.s WHERE d.i = d.n AND ins.t IN (0, 3)
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(rep, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id AND d.best = 1
""",
    "op13_merkle": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
    CASE WHEN xor(list_reduce([ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')], lambda s, b:
      list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(s, b)),
      4294967295::BIGINT), 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents
), l AS (
  SELECT doc_id, source,
    [CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END FOR x IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]] AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS t, CASE WHEN other IS NULL THEN '-' ELSE strlen(other) || ':' || other END AS o
  FROM d
), leaf AS (
  SELECT doc_id, source, sha256(array_to_string(head, '') || t) AS leaf, sha256(array_to_string(head, '') || o) AS other FROM l
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaf
), low AS (
  SELECT source, 0 AS lv, list(leaf ORDER BY r) AS nodes FROM numbered GROUP BY source
  UNION ALL
  SELECT source, lv + 1, [sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')) FOR i IN range(0, (len(nodes) + 2) // 3)] FROM low WHERE len(nodes) > 1
), sub AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r FROM low WHERE len(nodes) = 1
), high AS (
  SELECT 0 AS lv, list(subroot ORDER BY r) AS nodes FROM sub HAVING count(*) > 0
  UNION ALL
  SELECT lv + 1, [sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')) FOR i IN range(0, (len(nodes) + 2) // 3)] FROM high WHERE len(nodes) > 1
), tall AS (
  SELECT source, max(lv) AS h FROM low GROUP BY source
), steps AS (
  SELECT n.source, n.r, w.lv AS lv, (n.r // (3 ** w.lv)::BIGINT) AS p, w.nodes FROM numbered n JOIN low w ON w.source IS NOT DISTINCT FROM n.source AND len(w.nodes) > 1
  UNION ALL
  SELECT n.source, n.r, t.h + w.lv, (s.r // (3 ** w.lv)::BIGINT), w.nodes
  FROM numbered n JOIN sub s ON s.source IS NOT DISTINCT FROM n.source JOIN tall t ON t.source IS NOT DISTINCT FROM n.source JOIN high w ON len(w.nodes) > 1
), sides AS (
  SELECT source, r, lv, coalesce(array_to_string(nodes[p // 3 * 3 + 1 : p], ''), '') AS lft, coalesce(array_to_string(nodes[p + 2 : p // 3 * 3 + 3], ''), '') AS rgt FROM steps
), ways AS (
  SELECT source, r, list(lft ORDER BY lv) AS ls, list(rgt ORDER BY lv) AS rs, sha256(string_agg(lft || rgt, '' ORDER BY lv)) AS proof FROM sides GROUP BY source, r
), fold AS (
  SELECT n.source, n.r, 0 AS lv, n.other AS digest, coalesce(w.ls, []) AS ls, coalesce(w.rs, []) AS rs
  FROM numbered n LEFT JOIN ways w ON w.source IS NOT DISTINCT FROM n.source AND w.r = n.r
  UNION ALL
  SELECT source, r, lv + 1, sha256(ls[lv + 1] || digest || rs[lv + 1]), ls, rs FROM fold WHERE lv < len(ls)
), folded AS (
  SELECT source, r, digest FROM fold WHERE lv = len(ls)
)
SELECT n.doc_id, n.leaf, s.subroot, t.root, coalesce(w.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = t.root AS verified
FROM numbered n JOIN sub s ON s.source IS NOT DISTINCT FROM n.source
JOIN folded f ON f.source IS NOT DISTINCT FROM n.source AND f.r = n.r
LEFT JOIN ways w ON w.source IS NOT DISTINCT FROM n.source AND w.r = n.r
CROSS JOIN (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1) t
""",
}
