"""One registered query per operator: it applies the operator to its whole
table with production parameters and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_dir
from . import bpe, interactions, lm, merkle, neardup, packing, quality, shards, simhash, spans, topk, toxicity, urls
from .common import crc_mod, read

TOKENIZERS = None  # folder of the tokenizer files; None: where public_tokenizers has them


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {}
ORACLE: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    if fn is None:
        return lambda f: query(f, sql=sql)
    QUERIES[fn.__name__] = fn
    if sql is not None:
        ORACLE[fn.__name__] = sql
    return fn


@query
def op1_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(crc_mod("doc_id", 5) != 0))
    return toxicity.score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_substring_dedup(spark, sf_dir):
    return spans.dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("dedup_info.sentences").alias("n_sentences"), F.col("dedup_info.removed").alias("n_removed"),
        F.col("dedup_info.cuts").alias("cuts"))


@query
def op3_token_shards(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    path = shared_dir(spark, "op3-shards")
    shards.write_shards(docs, path, tokenizer_path("word_bpe_49k.json"), "word", end_id=1)
    return shards.read_shards(spark, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op4_bpe(spark, sf_dir):
    out = bpe.encode_decode(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op7_packing(spark, sf_dir):
    out = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op9_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(sql="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT a.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) AS INTEGER) AS rank,
       b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
WHERE a.vec_id % 50 = 0
QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) <= 5""")
def op5_topk(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"), k=5)


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@query(sql="""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
r AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
g AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
h AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k FROM r LEFT JOIN g USING (page_id) GROUP BY host),
parts AS (SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l FROM h),
two AS (SELECT *, array_to_string(l[-2:], '.') AS d2,
               array_to_string(l[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br') AS long FROM parts),
hs AS (SELECT host, n, k, CASE WHEN long THEN d2 ELSE l[-1] END AS suffix,
              CASE WHEN long THEN array_to_string(l[-3:], '.') ELSE d2 END AS domain FROM two),
ds AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hs GROUP BY suffix, domain),
ss AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM ds GROUP BY suffix),
g0 AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS m FROM ss),
s1 AS (SELECT suffix, n, k, m AS c FROM ss, g0),
w1 AS (SELECT coalesce(least(0.999, greatest(0.001, CASE WHEN sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) > 0 THEN
         (sum(CASE WHEN n > 0 THEN n * (k / n - c) ** 2 END) - sum(CASE WHEN n > 0 THEN c * (1 - c) END)) / sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) END)), 0.001) AS rho FROM s1),
p1 AS (SELECT suffix, (k + (1 - rho) / rho * c) / (n + (1 - rho) / rho) AS c FROM s1, w1),
s2 AS (SELECT suffix, domain, n, k, c FROM ds JOIN p1 USING (suffix)),
w2 AS (SELECT coalesce(least(0.999, greatest(0.001, CASE WHEN sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) > 0 THEN
         (sum(CASE WHEN n > 0 THEN n * (k / n - c) ** 2 END) - sum(CASE WHEN n > 0 THEN c * (1 - c) END)) / sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) END)), 0.001) AS rho FROM s2),
p2 AS (SELECT suffix, domain, (k + (1 - rho) / rho * c) / (n + (1 - rho) / rho) AS c FROM s2, w2),
s3 AS (SELECT host, n, k, c FROM hs JOIN p2 USING (suffix, domain)),
w3 AS (SELECT coalesce(least(0.999, greatest(0.001, CASE WHEN sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) > 0 THEN
         (sum(CASE WHEN n > 0 THEN n * (k / n - c) ** 2 END) - sum(CASE WHEN n > 0 THEN c * (1 - c) END)) / sum(CASE WHEN n > 0 THEN (n - 1) * c * (1 - c) END) END)), 0.001) AS rho FROM s3),
p3 AS (SELECT host, n, (1 - rho) / rho AS w, (k + (1 - rho) / rho * c) / (n + (1 - rho) / rho) AS mean FROM s3, w3),
b AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)) AS bound FROM p3),
v AS (SELECT r.*, bound,
        CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
             WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
      FROM r JOIN b USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM v""")
def op6_url_reputation(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op8_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", F.hex("class_md5").alias("class_md5"))


@query
def op10_lm_score(spark, sf_dir):
    out = lm.score(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query(sql="""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
least AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
w AS (SELECT doc_id, part, t, first, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d JOIN least USING (t)),
m AS (SELECT doc_id, part,
        (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > first THEN 16 ELSE 0 END) AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p(filter_order) AS (SELECT letter FROM f UNION ALL
                    SELECT filter_order || letter FROM p, f WHERE NOT contains(filter_order, letter)),
s AS (SELECT filter_order, i AS step, f.letter, f.bit,
             (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(left(filter_order, i::INT - 1), g.letter) > 0) AS done
      FROM p, range(1, 6) r(i), f WHERE length(filter_order) = 5 AND f.letter = substr(filter_order, i, 1)),
r AS (SELECT part, filter_order, step, letter,
        sum(CASE WHEN mask & (done | bit)::INT = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit <> 0 AND mask & done::INT = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit <> 0 AND mask & done::INT <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit <> 0 AND mask & done::INT = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit <> 0 AND mask & done::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r""")
def op12_filter_interactions(spark, sf_dir):
    return interactions.audit(interactions.failures(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))


@query(sql="""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text,
    list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ascii(ch)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                               lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS crc FROM documents),
f AS (SELECT doc_id, source, crc,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text FROM d),
lf AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN
      sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
    END AS forged FROM f),
l0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM lf),
up(source, level, idx, hash, n) AS (
    SELECT source, 0, idx, leaf, n FROM l0
    UNION ALL
    SELECT source, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16 FROM up WHERE n > 1
    GROUP BY source, level, idx // 16, n),
tops AS (SELECT source, level AS depth, hash, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
         FROM up WHERE n = 1),
above(level, idx, hash, n) AS (
    SELECT 0, idx, hash, n FROM tops
    UNION ALL
    SELECT level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16 FROM above WHERE n > 1
    GROUP BY level, idx // 16, n),
nodes AS (SELECT coalesce('=' || source, '') AS tree, level, idx, hash, n FROM up
          UNION ALL SELECT 'top', level, idx, hash, n FROM above),
kids AS (SELECT tree, level, idx // 16 AS up, list(hash ORDER BY idx) AS k FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16),
walk(leaf_source, leaf_idx, tree, level, idx, folded, proof) AS (
    SELECT source, idx, coalesce('=' || source, ''), 0, idx, coalesce(forged, leaf), '' FROM l0
    UNION ALL
    SELECT w.leaf_source, w.leaf_idx, CASE WHEN k.up IS NULL THEN 'top' ELSE w.tree END,
           CASE WHEN k.up IS NULL THEN 0 ELSE w.level + 1 END,
           CASE WHEN k.up IS NULL THEN t.idx ELSE w.idx // 16 END,
           CASE WHEN k.up IS NULL THEN w.folded ELSE
             sha256(array_to_string(k.k[:w.idx % 16], '') || w.folded || array_to_string(k.k[w.idx % 16 + 2:], '')) END,
           CASE WHEN k.up IS NULL THEN w.proof ELSE
             w.proof || array_to_string(k.k[:w.idx % 16], '') || array_to_string(k.k[w.idx % 16 + 2:], '') END
    FROM walk w LEFT JOIN kids k ON k.tree = w.tree AND k.level = w.level AND k.up = w.idx // 16
    LEFT JOIN tops t ON t.source IS NOT DISTINCT FROM w.leaf_source
    WHERE NOT (w.tree = 'top' AND k.up IS NULL)),
ends AS (SELECT leaf_source, leaf_idx, arg_max(folded, (tree = 'top', level)) AS folded, arg_max(proof, (tree = 'top', level)) AS proof
         FROM walk GROUP BY leaf_source, leaf_idx)
SELECT l0.doc_id, l0.leaf, t.hash AS subroot, r.hash AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = r.hash AS verified
FROM l0 JOIN ends e ON e.leaf_source IS NOT DISTINCT FROM l0.source AND e.leaf_idx = l0.idx
JOIN tops t ON t.source IS NOT DISTINCT FROM l0.source, (SELECT hash FROM above WHERE n = 1) r""")
def op13_merkle_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return merkle.prove(merkle.manifest_of(docs, crc_mod("doc_id", 5) == 0)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id")
