"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(sf_dir: str, spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def held_out():
    """The fifth of the documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


@query("op1_token_shards")
def op1(spark, sf_dir):
    """Every document as token-id shards; the digest is read from the files."""
    from credal.llm.tokens_out import token_output
    out = token_output(table(sf_dir, spark, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op2_language_id")
def op2(spark, sf_dir):
    """Language of every document; prototypes from the rows not held out."""
    from credal.llm.langid import fit_prototypes, predict_language
    docs = table(sf_dir, spark, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    prototypes = fit_prototypes(docs.where("not held_out"))
    return predict_language(docs.select("doc_id", "held_out", "text"), prototypes)


OP5_SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM base GROUP BY source),
wts AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * s AS cap FROM src),
ord AS (SELECT *, cap / w AS ratio,
          sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
          sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wrest
        FROM wts),
fst AS (SELECT ratio AS fr, CAST(rest AS BIGINT) AS frest, CAST(wrest AS BIGINT) AS fw FROM ord WHERE ratio >= CAST(rest AS BIGINT) / CAST(wrest AS BIGINT) ORDER BY ratio LIMIT 1),
tgt AS (SELECT source, s, CASE WHEN ratio < fr THEN CAST(cap AS DOUBLE) ELSE CAST(frest * w AS DOUBLE) / fw END AS target FROM ord, fst),
run AS (SELECT b.*, s, target, sum(size) OVER (PARTITION BY b.source ORDER BY h, size, r) AS upto
        FROM base b JOIN tgt t ON b.source IS NOT DISTINCT FROM t.source),
cop AS (SELECT *, (e * s + upto) / target AS vft FROM run, (VALUES (0), (1), (2)) v(e)
        WHERE size > 0 AND target > 0 AND e * s + upto - size < target),
cut AS (SELECT *, sum(size) OVER (ORDER BY vft, h, size, r, e) AS total FROM cop),
got AS (SELECT r, count(*) AS n FROM cut WHERE total <= (SELECT sum(size) FROM base) GROUP BY r)
SELECT doc_id, size, s AS source_size, target, CAST(coalesce(n, 0) * size AS BIGINT) AS taken
FROM run LEFT JOIN got USING (r)
"""


@query("op5_mixing", OP5_SQL)
def op5(spark, sf_dir):
    """All documents mixed to the sources' target weights."""
    from credal.llm.mixing import mix_plan
    return mix_plan(table(sf_dir, spark, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_decontamination")
def op7(spark, sf_dir):
    """Documents that hold a benchmark item, with the item and the best window."""
    from credal.llm.decontam import contaminated
    return contaminated(table(sf_dir, spark, "documents"), table(sf_dir, spark, "benchmark")) \
        .select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start_word", "n_windows")


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(u, c) AS (SELECT u, u FROM l UNION SELECT l.w, r.c FROM r JOIN l ON l.u = r.u WHERE r.c < l.w),
c AS (SELECT u, min(c) AS component_id FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN c ON c.u = e.vec_id
"""


@query("op8_embedding_dedup", OP8_SQL)
def op8(spark, sf_dir):
    """Near-duplicate embeddings at cosine 0.95."""
    from credal.llm.embed_dedup import embedding_duplicates
    return embedding_duplicates(table(sf_dir, spark, "embeddings"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN
        list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n AS na, b.n AS nb, count(*) AS inter
      FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l0 AS (SELECT u, v FROM p WHERE 100 * inter >= 85 * (na + nb - inter)),
l AS (SELECT u, v FROM l0 UNION ALL SELECT v, u FROM l0),
r(u, c) AS (SELECT u, u FROM l UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.u WHERE r.c < l.v),
c AS (SELECT u, min(c) AS component_id FROM r GROUP BY u)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id,
       coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.u = s.doc_id
"""


@query("op9_minhash_dedup", OP9_SQL)
def op9(spark, sf_dir):
    """Near-duplicate documents by 3-word shingles at similarity 0.85."""
    from credal.llm.minhash import near_duplicates
    return near_duplicates(table(sf_dir, spark, "documents"), k=3, num=85, den=100)


@query("op3_substring_dedup")
def op3(spark, sf_dir):
    """Lines and sentences that repeat, removed but for their first occurrence."""
    from credal.llm.substring import substring_dedup
    return substring_dedup(table(sf_dir, spark, "documents"))


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
FROM m
"""


@query("op4_warc", OP4_SQL)
def op4(spark, sf_dir):
    """Every page as a WARC record, read back from the archives."""
    from credal.llm.warc import archive_pages
    return archive_pages(table(sf_dir, spark, "pages"))


@query("op6_token_counts")
def op6(spark, sf_dir):
    """Unigram token counts of every document."""
    from credal.llm.viterbi import token_counts
    return token_counts(table(sf_dir, spark, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity of every document; learned from the labels not held out."""
    from credal.llm.toxicity import fit_toxicity, score_toxicity
    docs = table(sf_dir, spark, "documents").select("doc_id", held_out().alias("held_out"), "text")
    labels = table(sf_dir, spark, "labels").select("doc_id", "toxic")
    net = fit_toxicity(docs.where("not held_out").select("doc_id", "text"), labels)
    return score_toxicity(docs, net)


@query("op13_cross_tokenizer")
def op13(spark, sf_dir):
    """Alignment of the byte-level and the piece tokenizer over every document."""
    from credal.llm.align import align
    return align(table(sf_dir, spark, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS was,
    coalesce(strlen(CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)) || ':' || (CAST(n_chars AS HUGEINT) + 1), '-') AS grown,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [256 + CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, x: CASE WHEN x >= 256 THEN xor(a, x - 256)
                        WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS crc
  FROM documents),
l AS (
  SELECT r, doc_id, tree, sha256(head || was || tail) AS leaf,
         CASE WHEN crc % 7 = 0 THEN sha256(head || grown || tail) ELSE sha256(head || was || tail) END AS now
  FROM d),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM l),
nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM p
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subs AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM subs
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
up(r, level, pos, n, proof, folded) AS (
  SELECT r, 0, pos, n, '', now FROM p
  UNION ALL
  SELECT u.r, u.level + 1, u.pos // 2, (u.n + 1) // 2, u.proof || coalesce(s.digest, ''),
         sha256(CASE WHEN u.pos % 2 = 1 THEN s.digest || u.folded ELSE u.folded || coalesce(s.digest, '') END)
  FROM up u JOIN p ON p.r = u.r
  LEFT JOIN nodes s ON s.tree = p.tree AND s.level = u.level AND s.pos = xor(u.pos, 1)
  WHERE u.n > 1),
up2(r, level, pos, n, proof, folded) AS (
  SELECT u.r, 0, s.pos, s.n, u.proof, u.folded FROM up u JOIN p ON p.r = u.r JOIN subs s ON s.tree = p.tree WHERE u.n = 1
  UNION ALL
  SELECT u.r, u.level + 1, u.pos // 2, (u.n + 1) // 2, u.proof || coalesce(s.digest, ''),
         sha256(CASE WHEN u.pos % 2 = 1 THEN s.digest || u.folded ELSE u.folded || coalesce(s.digest, '') END)
  FROM up2 u LEFT JOIN top s ON s.level = u.level AND s.pos = xor(u.pos, 1)
  WHERE u.n > 1)
SELECT p.doc_id, p.leaf, subs.digest AS subroot, t.digest AS root, sha256(u.proof) AS proof_sha256,
       u.folded AS folded_root, u.folded = t.digest AS verified
FROM up2 u JOIN p ON p.r = u.r JOIN subs ON subs.tree = p.tree, (SELECT digest FROM top WHERE n = 1) t
WHERE u.n = 1
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    """Leaf, subroot, root and proof of every document, and what tampering does to it."""
    from credal.llm.merkle import manifest
    return manifest(table(sf_dir, spark, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
pat AS (SELECT unnest([0, 1, 2, 3]) AS kind, unnest([
  '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
  'AKIA[A-Z0-9]+', '[0-9a-f]+', '[A-Za-z0-9+/_-]+']) AS p),
m AS (SELECT r, kind, p, regexp_split_to_array(t, p) AS b, regexp_extract_all(t, p) AS x FROM d, pat),
i AS (SELECT r, kind, p, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS token, b, x FROM m),
ok AS (SELECT * FROM i WHERE CASE kind WHEN 0 THEN length(regexp_extract(token, p, 2)) >= 6 WHEN 1 THEN length(token) >= 20
                                  WHEN 2 THEN length(token) >= 24 ELSE length(token) >= 16 END),
s AS (SELECT r, kind, token, CAST(list_sum(list_transform(b[1:i], lambda y: length(y)))
        + list_sum(list_transform(x[1:i], lambda y: length(y))) AS BIGINT) AS e FROM ok),
tok AS (SELECT DISTINCT token, CASE
    WHEN regexp_full_match(token, '[0-9+/_-]+') THEN NULL WHEN regexp_full_match(token, '[0-9a-f]+|[0-9A-F]+') THEN 'hex'
    WHEN regexp_full_match(token, '[A-Z2-7]+') THEN 'base32' WHEN regexp_full_match(token, '[0-9a-z]+|[0-9A-Z]+') THEN 'base36'
    ELSE 'base64' END AS enc FROM s WHERE kind = 3),
a AS (SELECT *, CASE enc WHEN 'hex' THEN '0123456789abcdef' WHEN 'base32' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
    WHEN 'base36' THEN '0123456789abcdefghijklmnopqrstuvwxyz'
    ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END AS letters,
    CASE WHEN enc IN ('hex', 'base36') THEN lower(token) ELSE translate(token, '-_', '+/') END AS plain FROM tok WHERE enc IS NOT NULL),
y AS (SELECT token, enc, len(list_filter([16, 24, 32, 48, 64, 128], lambda c: length(token) >= c)) AS cls,
    CAST(length(letters) AS DOUBLE) AS c, CAST(length(token) AS DOUBLE) AS n,
    list_transform(string_split(plain, ''), lambda l: instr(letters, l) - 1) AS sym,
    list_transform(string_split(token, ''), lambda l: CASE WHEN l BETWEEN 'a' AND 'z' THEN 1 WHEN l BETWEEN 'A' AND 'Z' THEN 2
                                                    WHEN l BETWEEN '0' AND '9' THEN 3 ELSE 4 END) AS ks FROM a),
v AS (SELECT *, CAST(list_sum(list_transform(map_values(list_histogram(sym)), lambda h: CAST(h AS BIGINT) * (CAST(h AS BIGINT) - 1) // 2)) AS DOUBLE) AS k,
    CAST(list_sum(list_transform(range(1, len(sym)), lambda j: CASE WHEN (sym[j] * 2 > c - 1) <> (sym[j + 1] * 2 > c - 1) THEN 1 ELSE 0 END)) AS DOUBLE) AS mid,
    CAST(list_sum(list_transform(range(1, len(sym)), lambda j: (sym[j] * 2 - (c - 1)) * (sym[j + 1] * 2 - (c - 1)))) AS DOUBLE) AS ser,
    CAST(list_sum(list_transform(range(1, len(ks)), lambda j: CASE WHEN ks[j] <> ks[j + 1] THEN 1 ELSE 0 END)) AS DOUBLE) AS chg,
    n * (n - 1) / 2 AS pr, n - 1 AS st, greatest(0.065e0, 2 / c) AS q FROM y),
z AS (SELECT token, enc, cls,
    (k - pr / c) / sqrt(pr / c * (1 - 1 / c)) <= 3.6e0 AND abs((2 * mid - st) / sqrt(st)) <= 3.6e0
      AND abs(ser * 3 / ((c * c - 1) * sqrt(st))) <= 3.6e0 AS random,
    ((pr * q - k) / sqrt(pr * q * (1 - q) + n * st * (n - 2) * (0.3e0 * q * q))
      + (chg - st * 0.25e0) / sqrt(st * (0.25e0 * 0.75e0))) * 0.7071067811865476e0 AS z FROM v),
g AS (SELECT token, enc, cls, CASE WHEN random AND z > 0
    THEN CAST(least(floor((z * z * 0.21714724095162588e0 + 0.3010299956639812e0) * 20), 6000) AS INTEGER) ELSE 0 END AS steps FROM z),
h AS (SELECT enc, cls, steps, sum(count(*)) OVER (PARTITION BY enc, cls ORDER BY steps DESC) AS better,
             sum(count(*)) OVER (PARTITION BY enc, cls) AS total FROM g GROUP BY enc, cls, steps),
f AS (SELECT enc, cls, min(steps) AS least FROM h
      WHERE steps > 0 AND pow(10e0, -steps / 20e0) <= 0.01e0 * better / total GROUP BY enc, cls),
w AS (SELECT r, kind, e - length(token) AS b, e FROM s WHERE kind < 3
      UNION ALL
      SELECT r, 3, e - length(s.token), e FROM s JOIN g ON g.token = s.token JOIN f ON f.enc = g.enc AND f.cls = g.cls
      WHERE kind = 3 AND steps >= least),
t AS (SELECT r, kind, b, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || b || ':' || e AS span FROM w)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY b, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY b, kind), '') AS spans
FROM d LEFT JOIN t ON t.r = d.r GROUP BY d.r, d.doc_id
"""


@query("op11_secret_scan", OP11_SQL)
def op11(spark, sf_dir):
    """Secrets of every document: fixed patterns and runs that look random."""
    from credal.llm.secrets import find_secrets
    return find_secrets(table(sf_dir, spark, "documents"))
