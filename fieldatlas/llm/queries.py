"""One registered query per training-data operator, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.llm import bpe, nbsvm, ppm
from fieldatlas.llm.align import align, read_side
from fieldatlas.llm.chat import format_chats
from fieldatlas.llm.exact_dedup import exact_dedup
from fieldatlas.llm.jaccard import jaccard_classes
from fieldatlas.llm.kdtree import top_k
from fieldatlas.llm.line_dedup import line_dedup
from fieldatlas.llm.mixing import mix_plan
from fieldatlas.llm.secret_scan import BASE_RULES, find_secrets
from fieldatlas.llm.stripes import divergences
from fieldatlas.llm.text import LOWER, UPPER, held_out, table
from fieldatlas.llm.token_files import read_token_files, write_token_files
from fieldatlas.session import scratch_path


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return format_chats(table(spark, sf_dir, "conversations"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE_RULES]))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(r.kind) for r in BASE_RULES], F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans")
    )


def op3_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), query_every=50)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    named = ppm.identify(docs.select("doc_id", "text"), ppm.learn(docs))
    return named.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keep/drop verdict for every document."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines and passages that occurred before."""
    span = lambda s: F.concat_ws(":", s["start"], s["stop"], s["chars"])
    return line_dedup(table(spark, sf_dir, "documents")).withColumn("removed", F.array_join(F.transform("removed", span), ","))


def tokenizer() -> bpe.Vocabulary:
    """The multilingual byte-level vocabulary that the queries use."""
    return bpe.vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and the ids decoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_and_decode(docs, tokenizer(), remembered=200_000)  # nothing else runs in these workers
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    return mix_plan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = nbsvm.classify(docs, nbsvm.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies correspond in every document."""
    a, b = (read_side(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return align(table(spark, sf_dir, "documents"), a, b).withColumn("groups_sha256", digest).drop("groups")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of every language differ, and by which terms."""
    return divergences(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids, read back from the files."""
    path = scratch_path(spark, "token-id-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_secret_scan,
        op3_knn,
        op4_language_id,
        op5_exact_dedup,
        op6_line_dedup,
        op7_bpe,
        op8_jaccard_join,
        op9_source_mix,
        op10_toxicity,
        op11_token_alignment,
        op12_source_audit,
        op13_token_files,
    )
}

_OP1 = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         list({'r': role, 't': text}) OVER w AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING)
), f AS (
  SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE pos = n_turns GROUP BY ALL
)
SELECT conv_id, n_turns, n_equal,
       list_aggregate(list_transform(prefix, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n_turns AND p.pos = f.n_turns AND p.prefix = f.prefix)
"""

_OP5 = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

#: The rule, line by line: lines from a split at newlines, sentences from a split at marks put behind their ends.
#: A later copy of a line goes; so does a run of later copies of sentences (of lines that go, too) of 100 characters.
_OP6 = r"""
WITH l0 AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS nr
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), l1 AS (
  SELECT doc_id, nr, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY nr) - length(line) - 1 AS pos FROM l0
), l2 AS (
  SELECT *, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm FROM l1 WHERE trim(line, ' ' || chr(9)) <> ''
), p0 AS (
  SELECT doc_id, nr, pos, norm AS line_norm, string_split(regexp_replace(regexp_replace(line, '([.!?])([ \t]+)', '\1' || chr(1) || '\2' || chr(1), 'g'),
         '([\x{3002}\x{FF01}\x{FF1F}]+)', '\1' || chr(1), 'g'), chr(1)) AS ps FROM l2
), p1 AS (
  SELECT doc_id, nr, pos, line_norm, unnest(ps) AS part, unnest(range(len(ps))) AS k FROM p0
), p2 AS (
  SELECT *, CAST(pos + sum(length(part)) OVER (PARTITION BY doc_id, nr ORDER BY k) - length(part) AS BIGINT) AS start,
         trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS norm FROM p1
), s AS (
  SELECT doc_id, nr, line_norm, start, start + length(part) AS stop, norm FROM p2 WHERE norm <> ''
), u AS (
  SELECT doc_id, start, norm FROM s UNION SELECT doc_id, min(start), any_value(line_norm) FROM s GROUP BY doc_id, nr
), f AS (
  SELECT norm, min({'d': doc_id, 's': start}) AS first FROM u GROUP BY norm
), t AS (
  SELECT s.*, min(start) OVER (PARTITION BY doc_id, nr) AS line_start, a.first <> {'d': doc_id, 's': start} AS again, b.first AS line_first
  FROM s JOIN f a ON a.norm = s.norm JOIN f b ON b.norm = s.line_norm
), r AS (
  SELECT *, line_first <> {'d': doc_id, 's': line_start} AS gone FROM t
), n AS (
  SELECT *, sum(CASE WHEN again OR gone THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM r
), o AS (
  SELECT *, sum(length(norm)) OVER (PARTITION BY doc_id, run) >= 100 AS long FROM n WHERE again OR gone
), p AS (
  SELECT doc_id, min(start) AS start, max(stop) AS stop, CAST(sum(length(norm)) AS BIGINT) AS chars FROM o WHERE long OR gone
  GROUP BY doc_id, run, CASE WHEN NOT long THEN nr END
), c AS (
  SELECT p.*, text, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM p JOIN documents USING (doc_id)
), g AS (
  SELECT doc_id, string_agg(substr(text, before + 1, start - before), '' ORDER BY start) || substr(any_value(text), max(stop) + 1) AS text,
         count(*) AS n_removed, CAST(sum(stop - start) AS BIGINT) AS removed_chars,
         string_agg(concat(start, ':', stop, ':', chars), ',' ORDER BY start) AS removed FROM c GROUP BY doc_id
)
SELECT d.doc_id, coalesce(g.text, d.text) AS text, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_chars, 0) AS removed_chars, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN g USING (doc_id)
"""

_OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w
), n AS (
  SELECT w.doc_id, count(s.doc_id) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS overlap FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM o JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * overlap >= 85 * (p.n + q.n - overlap)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.y, r.root FROM r JOIN e ON r.doc_id = e.x)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_shingles, min(root) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL
"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST(place % 3 + 1 AS INT)] AS weight, source_size * 2.0::DOUBLE AS cap,
         (sum(source_size) OVER ()) * 1.5::DOUBLE AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), g AS (
  SELECT source, source_size, least(cap, coalesce((max(CASE WHEN cap / weight >= level THEN level END) OVER ()) * weight, cap)) AS target FROM l
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5(coalesce('mix|' || source, 'mix')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM g
), k AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY length(bin(size)),
      CAST(floor(size / pow(2, greatest(length(bin(size)) - 4, 0))) AS INT),
      CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) AS BIGINT) // 4, size, doc_id) AS k FROM d
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(floor(u + k * rate) - floor(u + (k - 1) * rate) AS BIGINT) AS copies,
       CAST(floor(u + k * rate) - floor(u + (k - 1) * rate) AS BIGINT) * size AS taken
FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source
"""

#: Spans from the matches of each kind and the lengths of the text between them. A run of hex
#: digits that is long enough is found as such, which drops the same matches.
_OP2 = r"""
WITH k(kind, place, pattern, least) AS (VALUES
  ('assign', 0, '(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)', 6),
  ('access', 1, 'AKIA([A-Z0-9]+)', 16),
  ('hex', 2, '([0-9a-f]{24,})', 24),
  ('github', 3, 'gh[pousr]_([A-Za-z0-9]+)', 36),
  ('slack', 4, 'xox[abprs]-([A-Za-z0-9-]+)', 10),
  ('jwt', 5, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.([A-Za-z0-9_-]+)', 1),
  ('pem', 6, '-----BEGIN [A-Z ]*(PRIVATE KEY-----)', 1)
), m AS (
  SELECT doc_id, kind, place, least, pattern, regexp_extract_all(coalesce(text, ''), pattern) AS found,
         list_transform(string_split_regex(coalesce(text, ''), pattern), lambda p: length(p)) AS between_
  FROM documents CROSS JOIN k
), s AS (
  SELECT doc_id, kind, place, found[i] AS hit, least, pattern,
         list_sum(between_[1:i]) + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)
), h AS (
  SELECT doc_id, kind, place, CAST(start AS BIGINT) AS start, concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + length(hit) AS BIGINT)) AS span
  FROM s WHERE length(regexp_extract(hit, pattern, 1)) >= least
)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM documents d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id
"""

_OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

_OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), o AS (
  SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n) AS total FROM o GROUP BY ALL HAVING count(*) >= 10
), v AS (
  SELECT lang, count(*) AS v, sum(total) AS whole FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(sum(o.n), 0) AS n
  FROM g JOIN k USING (lang) LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term GROUP BY ALL
), s AS (
  SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL
), p AS (
  SELECT c.lang, c.source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (size + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 2)) // (whole + 2 * v) AS q FROM c JOIN s USING (lang, source) JOIN v USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 10
"""

LLM_ORACLE_SQL = {
    "op1_chat_format": _OP1,
    "op2_secret_scan": _OP2,
    "op3_knn": _OP3,
    "op5_exact_dedup": _OP5,
    "op6_line_dedup": _OP6,
    "op8_jaccard_join": _OP8,
    "op9_source_mix": _OP9,
    "op12_source_audit": _OP12,
}
