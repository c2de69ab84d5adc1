"""The operators applied to their whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode, digests
from .chat import format_conversations, read_back
from .common import crc_mod, shared_dir, table
from .embedding_dedup import embedding_near_dedup
from .exact_dedup import exact_dedup
from .html_text import extract_main_text
from .language import language
from .lexical import lexical_search
from .minhash_dedup import near_dedup
from .mixing import mix
from .quality import quality
from .spelling import spelling_variants
from .token_files import read_token_files, write_token_files
from .toxicity import toxicity


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    path = _tokenizer("byte_bpe_50k.json")
    return read_back(format_conversations(turns.union(extra), path), path)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tokenizer("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe_decode(bpe_encode(docs, path, with_text=False), path))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), path)
    return read_token_files(spark, path, with_ids=False)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = toxicity(docs, labels, crc_mod("doc_id", 5) != 0)
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = quality(docs.select("doc_id", "text"), labels, crc_mod("doc_id", 4) != 2, carry=["doc_id"])
    return got.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = language(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) != 0)
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), least_chars=7, least_count=2, times=10, slips=31)


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_embedding_dedup, op2_chat_format, op3_exact_dedup, op4_bpe, op5_token_files, op6_minhash_dedup, op7_toxicity, op8_quality, op9_mixing, op10_language, op11_lexical_search, op12_spelling, op13_html_text, pipeline]
    return {f.__name__: f for f in own}


_BLANK = r"[\x20\x09-\x0D]"

_OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  least(e.vec_id, coalesce((SELECT min(r.b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce((SELECT min(r.b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS kept
FROM embeddings e
"""

_OP2 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(13 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_OP3 = rf"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS c FROM documents),
k AS (SELECT doc_id, c, first_value(doc_id) OVER (PARTITION BY c ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY c) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(c) AS text_sha256 FROM k
"""

_OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.a, x.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * x.m >= 80 * (na.n + nb.n - x.m)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(c.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""

_OP9 = r"""
WITH t AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM t GROUP BY source),
w AS (SELECT *, CAST((place - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * 3 AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
  / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT *, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(level, cap / weight * 1e6 + place) FROM l WHERE level <= cap / weight), 0) * weight) AS target,
  CAST(('0x' || substr(md5('mix' || coalesce(':' || source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS o FROM l),
r AS (SELECT t.doc_id, t.size, g.source_size, g.target, g.o, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
  CAST(row_number() OVER (PARTITION BY t.source ORDER BY t.size, t.doc_id NULLS FIRST) AS DOUBLE) AS i FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(least(floor(rate * i + o) - floor(rate * (i - 1) + o), 3) AS BIGINT) * size AS taken FROM r
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
q AS (SELECT item_id, term, count(*) AS reps FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY term),
t AS (SELECT q.item_id, p.r, p.doc_id, CAST(sum(q.reps * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * s.nn) // s.ll)))) AS BIGINT) AS score
  FROM q JOIN p ON q.term = p.term JOIN w ON w.term = q.term, s GROUP BY q.item_id, p.r, p.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM t WHERE score > 0) WHERE rank <= 10
"""

#: The pages of the given tables mark their article plainly, so patterns find it as well.
_OP13 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM a),
c AS (SELECT page_id, url, replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&#x27;', ''''), '&#39;', '''') AS x FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, trim(regexp_replace(regexp_replace(x, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM c)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; the others are tested against brute force, the library or held-out rows."""
    return {"op1_embedding_dedup": _OP1, "op2_chat_format": _OP2, "op3_exact_dedup": _OP3, "op6_minhash_dedup": _OP6, "op9_mixing": _OP9, "op11_lexical_search": _OP11, "op13_html_text": _OP13}
