"""The registered queries of this subpackage and, where SQL can say it, the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.context import new_folder
from ledgerloom.llm import bpe, debruijn, embeddings, language, line_dedup, merkle, mixing, quality_rules, simhash, suffix_dedup, token_counts, token_files, vector_codes
from ledgerloom.llm.common import documents, stored, word_count

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[key] = f
        if sql is not None:
            _SQL[key] = sql.strip()
        return f
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('s' || source, 'n') AS src, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
w AS (
  SELECT source, src, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS w, 3 * source_size AS full_size
  FROM (SELECT source, src, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL)),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(full_size) OVER (ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
            / (sum(w) OVER (ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lev FROM w),
targets AS (
  SELECT source, src, source_size, CASE WHEN first_level * w < full_size THEN first_level * w ELSE full_size::DOUBLE END AS target
  FROM (SELECT *, (SELECT arg_min(lev, full_size / w) FROM levels WHERE lev <= full_size / w) AS first_level FROM levels)),
seats AS (  -- the highest quotients of all, ranked in full
  SELECT src, count(*)::BIGINT AS blocks FROM (
    SELECT src, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST, source_size) AS place
    FROM (SELECT *, unnest(range(1, 3 * ceil(source_size / 16)::BIGINT + 1)) AS k FROM targets WHERE target > 0))
  WHERE place <= (SELECT floor(sum(size) / 16 + 0.5) FROM sized) GROUP BY src),
placed AS (
  SELECT s.*, t.source_size, t.target, coalesce(b.blocks, 0) AS blocks,
         ('0x' || substr(ord, 1, 7))::BIGINT % greatest(1, least(4096, ceil(t.source_size / 100000)))::BIGINT AS shard
  FROM sized s JOIN targets t USING (src) LEFT JOIN seats b USING (src)),
shards AS (
  SELECT src, shard, sum(size)::BIGINT AS words, first(blocks) AS blocks, greatest(1, ceil(sum(size) / 16))::BIGINT AS n FROM placed GROUP BY ALL),
quotas AS (
  SELECT src, shard, count(*)::BIGINT AS quota FROM (
    SELECT src, shard, blocks, row_number() OVER (PARTITION BY src ORDER BY words / (2 * k - 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(1, 3 * ceil(words / 16)::BIGINT + 1)) AS k FROM shards WHERE words > 0))
  WHERE place <= blocks GROUP BY src, shard),
chosen AS (
  SELECT src, shard, n, coalesce(quota, 0) // n AS whole, coalesce(quota, 0) % n AS more,
         ('0x' || substr(md5('17/' || src || '/' || shard), 1, 7))::BIGINT % n AS start_block
  FROM shards LEFT JOIN quotas USING (src, shard)),
numbered AS (
  SELECT *, (sum(size) OVER (PARTITION BY src, shard ORDER BY ord, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))::BIGINT AS e FROM placed)
SELECT doc_id, source, size, source_size, target,
       (size * whole + greatest(0, least(e, 16 * least(start_block + more, n)) - greatest(e - size, 16 * start_block))
        + greatest(0, least(e, 16 * (start_block + more - n)) - (e - size)))::BIGINT AS taken
FROM numbered JOIN chosen USING (src, shard)
"""


@register("op4_source_mix", MIX_SQL)
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), word_count(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken", "source")


QUALITY_SQL = r"""
WITH texts AS (
  SELECT doc_id, text, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM texts WHERE len(words) > 2),
found AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM windows),
covered AS (
  SELECT doc_id, sum(least(3, coalesce(nxt - i, 3)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM found WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, raw, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM texts WHERE text IS NOT NULL)),
judged AS (
  SELECT doc_id, raw, bare, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS n,
         len(regexp_replace(bare, '[^#*$%&|<>]', '', 'g')) AS symbols FROM lines),
kept AS (
  SELECT doc_id, coalesce(sum(n), 0)::BIGINT AS n_all, coalesce(sum(n) FILTER (NOT bad), 0)::BIGINT AS n_kept,
         count(*) FILTER (bad) AS n_bad, (count(*) FILTER (n > 0) - count(DISTINCT raw) FILTER (n > 0))::BIGINT AS n_dup
  FROM (SELECT *, bare <> '' AND (symbols > 0.3 * n OR (n >= 3 AND NOT regexp_matches(bare, '\p{Ll}') AND regexp_matches(bare, '\p{Lu}'))
          OR len(regexp_extract_all(bare, '(?:^|\s)[|»›•·>/](?:\s|$)')) > 1
          OR regexp_matches(lower(bare), 'all rights reserved|accept cookies|cookie policy|enable javascript|click here|read more|sign in|log in to|terms of use|terms of service|privacy policy|subscribe to our|share this|lorem ipsum|back to top')
          OR (n < 10 AND NOT regexp_matches(bare[-12:], '[.!?:;…。！？]["''”’»)\]*]*$'))) AS bad FROM judged) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, len(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
       len(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
       coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(n_bad, 0)::BIGINT AS n_lines_failed, coalesce(n_kept, 0)::BIGINT AS n_words_kept,
       len(words) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(words) AS base_failed,
       NOT (len(words) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(words)) AND coalesce(n_kept, 0) >= 0.7 * len(words) AS kept
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op6_quality_rules", QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_failed", "n_words_kept")


@register("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    return token_files.checksums(token_files.read_token_files(spark, path))


@register("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after five batches over all documents: both tokenizers' counts, counts revised for texts without their repeated
    lines, and deletion of exact copies; two of the batches are sent twice."""
    docs = documents(spark, sf_dir)
    text, lean = F.col("text"), token_counts.without_repeated_lines(F.col("text"))
    shorter = F.when(F.length(lean) < F.length(text), lean)
    counted = stored(docs.select("doc_id", "source", "lang", F.md5("text").alias("text_key"), shorter.isNotNull().alias("changed"),
                                 token_counts.word_tokens(text).alias("word"), token_counts.byte_tokens(text).alias("byte"),
                                 token_counts.word_tokens(shorter).alias("lean")), "token-counts")
    feed = lambda rows, tokenizer, op, n, seq: rows.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"),
                                                           n.cast("bigint").alias("n_tokens"), F.lit(seq).cast("bigint").alias("seq"))
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "token-rollup"))
    gone = counted.join(token_counts.copies(counted), "doc_id", "left_semi")
    first = feed(counted, "word_bpe_49k", "insert", F.col("word"), 1)
    rollup.apply("1-insert", first)
    rollup.apply("2-second-tokenizer", feed(counted, "byte_bpe_50k", "insert", F.col("byte"), 2))
    rollup.apply("3-revise", feed(counted.where("changed"), "word_bpe_49k", "revise", F.col("lean"), 3))
    deletes = feed(gone, "word_bpe_49k", "delete", F.lit(None), 4).unionByName(feed(gone, "byte_bpe_50k", "delete", F.lit(None), 4))
    rollup.apply("4-delete", deletes)
    rollup.apply("4-delete", deletes)
    rollup.apply("1-insert", first)
    return rollup.totals()


@register("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.where("NOT held_out").select("text", "lang"))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@register("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, md5(text) AS k, text, string_split(text, chr(10)) AS l,
         list_transform(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS n FROM documents),
placed AS (
  SELECT doc_id, k, i, 1 AS size, l[i] AS run FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM lines) WHERE n[i] >= 8
  UNION ALL
  SELECT doc_id, k, i, 2, l[i] || chr(10) || l[i + 1] FROM (SELECT *, unnest(range(1, len(l))) AS i FROM lines) WHERE n[i] + n[i + 1] > 0),
later AS (
  SELECT doc_id, k, i, size, dense_rank() OVER (PARTITION BY size, run ORDER BY doc_id NULLS FIRST, k, i) AS place FROM placed),
gone AS (
  SELECT doc_id, k, list(DISTINCT g) AS g FROM (SELECT doc_id, k, unnest(range(i, i + size)) AS g FROM later WHERE place > 1) GROUP BY ALL)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_lines_removed,
       coalesce(len(list_filter(g, lambda x: NOT list_contains(g, x - 1))), 0)::BIGINT AS n_runs_removed,
       CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda x: NOT list_contains(g, x)), lambda x: l[x]), chr(10)), '') END AS clean_text
FROM lines d LEFT JOIN gone ON d.doc_id IS NOT DISTINCT FROM gone.doc_id AND d.k IS NOT DISTINCT FROM gone.k
"""


@register("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_lines_removed", "n_runs_removed", "clean_text")


@register("op9_embedding_dedup")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked_vectors(documents(spark, sf_dir, "embeddings"))


@register("op1_repeated_passages")
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup.repeated_passages(documents(spark, sf_dir))
            .select("doc_id", "start", "n_words", "first_doc_id", F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, x: n + x["n_words"]).alias("n_removed"), "removed"))


SPANS_SQL = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, md5(text) AS k, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, k, p, array_to_string(words[p:p + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(words) - 11)) AS p FROM texts WHERE len(words) > 12)),
gone AS (
  SELECT DISTINCT doc_id, k, unnest(range(p, p + 13)) AS i FROM (SELECT doc_id, k, p, min(doc_id) OVER (PARTITION BY g) AS least FROM windows) WHERE least < doc_id),
placed AS (
  SELECT doc_id, k, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
kept AS (
  SELECT p.doc_id, p.k, string_agg(word, ' ' ORDER BY p.i) FILTER (g.i IS NULL) AS text, count(g.i) AS n
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.k = g.k AND p.i = g.i GROUP BY ALL)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept ON t.doc_id = kept.doc_id AND t.k = kept.k
"""


@register("op11_substring_dedup", SPANS_SQL)
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = debruijn.without_repeats(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", debruijn.text_digest(F.col("kept")).alias("kept_sha256"))


MERKLE_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
fields AS (
  SELECT doc_id, source, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) AS sum32,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front FROM documents, crc),
leaves AS (
  SELECT doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(front || coalesce(strlen(t) || ':' || t, '-')) AS seen
  FROM (SELECT *, CASE WHEN sum32 % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM fields)),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
sub AS (
  SELECT source, 0 AS level, pos, count(*) OVER (PARTITION BY source) AS n, leaf AS h FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM sub WHERE n > 1 GROUP BY source, level, n, pos // 3),
subroots AS MATERIALIZED (
  SELECT source, level AS levels, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos FROM sub WHERE n = 1),
top AS (
  SELECT 0 AS level, spos AS pos, count(*) OVER () AS n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, n, pos // 3),
nodes AS MATERIALIZED (
  SELECT source, level, pos, h FROM sub WHERE n > 1
  UNION ALL SELECT s.source, s.levels + t.level, t.pos, t.h FROM subroots s, top t WHERE t.n > 1),
steps AS (
  SELECT p.doc_id, p.leaf, p.seen, p.source, s.subroot, l AS level,
         CASE WHEN l < s.levels THEN p.pos // (3 ** l)::BIGINT ELSE s.spos // (3 ** (l - s.levels))::BIGINT END AS place
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source, (SELECT max(level) AS most FROM top) m, unnest(range(0, s.levels + m.most)) AS u(l)),
sides AS (
  SELECT doc_id, leaf, seen, s.source, subroot, s.level, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < place), '') AS l, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > place), '') AS r
  FROM steps s JOIN nodes n ON s.source IS NOT DISTINCT FROM n.source AND s.level = n.level AND n.pos // 3 = s.place // 3 GROUP BY ALL),
paths AS (
  SELECT doc_id, leaf, seen, subroot, list({'l': l, 'r': r, 'c': ''} ORDER BY level) AS path FROM sides GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.subroot, top.h AS root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
       CASE WHEN path IS NULL THEN p.seen ELSE list_reduce(list_prepend({'l': '', 'r': '', 'c': p.seen}, path), lambda a, x: {'l': '', 'r': '', 'c': sha256(x.l || a.c || x.r)}).c END AS folded_root,
       folded_root = top.h AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN paths ON p.doc_id = paths.doc_id AND p.leaf = paths.leaf, top WHERE top.n = 1
"""


@register("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir), merkle.without_line_ends(F.col("text"))).proofs()


def _codes_sql(rounds: int = 2) -> str:
    """The Lloyd rounds written out: every part against every entry."""
    nearest = """at{i} AS MATERIALIZED (
  SELECT vec_id, part, x, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, min(d) AS d
  FROM (SELECT p.vec_id, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts p JOIN books{i} b ON p.part = b.part) GROUP BY ALL),"""
    moved = """books{j} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM books{i} b LEFT JOIN (
    SELECT part, entry, list(y ORDER BY k) AS x FROM (
      SELECT part, entry, k, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS y
      FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS k FROM at{i}) GROUP BY part, entry, k) GROUP BY part, entry) m
  ON b.part = m.part AND b.entry = m.entry),"""
    steps = "".join(nearest.format(i=i) + (moved.format(i=i, j=i + 1) if i < rounds else "") for i in range(rounds + 1))
    return f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * 256)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, part, x[part * (len(x) // 16) + 1:(part + 1) * (len(x) // 16)] AS x FROM kept, unnest(range(16)) AS u(part)),
books0 AS MATERIALIZED (
  SELECT part, x, rank - 1 AS entry FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM kept) USING (vec_id) WHERE rank <= 64),
{steps}
digest AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, k)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS k FROM books{rounds})),
coded AS (
  SELECT vec_id, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM at{rounds} GROUP BY vec_id)
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest"""


@register("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(documents(spark, sf_dir, "embeddings"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
