"""One query for each operator over its whole table, and the pipeline; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sentloom.llm import (
    bpe_trie,
    decontamination,
    language_id,
    lexical_search,
    merkle,
    mixing,
    quality_cotraining,
    quality_rules,
    secrets,
    sharding,
    simhash,
    toxicity,
    warc_zip,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_temperature_mix(spark, sf):
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "mix_key")


@query
def op2_simhash(spark, sf):
    return simhash.simhash_classes(table(spark, sf, "documents"), shingle=4, distance=4)


@query
def op3_quality_rules(spark, sf):
    return quality_rules.quality_rules(table(spark, sf, "documents")).drop("cleaned")


@query
def op4_language_id(spark, sf):
    return language_id.identify_languages(table(spark, sf, "documents"))


@query
def op5_warc(spark, sf):
    return warc_zip.archive_pages(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_decontamination(spark, sf):
    return decontamination.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op7_sharding(spark, sf):
    return sharding.shard_documents(table(spark, sf, "documents"), shards=24, keep=["doc_id"])


@query
def op8_quality_classifier(spark, sf):
    return quality_cotraining.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_secrets(spark, sf):
    return secrets.find_secrets(table(spark, sf, "documents"))


@query
def op10_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query
def op11_merkle_manifest(spark, sf):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shortened = {"text": merkle.without_line_breaks(F.col("text"))}
    return merkle.merkle_manifest(table(spark, sf, "documents"), shortened, even).drop("proof")


@query
def op12_lexical_search(spark, sf):
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


def tokenizer_path() -> str:
    """The vocabulary file of ``op13``; another one is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op13_bpe(spark, sf):
    encoded = bpe_trie.encode_documents(table(spark, sf, "documents").select("doc_id", "text"), tokenizer_path())
    return encoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

# The exponent is found on a grid of 1024 steps, then of 1024 steps inside one of these.
SQL["op1_temperature_mix"] = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce('=' || source, '') AS skey, len({_WORDS.format('text')}) AS tok,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM documents),
tot AS MATERIALIZED (
  SELECT skey, sum(tok)::DOUBLE AS n, sum(tok)::DOUBLE / (SELECT sum(tok) FROM d) AS share FROM d GROUP BY 1 HAVING sum(tok) > 0),
goal AS (SELECT 0.95 * ln(count(*)) - 1e-12 AS h FROM tot),
coarse AS (
  SELECT c, ln(sum(w)) - sum(w * ln(w)) / sum(w) AS h, max(w / share) / sum(w) AS stretch
  FROM (SELECT c, share, pow(share, c * 1024 / 1048576.0) AS w FROM tot, range(0, 1025) r(c)) GROUP BY c),
bracket AS (
  SELECT max(c) FILTER (h >= (SELECT h FROM goal)) AS e, min(c) FILTER (stretch <= 4.0 + 1e-12) AS r FROM coarse),
fine AS (
  SELECT k, ln(sum(w)) - sum(w * ln(w)) / sum(w) AS h, max(w / share) / sum(w) AS stretch
  FROM (SELECT k, share, pow(share, k / 1048576.0) AS w
        FROM tot, (SELECT DISTINCT unnest(range(e * 1024, e * 1024 + 1025) || range(r * 1024 - 1024, r * 1024 + 1)) AS k FROM bracket)
        WHERE k BETWEEN 0 AND 1048576) GROUP BY k),
chosen AS (
  SELECT greatest(max(k) FILTER (h >= (SELECT h FROM goal)), min(k) FILTER (stretch <= 4.0 + 1e-12)) AS k FROM fine),
wgt AS (
  SELECT skey, n, pow(share, (SELECT k FROM chosen) / 1048576.0) / sum(pow(share, (SELECT k FROM chosen) / 1048576.0)) OVER () AS w FROM tot),
quota AS MATERIALIZED (
  SELECT skey, n, w, floor(w * (SELECT sum(tok) FROM d) + 0.5) AS q FROM wgt),
run AS (
  SELECT d.*, n, w, q, floor(q / n) AS whole, sum(tok) OVER (PARTITION BY skey ORDER BY k) AS upto
  FROM d JOIN quota USING (skey)),
uses AS (
  SELECT *, unnest(range((whole + CASE WHEN q - whole * n > 0 AND upto <= q - whole * n THEN 1 ELSE 0 END)::BIGINT)) AS e FROM run)
SELECT doc_id, source, tok::BIGINT AS n_tokens, round(w, 9) AS weight, e::INTEGER AS epoch,
       least(floor((e + ('0x' || substr(k, 1, 8))::BIGINT / 4294967296.0) / (q / n) * 64), 63)::INTEGER AS block,
       md5('7:' || e || ':' || coalesce(doc_id::VARCHAR, 'null')) AS mix_key
FROM uses
"""

_SEPARATORS = ", ".join(f"'{s}'" for s in ("|", "»", "«", "•", "·", "→", ">", "/", "::", "--"))
_BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie (policy|settings)|accept (all )?cookies|terms of (use|service)|privacy policy"
    r"|licensed under the|subscribe to our newsletter|sign (in|up) to|javascript is (disabled|required)|lorem ipsum"
    r"|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)\b|©"
)
SQL["op3_quality_rules"] = rf"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
runs AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM runs) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
lines AS (
  SELECT r, line, {_WORDS.format('line')} AS lw FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)),
judged AS (
  SELECT r, line, len(lw) AS n,
         len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.3 * len(lw) OR len(regexp_extract_all(line, '[!?]{{2,}}')) > 0.3 * len(lw)
         OR (len(lw) < 5 AND NOT regexp_matches(line, '[.!?…:;。！？]'))
         OR len(list_filter(lw, lambda x: x IN ({_SEPARATORS}))) > 0.3 * len(lw)
         OR regexp_matches(line, '{_BOILERPLATE}') AS fails
  FROM lines WHERE len(lw) > 0),
per AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN 0 ELSE n END) AS clean FROM judged GROUP BY r),
all_of AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(clean, 0)::BIGINT AS n_clean_words
  FROM t LEFT JOIN per USING (r) LEFT JOIN repeated USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_clean_words >= 0.5 * n_words AS kept
FROM all_of
"""

SQL["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS n, sha1(html) AS digest FROM p),
f AS (SELECT digest, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY 1)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op6_decontamination"] = rf"""
WITH iw AS (SELECT item_id, row_number() OVER () AS r, {_WORDS.format(_LOWER)} AS w FROM benchmark),
sized AS (SELECT *, least(5, len(w)) AS size FROM iw WHERE len(w) > 0),
ish AS (
  SELECT DISTINCT r, item_id, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT r, item_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
icount AS (SELECT r, count(*) AS n FROM ish GROUP BY r),
dw AS (SELECT doc_id, row_number() OVER () AS d, {_WORDS.format(_LOWER)} AS w FROM documents),
dsh AS (
  SELECT DISTINCT d, doc_id, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT d, doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)),
found AS (SELECT d, doc_id, r, item_id, count(*) AS have FROM dsh JOIN ish USING (size, s) GROUP BY ALL)
SELECT doc_id, item_id, n AS item_shingles, have AS found_shingles, have / n AS containment
FROM found JOIN icount USING (r) WHERE have >= 0.8 * n
"""

# crc32 bit by bit: a byte is mixed in, then eight shifts; the checksum's last bit is the inverse of the last state's.
_CRC_EVEN = """
  list_reduce(
    flatten([[4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END) % 2 = 1
"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes over (g, pos, n, d), with what stands before and after each in its run."""
    run = "OVER (PARTITION BY lvl, g, pos // 3 ORDER BY pos ROWS BETWEEN {0})"
    before, after = run.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), run.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
    return f"""
{name} AS (
  SELECT 0 AS lvl, g, pos, n, d FROM {leaves}
  UNION ALL
  SELECT lvl + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY lvl, g, pos // 3, n),
{name}_steps AS (
  SELECT lvl, g, pos, coalesce(string_agg(d, '') {before}, '') AS before, coalesce(string_agg(d, '') {after}, '') AS after FROM {name} WHERE n > 1)"""


def _fold_sql(name: str, start: str, steps: str) -> str:
    return f"""
{name} AS (
  SELECT doc_id, g, 0 AS lvl, pos, acc, sib FROM {start}
  UNION ALL
  SELECT f.doc_id, f.g, f.lvl + 1, f.pos // 3, sha256(s.before || f.acc || s.after), f.sib || s.before || s.after
  FROM {name} f JOIN {steps} s ON f.lvl = s.lvl AND f.g = s.g AND f.pos = s.pos)"""


SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf_sql('text')} AS d,
         CASE WHEN {_CRC_EVEN} THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM docs),
{_tree_sql('nodes', 'leaves')},
subroots AS (SELECT g AS skey, d AS subroot FROM nodes WHERE n = 1),
crown AS (
  SELECT skey, 'all' AS g, row_number() OVER (ORDER BY encode(skey)) - 1 AS pos, count(*) OVER () AS n, subroot AS d FROM subroots),
{_tree_sql('tops', 'crown')},
below AS (SELECT doc_id, g, pos, coalesce(changed, d) AS acc, '' AS sib FROM leaves),
{_fold_sql('inner_fold', 'below', 'nodes_steps')},
reached AS (
  SELECT f.doc_id, 'all' AS g, c.pos, f.acc, f.sib
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS r FROM inner_fold) f JOIN crown c ON c.skey = f.g WHERE r = 1),
{_fold_sql('outer_fold', 'reached', 'tops_steps')},
done AS (SELECT doc_id, acc, sib, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS r FROM outer_fold)
SELECT doc_id, leaves.d AS leaf, subroot, (SELECT d FROM tops WHERE n = 1) AS root, sha256(sib) AS proof_sha256, acc AS folded_root,
       acc = (SELECT d FROM tops WHERE n = 1) AS verified
FROM leaves JOIN done USING (doc_id) JOIN subroots ON skey = leaves.g WHERE r = 1
"""

_TERMS = r"regexp_extract_all({0}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
SQL["op12_lexical_search"] = rf"""
WITH words AS (SELECT doc_id, {_TERMS.format(_LOWER)} AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0),
tot AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER)}) AS t FROM benchmark),
tf AS (
  SELECT doc_id, t, count(*) AS f FROM (SELECT doc_id, unnest(w) AS t FROM words) SEMI JOIN (SELECT DISTINCT t FROM q) USING (t) GROUP BY 1, 2),
wt AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, tot GROUP BY t, docs),
m AS (SELECT doc_id, 100 - 90 + ((90 * n * docs) // terms) AS m FROM d, tot),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * f) // (1000 * f + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
