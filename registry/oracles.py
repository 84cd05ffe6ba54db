"""The same queries as DuckDB SQL over the given tables.

Nothing here comes from the package: rules and word lists are written out again, so a
wrong rule in the package shows as a difference.
"""

from __future__ import annotations

import string

SEED = 7

# Whitespace when text is stripped or split, as characters and as a pattern class.
WHITESPACE = "".join(map(chr, [
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
    0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
WIDE = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WHITESPACE_RUN = r"[\x09-\x0D\x1C-\x20" + WIDE + "]+"

# The published mteval-v13a rules.
ENTITIES_13A = {"&quot;": '"', "&amp;": "&", "&lt;": "<", "&gt;": ">"}
RULES_13A = [
    (r"([{-~[-` -&(-+:-@/])", r" \1 "),
    (r"([^0-9])([.,])", r"\1 \2 "),
    (r"([.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
]

# Moses-style rules; the apostrophe and the words that keep their period differ by language.
SEPARATE = [
    (r"[\x00-\x20" + WIDE + "]+", "  "),
    (r"([^\pL\pM\pN\s.'`,-])", r" \1 "),
    (r"([.][.]+)", r" \1 "),
    (r"([^\pN]),", r"\1 , "),
    (r",([^\pN])", r" , \1"),
]
APOSTROPHES = {
    "en": [(r"([^\pL\pM])'([^\pL\pM])", r"\1 ' \2"), (r"([^\pL\pM])'([\pL\pM])", r"\1 ' \2"),
           (r"([\pL\pM])'([^\pL\pM])", r"\1 ' \2"), (r"([\pL\pM])'([\pL\pM])", r"\1 '\2")],
    "fr": [(r"([^\pL\pM])'([^\pL\pM])", r"\1 ' \2"), (r"([^\pL\pM])'([\pL\pM])", r"\1 ' \2"),
           (r"([\pL\pM])'([^\pL\pM])", r"\1 ' \2"), (r"([\pL\pM])'([\pL\pM])", r"\1' \2")],
    "de": [("'", " ' ")],
    "es": [("'", " ' ")],
}
KEPT_PERIODS = {
    "en": "Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|vs|etc|e[.]g|i[.]e|No|Inc|Ltd",
    "de": "Dr|Prof|Hr|Fr|Nr|Str|bzw|usw|z[.]B|d[.]h|u[.]a|ca|evtl|ggf",
    "fr": "M|MM|Mme|Mlle|Dr|etc|av|apr|env|cf",
    "es": "Sr|Sra|Srta|Dr|Dra|Ud|Uds|etc|Av|pág",
}


def separation_rules(lang: str) -> list[tuple[str, str]]:
    return [
        *SEPARATE, *APOSTROPHES[lang],
        (r"\s+", "  "),
        (f" ({KEPT_PERIODS[lang]})[.] ", " \\1\x01 "),
        (r" ((?:[\pL\pM][.])+[\pL\pM])[.] ", " \\1\x01 "),
        (r"([^ .])[.] ", r"\1 . "),
        ("\x01", "."),
    ]


# --- views -------------------------------------------------------------------

LINES = """
lines AS (
  SELECT lang, source, doc_id, pos, text,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) AS line_no
  FROM (SELECT doc_id, lang, source,
               unnest(string_split(text, chr(10))) AS text,
               unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents))"""

PAIRS = LINES + """,
pairs AS (
  SELECT coalesce(e.line_no, d.line_no) AS line_no, e.source AS corpus,
         'en' AS src_lang, 'de' AS tgt_lang,
         coalesce(e.text, '') AS src, coalesce(d.text, '') AS tgt
  FROM (SELECT * FROM lines WHERE lang = 'en') e
  FULL OUTER JOIN (SELECT * FROM lines WHERE lang = 'de') d ON e.line_no = d.line_no)"""

CLEAN = PAIRS + """,
clean AS (SELECT line_no, corpus, src, tgt FROM pairs WHERE src <> '' AND tgt <> '')"""

SCORED = PAIRS + """,
scored_pairs AS (
  SELECT line_no, corpus, src, tgt,
         round(least(length(src), length(tgt)) * 1.0 / greatest(length(src), length(tgt)), 4) AS score
  FROM pairs WHERE src <> '' AND tgt <> '')"""

CORPORA = SCORED + """,
corpora AS (
  SELECT line_no, src, tgt, score,
         CASE line_no % 3 WHEN 0 THEN 'parallel' WHEN 1 THEN 'l1_syn_l2_orig' ELSE 'l1_orig_l2_syn' END AS part
  FROM scored_pairs)"""

SYNTHETIC = CORPORA + """,
synthetic AS (
  SELECT line_no, src AS l1, tgt AS l2, score,
         CASE part WHEN 'l1_syn_l2_orig' THEN 'synthetic' ELSE 'original' END AS l1_origin,
         CASE part WHEN 'l1_syn_l2_orig' THEN 'original' ELSE 'synthetic' END AS l2_origin
  FROM corpora WHERE part <> 'parallel')"""

TURNS = """
turns AS (
  SELECT a.conv_id * 100 + a.turn AS sent_id, a.text AS src, b.text AS tgt
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""

HYP_REF = """
hyp_ref AS (
  SELECT item_id, text AS ref,
         (SELECT string_agg(w, ' ' ORDER BY i)
          FROM (SELECT unnest(string_split(text, ' ')) AS w,
                       unnest(range(len(string_split(text, ' ')))) AS i)
          WHERE i % 5 <> 4) AS hyp
  FROM benchmark)"""

LEDGER = """
ledger AS (
  SELECT user_id % 5 AS experiment, (event_id // 2) % 8 + 1 AS iteration,
         CASE WHEN event_id % 2 = 0 THEN '1n' ELSE 'n1' END AS direction,
         round(avg(value), 0) AS metric
  FROM events GROUP BY ALL)"""

BASELINES = LEDGER + """,
baselines AS (SELECT experiment, direction, avg(metric) AS baseline FROM ledger GROUP BY ALL)"""


def flags(ctes: str, baseline: str, where: str = "true") -> str:
    """Accept flags as a view; ``baseline`` is an expression, NULL for none."""
    return ctes + f""",
flags AS (
  SELECT experiment, iteration, direction, metric, metric >= bar OR bar IS NULL AS accepted
  FROM (SELECT l.*, greatest({baseline}, max(metric) OVER (
                 PARTITION BY experiment, direction ORDER BY iteration
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS bar
        FROM ledger l LEFT JOIN baselines b USING (experiment, direction) WHERE {where}))"""


def vocab(lang: str) -> str:
    return f"""
vocab_{lang} AS (
  SELECT token, "count", row_number() OVER (ORDER BY "count" DESC, token) - 1 AS token_id
  FROM (SELECT unnest(string_split(lower(text), ' ')) AS token, count(*) AS "count"
        FROM lines WHERE lang = '{lang}' GROUP BY 1))"""


# --- expressions -------------------------------------------------------------

def strip(expr: str) -> str:
    return f"trim({expr}, '{WHITESPACE}')"


def words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WHITESPACE_RUN}'), lambda w: w <> '')"


def one_line(expr: str) -> str:
    return f"translate({expr}, chr(9) || chr(10) || chr(13), '   ')"


def rules(expr: str, chain: list[tuple[str, str]]) -> str:
    for pattern, replacement in chain:
        pattern = pattern.replace("'", "''")
        replacement = replacement.replace("'", "''")
        expr = f"regexp_replace({expr}, '{pattern}', '{replacement}', 'g')"
    return expr


def tokenised(expr: str, lang: str) -> str:
    return words(rules(f"' ' || {expr} || ' '", separation_rules(lang)))


def tokens_13a(expr: str) -> str:
    expr = f"replace(replace(replace({expr}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for entity, char in ENTITIES_13A.items():
        expr = f"replace({expr}, '{entity}', '{char}')"
    return words(rules(f"' ' || {expr} || ' '", RULES_13A))


def sample_key(expr: str) -> str:
    return f"md5('{SEED}:' || {expr})"


def grams(view: str, arr: str, top: int, keep: str = "") -> str:
    """n-grams of an array column up to an order, with counts: (key, n, gram, c)."""
    return " UNION ALL ".join(
        f"SELECT part, id, {n} AS n, gram, count(*) AS c FROM (SELECT part, id, unnest([array_to_string({arr}[i:i+{n - 1}], chr(31)) "
        f"FOR i IN range(1, len({arr}) - {n - 2})]) AS gram FROM {view}) {keep} GROUP BY ALL"
        for n in range(1, top + 1)
    )


def bleu(rows: str, hyp: str, ref: str) -> str:
    """BLEU by counting exploded n-grams: CTEs ending in ``bleu(part, bleu)``.

    ``rows`` is a query of (part, id, hyp, ref); hyp and ref are token expressions.
    """
    return f"""
seg AS (SELECT part, id, {hyp} AS h, {ref} AS r FROM ({rows})),
hg AS ({grams('seg', 'h', 4)}),
rg AS ({grams('seg', 'r', 4)}),
per AS (
  SELECT part, n, sum(hg.c) AS total, sum(CASE WHEN rg.c IS NULL THEN 0 ELSE least(hg.c, rg.c) END) AS match
  FROM hg LEFT JOIN rg USING (part, id, n, gram) GROUP BY ALL),
orders AS (
  SELECT part, n, coalesce(total, 0) AS total, coalesce(match, 0) AS match
  FROM (SELECT DISTINCT part, n FROM seg, (SELECT unnest(range(1, 5)) AS n)) LEFT JOIN per USING (part, n)),
smooth AS (
  SELECT *, sum((match = 0)::INT) OVER (PARTITION BY part ORDER BY n) AS zeros FROM orders),
lens AS (SELECT part, sum(len(h)) AS hl, sum(len(r)) AS rl FROM seg GROUP BY part),
bleu AS (
  SELECT part, CASE WHEN max(match) = 0 OR min(total) = 0 THEN 0.0 ELSE
         100.0 * exp(sum(ln(CASE WHEN match > 0 THEN match::DOUBLE ELSE pow(0.5::DOUBLE, zeros) END / greatest(total, 1))) / 4)
         * max(CASE WHEN hl >= rl THEN 1.0::DOUBLE ELSE exp(1.0::DOUBLE - rl::DOUBLE / hl) END) END AS bleu
  FROM smooth JOIN lens USING (part) GROUP BY part)"""


def chrf(rows: str, word_order: int) -> str:
    """chrF by counting exploded n-grams: CTEs ending in ``chrf(part, chrf)``."""
    punct = string.punctuation.replace("'", "''")
    split_word = (
        f"CASE WHEN length(w) = 1 THEN [w] "
        f"WHEN contains('{punct}', w[-1:]) THEN [w[:-2], w[-1:]] "
        f"WHEN contains('{punct}', w[1:1]) THEN [w[1:1], w[2:]] ELSE [w] END"
    )

    def chars(c: str) -> str:
        return f"list_filter(string_split(regexp_replace({c}, '{WHITESPACE_RUN}', '', 'g'), ''), lambda x: x <> '')"

    def chrf_words(c: str) -> str:
        return f"flatten([{split_word} FOR w IN {words(c)}])"

    kinds = [("c", 6)] + ([("w", word_order)] if word_order else [])
    sides = "\n".join(
        f", {side}{kind} AS ({grams('cseg', side + kind, top)})" for kind, top in kinds for side in ("h", "r")
    )
    stats = " UNION ALL ".join(
        f"""SELECT part, '{kind}' AS kind, n,
               (SELECT coalesce(sum(x.c), 0) FROM h{kind} x WHERE x.part = o.part AND x.n = o.n
                 AND EXISTS (SELECT 1 FROM r{kind} y WHERE y.part = x.part AND y.id = x.id AND y.n = x.n)) AS hyp,
               (SELECT coalesce(sum(c), 0) FROM r{kind} x WHERE x.part = o.part AND x.n = o.n) AS ref,
               (SELECT coalesce(sum(least(x.c, y.c)), 0) FROM h{kind} x JOIN r{kind} y USING (part, id, n, gram)
                 WHERE x.part = o.part AND x.n = o.n) AS match
            FROM (SELECT DISTINCT part, n FROM cseg, (SELECT unnest(range(1, {top + 1})) AS n)) o"""
        for kind, top in kinds
    )
    cols = ", ".join(
        f"{chars(s) if kind == 'c' else chrf_words(s)} AS {s[0]}{kind}" for kind, _ in kinds for s in ("hyp", "ref")
    )
    return f"""
cseg AS (SELECT part, id, {cols} FROM ({rows})){sides},
cstat AS ({stats}),
pr AS (
  SELECT part, avg(match::DOUBLE / hyp) AS p, avg(match::DOUBLE / ref) AS r
  FROM cstat WHERE hyp > 0 AND ref > 0 GROUP BY part),
chrf AS (
  SELECT part, CASE WHEN coalesce(p, 0) + coalesce(r, 0) = 0 THEN 0.0 ELSE 100 * 5 * p * r / (4 * p + r) END AS chrf
  FROM (SELECT DISTINCT part FROM cseg) LEFT JOIN pr USING (part))"""


def bpe(words: str, size: int) -> str:
    """Byte pairs, one merge at a time: CTEs ending in ``cut(w, seg)``, ``merges(i, a, b)`` and ``alphabet(c, n)``.

    ``words`` is a query of (w, n); words with n = 0 are cut but teach nothing. Needs WITH RECURSIVE.
    """
    return f"""
bw AS MATERIALIZED (SELECT '▁' || w AS w, sum(n) AS n FROM ({words}) GROUP BY 1),
alphabet AS MATERIALIZED (
  SELECT c, sum(n) AS n FROM (SELECT unnest(string_split(w, '')) AS c, n FROM bw) WHERE c <> '' GROUP BY c HAVING sum(n) > 0),
bpe AS (
  SELECT 0 AS i, w, n, ' ' || array_to_string(list_filter(string_split(w, ''), lambda c: c <> ''), '  ') || ' ' AS seg,
         '' AS a, '' AS b FROM bw
  UNION ALL
  SELECT i + 1, w, n, replace(seg, ' ' || p.a || '  ' || p.b || ' ', ' ' || p.a || p.b || ' '), p.a, p.b
  FROM bpe, (
    SELECT a, b FROM (SELECT unnest(s[:-2]) AS a, unnest(s[2:]) AS b, n
                      FROM (SELECT string_split(trim(seg, ' '), '  ') AS s, n FROM bpe WHERE n > 0))
    GROUP BY a, b ORDER BY sum(n) DESC, length(a || b), a || b, length(a) LIMIT 1) p
  WHERE i < (SELECT {size} - 3 - count(*) FROM alphabet)),
merges AS (SELECT DISTINCT i, a, b FROM bpe WHERE i > 0),
cut AS MATERIALIZED (SELECT w, string_split(trim(seg, ' '), '  ') AS p FROM bpe WHERE i = (SELECT max(i) FROM bpe))"""


def student_ids(train: str, others: str) -> str:
    """CTEs ending in ``side_ids(split, line_no, side, ids, known)`` for the two-sided student pairs."""
    return f"""
mixed AS ({mixture([SO, OS], with_ctes=False)}),
stu AS (
  SELECT line_no, CASE WHEN {train} THEN 'train' ELSE {others} END AS split, {strip('l1')} AS src, {strip('l2')} AS tgt
  FROM mixed WHERE {strip('l1')} <> '' AND {strip('l2')} <> ''),
sw AS MATERIALIZED (
  SELECT split, line_no, side, unnest({words('text')}) AS w, unnest(range(len({words('text')}))) AS i
  FROM (SELECT split, line_no, 'src' AS side, src AS text FROM stu UNION ALL SELECT split, line_no, 'tgt', tgt FROM stu)),
{bpe("SELECT w, CASE split WHEN 'train' THEN 1 ELSE 0 END AS n FROM sw", SMALL_VOCABULARY)},
sp AS MATERIALIZED (
  SELECT split, line_no, side, i, unnest(p) AS token, unnest(range(len(p))) AS j FROM sw JOIN cut ON cut.w = '▁' || sw.w),
sd AS (
  SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS id FROM sp
  WHERE split = 'train' AND token NOT IN ('<s>', '<pad>', '</s>', '<unk>') GROUP BY token)"""


SMALL_VOCABULARY = 128
THRESHOLDS = "(SELECT (unnest(range(10)) / 10.0)::DOUBLE AS threshold)"
HYP_ROWS = "SELECT 0 AS part, item_id AS id, hyp, ref FROM hyp_ref"
NEGATIVES = f"""
keyed AS (SELECT *, {sample_key('line_no')} AS key FROM clean),
negatives AS (
  SELECT line_no, src, other AS tgt, tgt_line_no FROM (
    SELECT line_no, src, tgt,
           coalesce(lead(tgt) OVER (ORDER BY key), first_value(tgt) OVER (ORDER BY key)) AS other,
           coalesce(lead(line_no) OVER (ORDER BY key), first_value(line_no) OVER (ORDER BY key)) AS tgt_line_no
    FROM keyed)
  WHERE tgt_line_no <> line_no AND other <> tgt)"""

# Features of ``ex(line_no, src, tgt)``; the target's words are cut as those of the frequency list.
FEATURES = f"""
fw AS (SELECT unnest({tokenised('lower(text)', 'de')}) AS word FROM lines WHERE lang = 'de'),
ff AS (SELECT word, count(*) AS n FROM fw GROUP BY word HAVING count(*) >= 2),
fb AS (SELECT line_no, src, tgt, {words('lower(src)')} AS s, {words('lower(tgt)')} AS t,
              regexp_extract_all(src, '\\d+') AS sd, regexp_extract_all(tgt, '\\d+') AS td,
              len(regexp_extract_all(src, '[.,;:!?()]')) AS sp, len(regexp_extract_all(tgt, '[.,;:!?()]')) AS tp
       FROM ex),
fl AS (SELECT line_no, avg(ln(coalesce(n, 1)::DOUBLE)) AS lf
       FROM (SELECT line_no, unnest({tokenised('lower(tgt)', 'de')}) AS word FROM fb) LEFT JOIN ff USING (word) GROUP BY line_no),
features AS (
  SELECT line_no, len(s)::INT AS src_tokens, len(t)::INT AS tgt_tokens,
         round(least(length(src), length(tgt))::DOUBLE / greatest(length(src), length(tgt)), 6) AS length_ratio,
         round(coalesce(len(list_distinct(list_intersect(s, t))) / nullif(len(list_distinct(s)), 0), 0)::DOUBLE, 6) AS copied_share,
         round(CASE WHEN greatest(sp, tp) = 0 THEN 1.0 ELSE least(sp, tp) / greatest(sp, tp) END::DOUBLE, 6) AS punct_agreement,
         round(CASE WHEN len(sd) + len(td) = 0 THEN 1.0 ELSE len(list_distinct(list_intersect(sd, td)))
               / len(list_distinct(list_concat(sd, td))) END::DOUBLE, 6) AS digit_agreement,
         round(coalesce(lf, 0)::DOUBLE, 6) AS tgt_log_freq
  FROM fb LEFT JOIN fl USING (line_no))"""

THREES = "regexp_extract_all({}, '[^ ]{{1,3}}')"
LOG_TEXT = "replace(tgt, chr(10), ' ')"
# The log lacks ids ending in 4, and every third hypothesis its first word; every reference counts.
REPORT_ROWS = f"""SELECT 0 AS part, sent_id AS id, {one_line('tgt')} AS ref,
       CASE WHEN sent_id % 10 = 4 THEN '' ELSE
            split_part(CASE WHEN sent_id % 3 = 0 THEN regexp_replace({LOG_TEXT}, '^[^ ]* ', '') ELSE {LOG_TEXT} END, chr(9), 1) END AS hyp
  FROM turns"""
ROLES = "CASE source WHEN 'src0' THEN 'test' WHEN 'src1' THEN 'valid' ELSE 'train' END"


def mixture(parts: list[str], with_ctes: bool = True) -> str:
    """Parallel pairs, then each synthetic kind after the last line of what came before."""
    sql = "SELECT line_no, src AS l1, tgt AS l2, 'original' AS l1_origin, 'original' AS l2_origin FROM corpora WHERE part = 'parallel'"
    before = "(SELECT max(line_no) FROM corpora WHERE part = 'parallel')"
    for part in parts:
        l1, l2 = ("synthetic", "original") if part == "l1_syn_l2_orig" else ("original", "synthetic")
        sql += f" UNION ALL SELECT line_no + {before}, src, tgt, '{l1}', '{l2}' FROM corpora WHERE part = '{part}'"
        before += f" + (SELECT max(line_no) FROM corpora WHERE part = '{part}')"
    return f"WITH {CORPORA} {sql}" if with_ctes else sql


SO, OS = "l1_syn_l2_orig", "l1_orig_l2_syn"

SQL: dict[str, str] = {
    # sources and sinks
    "read_corpus": f"""WITH {LINES}
        SELECT 'documents' AS corpus, 'en' AS lang, line_no, {one_line('text')} AS text FROM lines WHERE lang = 'en'""",
    "read_parallel": f"""WITH {PAIRS}
        SELECT 'documents' AS corpus, line_no, src_lang, tgt_lang, {one_line('src')} AS src, {one_line('tgt')} AS tgt
        FROM pairs""",
    "read_parallel_listed": f"""WITH {LINES}, s AS (
          SELECT row_number() OVER (ORDER BY line_no % 3, line_no) AS line_no, text FROM lines WHERE lang = 'en'),
        t AS (SELECT row_number() OVER (ORDER BY line_no % 3, line_no) AS line_no, text FROM lines WHERE lang = 'de')
        SELECT 'listed' AS corpus, coalesce(s.line_no, t.line_no) AS line_no, 'en' AS src_lang, 'de' AS tgt_lang,
               coalesce({one_line('s.text')}, '') AS src, coalesce({one_line('t.text')}, '') AS tgt
        FROM s FULL OUTER JOIN t ON s.line_no = t.line_no""",
    "read_corpora": f"""WITH {LINES}
        SELECT lang || '_lines' AS corpus, {one_line('text')} AS text,
               row_number() OVER (ORDER BY CASE lang WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END, line_no) AS line_no
        FROM lines WHERE lang IN ('fr', 'de', 'en')""",
    "assign_splits": f"""WITH {LINES}
        SELECT {ROLES} AS split, source AS corpus, lang, line_no FROM lines
        WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4')""",
    "write_splits": f"""WITH {LINES}
        SELECT {ROLES} AS split, source AS corpus, lang, line_no, text FROM lines
        WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4')""",
    "read_corpus_glob": f"""WITH {LINES}
        SELECT row_number() OVER (ORDER BY lang, line_no) AS line_no, {one_line('text')} AS text FROM lines""",
    "read_scored": f"WITH {SCORED} SELECT {one_line('src')} AS src, {one_line('tgt')} AS tgt, score FROM scored_pairs",
    "write_sides": f"""WITH {CLEAN}
        SELECT row_number() OVER (ORDER BY line_no) AS line_no, {one_line('src')} AS src, {one_line('tgt')} AS tgt
        FROM clean""",
    "write_wordfreq": f"""WITH {LINES}, w AS (
          SELECT unnest({tokenised('lower(text)', 'de')}) AS word FROM lines WHERE lang = 'de')
        SELECT word, count(*) AS "count" FROM w GROUP BY word HAVING count(*) >= 2""",
    "materialize_once_per_stage": f"WITH {LINES} SELECT source AS corpus, count(*) AS n_rows FROM lines GROUP BY ALL",
    "write_result": f"""WITH {LEDGER}
        SELECT experiment, iteration, direction, metric FROM ledger
        QUALIFY row_number() OVER (PARTITION BY experiment, direction ORDER BY metric DESC, iteration DESC) = 1""",
    "write_synthetic": f"WITH {SYNTHETIC} SELECT line_no, l1, l2, l1_origin, l2_origin FROM synthetic",
    # projections and filters
    "number_lines": f"WITH {LINES} SELECT lang, source, doc_id, pos, text, line_no FROM lines",
    "drop_empty_pairs": f"""WITH {PAIRS}
        SELECT line_no, corpus, {strip('src')} AS src, {strip('tgt')} AS tgt
        FROM pairs WHERE {strip('src')} <> '' AND {strip('tgt')} <> ''""",
    "drop_empty_pairs_unchanged": f"WITH {CLEAN} SELECT line_no, corpus, src, tgt FROM clean",
    "side_src": f"WITH {PAIRS} SELECT line_no, src AS text FROM pairs",
    "side_tgt": f"WITH {PAIRS} SELECT line_no, tgt AS text FROM pairs",
    "filter_by_score": f"WITH {SCORED} SELECT line_no, corpus, score FROM scored_pairs WHERE score > 0.5::DOUBLE",
    "max_pieces": f"""WITH {LINES}
        SELECT lang, line_no, len({words('text')})::INT AS n_pieces FROM lines WHERE len({words('text')}) <= 100""",
    "strip_lines": f"WITH {LINES} SELECT lang, line_no, {strip('text')} AS text FROM lines WHERE {strip('text')} <> ''",
    "length_filter": f"""WITH {PAIRS}, p AS (SELECT line_no, {words('src')} AS s, {words('tgt')} AS t FROM pairs)
        SELECT line_no, array_to_string(s, ' ') AS src_pieces, array_to_string(t, ' ') AS tgt_pieces
        FROM p WHERE len(s) BETWEEN 5 AND 80 AND len(t) BETWEEN 5 AND 80""",
    "encode_stats": f"""WITH {PAIRS}, p AS (SELECT len({words('src')}) AS s, len({words('tgt')}) AS t FROM pairs)
        SELECT count(*) AS num_lines,
               sum((s = 0)::INT + (t = 0)::INT)::BIGINT AS num_empty,
               sum((s > 0 AND s NOT BETWEEN 5 AND 80)::INT + (t > 0 AND t NOT BETWEEN 5 AND 80)::INT)::BIGINT AS num_filtered,
               count(*) FILTER (WHERE s BETWEEN 5 AND 80 AND t BETWEEN 5 AND 80) AS num_kept
        FROM p""",
    "parse_hypotheses": f"""WITH {TURNS}
        SELECT sent_id, (-0.5)::DOUBLE AS score, split_part({LOG_TEXT}, chr(9), -1) AS text FROM turns""",
    "parse_hypotheses_third": f"""WITH {TURNS}, t AS (
          SELECT sent_id, regexp_replace({LOG_TEXT}, '^(.*) ', '\\1' || chr(9)) AS text FROM turns)
        SELECT sent_id, (-0.5)::DOUBLE AS score, split_part(text, chr(9), 1) AS third, split_part(text, chr(9), -1) AS last
        FROM t""",
    "normalize_text": f"WITH {LINES} SELECT lang, line_no, nfc_normalize(text) AS text FROM lines",
    "lower_text": f"WITH {LINES} SELECT lang, line_no, lower(text) AS text FROM lines",
    **{
        f"tokenize_{lang}": f"""WITH {LINES}
            SELECT line_no, array_to_string({tokenised('text', lang)}, ' ') AS tokens FROM lines WHERE lang = '{lang}'"""
        for lang in ("de", "en", "es", "fr")
    },
    "encode_pieces": f"WITH {LINES} SELECT lang, line_no, array_to_string({THREES.format('text')}, ' ') AS pieces FROM lines",
    "encode_ids": f"""WITH {LINES}, {vocab('en')}, t AS (
          SELECT line_no, unnest(string_split(lower(text), ' ')) AS token,
                 unnest(range(len(string_split(text, ' ')))) AS i FROM lines WHERE lang = 'de')
        SELECT line_no, string_agg(coalesce(token_id, 3)::VARCHAR, ' ' ORDER BY i) AS id_text
        FROM t LEFT JOIN vocab_en USING (token) GROUP BY line_no""",
    "decode_pieces": f"WITH {LINES} SELECT lang, line_no, text FROM lines",
    "decode_ids": f"""WITH {LINES}, {vocab('en')}, t AS (
          SELECT line_no, unnest(string_split(lower(text), ' ')) AS token,
                 unnest(range(len(string_split(text, ' ')))) AS i FROM lines WHERE lang = 'de')
        SELECT line_no, string_agg(coalesce(v.token, (SELECT token FROM vocab_en WHERE token_id = 0)), '' ORDER BY i) AS text
        FROM t LEFT JOIN vocab_en v USING (token) GROUP BY line_no""",
    "remove_subwords": f"WITH {TURNS} SELECT sent_id, {strip('tgt')} AS text FROM turns",
    "lang_codes": """SELECT doc_id, lang AS code, '__' || lang || '_' || upper(lang) || '__' AS symbol FROM documents""",
    "score_label": f"""WITH {SCORED}
        SELECT line_no, lpad(floor(score * 10)::INT::VARCHAR, 2, '0') AS label,
               (CASE WHEN floor(score * 10) >= 10 THEN 1.0 ELSE floor(score * 10) / 10 END)::DOUBLE AS threshold
        FROM scored_pairs""",
    "with_placeholder": f"WITH {LINES} SELECT lang, line_no, line_no::VARCHAR AS tgt FROM lines",
    "add_lang_tags": f"""WITH {PAIRS}
        SELECT line_no, array_to_string(list_prepend('en_XX', {words('src')}), ' ') AS src_pieces,
               array_to_string(list_prepend('de_DE', {words('tgt')}), ' ') AS tgt_pieces FROM pairs""",
    "parse_report": f"WITH {LEDGER} SELECT experiment, iteration, direction, metric AS value FROM ledger",
    # joins
    "pair_by_line_pad": f"WITH {PAIRS} SELECT * FROM pairs",
    "pair_by_line_truncate": f"""WITH {LINES}
        SELECT e.line_no, e.text AS src, d.text AS tgt
        FROM lines e JOIN lines d ON e.line_no = d.line_no WHERE e.lang = 'en' AND d.lang = 'de'""",
    "attach_hypotheses": f"""WITH {TURNS}
        SELECT sent_id, src, split_part({LOG_TEXT}, chr(9), -1) AS hyp FROM turns WHERE sent_id % 10 <> 4""",
    "missing_hypotheses": f"WITH {TURNS} SELECT count(*) AS missing FROM turns WHERE sent_id % 10 = 4",
    "map_vocabulary": f"""WITH {LINES}, {vocab('en')}, {vocab('de')}
        SELECT d.token, d.token_id, coalesce(e.token_id, 0) AS src_id FROM vocab_de d LEFT JOIN vocab_en e USING (token)""",
    "trim_embeddings": f"""WITH {LINES}, {vocab('de')}, k AS (
          SELECT token_id, CASE WHEN token_id > (SELECT max(vec_id) FROM embeddings) THEN 0 ELSE token_id END AS src_id FROM vocab_de)
        SELECT token_id, src_id,
               array_to_string([round(x::DOUBLE * 1000000)::BIGINT::VARCHAR FOR x IN embedding], ' ') AS millionths
        FROM k JOIN embeddings ON vec_id = src_id""",
    "ids_from_vocab": f"""WITH {LINES}, {vocab('de')}, t AS (
          SELECT line_no, unnest(string_split(lower(text), ' ')) AS token,
                 unnest(range(len(string_split(text, ' ')))) AS i FROM lines WHERE lang = 'de')
        SELECT line_no, string_agg(token_id::VARCHAR, ' ' ORDER BY i) || ' 2' AS ids
        FROM t JOIN vocab_de USING (token) GROUP BY line_no""",
    "missing_corpora": """SELECT corpus FROM (VALUES ('src1'), ('src2'), ('src99'), ('dev')) v(corpus)
        WHERE corpus NOT IN (SELECT source FROM documents)""",
    # aggregations
    "threshold_sweep_by_corpus": f"""WITH {SCORED}
        SELECT corpus, threshold, count(*) FILTER (WHERE score > threshold) AS n_pairs
        FROM scored_pairs, {THRESHOLDS} GROUP BY ALL""",
    "threshold_sweep": f"""WITH {SCORED}
        SELECT threshold, count(*) FILTER (WHERE score > threshold) AS n_pairs
        FROM scored_pairs, {THRESHOLDS} GROUP BY ALL""",
    "word_frequencies": f"""WITH w AS (
          SELECT unnest({tokenised('lower(text)', 'en')}) AS word FROM documents WHERE lang = 'en')
        SELECT word, count(*) AS "count" FROM w GROUP BY word HAVING count(*) >= 2""",
    "word_frequencies_as_written": f"""WITH {LINES}, w AS (
          SELECT unnest({tokenised('lower(text)', 'de')}) AS word FROM lines WHERE lang = 'de')
        SELECT word, count(*) AS "count" FROM w GROUP BY word HAVING NOT contains(count(*) || ' ' || word, '1')""",
    "build_dictionary": f"""WITH {LINES}, t AS (
          SELECT unnest(string_split(lower(text), ' ')) AS token, 1 AS n FROM lines WHERE lang = 'en'
          UNION ALL SELECT unnest(['__en_XX__', '__de_DE__']), 1),
        c AS (SELECT token, count(*) AS "count" FROM t WHERE token NOT IN ('<s>', '<pad>', '</s>', '<unk>') GROUP BY token),
        s AS (SELECT count(*) + 4 AS size FROM c),
        p AS (SELECT size, (8 - (size + 3) % 8) % 8 + 3 AS k FROM s)
        SELECT token, "count", row_number() OVER (ORDER BY "count" DESC, token) + 3 AS token_id FROM c
        UNION ALL
        SELECT 'madeupword' || lpad(i::VARCHAR, 4, '0'), 0, size + i FROM (SELECT size, unnest(range(k)) AS i FROM p)""",
    "joined_dictionary": f"""WITH {PAIRS}, c AS (
          SELECT unnest({words("src || ' ' || tgt")}) AS token, count(*) AS "count" FROM pairs GROUP BY 1)
        SELECT token, "count", row_number() OVER (ORDER BY "count" DESC, token) + 3 AS token_id FROM c""",
    "corpus_counts": f"WITH {LINES} SELECT lang, source AS corpus, count(*) AS n_rows FROM lines GROUP BY ALL",
    "corpus_bleu": f"WITH {HYP_REF}, {bleu(HYP_ROWS, tokens_13a('hyp'), tokens_13a('ref'))} SELECT round(bleu, 6) AS bleu FROM bleu",
    "corpus_bleu_turns": f"""WITH {TURNS}, {bleu(
        'SELECT sent_id % 3 AS part, sent_id AS id, src AS hyp, tgt AS ref FROM turns', tokens_13a('hyp'), tokens_13a('ref'))}
        SELECT part, round(bleu, 6) AS bleu FROM bleu""",
    "corpus_chrf": f"WITH {HYP_REF}, {chrf(HYP_ROWS, 0)} SELECT round(chrf, 6) AS chrf FROM chrf",
    "corpus_chrf_plus_plus": f"WITH {HYP_REF}, {chrf(HYP_ROWS, 2)} SELECT round(chrf, 6) AS chrf FROM chrf",
    "corpus_bleu_pieces": f"WITH {HYP_REF}, {bleu(HYP_ROWS, THREES.format('hyp'), THREES.format('ref'))} SELECT round(bleu, 6) AS bleu FROM bleu",
    "evaluate": f"""
        (WITH {HYP_REF}, {bleu(HYP_ROWS, tokens_13a('hyp'), tokens_13a('ref'))} SELECT 'BLEU' AS metric, round(bleu, 6) AS value FROM bleu)
        UNION ALL (WITH {HYP_REF}, {chrf(HYP_ROWS, 0)} SELECT 'chrF', round(chrf, 6) FROM chrf)
        UNION ALL (WITH {HYP_REF}, {bleu(HYP_ROWS, THREES.format('hyp'), THREES.format('ref'))} SELECT 'spBLEU', round(bleu, 6) FROM bleu)""",
    "vocab_coverage": f"""WITH {LINES}, {vocab('en')}, t AS (
          SELECT lang, unnest(string_split(lower(text), ' ')) AS token FROM lines)
        SELECT lang, count(*) AS n_tokens, count(*) FILTER (WHERE token_id IS NULL) AS n_oov,
               round(count(*) FILTER (WHERE token_id IS NULL) / count(*), 6) AS oov_rate
        FROM t LEFT JOIN vocab_en USING (token) GROUP BY lang""",
    # run ledger
    "best_run": f"""WITH {LEDGER}
        SELECT experiment, iteration, direction, metric FROM ledger
        QUALIFY row_number() OVER (PARTITION BY experiment, direction ORDER BY metric DESC, iteration DESC) = 1""",
    "accept_flags": f"WITH {flags(BASELINES, 'NULL')} SELECT * FROM flags",
    "accept_flags_baseline": f"WITH {flags(BASELINES, 'baseline')} SELECT * FROM flags",
    "stop_iteration": f"""WITH {flags(BASELINES, 'NULL')}
        SELECT experiment, coalesce(min(iteration) FILTER (WHERE NOT any_ok), 8) AS stop_iteration
        FROM (SELECT experiment, iteration, bool_or(accepted) AS any_ok FROM flags GROUP BY ALL) GROUP BY experiment""",
    "best_threshold": f"""WITH {LEDGER}
        SELECT experiment, direction, (iteration - 1) / 10 AS threshold, metric FROM ledger WHERE metric >= 0
        QUALIFY row_number() OVER (PARTITION BY experiment, direction ORDER BY metric DESC, iteration DESC) = 1""",
    "assign_ids": f'WITH {LINES}, {vocab("en")} SELECT token, "count", token_id FROM vocab_en',
    "gate": f"""WITH {flags(BASELINES, 'baseline', 'iteration = 1')}
        SELECT experiment, bool_and(accepted) AND count(*) >= 2 AS go_on FROM flags GROUP BY experiment""",
    # orders, prefixes, samples
    "order_by_id": f"WITH {TURNS} SELECT sent_id::VARCHAR AS sent_id, src FROM turns ORDER BY turns.sent_id",
    "order_by_frequency": f"""WITH {LINES}, {vocab('fr')} SELECT token AS word, "count" FROM vocab_fr ORDER BY "count" DESC, word DESC""",
    "head_lines": f"WITH {LINES} SELECT lang, line_no, text FROM lines WHERE line_no <= 1000",
    "growing_prefix": f"""WITH {LINES}, n AS (
          SELECT 0 AS iteration, 1000000 AS lim UNION ALL SELECT 0, 2000000 UNION ALL SELECT i, (i + 2) * 1000000 FROM range(1, 9) t(i))
        SELECT iteration::BIGINT AS iteration, count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars
        FROM n JOIN lines ON lang = 'en' AND line_no <= lim GROUP BY iteration, lim""",
    "cap_pairs": f"WITH {CLEAN} SELECT line_no, src, tgt FROM clean ORDER BY {sample_key('line_no')} LIMIT 600000",
    "cap_pairs_as_written": f"WITH {CLEAN} SELECT line_no, src, tgt FROM clean ORDER BY line_no LIMIT 600000",
    "shuffle_rows": f"WITH {CLEAN} SELECT line_no, src, tgt FROM clean ORDER BY {sample_key('line_no')}",
    # mixtures
    "concat_corpora": f"""WITH {LINES}
        SELECT lang, row_number() OVER (ORDER BY CASE lang WHEN 'fr' THEN 1 WHEN 'en' THEN 2 WHEN 'de' THEN 3 ELSE 4 END, line_no)
               AS line_no, text FROM lines""",
    "augment": f"""WITH {CORPORA}, u AS (
          SELECT line_no, src, tgt, 'original' AS src_origin, 'original' AS tgt_origin FROM corpora WHERE part = 'parallel'
          UNION ALL SELECT line_no + (SELECT max(line_no) FROM corpora WHERE part = 'parallel'), src, tgt, 'synthetic', 'original'
          FROM corpora WHERE part = 'l1_syn_l2_orig')
        SELECT line_no, {strip('src')} AS src, {strip('tgt')} AS tgt, src_origin, tgt_origin
        FROM u WHERE {strip('src')} <> '' AND {strip('tgt')} <> ''""",
    "mixture_back_1n": mixture([SO]),
    "mixture_back_n1": mixture([OS]),
    "mixture_forward_1n": mixture([OS]),
    "mixture_forward_n1": mixture([SO]),
    "mixture_all_1n": mixture([SO, OS]),
    "mixture_all_n1": mixture([SO, OS]),
    "joint_text": f"WITH {CLEAN} SELECT src AS text FROM clean UNION ALL SELECT tgt FROM clean",
    "temperature_weights": f"""WITH {LINES}, n AS (SELECT lang, count(*) AS n_rows FROM lines GROUP BY lang),
        p AS (SELECT lang, n_rows, pow(n_rows, 1 / 1.5) / sum(pow(n_rows, 1 / 1.5)) OVER () AS p FROM n)
        SELECT lang, n_rows, round(p, 6) AS p, round(p * sum(n_rows) OVER () / n_rows, 6) AS rate FROM p""",
    "temperature_mix": f"""WITH {LINES}, n AS (SELECT lang, count(*) AS n_rows FROM lines GROUP BY lang),
        p AS (SELECT lang, n_rows, pow(n_rows, 1 / 1.5) / sum(pow(n_rows, 1 / 1.5)) OVER () AS p FROM n),
        r AS (SELECT lang, p * sum(n_rows) OVER () / n_rows AS rate FROM p),
        d AS (SELECT lang, line_no, (floor(rate) + (('0x' || substr({sample_key('line_no')}, 1, 8))::BIGINT / 4294967296.0
                     < rate - floor(rate))::INT)::BIGINT AS copies FROM lines JOIN r USING (lang))
        SELECT lang, line_no, unnest(range(1, copies + 1)) AS copy FROM d""",
    # scoring, subwords, synthesis
    "pair_features": f"""WITH {CLEAN}, ex AS (SELECT line_no, src, tgt FROM clean), {FEATURES}
        SELECT * FROM features""",
    "make_negatives": f"WITH {CLEAN}, {NEGATIVES} SELECT line_no, src, tgt, tgt_line_no FROM negatives",
    "pair_examples": f"""WITH {CLEAN}, {NEGATIVES}, ex AS (
          SELECT line_no * 2 AS line_no, src, tgt FROM clean UNION ALL SELECT line_no * 2 + 1, src, tgt FROM negatives), {FEATURES}
        SELECT *, (1 - line_no % 2)::DOUBLE AS label FROM features""",
    "classifier_data": f"""WITH {LINES}, c AS (
          SELECT lang, {one_line('text')} AS text, CASE source WHEN 'src2' THEN 'dev' ELSE 'train' END AS part,
                 row_number() OVER (PARTITION BY lang, source = 'src2' ORDER BY source DESC, line_no) AS line_no
          FROM lines WHERE source IN ('src1', 'src2', 'src3') AND lang IN ('en', 'de')),
        p AS (SELECT e.part, e.line_no, {strip('e.text')} AS src, {strip('d.text')} AS tgt
              FROM c e JOIN c d ON e.part = d.part AND e.line_no = d.line_no WHERE e.lang = 'en' AND d.lang = 'de'),
        k AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY {sample_key('line_no')}) AS r FROM p WHERE src <> '' AND tgt <> '')
        SELECT part, line_no, src, tgt FROM k WHERE part = 'dev' OR r <= 600000""",
    "score_pairs_formula": f"WITH {SCORED} SELECT line_no, score FROM scored_pairs",
    "clean_synthetic": f"WITH {SYNTHETIC} SELECT line_no, l1_origin, l2_origin, score FROM synthetic WHERE score > 0.3::DOUBLE",
    "learn_bpe": f"""WITH RECURSIVE {LINES}, {bpe(f"SELECT unnest({words('text')}) AS w, 1 AS n FROM lines", SMALL_VOCABULARY)},
        entries AS (
          SELECT unnest(['<unk>', '<s>', '</s>']) AS piece, 0 AS part, unnest(range(3)) AS nth
          UNION ALL SELECT a || b, 1, i FROM merges
          UNION ALL SELECT c, 2, row_number() OVER (ORDER BY n DESC, c) FROM alphabet)
        SELECT piece, row_number() OVER (ORDER BY part, nth) - 1 AS piece_id
        FROM (SELECT piece, part, nth FROM entries QUALIFY row_number() OVER (PARTITION BY piece ORDER BY part, nth) = 1)""",
    "apply_bpe": f"""WITH RECURSIVE {LINES}, {bpe(f"SELECT unnest({words('text')}) AS w, 1 AS n FROM lines", SMALL_VOCABULARY)},
        lw AS (SELECT lang, line_no, unnest({words('text')}) AS w, unnest(range(len({words('text')}))) AS i FROM lines),
        pieces AS (
          SELECT lang, line_no, string_agg(array_to_string(p, ' '), ' ' ORDER BY i) AS pieces
          FROM lw JOIN cut ON cut.w = '▁' || lw.w GROUP BY lang, line_no)
        SELECT lang, line_no, coalesce(pieces, '') AS pieces FROM lines LEFT JOIN pieces USING (lang, line_no)""",
    "translate": f"""WITH {TURNS}
        SELECT sent_id, array_to_string(list_reverse(string_split({one_line('src')}, ' ')), ' ') AS hyp FROM turns""",
    "synthesize": f"""WITH {LINES}
        SELECT line_no, text AS original, array_to_string(list_reverse(string_split(text, ' ')), ' ') AS synthetic
        FROM lines WHERE lang = 'en' AND len({words('text')}) > 0""",
    "synthesize_prefix": f"""WITH {LINES}
        SELECT line_no, text AS original, array_to_string(list_reverse(string_split(text, ' ')), ' ') AS synthetic
        FROM lines WHERE lang = 'en' AND line_no <= 2000 AND len({words('text')}) BETWEEN 1 AND 100""",
    "prepare_student": f"""WITH RECURSIVE {CORPORA}, {student_ids('line_no % 10 < 8', "CASE line_no % 10 WHEN 8 THEN 'valid' ELSE 'test' END")},
        one AS (
          SELECT split, line_no, side, string_agg(coalesce(id, 3)::VARCHAR, ' ' ORDER BY i, j) AS ids
          FROM sp LEFT JOIN sd USING (token) GROUP BY ALL)
        SELECT s.split, s.line_no, s.ids AS src_ids, t.ids AS tgt_ids
        FROM one s JOIN one t ON s.line_no = t.line_no AND s.split = t.split WHERE s.side = 'src' AND t.side = 'tgt'""",
    "student_coverage": f"""WITH RECURSIVE {CORPORA}, {student_ids('line_no % 50 = 0', "'test'")}
        SELECT split, side, count(*) AS n_tokens, count(*) FILTER (WHERE id IS NULL) AS n_oov,
               round(count(*) FILTER (WHERE id IS NULL) / count(*), 6) AS oov_rate
        FROM sp LEFT JOIN sd USING (token) GROUP BY ALL""",
    "report": f"""
        (WITH {TURNS}, {bleu(REPORT_ROWS, tokens_13a('hyp'), tokens_13a('ref'))} SELECT 'BLEU' AS metric, round(bleu, 6) AS value FROM bleu)
        UNION ALL (WITH {TURNS}, {chrf(REPORT_ROWS, 0)} SELECT 'chrF', round(chrf, 6) FROM chrf)
        UNION ALL (WITH {TURNS}, {bleu(REPORT_ROWS, THREES.format('hyp'), THREES.format('ref'))} SELECT 'spBLEU', round(bleu, 6) FROM bleu)
        UNION ALL (WITH {TURNS} SELECT 'missing', (count(*) FILTER (WHERE sent_id % 10 = 4))::DOUBLE FROM turns)""",
    # loops
    "search_threshold": f"""WITH {CORPORA}, n AS (
          SELECT d.direction, threshold,
                 count(*) FILTER (WHERE c.part = 'parallel' OR (c.part = d.part AND score > threshold)) AS n_pairs
          FROM corpora c, (VALUES ('1n', '{SO}'), ('n1', '{OS}')) d(direction, part), {THRESHOLDS} GROUP BY ALL)
        SELECT direction, threshold, n_pairs,
               row_number() OVER (PARTITION BY direction ORDER BY n_pairs DESC, threshold DESC) = 1 AS best FROM n""",
}
SQL["ids_from_vocab_all"] = SQL["encode_ids"].replace("line_no,", "lang, line_no,").replace(" FROM lines WHERE lang = 'de'", " FROM lines").replace(
    "GROUP BY line_no", "GROUP BY lang, line_no").replace("AS id_text", "AS ids")
# Models do not change what is translated, so every run of a direction with one threshold has the same metric:
# the best threshold is tried again in the loop, which goes on while one direction is as good as its best.
SQL["iterate"] = f"""WITH {CORPORA},
  par AS (SELECT src AS l1, tgt AS l2 FROM corpora WHERE part = 'parallel'),
  w AS (SELECT lang, text, string_split(text, ' ') AS words FROM lines WHERE lang IN ('en', 'de') AND len({words('text')}) > 0),
  made AS (SELECT lang, text, array_to_string(list_reverse(words[:greatest(1, len(words) * (len(words) % 10 + 1) // 10)]), ' ') AS turned FROM w),
  fed AS (
    SELECT '1n' AS direction, {strip('l1')} AS src, {strip('l2')} AS tgt, NULL AS score FROM par
    UNION ALL SELECT 'n1', {strip('l2')}, {strip('l1')}, NULL FROM par
    UNION ALL SELECT CASE lang WHEN 'de' THEN '1n' ELSE 'n1' END, {strip('turned')}, {strip('text')},
      round(least(length(text), length(turned))::DOUBLE / greatest(length(text), length(turned)), 4) FROM made),
  first AS (SELECT '1n' AS direction, avg(length(l1)) AS metric FROM par UNION ALL SELECT 'n1', avg(length(l2)) FROM par),
  m AS (
    SELECT direction, (t / 10.0)::DOUBLE AS threshold, avg(length(src)) FILTER (score IS NULL OR score > (t / 10.0)::DOUBLE) AS metric
    FROM fed, range(10) r(t) WHERE src <> '' AND tgt <> '' GROUP BY ALL),
  best AS (SELECT direction, threshold, metric FROM m QUALIFY row_number() OVER (PARTITION BY direction ORDER BY metric DESC, threshold DESC) = 1),
  loops AS (SELECT CASE WHEN count(*) > 0 THEN 8 ELSE 1 END AS n FROM best JOIN first USING (direction) WHERE best.metric >= first.metric)
  SELECT 'first' AS stage, 0 AS iteration, direction, NULL::DOUBLE AS threshold, metric FROM first
  UNION ALL SELECT 'score_' || threshold, 0, direction, threshold, metric FROM m
  UNION ALL SELECT 'it_' || i, i, direction, threshold, metric FROM best, loops, range(1, 9) r(i) WHERE i <= n"""
SQL["ids_from_vocab_shuffled"] = SQL["encode_ids"].replace("AS id_text", "AS ids")
SQL["encode_pieces_model"] = SQL["apply_bpe"]


_MARKED = f"SELECT lang, line_no, i, '▁' || w AS w FROM (SELECT lang, line_no, unnest({words('text')}) AS w, unnest(range(len({words('text')}))) AS i FROM lines)"
SCORED_PIECES = f"""
marked AS MATERIALIZED ({_MARKED}),
wc AS (SELECT w, count(*) AS n FROM marked GROUP BY w),
parts AS (
  SELECT substr(w, i, k) AS piece, sum(n)::BIGINT AS n
  FROM wc, (SELECT unnest(range(1, 5)) AS k) ks, LATERAL (SELECT unnest(range(1, length(w) - k + 2)) AS i) places GROUP BY 1),
chosen AS (
  SELECT piece, n FROM parts WHERE length(piece) = 1
  UNION ALL (SELECT piece, n FROM parts WHERE length(piece) > 1 ORDER BY n DESC, piece LIMIT 8000)),
scored AS (SELECT piece, n, ln(n::DOUBLE / (SELECT sum(n) FROM chosen)) AS score FROM chosen)"""
SQL["scored_vocabulary"] = f"WITH {LINES}, {SCORED_PIECES} SELECT piece, n, round(score, 6) AS score FROM scored"


def _way(size: int) -> str:
    score = "coalesce(v1.s, (SELECT min(s) - 10000000 FROM v))" if size == 1 else f"v{size}.s"
    way = f"{{'s': st[{size}].s + {score}, 'n': st[{size}].n - 1, 'l': {size}, 'p': st[{size}].p || ' ' || substr(k.w, i + 2 - {size}, {size})}}"
    return way if size == 1 else f"CASE WHEN v{size}.s IS NOT NULL THEN {way} END"


# Of each prefix the best way is kept, and those of the last four prefixes are at hand.
SQL["encode_scored"] = f"""WITH RECURSIVE {LINES}, {SCORED_PIECES},
  v AS MATERIALIZED (SELECT piece, round(round(score, 4) * 1000000)::BIGINT AS s FROM scored WHERE piece NOT IN ('q', 'ñ')),
  walk AS (
    SELECT w, 0 AS i, [{{'s': 0::BIGINT, 'n': 0, 'l': 0, 'p': ''}}] AS st FROM wc
    UNION ALL
    SELECT w, i + 1, list_prepend(list_reverse_sort(list_filter(ways, lambda x: x IS NOT NULL))[1], st)[1:4]
    FROM (
      SELECT k.w, i, st, [{", ".join(_way(size) for size in range(1, 5))}] AS ways
      FROM walk k {" ".join(f"LEFT JOIN v v{n} ON i >= {n - 1} AND v{n}.piece = substr(k.w, i + 2 - {n}, {n})" for n in range(1, 5))}
      WHERE i < length(k.w))),
  cut AS (SELECT w, trim(st[1].p) AS p FROM walk WHERE i = length(w)),
  got AS (SELECT lang, line_no, string_agg(p, ' ' ORDER BY i) AS pieces FROM marked JOIN cut USING (w) GROUP BY ALL)
  SELECT lang, line_no, coalesce(pieces, '') AS pieces FROM lines LEFT JOIN got USING (lang, line_no)"""


def batches(rows: str, lanes: int, tokens: int, positions: int) -> str:
    """CTEs ending in ``placed``: ``rows`` (id, text, size) with lane and batch, the start of a batch found from the one before."""
    return f"""
sized AS MATERIALIZED (
  SELECT *, (('0x' || substr(md5('0:' || id), 1, 8))::BIGINT % {lanes})::INTEGER AS lane FROM ({rows})),
fit AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY size DESC, id) AS r FROM sized WHERE size <= {min(tokens, positions)}),
starts AS (
  SELECT lane, 0::BIGINT AS batch, r AS first, r + {tokens} // size AS next FROM fit WHERE r = 1
  UNION ALL SELECT f.lane, s.batch + 1, f.r, f.r + {tokens} // f.size FROM starts s JOIN fit f ON f.lane = s.lane AND f.r = s.next),
placed AS (
  SELECT sized.*, s.batch FROM sized LEFT JOIN fit USING (lane, id) LEFT JOIN starts s ON s.lane = fit.lane AND fit.r >= s.first AND fit.r < s.next)"""


SQL["translate_batched"] = f"""WITH RECURSIVE {TURNS}, {batches(f"SELECT sent_id AS id, {one_line('src')} AS text, greatest(1, len({words('src')})) AS size FROM turns", 8, 3000, 2000)}
  SELECT id AS sent_id, CASE WHEN batch IS NOT NULL THEN array_to_string(list_reverse(string_split(text, ' ')), ' ') END AS hyp, lane, batch FROM placed"""
SQL["batch_sizes"] = f"""WITH RECURSIVE {LINES}, {batches(f"SELECT line_no AS id, text, greatest(1, len({words('text')})) AS size FROM lines WHERE lang = 'en' AND text <> ''", 64, 400, 120)}
  SELECT lane, batch, count(*) AS n_rows, max(size)::BIGINT AS longest, sum(size)::BIGINT AS n_tokens, count(batch) AS n_translated FROM placed GROUP BY lane, batch"""


def _moved(value: str, nth: str) -> str:
    return f"('0x' || substr(md5('{SEED}:' || {nth} || ':' || {value}), 1, 8))::BIGINT"


# A table of rows and columns with room for n numbers; eight turns, and again for those that land outside.
SQL["permute_rows"] = f"""WITH RECURSIVE {LINES},
  ids AS (SELECT line_no FROM lines WHERE lang = 'en'),
  cols AS (SELECT n, ceil(sqrt(n))::BIGINT AS c FROM (SELECT count(*) AS n FROM ids)),
  size AS (SELECT n, c, (n + c - 1) // c AS r FROM cols),
  walk AS (
    SELECT line_no, 0 AS i, (line_no - 1) // c AS rw, (line_no - 1) % c AS cl, n, c, r FROM ids, size
    UNION ALL
    SELECT line_no, CASE WHEN i = 8 THEN 0 ELSE i + 1 END,
           CASE WHEN i = 8 THEN rw WHEN i % 2 = 0 THEN (rw + {_moved('cl', 'i')}) % r ELSE rw END,
           CASE WHEN i = 8 THEN cl WHEN i % 2 = 1 THEN (cl + {_moved('rw', 'i')}) % c ELSE cl END, n, c, r
    FROM walk WHERE i < 8 OR rw * c + cl >= n)
  SELECT line_no, rw * c + cl + 1 AS place FROM walk WHERE i = 8 AND rw * c + cl < n"""

# Band of a rank: first rank 2 ** k - 2; a last band of one word belongs to the one before.
SQL["replace_words"] = f"""WITH {CLEAN},
  wc AS (SELECT word, count(*) AS n FROM (SELECT unnest({words('tgt')}) AS word FROM clean) GROUP BY word),
  rk AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS rank, count(*) OVER () AS total FROM wc),
  starts AS (
    SELECT first, lead(first, 1, total) OVER (ORDER BY first) - first AS size
    FROM (SELECT DISTINCT (1::BIGINT << k) - 2 AS first, total FROM range(1, 40) t(k), (SELECT max(total) AS total FROM rk))
    WHERE first < total AND (first < total - 1 OR first = 0)),
  bands AS (SELECT word, rank, first, size FROM rk JOIN starts ON rank >= first AND rank < first + size),
  w AS (SELECT line_no, unnest({words('tgt')}) AS word, unnest(range(len({words('tgt')}))) AS pos, len({words('tgt')}) AS n FROM clean),
  k AS (SELECT *, md5('{SEED}:' || line_no || ':' || pos) AS key FROM w),
  o AS (SELECT *, row_number() OVER (PARTITION BY line_no ORDER BY key) AS nth FROM k),
  c AS (
    SELECT line_no, pos, first + (rank - first + CASE WHEN size > 1 THEN 1 + ('0x' || substr(key, 9, 8))::BIGINT % (size - 1) ELSE 0 END) % size AS target
    FROM o JOIN bands USING (word) WHERE nth <= greatest(1, ceil(n * 0.3::DOUBLE))),
  news AS (SELECT line_no, pos, word AS new FROM c JOIN bands ON target = rank)
  SELECT line_no, string_agg(coalesce(new, word), ' ' ORDER BY pos) AS tgt, count(new) AS n_replaced FROM w LEFT JOIN news USING (line_no, pos) GROUP BY line_no"""


def _sides(src: str, tgt: str, tag: str) -> str:
    """Words that occur together, in parts of at most 100 words, and two rounds of expectation maximisation over them."""
    def counted(col: str, name: str, count: str) -> str:
        return f"""SELECT line_no, part, {name}, count(*) AS {count} FROM (
          SELECT line_no, floor(pos * k / n)::INT AS part, {name} FROM (
            SELECT line_no, k, len({col}) AS n, unnest({col}) AS {name}, unnest(range(len({col}))) AS pos FROM cut_{tag})) GROUP BY ALL"""

    table = f"""
cut_{tag} AS (
  SELECT line_no, s, t, ceil(greatest(len(s), len(t), 1) / 100) AS k
  FROM (SELECT line_no, {words(f'lower({src})')} AS s, {words(f'lower({tgt})')} AS t FROM clean)),
ss_{tag} AS ({counted('s', 's', 'ns')}),
tt_{tag} AS ({counted('t', 't', 'nt')}),
co_{tag} AS MATERIALIZED (
  SELECT line_no, part, s, ns, t, nt FROM (SELECT * FROM ss_{tag} UNION ALL SELECT DISTINCT line_no, part, '', 1 FROM tt_{tag}) JOIN tt_{tag} USING (line_no, part))"""
    before = None
    for i in (1, 2):
        rows = f"SELECT *, ns * 1.0::DOUBLE AS w FROM co_{tag}" if before is None else f"SELECT co_{tag}.*, ns * p AS w FROM co_{tag} JOIN {before} USING (s, t)"
        table += f""",
x{i}_{tag} AS (SELECT s, t, nt * w / sum(w) OVER (PARTITION BY line_no, part, t) AS c FROM ({rows})),
g{i}_{tag} AS (SELECT s, t, sum(c) AS c FROM x{i}_{tag} GROUP BY s, t),
p{i}_{tag} AS MATERIALIZED (SELECT s, t, p FROM (SELECT s, t, c / sum(c) OVER (PARTITION BY s) AS p FROM g{i}_{tag}) WHERE p >= 0.00137)"""
        before = f"p{i}_{tag}"
    return table


def _explained(tag: str, out: str) -> str:
    return f"""
b_{tag} AS (SELECT line_no, part, t, max(p) AS p FROM ss_{tag} JOIN tt_{tag} USING (line_no, part) JOIN p2_{tag} USING (s, t) GROUP BY ALL),
f_{tag} AS (SELECT line_no, sum(nt * coalesce(p, 0)) / sum(nt) AS {out} FROM tt_{tag} LEFT JOIN b_{tag} USING (line_no, part, t) GROUP BY line_no)"""


SQL["translation_probabilities"] = f"WITH {CLEAN}, {_sides('src', 'tgt', 'f')} SELECT s, t, round(p, 6) AS p FROM p2_f WHERE p > 0.0123::DOUBLE"
SQL["lexical_features"] = f"""WITH {CLEAN}, {_sides('src', 'tgt', 'f')}, {_sides('tgt', 'src', 'b')}, {_explained('f', 'lexical_tgt')}, {_explained('b', 'lexical_src')}
  SELECT line_no, coalesce(round(lexical_tgt, 6), 0) AS lexical_tgt, coalesce(round(lexical_src, 6), 0) AS lexical_src
  FROM clean LEFT JOIN f_f USING (line_no) LEFT JOIN f_b USING (line_no)"""

SQL["temperature_quotas"] = f"""WITH {LINES}, n AS (SELECT lang, count(*) AS n_rows FROM lines GROUP BY lang),
  p AS (SELECT lang, n_rows, pow(n_rows, 1 / 1.5) / sum(pow(n_rows, 1 / 1.5)) OVER () AS p FROM n),
  r AS (SELECT lang, n_rows, p * sum(n_rows) OVER () / n_rows AS rate FROM p),
  d AS (SELECT lang, line_no, floor(rate)::BIGINT
               + (row_number() OVER (PARTITION BY lang ORDER BY {sample_key('line_no')}) <= round(n_rows * (rate - floor(rate))))::INT AS copies
        FROM lines JOIN r USING (lang))
  SELECT lang, line_no, unnest(range(1, copies + 1)) AS copy FROM d"""
