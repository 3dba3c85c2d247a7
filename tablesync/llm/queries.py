"""The queries of this package, with the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import (
    exact_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality_net,
    quality_rules,
    quotes,
    ranked_search,
    span_dedup,
    spelling,
    toxicity,
    winnowing,
)
from tablesync.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op6_toxicity")
def op6(spark, folder):
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


LINES = r"""
WITH line AS (
  SELECT d.doc_id, t.pos, t.line,
         translate(trim(t.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents d,
       (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) t
), frequent AS (
  SELECT key FROM line WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN frequent f USING (key)
GROUP BY doc_id
"""


@query("op7_line_dedup", LINES)
def op7(spark, folder):
    return line_dedup.line_report(table(spark, folder, "documents"))


@query("op9_quality_rules")
def op9(spark, folder):
    return quality_rules.apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_winnowing")
def op4(spark, folder):
    return winnowing.fingerprints(table(spark, folder, "documents"))


@query("op2_packing")
def op2(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


JOIN = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, w[i:i + 2] AS s
  FROM word, range(1, greatest(len(w) - 2, 1) + 1) AS r(i)
  WHERE len(w) > 0
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN size m ON m.doc_id = a.doc_id JOIN size n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 90 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id,
       (SELECT count(*) FROM link l WHERE l.a = d.doc_id) AS n_links
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN size s USING (doc_id)
GROUP BY d.doc_id
"""


@query("op1_ngram_join", JOIN)
def op1(spark, folder):
    return ngram_join.ngram_join(table(spark, folder, "documents"))


@query("op3_quality_net")
def op3(spark, folder):
    return quality_net.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 6, "de": 3, "fr": 2},
    "source": {"src0": 3},
}
MIX_EPOCHS, MIX_SEED = 2, 5


def _share_sql(level: str, nodes: str, parent: str) -> str:
    """One level of the budgets in SQL; ``parent`` are the columns that siblings share."""
    over = f"PARTITION BY {parent}"
    order = f"{over} ORDER BY capacity / weight, {level}"
    return f"""
{level}_1 AS (
  SELECT *, given - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ({nodes})
), {level}_2 AS (
  SELECT *, capacity * weights <= weight * rest AS short FROM {level}_1
), {level}_3 AS (
  SELECT *, max(CASE WHEN NOT short THEN rest END) OVER ({over}) AS pool,
         sum(CASE WHEN short THEN 0 ELSE weight END) OVER ({over}) AS open
  FROM {level}_2
), {level}_4 AS (
  SELECT *, CASE WHEN short THEN capacity ELSE weight * pool // open END AS base,
         CASE WHEN short THEN -1 ELSE weight * pool % open END AS remainder
  FROM {level}_3
), {level}_5 AS (
  SELECT *, least(given, sum(capacity) OVER ({over})) - sum(base) OVER ({over}) AS unused,
         row_number() OVER ({over} ORDER BY remainder DESC, {level}) AS turn
  FROM {level}_4
), {level}_b AS (
  SELECT *, base + CASE WHEN turn <= unused AND remainder >= 0 THEN 1 ELSE 0 END AS budget FROM {level}_5
)"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE 1 END"


MIX = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         'domain' || ((strpos('0123456789abcdef', md5(coalesce(source, ''))[1]) - 1) // 4) AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
  FROM documents
), leaf AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
         CAST({MIX_EPOCHS} * sum(n_tokens) AS BIGINT) AS capacity
  FROM doc GROUP BY ALL
), {_share_sql("domain", f'''
  SELECT domain, 0 AS root, CAST(sum(capacity) AS BIGINT) AS capacity, CAST({_weight_sql("domain")} AS BIGINT) AS weight,
         (SELECT CAST(sum(tokens) AS BIGINT) * 3 // 4 FROM leaf) AS given
  FROM leaf GROUP BY domain''', "root")},
{_share_sql("lang", f'''
  SELECT domain, lang, CAST(sum(leaf.capacity) AS BIGINT) AS capacity, CAST({_weight_sql("lang")} AS BIGINT) AS weight,
         any_value(budget) AS given
  FROM leaf JOIN domain_b USING (domain) GROUP BY domain, lang''', "domain")},
{_share_sql("source", f'''
  SELECT domain, lang, source, leaf.tokens, leaf.capacity, CAST({_weight_sql("source")} AS BIGINT) AS weight, budget AS given
  FROM leaf JOIN lang_b USING (domain, lang)''', "domain, lang")},
keyed AS (
  SELECT doc_id, domain, lang, source, n_tokens, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
         budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS part
  FROM doc JOIN source_b USING (domain, lang, source)
), placed AS (
  SELECT *, md5('{MIX_SEED}:' || CAST(epochs AS BIGINT) || ':' || doc_id) AS k, sum(n_tokens) OVER (PARTITION BY domain, lang, source
                                ORDER BY md5('{MIX_SEED}:' || CAST(epochs AS BIGINT) || ':' || doc_id)) AS so_far
  FROM keyed
), edge AS (
  SELECT domain, lang, source, epochs, min(k) AS k, min_by(part, k) - min_by(so_far, k) + min_by(n_tokens, k) AS spare, min_by(n_tokens, k) AS size
  FROM placed WHERE so_far > part GROUP BY ALL
), below AS (
  SELECT *, epochs < {MIX_EPOCHS} AND sum(size) FILTER (WHERE epochs < {MIX_EPOCHS}) OVER (PARTITION BY domain, lang ORDER BY size, source)
            <= sum(spare) OVER (PARTITION BY domain, lang) AS first
  FROM edge
), middle AS (
  SELECT *, NOT first AND epochs < {MIX_EPOCHS}
            AND sum(CASE WHEN first OR epochs >= {MIX_EPOCHS} THEN 0 ELSE size END) OVER (PARTITION BY domain ORDER BY size, lang, source)
            <= sum(spare - CASE WHEN first THEN size ELSE 0 END) OVER (PARTITION BY domain) AS second
  FROM below
), top AS (
  SELECT *, NOT first AND NOT second AND epochs < {MIX_EPOCHS}
            AND sum(CASE WHEN first OR second OR epochs >= {MIX_EPOCHS} THEN 0 ELSE size END) OVER (ORDER BY size, domain, lang, source)
            <= sum(spare - CASE WHEN first OR second THEN size ELSE 0 END) OVER () AS third
  FROM middle
)
SELECT p.doc_id, p.domain, p.lang, p.source, CAST(n_tokens AS BIGINT) AS n_tokens,
       CAST(p.epochs + CASE WHEN so_far <= part OR (p.k = t.k AND (first OR second OR third)) THEN 1 ELSE 0 END AS BIGINT) AS times
FROM placed p LEFT JOIN top t USING (domain, lang, source)
"""


def three_quarters(tokens: Column) -> Column:
    return F.floor(tokens * 3 / 4)


def mix_options() -> dict:
    return {
        "levels": {"domain": mixing.domain_of(), "lang": F.col("lang"), "source": F.col("source")},
        "weights": MIX_WEIGHTS,
        "total": three_quarters,
        "epochs": MIX_EPOCHS,
        "seed": MIX_SEED,
    }


@query("op5_mixing", MIX)
def op5(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    levels = [F.col(f"__level_{k}").alias(k) for k in MIX_WEIGHTS]
    return mixing.mix(docs, **mix_options()).select("doc_id", *levels, F.col("__tokens").alias("n_tokens"), F.col("__times").alias("times"))


SPANS = r"""
WITH part AS (
  SELECT d.doc_id, p.pos, p.part,
         regexp_extract_all(regexp_replace(translate(p.part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[.!?\n]+$', ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents d,
       (SELECT unnest(l) AS part, generate_subscripts(l, 1) AS pos
        FROM (SELECT regexp_extract_all(coalesce(d.text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS l)) p
), numbered AS (
  SELECT *, greatest(sum(CASE WHEN len(words) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos), 1)
            + CASE WHEN first_value(len(words)) OVER (PARTITION BY doc_id ORDER BY pos) = 0 AND pos > 1
                   THEN sum(CASE WHEN len(words) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos)
                        + 1 - greatest(sum(CASE WHEN len(words) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos), 1)
                   ELSE 0 END AS i
  FROM part
), sentence AS (
  SELECT doc_id, i, string_agg(part, '' ORDER BY pos) AS part,
         coalesce(any_value(array_to_string(words, ' ')) FILTER (WHERE len(words) > 0), '') AS s,
         coalesce(max(len(words)), 0) AS n
  FROM numbered GROUP BY doc_id, i
), same AS (
  SELECT x.doc_id, x.i, x.n, y.doc_id AS earlier, x.i - y.i AS shift
  FROM sentence x JOIN sentence y ON x.s = y.s AND (y.doc_id < x.doc_id OR (y.doc_id = x.doc_id AND y.i < x.i))
), stretch AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, earlier, shift ORDER BY i) AS island FROM same
), long AS (
  SELECT *, count(*) OVER own AS sentences, sum(n) OVER own AS words
  FROM stretch WINDOW own AS (PARTITION BY doc_id, earlier, shift, island)
), gone AS (
  SELECT doc_id, i, min(earlier) AS first_id FROM long WHERE sentences >= 2 AND words >= 20 GROUP BY doc_id, i
), first AS (
  SELECT doc_id, list_sort(list(DISTINCT first_id)) AS first_ids FROM gone GROUP BY doc_id
)
SELECT d.doc_id, count(s.i) AS n_sentences, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(s.part, '' ORDER BY s.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256,
       coalesce(any_value(f.first_ids), []) AS first_ids
FROM documents d LEFT JOIN sentence s USING (doc_id) LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i
LEFT JOIN first f ON f.doc_id = d.doc_id
GROUP BY d.doc_id
"""


@query("op10_span_dedup", SPANS)
def op10(spark, folder):
    return span_dedup.span_report(table(spark, folder, "documents"))


# The given conversations quote nobody. In mail form, which both engines derive, every message quotes the
# first line of the message two turns before it, and every third one also the one that quoted.
MAIL = """
SELECT conv_id, turn, role,
       coalesce(CASE WHEN turn % 3 = 2 THEN '> > ' || line4 || chr(10) END, '')
       || coalesce('> ' || line2 || chr(10), '') || coalesce(text, '') AS text
FROM (
  SELECT *, lag(line, 2) OVER (PARTITION BY conv_id ORDER BY turn, text) AS line2,
         lag(line, 4) OVER (PARTITION BY conv_id ORDER BY turn, text) AS line4
  FROM (SELECT conv_id, turn, role, text, split_part(coalesce(text, ''), chr(10), 1) AS line FROM {conversations}) a
) b
"""

QUOTES = (
    "WITH RECURSIVE mail AS (" + MAIL.format(conversations="conversations") + r"""
), raw AS (
  SELECT DISTINCT conv_id, turn, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM mail
), line AS (
  SELECT conv_id, turn, pos,
         len(regexp_replace(regexp_extract(raw, '^((?:[ \t]*>)+)[ \t]?', 1), '[ \t]', '', 'g')) AS level,
         trim(regexp_replace(lower(regexp_replace(raw, '^((?:[ \t]*>)+)[ \t]?', '')), '[ \t\x0B\f\r]+', ' ', 'g')) AS key
  FROM raw
), quoted AS (
  SELECT q.conv_id, q.turn, q.pos, q.level, q.key,
         (SELECT max(s.turn) FROM line s WHERE s.conv_id = q.conv_id AND s.key = q.key AND s.level = 0 AND s.turn < q.turn)
           AS from_turn,
         (SELECT min({'c': s.conv_id, 't': s.turn}) FROM line s WHERE s.key = q.key AND s.level = 0 AND s.conv_id <> q.conv_id) AS origin
  FROM line q WHERE q.level > 0 AND q.key <> ''
), found AS (
  SELECT conv_id, turn, count(DISTINCT pos) AS n_quoted,
         count(DISTINCT CASE WHEN from_turn IS NOT NULL OR origin IS NOT NULL THEN pos END) AS n_linked,
         min({'l': level, 'c': origin.c, 't': origin.t}) FILTER (WHERE from_turn IS NULL AND origin IS NOT NULL) AS origin,
         arg_max(from_turn, (-level) * 1000000 + from_turn) FILTER (WHERE from_turn IS NOT NULL) AS reply_to
  FROM quoted GROUP BY conv_id, turn
), reply AS (
  SELECT DISTINCT m.conv_id, m.turn, coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked, reply_to,
         origin.c AS origin_conv, origin.t AS origin_turn
  FROM mail m LEFT JOIN found f USING (conv_id, turn)
), thread AS (
  SELECT conv_id, turn, turn AS thread, 0 AS depth FROM reply WHERE reply_to IS NULL
  UNION ALL
  SELECT r.conv_id, r.turn, t.thread, t.depth + 1 FROM thread t JOIN reply r ON r.conv_id = t.conv_id AND r.reply_to = t.turn
), own AS (
  SELECT conv_id, turn, role,
         coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^((?:[ \t]*>)+)[ \t]?')), chr(10)), '') AS said
  FROM mail
)
SELECT o.conv_id, o.turn, o.role, o.said, n_quoted, n_linked, reply_to, origin_conv, origin_turn, thread, depth,
       row_number() OVER (PARTITION BY o.conv_id, thread ORDER BY o.turn, o.role, o.said) AS place
FROM own o JOIN reply USING (conv_id, turn) JOIN thread USING (conv_id, turn)
"""
)


@query("op8_quotes", QUOTES)
def op8(spark, folder):
    mail = spark.sql(MAIL, conversations=table(spark, folder, "conversations"))
    return quotes.conversations(mail)


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS t FROM documents
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_all FROM doc WHERE len(t) > 0
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL
), posting AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM doc) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting, total GROUP BY term
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""


@query("op11_ranked_search", RANKED)
def op11(spark, folder):
    return ranked_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes, four bits at a time; the sixteen steps follow from the polynomial."""
    steps = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        steps.append(x)
    nibbles = f"flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: [b[2], b[1]]))"
    values = f"list_transform({nibbles}, lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT))"
    step = f"xor(s >> 4, CAST({steps} AS BIGINT[])[(xor(s, v) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {values}), lambda s, v: {step}), 4294967295)"


VARIANTS = rf"""
WITH RECURSIVE run AS (
  SELECT id, run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
               unnest(regexp_extract_all({LOWER}, '[a-zA-Z\x{{00C0}}-\x{{00FF}}]{{6,}}')) AS run FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32_sql("id || ':' || run")} AS h FROM run
), word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gap AS (
  SELECT word, n, i, word[1:i] AS a, word[i + 2:] AS b FROM (SELECT word, n, unnest(range(len(word))) AS i FROM word)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM gap x JOIN gap y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, w.word, w.n FROM gap g JOIN word w ON w.word = g.a || g.b
  UNION SELECT w.word, g.word, g.n FROM gap g JOIN word w ON w.word = g.a || g.b
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS n FROM near GROUP BY word
), chosen AS (
  SELECT b.word, b.n_near, b.n AS best_n, min(o.other) AS other
  FROM best b JOIN near o ON o.word = b.word AND o.n = b.n GROUP BY ALL
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN other END AS form,
         CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM word w LEFT JOIN chosen c USING (word)
), way AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT y.word, f.form FROM way y JOIN formed f ON f.word = y.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, y.root
FROM formed f JOIN way y USING (word) JOIN formed r ON r.word = y.root WHERE r.form IS NULL
"""


@query("op12_spelling", VARIANTS)
def op12(spark, folder):
    return spelling.group_variants(table(spark, folder, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


COPIES = """
SELECT doc_id, max(doc_id) OVER own AS keep_id, count(*) OVER own AS group_size,
       doc_id = max(doc_id) OVER own AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW own AS (PARTITION BY coalesce(text, ''))
"""


@query("op13_exact_dedup", COPIES)
def op13(spark, folder):
    return exact_dedup.dedup_report(spark, f"{folder}/documents.parquet")
