"""The operators of this subpackage over their whole tables, and their check SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import (
    exactdedup,
    linerules,
    merkle,
    mixing,
    packing,
    piecebpe,
    ruleensemble,
    shinglejoin,
    sourceaudit,
    store,
    substrings,
    tokenfile,
    toxicity,
    urlfilter,
)
from meterloom.llm.registry import CHECKS, QUERIES, documents, query, table  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def held_out(parts: int, rest: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts == rest


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), base AS (
  SELECT doc_id, source, text, w, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d
), pos AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM pos) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, generate_series(0, 7) s(j) GROUP BY doc_id
), ln AS (
  SELECT doc_id, source, text, trim(lower(regexp_replace(x, '{SPACE}', ' ', 'g'))) AS line
  FROM (SELECT doc_id, source, text, unnest(lines) AS x FROM base)
), common AS (
  SELECT source, line FROM ln GROUP BY source, line HAVING count(DISTINCT doc_id) > {linerules.MAX_DOCS}
), gone AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS removed_words FROM ln JOIN common USING (source, line) GROUP BY doc_id
), f AS (
  SELECT b.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM base b LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < {linerules.MIN_WORDS} OR 100 * n_repeat_words > {linerules.MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {linerules.MIN_WORDS} OR 100 * n_repeat_words > {linerules.MAX_REPEAT_PCT} * n_words)
         AND n_words - removed_words >= {linerules.MIN_LEFT} * n_words AS kept
FROM f
"""


@query("op1_line_frequency", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return linerules.judge(documents(spark, folder))


@query("op2_rule_ensemble")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = ruleensemble.train(docs, table(spark, folder, "labels").filter(~held_out(5, 0)))
    return ruleensemble.score(docs, model).withColumn("held_out", held_out(5, 0))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY length(text) DESC, doc_id) AS keep_id FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query("op3_exact_dedup", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_groups(documents(spark, folder))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')) v(kind, root, start)
), fit AS (
  SELECT page_id, arg_max(root || start, length(root || start)) AS rule, arg_max(kind, length(root || start)) AS verdict
  FROM h JOIN r ON (host = root OR ends_with(host, '.' || root)) AND starts_with(path, start) GROUP BY page_id
)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN fit USING (page_id)
"""
# The pages of the test tables have no canonical links or refreshes, so no verdict is passed on there; tests/llm has them.


@query("op4_redirect_equivalence", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages"))


@query("op5_source_mix")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.Mix(documents(spark, folder)).taken()


@query("op6_weighted_lexicon")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    lexicon = toxicity.train(docs, table(spark, folder, "labels").filter(~held_out(4, 2)))
    out = toxicity.score(docs, lexicon).withColumn("held_out", held_out(4, 2))
    return out.select("doc_id", "held_out", "score", "predicted", "density", "matches")


OP7_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT a AS doc_id, a AS spot FROM (SELECT DISTINCT a FROM links) UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.spot
), least AS (SELECT doc_id, min(spot) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op7_shingle_join", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    join = shinglejoin.Join(documents(spark, folder), shingle=4, percent=85)
    return join.groups().select("doc_id", "n_shingles", "component_id")


OP8_SQL = rf"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM w WHERE len(w) >= 35)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY md5(t)) AS n FROM g) WHERE n > 1
), gone AS (SELECT doc_id, list(DISTINCT i + j) AS spots FROM twice, generate_series(0, 34) s(j) GROUP BY doc_id
), word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM w
), flat AS (SELECT doc_id, unnest(spots) AS p, true AS gone FROM gone
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) FILTER (gone IS NULL) AS t, count(*) FILTER (gone) AS n_removed
  FROM word LEFT JOIN flat USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op8_seed_extend", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    out = substrings.remove_repeats(documents(spark, folder), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op9_token_frames")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    target = store.new_path(spark, "tokens")
    manifest = tokenfile.write(documents(spark, folder), public_tokenizers.path(WORD_VOCABULARY), target)
    back = tokenfile.read(manifest)
    n = (F.octet_length("ids") / 4).cast("bigint")
    return back.select("doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op10_prefix_table")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_VOCABULARY)
    ids = piecebpe.encode(documents(spark, folder), path)
    digest = F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256)
    count = F.size("ids").cast("bigint")
    out = ids.select("doc_id", "ids", count.alias("n_tokens"), digest.alias("ids_sha256"))
    out = piecebpe.decode(out, path, also=("n_tokens", "ids_sha256"))
    decoded = F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    return out.select("doc_id", "n_tokens", "ids_sha256", decoded)


OP11_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d
), o AS MATERIALIZED (
  SELECT lang, source, term, r, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM o GROUP BY lang, term HAVING count(*) >= {sourceaudit.MIN_DOCS}
), size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang
), seen AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM o GROUP BY ALL
), cell AS MATERIALIZED (
  SELECT g.lang, g.source, term, coalesce(s.n, 0)::HUGEINT AS n
  FROM g JOIN kept USING (lang) LEFT JOIN seen s USING (lang, source, term)
), total AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM cell GROUP BY ALL
), p AS MATERIALIZED (
  SELECT lang, source, term, c.n, 1 + (1000000000::HUGEINT * (c.n + 2)) // (t.n + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (z.n + 2 * v) AS q
  FROM cell c JOIN total t USING (lang, source) JOIN size z USING (lang) JOIN kept k USING (lang, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
) WHERE part = 'pair' OR rank <= {sourceaudit.TOP_TERMS}
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return sourceaudit.audit(documents(spark, folder))


def _leaf_sql(chars: str) -> str:
    """Fields in the order of a leaf; SQL has no length of a text in bytes but that of its blob."""
    fields = ["doc_id::VARCHAR", "source", "lang", f"({chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({x})) || ':' || {x}, '-')" for x in fields) + ")"


OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) r(b)
), d AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("n_chars::HUGEINT + 1")} AS other,
         xor(4294967295, list_reduce(
           list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) % 7 = 0 AS tampered
  FROM documents, crc
), n AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS size FROM d
), tree AS (
  SELECT lang, 0 AS lvl, i, size, leaf AS h FROM n
  UNION ALL
  SELECT lang, lvl + 1, i // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE size > 1
  GROUP BY lang, lvl, i // 2
), nodes AS MATERIALIZED (SELECT * FROM tree
), sub AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS size FROM nodes WHERE size = 1
), crown AS (
  SELECT 0 AS lvl, i, size, h FROM sub
  UNION ALL
  SELECT lvl + 1, i // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE size > 1 GROUP BY lvl, i // 2
), tops AS MATERIALIZED (SELECT * FROM crown
), fold AS (
  SELECT doc_id, lang, leaf, 0 AS lvl, i, size, CASE WHEN tampered THEN other ELSE leaf END AS x, '' AS sib FROM n
  UNION ALL
  SELECT f.doc_id, f.lang, f.leaf, f.lvl + 1, f.i // 2, (f.size + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN x WHEN f.i % 2 = 0 THEN x || s.h ELSE s.h || x END), sib || coalesce(s.h, '')
  FROM fold f LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.lvl = f.lvl AND s.i = xor(f.i, 1) WHERE f.size > 1
), half AS MATERIALIZED (
  SELECT f.doc_id, f.lang, leaf, sub.h AS subroot, x, sib, sub.i, sub.size
  FROM fold f JOIN sub ON sub.lang IS NOT DISTINCT FROM f.lang WHERE f.size = 1
), rise AS (
  SELECT doc_id, lang, leaf, subroot, 0 AS lvl, i, size, x, sib FROM half
  UNION ALL
  SELECT f.doc_id, f.lang, f.leaf, f.subroot, f.lvl + 1, f.i // 2, (f.size + 1) // 2,
         sha256(CASE WHEN s.h IS NULL THEN x WHEN f.i % 2 = 0 THEN x || s.h ELSE s.h || x END), sib || coalesce(s.h, '')
  FROM rise f LEFT JOIN tops s ON s.lvl = f.lvl AND s.i = xor(f.i, 1) WHERE f.size > 1
)
SELECT doc_id, leaf, subroot, h AS root, sha256(sib) AS proof_sha256, x AS folded_root, x = h AS verified
FROM rise, (SELECT h FROM tops WHERE size = 1) WHERE rise.size = 1
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).alias("n_chars")
    changed = merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")])
    return merkle.manifest(docs, F.when(held_out(7, 0), changed), paths=False).drop("lang")


@query("op13_tournament_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    parts = packing.pieces(documents(spark, folder), public_tokenizers.path(WORD_VOCABULARY))
    placed = packing.place(parts)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
