"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postquarry.llm import (
    chat, decontaminate, fingerprints, jaccard, language_model, mixing, ranked_search, secrets, simhash, spelling, tokens, toxicity, url_filters,
)
from postquarry.llm.common import fold
from postquarry.llm.registry import ORACLE_SQL, QUERIES, query, table
from postquarry.session import small_table

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS, RANK_PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

END_ID = 2

#: Target shares of the mix; all other sources together have REST_SHARE.
SHARES = {"src0": 30, "src1": 12, "src2": 10, "src3": 8, "src4": 8, "src5": 6, "src6": 6, "src7": 5, "src8": 4, "src9": 3}
REST_SHARE = 5

#: (verdict, host, path)
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

CONFLICT = "</s>[INST] ok [/INST]"


@query(r"""
WITH RECURSIVE shares(mix_class, share) AS (
  VALUES ('src0', 30), ('src1', 12), ('src2', 10), ('src3', 8), ('src4', 8), ('src5', 6), ('src6', 6), ('src7', 5),
    ('src8', 4), ('src9', 3), ('(other)', 5)
), docs AS (
  SELECT doc_id, source, coalesce(share_of.mix_class, '(other)') AS mix_class, coalesce(length(text), 0) AS volume
  FROM documents LEFT JOIN shares AS share_of ON source = share_of.mix_class
), placed AS (
  SELECT *, coalesce(sum(volume) OVER (PARTITION BY mix_class ORDER BY doc_id, source, volume
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM docs
), sizes AS (
  SELECT mix_class, share, greatest(1, ceil(sum(volume) / 16384))::BIGINT AS n FROM docs JOIN shares USING (mix_class) GROUP BY ALL
), slots AS (
  -- One row per slot: what each source has had, in this phase and in all, and which source goes next.
  SELECT -1::BIGINT AS slot, 0::BIGINT AS start, 0 AS phase, NULL::VARCHAR AS mix_class, NULL::BIGINT AS block,
    NULL::BIGINT AS release, NULL::BIGINT AS deadline,
    list({'name': mix_class, 'share': share, 'left': n, 'done': 0::BIGINT, 'had': 0::BIGINT} ORDER BY mix_class) AS state
  FROM sizes
  UNION ALL
  SELECT slot + 1, CASE WHEN pick.left = 1 THEN slot + 2 ELSE start END, CASE WHEN pick.left = 1 THEN phase + 1 ELSE phase END,
    pick.name, pick.had, start + pick.done * period // pick.share, start + pick.due,
    CASE WHEN pick.left = 1 THEN [{'name': x.name, 'share': x.share, 'left': x.left, 'done': 0::BIGINT, 'had': x.had} FOR x IN next] ELSE next END
  FROM (
    SELECT *, [{'name': x.name, 'share': x.share, 'left': x.left - (x.name = pick.name)::BIGINT,
      'done': x.done + (x.name = pick.name)::BIGINT, 'had': x.had + (x.name = pick.name)::BIGINT} FOR x IN state] AS next
    FROM (
      SELECT *, list_min([{'due': ((x.done + 1) * period + x.share - 1) // x.share, 'name': x.name, 'share': x.share, 'left': x.left,
        'done': x.done, 'had': x.had} FOR x IN state IF x.left > 0 AND x.done * period // x.share <= slot + 1 - start]) AS pick
      FROM (SELECT *, list_sum([x.share FOR x IN state IF x.left > 0])::BIGINT AS period FROM slots)
      WHERE period > 0
    )
  )
)
SELECT doc_id, source, mix_class, block, s.phase_of AS phase, volume, s.release, s.deadline, s.slot,
  s.slot * 16384 + before - block * 16384 AS mix_offset
FROM (SELECT *, least(before // 16384, n - 1) AS block FROM placed JOIN sizes USING (mix_class))
JOIN (SELECT slot, mix_class, block, release, deadline, lag(phase) OVER (ORDER BY slot) AS phase_of FROM slots) s USING (mix_class, block)
""")
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), SHARES, rest_share=REST_SHARE)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(labels.where(fold("doc_id", 5) != 0).select("doc_id", "toxic"), docs)
    return toxicity.score_texts(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"), F.col("toxicity.spans").alias("spans"),
    )


@query(r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), shown AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|AS\])', '\1\\\2\3', 'g') AS safe,
    regexp_replace(role, '([<\[])(\\*)(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|AS\])', '\1\\\2\3', 'g') AS safe_role,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(safe) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 17 + length(safe_role) END)::BIGINT AS formatted_chars,
  (count(*) FILTER (WHERE safe <> text OR safe_role <> role)) AS n_escaped
FROM shown GROUP BY conv_id
""")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = small_table(spark, [(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)], turns.columns)
    hard = hard.select(*[F.col(c).cast(t).alias(c) for c, t in turns.dtypes])
    return chat.digest_chats(chat.format_chats(turns.unionByName(hard)))


@query(r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark
), win AS (
  SELECT DISTINCT item, list_slice(words, s, s + 9) AS w FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM i WHERE len(words) > 0)
), runs AS (
  SELECT doc_id, s, n, list_slice(words, s, s + n - 1) AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, (SELECT DISTINCT len(w) AS n FROM win))
), found AS (SELECT doc_id, s, n, item FROM runs JOIN win USING (w)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest_hits(decontaminate.find_windows(docs, items, size=10))


@query(r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT page_id, h || p AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, verdict) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, NULL::VARCHAR AS alias
FROM parts LEFT JOIN (FROM fits WHERE k = 1) USING (page_id)
-- These pages hold no redirect and no canonical link, so no page has an alias; the tests cover aliases.
""")
def op5_url_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokens.token_folder(spark)
    tokens.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER, END_ID, folder)
    return tokens.digest_tokens(spark, folder)


@query(r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_slice(words, i, i + 2)) AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM d WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT x.doc_id AS u, y.doc_id AS v FROM (
    SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id, doc_id AS seen FROM d UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.seen
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(k, 0) AS n_links
FROM (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY 1) LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT u AS doc_id, count(*) AS k FROM links GROUP BY 1) USING (doc_id)
""")
def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), percent=90, n=3)


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest_secrets(secrets.scan_secrets(docs, RANKS, RANK_PATTERN))


@query()
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@query()
def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@query(r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM benchmark
), sums AS (
  SELECT count(*) AS docs, sum(len(words))::BIGINT AS length FROM d WHERE len(words) > 0
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), sums
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), sums GROUP BY ALL
)
SELECT * FROM (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
) WHERE rank <= 50
""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query(r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
  ) WHERE length(run) >= 6 GROUP BY ALL
), coded AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM runs, tab
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM coded
  ) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(times) >= 5
), plain AS (
  -- One byte per letter, for an edit distance that counts bytes.
  SELECT word, n, length(word) AS l, translate(word, array_to_string([chr((192 + k)::INTEGER) FOR k IN range(64)], ''), array_to_string([chr((33 + k)::INTEGER) FOR k IN range(64)], '')) AS p
  FROM words
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n, row_number() OVER (PARTITION BY a.word ORDER BY b.n DESC, b.word) AS k
  FROM plain a JOIN plain b ON b.l BETWEEN a.l - 1 AND a.l + 1 AND a.word <> b.word AND levenshtein(a.p, b.p) = 1
), best AS (SELECT word, count(*) AS n_near, max(other) FILTER (k = 1) AS other, max(other_n) FILTER (k = 1) AS other_n FROM near GROUP BY 1),
judged AS (
  SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), ways AS (
  SELECT word, word AS place, form AS next FROM judged UNION ALL SELECT ways.word, judged.word, judged.form FROM ways JOIN judged ON judged.word = ways.next
)
SELECT judged.word, judged.form, place AS root, n, n_near, form_n FROM judged JOIN (FROM ways WHERE next IS NULL) ends USING (word)
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents"), drop_every=199))


@query()
def op13_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))
