"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waymark.llm import chat_windows, collocations, filter_audit, line_blocks, mcd, minhash_join, packing, pu_quality, sstable, suffix_dedup, templates, token_counts, warc_bundle
from waymark.llm.common import table


def op1_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd.quality_verdicts(spark, table(spark, sf_dir, "documents"))


def op2_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_sstable_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_shards(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op4_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = "\\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", held), (-7, 1, "assistant", held)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) as conv_id", "cast(turn as long) as turn", "role", "text")
    return chat_windows.conversation_digests(spark, rows.unionByName(planted), public_tokenizers.path("byte_bpe_50k.json"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundle.archive_pages(spark, table(spark, sf_dir, "pages"))


def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract_text(spark, table(spark, sf_dir, "pages"))


def op8_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(spark, table(spark, sf_dir, "documents"), length=200)


def op9_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_groups(spark, table(spark, sf_dir, "documents"), words=2, percent=80)


def op10_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_pair_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark, table(spark, sf_dir, "documents"))


def op12_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mcd_outliers, op2_piece_counts, op3_sstable_shards, op4_budgeted_windows, op5_warc_bundles, op6_cost_balanced_packing, op7_line_blocks, op8_suffix_runs, op9_signature_join, op10_template_windows, op11_pair_naming, op12_pu_quality, op13_first_failures)}


#: Pages' payloads: digests in base 32 from five hex digits, twenty bits, at a time; the smallest id of a payload answers.
WARC_SQL = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, url, octet_length(encode(h))::BIGINT AS payload_bytes, x, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, 5 * i + 1, 5))::BIGINT >> s) & 31) + 1), 1)), '')), '') AS payload_digest, min(page_id) OVER (PARTITION BY x) AS first_id FROM p)
SELECT page_id::BIGINT AS page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id::BIGINT END AS refers_to, url FROM d"""

#: Brute force: every string of 200 bytes by its MD5, those that start twice, the bytes they cover and what is left.
REPEAT_SQL = """WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
p AS (SELECT doc_id, i, md5(b[i + 1 : i + 200]) AS h FROM (SELECT doc_id, b, unnest(range(n - 199)) AS i FROM t)),
r AS (SELECT doc_id, i FROM p JOIN (SELECT h FROM p GROUP BY h HAVING count(*) > 1) USING (h)),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r)),
s AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY doc_id, span),
c AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM s GROUP BY doc_id),
k AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM s UNION ALL SELECT doc_id, max(z), NULL FROM s GROUP BY doc_id),
x AS (SELECT doc_id, string_agg(hex(b[k.a + 1 : coalesce(k.z, n)]), '' ORDER BY k.a) AS kept FROM k JOIN t USING (doc_id) WHERE coalesce(k.z, n) > k.a GROUP BY doc_id)
SELECT doc_id::BIGINT AS doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(CASE WHEN removed IS NULL THEN b ELSE unhex(coalesce(kept, '')) END) AS kept_sha256 FROM t LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)"""

#: Brute force: shingles of two words, all pairs that share one, links on whole sets, and what they reach.
NEAR_SQL = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT w.doc_id::BIGINT AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id))::BIGINT AS component_id, least(w.doc_id, coalesce(low, w.doc_id)) = w.doc_id AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = w.doc_id"""


#: Brute force: all phrases of one to four words, their counts, every cut, and every longer candidate that holds them.
PHRASE_SQL = """WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
j AS (SELECT lang, k, phrase, a, j, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 : k], ' ') AS y FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k),
s AS (SELECT j.lang, j.phrase, a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score FROM j JOIN f x ON x.lang = j.lang AND x.phrase = j.x JOIN f y ON y.lang = j.lang AND y.phrase = j.y),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))))) AS phrase FROM c WHERE k > 2),
h AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY ALL),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, score FROM low LEFT JOIN h USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000"""

#: Brute force: every text's failures, and every order's steps over them.
AUDIT_SQL = """WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, part, x, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY x) AS low FROM t),
b AS (SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x), regexp_matches(x, '[#$%&*|]'), coalesce(doc_id > low, false)] AS b FROM w),
k AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, list_sum(list_transform(range(5), lambda i: b[i + 1]::INT << i))::INT AS m, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*)::BIGINT AS n FROM b LEFT JOIN k USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(range(5))::INT AS i), o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT array_to_string(list_transform(o, lambda i: substr('ABCDE', i + 1, 1)), '') AS filter_order, step, o[step] AS f, 1 << o[step] AS own, coalesce(list_sum(list_transform(o[1 : step - 1], lambda i: 1 << i)), 0)::INT AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
r AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (m & (own | before) = 0), 0) AS kept, coalesce(sum(n) FILTER (m & before = 0 AND m & own <> 0), 0) AS removed, coalesce(sum(n) FILTER (m & before <> 0 AND m & own <> 0), 0) AS redundant, coalesce(sum(n) FILTER (m = own), 0) AS unique_fails, coalesce(sum(n) FILTER (m & before = 0 AND m & own <> 0 AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (m & before = 0 AND m & own <> 0 AND toxic = 1), 0) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r"""


def oracle_sql() -> dict[str, str]:
    """The other queries have no SQL form: they run tokenizers, estimates or readers of pages; tests/llm holds them against brute force."""
    return {"op5_warc_bundles": WARC_SQL, "op8_suffix_runs": REPEAT_SQL, "op9_signature_join": NEAR_SQL, "op11_pair_naming": PHRASE_SQL, "op13_first_failures": AUDIT_SQL}
