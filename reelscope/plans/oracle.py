"""DuckDB SQL for every registered query (the correctness oracle).

The fixture views of ``fixtures.py`` are written again here as CTEs over
the driver's pre-registered tables, independently of the Spark code.
"""

from __future__ import annotations

CATALOG_RAW = """
catalog_raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS show_id,
    CASE WHEN p_type IN ('PROMO','LARGE') THEN 'TV Show' ELSE 'Movie' END AS type,
    CASE WHEN p_partkey % 97 = 0 THEN NULL
         WHEN p_partkey % 5 = 0 THEN '"' || p_name || '"'
         WHEN p_partkey % 7 = 0 THEN p_name || ': ' || p_type
         ELSE p_name END AS title,
    CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_brand END AS director,
    CASE WHEN p_partkey % 83 = 0 THEN NULL
         ELSE p_type || ', ' || p_brand || ', Size ' || CAST(p_size AS VARCHAR) END AS "cast",
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'C' END AS country,
    CASE WHEN p_partkey % 101 = 0 THEN 'not a date'
         ELSE strftime(DATE '2015-01-01' + CAST(p_partkey % 1500 AS INTEGER), '%B %-d, %Y') END AS date_added,
    CASE WHEN p_partkey % 103 = 0 THEN 'n/a' ELSE CAST(1990 + p_size % 30 AS VARCHAR) END AS release_year,
    CAST(p_size AS VARCHAR) || ' min' AS duration,
    CASE WHEN p_partkey % 79 = 0 THEN NULL ELSE p_name || ' ' || p_type END AS description
  FROM part)"""

CATALOG_CLEAN = CATALOG_RAW + """,
catalog_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY title, director
           ORDER BY TRY_CAST(show_id AS BIGINT) NULLS LAST, show_id NULLS LAST) AS rn
  FROM catalog_raw WHERE title IS NOT NULL AND director IS NOT NULL),
catalog_clean AS (
  SELECT TRY_CAST(show_id AS BIGINT) AS show_id, type, replace(title, '"', '') AS title, director,
    "cast", country, CAST(try_strptime(trim(date_added), '%B %-d, %Y') AS DATE) AS date_added,
    TRY_CAST(release_year AS INTEGER) AS release_year, duration, description
  FROM catalog_ranked WHERE rn = 1)"""

SUBMISSIONS = """
landed_submissions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS submission_id,
    'src' || CAST(o_custkey % 3 AS VARCHAR) AS source,
    'Thread ' || CAST(o_orderkey AS VARCHAR) AS title,
    o_orderpriority AS description, o_orderdate AS created_utc, c_name AS author,
    TRY_CAST(floor(o_totalprice) AS INTEGER) AS score,
    o_orderstatus = 'F' AS spoiler, o_orderstatus = 'O' AS is_original_content,
    CAST(NULL AS VARCHAR) AS distinguished, '/t/' || CAST(o_orderkey AS VARCHAR) AS link
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

COMMENTS = """
landed_comments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS submission_id,
    CASE WHEN p_partkey % 61 = 0 THEN p_name || ' (old title)'
         WHEN p_partkey % 7 = 0 AND p_partkey % 5 <> 0 THEN p_name || ': ' || p_type
         ELSE p_name END AS show_title,
    p_brand AS show_director,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS comment_id,
    l_returnflag || l_linestatus || ' ' || p_name AS body,
    l_shipdate AS created_utc, TRY_CAST(floor(l_quantity) AS INTEGER) AS score,
    't3_' || CAST(l_orderkey AS VARCHAR) AS parent_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

COMMENTS_FLAT = SUBMISSIONS + "," + COMMENTS + """,
comments_flat AS (
  SELECT c.show_title, c.show_director, s.source, s.title, s.description, s.author,
    c.comment_id, c.body, c.created_utc, c.score, c.parent_id, c.submission_id
  FROM landed_comments c JOIN landed_submissions s ON c.submission_id = s.submission_id)"""

# 60-bit md5 prefix, as reelscope.functions.synthetic.hash60
def H60(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 15)) AS BIGINT)"


def DIGEST(x: str) -> str:
    return f"COALESCE(bit_xor({H60(x)}), 0)"


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["catalog_clean"] = with_(CATALOG_CLEAN) + """
SELECT show_id, type, title, director, "cast", country, CAST(date_added AS VARCHAR) AS date_added,
       release_year, duration, description FROM catalog_clean"""

ORACLE["dup_titles"] = with_(CATALOG_CLEAN) + """
SELECT title, count(title) AS qty FROM catalog_clean GROUP BY title HAVING count(title) > 1"""

ORACLE["missing_fields"] = with_(CATALOG_RAW) + """
SELECT count(*) FILTER (WHERE title IS NOT NULL AND description IS NULL) AS missing_description,
       count(*) FILTER (WHERE title IS NULL OR director IS NULL) AS missing_title_or_director,
       count(*) AS n_rows FROM catalog_raw"""

ORACLE["top_directors"] = with_(CATALOG_CLEAN) + """
SELECT director, count(*) AS count FROM catalog_clean
WHERE director IS NOT NULL AND type = 'Movie'
GROUP BY director ORDER BY count DESC, director ASC LIMIT 10"""

ORACLE["latest_submissions"] = with_(SUBMISSIONS) + """
SELECT submission_id, source, author, CAST(created_utc AS VARCHAR) AS created_utc, score
FROM landed_submissions ORDER BY created_utc DESC, submission_id ASC LIMIT 10"""

ORACLE["global_count"] = with_(CATALOG_CLEAN) + "SELECT count(*) AS n_rows FROM catalog_clean"

ORACLE["actors_exploded"] = with_(CATALOG_CLEAN) + """
SELECT show_id, title, director, actor
FROM (SELECT show_id, title, director, unnest(string_split("cast", ',')) AS actor
      FROM catalog_clean WHERE "cast" IS NOT NULL)"""

ORACLE["actors_list"] = with_(CATALOG_CLEAN) + """
SELECT show_id, title, CAST(len(string_split("cast", ',')) AS BIGINT) AS n_actors,
       array_to_string(string_split("cast", ','), '|') AS actor_names
FROM catalog_clean WHERE "cast" IS NOT NULL"""

ORACLE["title_keys"] = with_(CATALOG_CLEAN) + """
SELECT show_id, title, split_part(title, ':', 1) AS title_key FROM catalog_clean"""

ORACLE["comments_per_show"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + f"""
SELECT k.show_id, k.title, k.director, s.n_comments, s.comments_digest
FROM catalog_clean k JOIN (
  SELECT show_title, show_director, count(*) AS n_comments, {DIGEST('comment_id')} AS comments_digest
  FROM comments_flat GROUP BY show_title, show_director) s
ON k.title = s.show_title AND k.director = s.show_director"""

ORACLE["shows_title_join"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + f"""
SELECT k.show_id, k.title, k.director, s.n_comments, s.comments_digest
FROM catalog_clean k JOIN (
  SELECT show_title, count(*) AS n_comments, {DIGEST('comment_id')} AS comments_digest
  FROM comments_flat GROUP BY show_title) s
ON k.title = s.show_title"""

ORACLE["shows_without_comments"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """
SELECT show_id, title, director FROM catalog_clean k
WHERE NOT EXISTS (SELECT 1 FROM comments_flat c
                  WHERE c.show_title = k.title AND c.show_director = k.director)"""

# Brute force: the reference's joint collect over actors × comments on title.
ORACLE["shows_fanout"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """,
ct AS (SELECT date_added, release_year, title, type, duration, description, director,
              unnest(string_split("cast", ',')) AS actor FROM catalog_clean)
SELECT CAST(ct.date_added AS VARCHAR) AS date_added, ct.release_year, ct.title, ct.type, ct.duration,
       ct.description, ct.director, count(co.body) AS comment_entries, count(ct.actor) AS actor_entries
FROM ct JOIN comments_flat co ON ct.title = co.show_title
GROUP BY ct.date_added, ct.release_year, ct.title, ct.type, ct.duration, ct.description, ct.director"""

ORACLE["shows_table"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + f"""
SELECT k.show_id, k.title, k.director, k.type, CAST(k.date_added AS VARCHAR) AS added_date, k.release_year,
       CAST(len(string_split(k."cast", ',')) AS BIGINT) AS n_actors,
       array_to_string(string_split(k."cast", ','), '|') AS actor_names,
       s.n_comments, s.comments_digest
FROM catalog_clean k JOIN (
  SELECT show_title, show_director, count(*) AS n_comments,
         {DIGEST("concat_ws('|', body, author, CAST(created_utc AS VARCHAR), CAST(score AS VARCHAR))")} AS comments_digest
  FROM comments_flat GROUP BY show_title, show_director) s
ON k.title = s.show_title AND k.director = s.show_director
WHERE k."cast" IS NOT NULL"""

PHRASE_POSTS = r"""
ph AS (SELECT item_id, trim(regexp_replace(lower(split_part(text, ':', 1)), '[^\p{L}\p{N}]+', ' ', 'g')) AS phrase
       FROM benchmark),
po AS (SELECT doc_id AS post_id, source, n_chars AS score,
              trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS nt FROM documents),
mentions AS (SELECT ph.item_id, po.post_id, po.source FROM ph JOIN po
             ON ph.phrase <> '' AND contains(' ' || po.nt || ' ', ' ' || ph.phrase || ' '))"""

ORACLE["phrase_mentions"] = with_(PHRASE_POSTS) + "SELECT item_id, post_id, source FROM mentions"

ORACLE["channel_mentions"] = with_(PHRASE_POSTS) + """
SELECT item_id, post_id, source FROM mentions WHERE source IN ('src0', 'src3', 'src7', 'src11')"""

ORACLE["ranked_mentions"] = with_(PHRASE_POSTS) + """
SELECT item_id, source, post_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT m.item_id, m.source, m.post_id, po.score,
         row_number() OVER (PARTITION BY m.item_id, m.source ORDER BY po.score DESC, m.post_id) AS rank
  FROM mentions m JOIN po ON m.post_id = po.post_id) WHERE rank <= 3"""


def _hint(x: str) -> str:
    """32-bit integer of the first 8 hex digits of md5(x)."""
    return f"CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT)"


GENERATED = CATALOG_CLEAN + """,
gen_src AS (SELECT show_id, title, director, source,
                   concat_ws('|', 'reelscope', coalesce(CAST(show_id AS VARCHAR), ''), title,
                             coalesce(director, ''), source) AS skey
            FROM catalog_clean, (VALUES ('netflix'), ('tvshows')) s(source)
            WHERE title IS NOT NULL),
gen_ck AS (SELECT g.*, i, skey || '|' || CAST(i AS VARCHAR) AS ck,
                  CAST(""" + _hint("skey || '|score'") + """ % 101 AS INTEGER) AS score
           FROM gen_src g, range(0, 250) r(i)),
gen_idx AS (SELECT *, md5(ck || '#0') || md5(ck || '#1') || md5(ck || '#2') AS hx
            FROM gen_ck),
gen AS (SELECT title AS show_title, director AS show_director, source, md5(skey) AS sub_id, score,
          CAST(i AS VARCHAR) AS comment_id,
          substr(array_to_string(list_transform(range(0, 5), lambda k:
             array_to_string(list_transform(range(0, 10), lambda p:
               chr(97 + CAST((CAST(('0x' || substr(hx, 12 * k + 1, 12)) AS BIGINT)
                              // CAST(pow(26, 9 - p) AS BIGINT)) % 26 AS INTEGER))), '')), ''),
                 1, 8 + CAST(CAST(('0x' || substr(hx, 61, 8)) AS BIGINT) % 43 AS INTEGER)) AS body,
          TIMESTAMP '2024-01-01 00:00:00' - INTERVAL 10368000 SECOND
             + to_seconds(CAST(('0x' || substr(hx, 69, 8)) AS BIGINT) % 10368000) AS created_utc
        FROM gen_idx)"""

ORACLE["generated_comments"] = with_(GENERATED) + f"""
SELECT show_title, show_director, source, sub_id, score AS sub_score, count(*) AS n_comments,
       CAST(sum(length(body)) AS BIGINT) AS body_chars, min(length(body)) AS min_body,
       max(length(body)) AS max_body, CAST(min(created_utc) AS VARCHAR) AS first_created,
       CAST(max(created_utc) AS VARCHAR) AS last_created,
       {DIGEST("concat_ws('|', comment_id, body, CAST(created_utc AS VARCHAR), CAST(score AS VARCHAR))")} AS comments_digest
FROM gen GROUP BY show_title, show_director, source, sub_id, score"""

ORACLE["generated_bodies"] = with_(GENERATED) + """
SELECT sub_id, show_title, show_director, source, comment_id, body, CAST(created_utc AS VARCHAR) AS created_utc, score
FROM gen"""

NESTED_SUMMARY = with_(SUBMISSIONS[1:], COMMENTS) + f"""
SELECT s.submission_id, c.show_title, c.show_director, s.source, s.author,
       CAST(coalesce(c.n_comments, 0) AS BIGINT) AS n_comments,
       coalesce(c.comments_digest, 0) AS comments_digest
FROM landed_submissions s LEFT JOIN (
  SELECT submission_id, show_title, show_director, count(*) AS n_comments,
         {DIGEST('comment_id')} AS comments_digest
  FROM landed_comments GROUP BY submission_id, show_title, show_director) c
ON s.submission_id = c.submission_id"""

ORACLE["nested_submissions"] = NESTED_SUMMARY
ORACLE["discussions_roundtrip"] = NESTED_SUMMARY

FLAT = with_(COMMENTS_FLAT[1:]) + """
SELECT show_title, show_director, source, title, description, author, comment_id, body,
       CAST(created_utc AS VARCHAR) AS created_utc, score, parent_id, submission_id
FROM comments_flat"""
ORACLE["flat_comments"] = FLAT
ORACLE["comments_partitioned_roundtrip"] = FLAT

ORACLE["catalog_csv_scan"] = with_(CATALOG_RAW) + """
SELECT * FROM catalog_raw WHERE CAST(show_id AS BIGINT) % 113 <> 0"""

ORACLE["catalog_csv_quarantine"] = with_(CATALOG_RAW) + """
SELECT show_id, title, CAST(show_id AS BIGINT) % 113 = 0 AS quarantined FROM catalog_raw"""

ORACLE["catalog_roundtrip"] = ORACLE["catalog_clean"]

ORACLE["catalog_bucketed"] = with_(CATALOG_CLEAN) + """
SELECT release_year, count(*) AS n_shows FROM catalog_clean GROUP BY release_year"""

# what two runs r1 and one run r0 leave: append keeps all, replace the last of each
ORACLE["append_then_replace"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """,
built AS (SELECT show_id FROM catalog_clean k
  WHERE k."cast" IS NOT NULL AND EXISTS (SELECT 1 FROM comments_flat c
        WHERE c.show_title = k.title AND c.show_director = k.director)),
writes AS (SELECT * FROM (VALUES (1, 'r0'), (2, 'r1'), (3, 'r1')) w(n, run_id)),
stored AS (SELECT b.show_id, w.n, w.run_id, w.n = max(w.n) OVER (PARTITION BY b.show_id, w.run_id) AS is_last
           FROM built b, writes w)
SELECT show_id, run_id, count(*) AS copies_append, count(*) FILTER (is_last) AS copies_replace
FROM stored GROUP BY show_id, run_id"""

ORACLE["catalog_partitioned_bucketed"] = with_(CATALOG_CLEAN) + """
SELECT type, release_year, count(*) AS n_shows FROM catalog_clean GROUP BY type, release_year"""

_PROFILE_COLS = [("show_id", "bigint"), ("type", "string"), ("title", "string"),
                 ("director", "string"), ("cast", "string"), ("country", "string"),
                 ("date_added", "date"), ("release_year", "int"), ("duration", "string"),
                 ("description", "string")]
ORACLE["schema_profile"] = with_(CATALOG_CLEAN) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows,
       count(*) - count("{c}") AS n_nulls, count(DISTINCT CAST("{c}" AS VARCHAR)) AS n_distinct
FROM catalog_clean""" for c, t in _PROFILE_COLS)

ORACLE["checks"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """,
r AS (
  SELECT 'no_null_titles' AS "check", '0' AS expected,
         CAST((SELECT count(*) FROM catalog_clean WHERE title IS NULL) AS VARCHAR) AS actual
  UNION ALL SELECT 'unique_show_ids', '0',
         CAST((SELECT count(*) - count(DISTINCT show_id) FROM catalog_clean) AS VARCHAR)
  UNION ALL SELECT 'keys_unique_after_clean', '0',
         CAST((SELECT count(*) FROM (SELECT title, director FROM catalog_clean
               GROUP BY title, director HAVING count(*) > 1)) AS VARCHAR)
  UNION ALL SELECT 'string_is_not_number', '0', '0'
  UNION ALL SELECT 'null_equals_none', NULL, NULL
  UNION ALL SELECT 'no_rows_fails', NULL, NULL
  UNION ALL SELECT 'every_show_has_comments', '0',
         CAST((SELECT count(*) FROM catalog_clean k WHERE NOT EXISTS (SELECT 1 FROM comments_flat c
               WHERE c.show_title = k.title AND c.show_director = k.director)) AS VARCHAR))
SELECT "check", expected, actual,
       CASE WHEN "check" = 'string_is_not_number' THEN false
            WHEN "check" = 'no_rows_fails' THEN false
            WHEN "check" = 'null_equals_none' THEN true
            ELSE actual = expected END AS passed
FROM r"""

ORACLE["epoch_to_ts"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_seconds,
       CAST(ts AS VARCHAR) AS created_utc FROM events"""

ORACLE["channels"] = r"""
SELECT doc_id, channel FROM (
  SELECT doc_id, unnest(string_split_regex(regexp_replace(' ' || source || '  ' || lang || chr(9),
                 '^\s+|\s+$', '', 'g'), '\s+')) AS channel FROM documents) WHERE channel <> ''"""

ORACLE["mentions_per_day"] = with_(CATALOG_CLEAN) + """
SELECT CAST(date_trunc('day', e.ts) AS VARCHAR) AS day, k.show_id, k.title, count(*) AS n_mentions,
       CAST(sum(CAST(round(e.value * 100) AS BIGINT)) AS BIGINT) AS score_cents
FROM events e JOIN catalog_clean k ON e.user_id = k.show_id
GROUP BY date_trunc('day', e.ts), k.show_id, k.title"""

ORACLE["mention_alerts"] = with_(CATALOG_CLEAN) + """
SELECT e.event_id, CAST(e.ts AS VARCHAR) AS ts, k.show_id, k.title, e.event_type,
       CAST(round(e.value * 100) AS BIGINT) AS score_cents
FROM (SELECT DISTINCT ON (event_id) * FROM events) e JOIN catalog_clean k ON e.user_id = k.show_id"""

ORACLE["titles_desc"] = with_(CATALOG_RAW) + """
SELECT show_id, title, director FROM catalog_raw
ORDER BY title DESC NULLS LAST, show_id ASC LIMIT 5"""

ORACLE["title_counts_raw"] = with_(CATALOG_RAW) + """
SELECT title, count(*) AS count FROM catalog_raw GROUP BY title
ORDER BY count DESC, title ASC NULLS FIRST LIMIT 5"""

ORACLE["shows_table_hot"] = ORACLE["shows_table"].replace(
    "FROM lineitem JOIN part ON l_partkey = p_partkey",
    "FROM lineitem JOIN part ON (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END) = p_partkey")
assert ORACLE["shows_table_hot"] != ORACLE["shows_table"]

ORACLE["comments_per_show_bucketed"] = ORACLE["comments_per_show"]

ORACLE["dup_show_submissions"] = with_(SUBMISSIONS[1:], COMMENTS) + """
SELECT show_title, count(show_title) AS qty FROM (
  SELECT s.submission_id, c.show_title, c.show_director
  FROM landed_submissions s LEFT JOIN (
    SELECT DISTINCT submission_id, show_title, show_director FROM landed_comments) c
  ON s.submission_id = c.submission_id)
GROUP BY show_title HAVING count(show_title) > 1"""

ORACLE["missing_descriptions"] = with_(CATALOG_RAW) + """
SELECT show_id, title, director FROM catalog_raw WHERE title IS NOT NULL AND description IS NULL"""

ORACLE["missing_keys_after_dedup"] = with_(CATALOG_RAW) + """
SELECT show_id, title, director FROM (
  SELECT *, row_number() OVER (PARTITION BY title, director
           ORDER BY TRY_CAST(show_id AS BIGINT) NULLS LAST, show_id NULLS LAST) AS rn
  FROM catalog_raw) WHERE rn = 1 AND (title IS NULL OR director IS NULL)"""

ORACLE["dropped_shows"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """
SELECT show_id, title, director, reason FROM (
  SELECT k.show_id, k.title, k.director,
         CASE WHEN NOT EXISTS (SELECT 1 FROM comments_flat c
                               WHERE c.show_title = k.title AND c.show_director = k.director)
              THEN 'no_comments'
              WHEN k."cast" IS NULL THEN 'no_cast' END AS reason
  FROM catalog_clean k) WHERE reason IS NOT NULL"""

ORACLE["mentions_per_day_stream"] = ORACLE["mentions_per_day"]

HOT_SUMMARY = NESTED_SUMMARY.replace(
    "SELECT CAST(l_orderkey AS VARCHAR) AS submission_id,\n    CASE WHEN p_partkey % 61",
    "SELECT CASE WHEN l_orderkey % 3 = 0 THEN '1' ELSE CAST(l_orderkey AS VARCHAR) END AS submission_id,\n"
    "    CASE WHEN p_partkey % 61").replace(
    "FROM lineitem JOIN part ON l_partkey = p_partkey",
    "FROM lineitem JOIN part ON (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END) = p_partkey")
assert HOT_SUMMARY.count("l_orderkey % 3") == 2
# rows with part = 0 are submissions: one per (thread, show), whatever the parts
ORACLE["hot_thread_roundtrip"] = HOT_SUMMARY.replace(
    "AS comments_digest\nFROM landed_submissions", "AS comments_digest, CAST(1 AS BIGINT) AS n_submissions\n"
    "FROM landed_submissions")
assert "n_submissions" in ORACLE["hot_thread_roundtrip"]

ORACLE["phrase_alerts"] = ORACLE["phrase_mentions"]

ORACLE["collected_threads"] = r"""
WITH shows AS (SELECT text AS title, 'long ' || CAST(item_id AS VARCHAR) AS director FROM benchmark
  UNION ALL SELECT regexp_extract(text, '^\s*(\S+)', 1), 'word ' || CAST(item_id AS VARCHAR) FROM benchmark),
ph AS (SELECT title, director,
  trim(regexp_replace(lower(split_part(title, ':', 1)), '[^\p{L}\p{N}]+', ' ', 'g')) AS phrase FROM shows),
po AS (SELECT CAST(doc_id AS VARCHAR) AS submission_id, source,
  trim(regexp_replace(lower(concat_ws(' ', 'Post ' || CAST(doc_id AS VARCHAR), text)), '[^\p{L}\p{N}]+', ' ', 'g')) AS nt
  FROM documents),
co AS (SELECT CAST(conv_id AS VARCHAR) AS submission_id, count(*) AS n,
  """ + DIGEST("concat_ws('-', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR))") + r""" AS d
  FROM conversations GROUP BY conv_id)
SELECT ph.title AS show_title, ph.director AS show_director, po.submission_id, po.source,
       CAST(coalesce(co.n, 0) AS BIGINT) AS n_comments, coalesce(co.d, 0) AS comments_digest
FROM ph JOIN po ON ph.phrase <> '' AND contains(' ' || po.nt || ' ', ' ' || ph.phrase || ' ')
LEFT JOIN co ON co.submission_id = po.submission_id"""

ORACLE["comment_tree"] = """
WITH RECURSIVE li AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                                                l_quantity, l_extendedprice) AS k FROM lineitem),
c AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN '1' ELSE CAST(l_orderkey AS VARCHAR) END AS thread,
    concat_ws('-', l_orderkey, k) AS id, CASE WHEN l_orderkey % 4 <> 1 OR k <> 4 THEN l_shipdate END AS created,
    CASE WHEN l_orderkey % 70 = 9 AND k = 2 THEN concat_ws('-', l_orderkey, 3)
         WHEN l_orderkey % 70 = 9 AND k = 3 THEN concat_ws('-', l_orderkey, 2)
         WHEN l_orderkey % 50 = 7 AND k = 2 THEN 'gone'
         WHEN k = 1 THEN NULL
         WHEN l_orderkey % 5 = 0 THEN concat_ws('-', l_orderkey, k - 1)
         ELSE concat_ws('-', l_orderkey, k // 2) END AS parent
  FROM li),
j AS (SELECT c.*, p.id IS NOT NULL AS found FROM c LEFT JOIN c p ON p.thread = c.thread AND p.id = c.parent),
t AS (
  SELECT thread, id, id AS root, 0 AS depth, parent IS NOT NULL AS orphan,
         [{'at': coalesce(created, DATE '0001-01-01'), 'id': id}] AS path
  FROM j WHERE NOT found
  UNION ALL
  SELECT j.thread, j.id, t.root, t.depth + 1, t.orphan,
         list_append(t.path, {'at': coalesce(j.created, DATE '0001-01-01'), 'id': j.id})
  FROM j JOIN t ON t.thread = j.thread AND t.id = j.parent WHERE j.found)
SELECT c.thread AS submission_id, c.id AS comment_id, t.root AS root_id, CAST(t.depth AS INTEGER) AS depth,
       CASE WHEN t.id IS NOT NULL THEN row_number() OVER (PARTITION BY t.id IS NULL, c.thread ORDER BY t.depth, t.path) END AS position,
       CASE WHEN t.id IS NULL THEN 'cycle' WHEN t.orphan THEN 'orphan' ELSE 'tree' END AS state
FROM c LEFT JOIN t ON t.thread = c.thread AND t.id = c.id"""

ORACLE["shows_runs"] = with_(CATALOG_CLEAN, COMMENTS_FLAT[1:]) + """
, built AS (
  SELECT show_id, duration, show_id % 3 <> 0 AS one, show_id % 2 = 0 AND (show_id % 3 = 0 OR show_id % 4 = 0) AS two
  FROM catalog_clean k WHERE "cast" IS NOT NULL AND (show_id % 3 <> 0 OR show_id % 2 = 0)
    AND EXISTS (SELECT 1 FROM comments_flat c WHERE c.show_title = k.title AND c.show_director = k.director)),
l AS (
  SELECT show_id, CASE WHEN two THEN 'r2' ELSE 'r1' END AS run_id,
         CASE WHEN two AND show_id % 4 = 0 THEN duration || ' (new)' ELSE duration END AS duration,
         CAST(one AS BIGINT) + CAST(two AS BIGINT) AS n_versions
  FROM built)
SELECT *, 'folded' AS folded_run, duration AS folded_duration FROM l"""

ORACLE["indexed_mentions"] = with_(PHRASE_POSTS) + """
SELECT item_id, post_id, source, listed FROM mentions, (VALUES (false), (true)) v(listed)
WHERE NOT listed OR source IN ('src0', 'src3', 'src7', 'src11')"""

ORACLE["description_words"] = r"""
WITH w AS (
  SELECT doc_id AS post_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents)
  WHERE length(word) >= 3 AND regexp_matches(word, '\p{L}') GROUP BY doc_id, word),
f AS (SELECT word, count(*) AS n_docs FROM w GROUP BY word),
r AS (
  SELECT post_id, word, round(n * ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + n_docs)), 9) AS weight
  FROM w JOIN f USING (word))
SELECT post_id, word AS description_word FROM r
QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY weight DESC, word) = 1"""

ORACLE["catalog_positions"] = with_(CATALOG_RAW) + """
, t AS (SELECT CAST(show_id AS BIGINT) AS show_id,
               CASE WHEN CAST(show_id AS BIGINT) % 3 = 0 THEN 'Same title' ELSE title END AS title FROM catalog_raw)
SELECT show_id, title, row_number() OVER (ORDER BY title DESC NULLS LAST, show_id) AS position FROM t"""

ORACLE["merged_sketches"] = with_(CATALOG_CLEAN) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count("{c}") AS n_nulls,
       count(DISTINCT CAST("{c}" AS VARCHAR)) AS exact, true AS is_close FROM catalog_clean""" for c, t in _PROFILE_COLS)

ORACLE["whole_run"] = with_(GENERATED, SUBMISSIONS[1:], COMMENTS) + rf"""
, st AS (
  SELECT s.submission_id, s.author, trim(regexp_replace(lower(concat_ws(' ', s.title,
    CASE WHEN o_custkey % 10 = 0 THEN coalesce('About ' || p_name || '!', s.description) ELSE s.description END)),
    '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS nt
  FROM landed_submissions s JOIN orders ON s.submission_id = CAST(o_orderkey AS VARCHAR)
  LEFT JOIN part ON p_partkey = o_orderkey % 200 + 1),
k AS (
  SELECT DISTINCT title, director,
    trim(regexp_replace(lower(split_part(title, ':', 1)), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS phrase FROM catalog_clean),
hits AS (
  SELECT k.title, k.director, st.submission_id, st.author
  FROM k JOIN st ON phrase <> '' AND contains(' ' || nt || ' ', ' ' || phrase || ' ')),
said AS (
  SELECT h.title, h.director, c.body, h.author, c.created_utc, c.score
  FROM hits h JOIN landed_comments c ON c.submission_id = h.submission_id
  UNION ALL SELECT show_title, show_director, body, 'default_author', created_utc, score FROM gen),
s AS (
  SELECT title, director, count(*) AS n_comments,
    {DIGEST("concat_ws('|', body, author, CAST(created_utc AS VARCHAR), CAST(score AS VARCHAR))")} AS comments_digest
  FROM said GROUP BY title, director)
SELECT k.show_id, k.title, k.director, k.type, CAST(k.date_added AS VARCHAR) AS added_date, k.release_year,
  CAST(len(string_split(k."cast", ',')) AS BIGINT) AS n_actors,
  array_to_string(string_split(k."cast", ','), '|') AS actor_names, s.n_comments, s.comments_digest
FROM catalog_clean k JOIN s USING (title, director) WHERE k."cast" IS NOT NULL"""
