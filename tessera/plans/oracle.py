"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is ``WITH <shared CTEs> SELECT ...`` over the parquet views
``region nation customer supplier part orders lineitem documents ...``.
Types are cast to match the Spark side (row numbers INTEGER, sums of
integers BIGINT) and computed doubles are rounded the same way.
"""

from __future__ import annotations

from ..functions.text import NOUN_SUFFIX_RULES
from ..operators import sentences as S
from . import documents as D
from . import recommendations as R
from . import tables as TB

WS = r"[ \t\n\x0B\f\r]"
CLITIC = r"(\p{L})(n''t|''s|''re|''ve|''ll|''d|''m)([^\p{L}]|$)"
OUTER = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def _tokens_cte(name: str, source: str) -> str:
    return f"""
{name}_pieces AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS piece
  FROM (SELECT doc_id,
               regexp_split_to_array(regexp_replace(lower(text), '{CLITIC}', '\\1 \\2\\3', 'g'),
                                     '{WS}+') AS l
        FROM {source})),
{name} AS (
  SELECT doc_id, pos, token FROM (
    SELECT doc_id, pos, regexp_replace(piece, '{OUTER}', '', 'g') AS token FROM {name}_pieces)
  WHERE regexp_matches(token, '^\\p{{L}}+$') AND length(token) >= 3)"""


def _lemma_rules() -> str:
    parts = ["SELECT term, term AS cand, 0 AS rule FROM terms"]
    for i, (suffix, repl) in enumerate(NOUN_SUFFIX_RULES, start=1):
        parts.append(
            f"SELECT term, left(term, length(term) - {len(suffix)}) || '{repl}', {i} "
            f"FROM terms WHERE suffix(term, '{suffix}')")
    return "\n  UNION ALL ".join(parts)


def _query_words() -> str:
    rows = ", ".join(f"({i}, '{w}')" for i, ws in enumerate(D.REFERENCE_QUERIES) for w in ws)
    return f"""
qwords AS (
  SELECT * FROM (VALUES {rows}) t(query_id, term)
  UNION ALL SELECT CAST(10 + FLOOR(term_id / 3) AS INTEGER), term FROM vocab WHERE term_id < 30
  UNION ALL SELECT 20, term FROM vocab WHERE term_id = 0
  UNION ALL SELECT 20, term FROM vocab WHERE term_id = 0
  UNION ALL SELECT 20, '{D.UNKNOWN_WORD}')"""


def text_ctes(p: D.Params = D.Params()) -> str:
    return f"""
docs AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS title, source AS genre, text FROM documents
  WHERE doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL),
{_tokens_cte('tokens', 'docs')},
stop AS (
  SELECT token AS word FROM (
    SELECT token, COUNT(*) AS c FROM tokens
    WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')
    GROUP BY token ORDER BY c DESC, token LIMIT {p.stop_top})),
rawtf AS (SELECT doc_id, token, COUNT(*) AS cnt FROM tokens GROUP BY doc_id, token),
lex AS (SELECT token AS term FROM rawtf GROUP BY token HAVING COUNT(*) >= 2),
terms AS (SELECT DISTINCT token AS term FROM rawtf),
cands AS (
  {_lemma_rules()}),
best AS (
  SELECT term, arg_min(cand, length(cand) * 100 + rule) AS lemma
  FROM cands WHERE cand IN (SELECT term FROM lex) GROUP BY term),
lemmas AS (SELECT t.term, COALESCE(b.lemma, t.term) AS lemma FROM terms t LEFT JOIN best b ON t.term = b.term),
ltok AS (
  SELECT k.doc_id, k.pos, k.token, m.lemma FROM tokens k JOIN lemmas m ON k.token = m.term
  WHERE length(m.lemma) > 2),
kept AS (SELECT doc_id, pos, lemma AS term FROM ltok WHERE lemma NOT IN (SELECT word FROM stop)),
tf AS (SELECT doc_id, term, COUNT(*) AS cnt FROM kept GROUP BY doc_id, term),
dl AS (SELECT doc_id, CAST(SUM(cnt) AS BIGINT) AS n_terms FROM tf GROUP BY doc_id),
dfreq AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
vocab AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS term_id, term, df
  FROM dfreq ORDER BY df DESC, term LIMIT {p.num_terms}),
idf AS (
  SELECT v.term_id, v.term, v.df,
         ln(CAST((SELECT COUNT(*) FROM docs) AS DOUBLE) / CAST(v.df AS DOUBLE)) AS idf
  FROM vocab v),
tfidf AS (
  SELECT tf.doc_id, i.term_id, i.idf * tf.cnt / dl.n_terms AS w
  FROM tf JOIN idf i ON tf.term = i.term JOIN dl ON tf.doc_id = dl.doc_id),
{_query_words()},
qv AS (
  SELECT q.query_id, i.term_id, SUM(i.idf) AS w FROM qwords q JOIN idf i ON q.term = i.term
  GROUP BY q.query_id, i.term_id)"""


def _ln(x: str) -> str:
    return f"ln(greatest({x}, 1e-12))"


def _pair_score(a: str, b: str, ab: str, n: str) -> str:
    p, p1, p2 = f"({b} / {n})", f"({ab} / {a})", f"(({b} - {ab}) / greatest({n} - {a}, 1))"
    return (f"(-2 * ({ab} * {_ln(p)} + ({a} - {ab}) * {_ln('1 - ' + p)}"
            f" + ({b} - {ab}) * {_ln(p)} + ({n} - {a} - {b} + {ab}) * {_ln('1 - ' + p)}"
            f" - (CASE WHEN {a} = {ab} THEN 0.0 ELSE {ab} * {_ln(p1)} + ({a} - {ab}) * {_ln('1 - ' + p1)} END)"
            f" - (CASE WHEN {b} = {ab} THEN 0.0 ELSE {_rest(a, b, ab, n, p2)} END)))")


def _rest(a: str, b: str, ab: str, n: str, p2: str) -> str:
    return f"({b} - {ab}) * {_ln(p2)} + ({n} - {a} - {b} + {ab}) * {_ln('1 - ' + p2)}"


def sentence_ctes() -> str:
    """Pieces, counts, abbreviations, starters, collocations and boundaries."""
    closers, upper = S.CLOSERS.replace("'", "''"), S.UPPER
    bare = r"(regexp_matches({0}, '^[0-9]+$') OR regexp_matches({0}, '^\p{{L}}$'))"
    letters = "CAST(length(replace(word, '.', '')) AS DOUBLE)"
    share = "(t.stops / t.pieces)"
    score = (f"-2 * (k * {_ln(share)} + (n - k) * {_ln('1 - ' + share)} - k * ln(0.99) - (n - k) * ln(0.01))"
             f" * exp(-{letters}) * (length(word) - {letters} + 1) * pow({letters}, -(n - k))")
    return rf"""
docs AS (
  SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL),
cut AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '') AS p FROM docs),
flat AS (
  SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS x FROM cut WHERE len(p) > 0),
core AS (SELECT *, regexp_replace(x, '{closers}', '') AS c FROM flat),
described AS (
  SELECT doc_id, pos, CASE WHEN regexp_matches(c, '[!?]$') THEN 2 WHEN suffix(c, '.') THEN 1 ELSE 0 END AS kind,
         regexp_replace(lower(c), '{OUTER}', '', 'g') AS word, regexp_matches(x, '{upper}') AS upper
  FROM core),
pieces AS (
  SELECT *, lead(word) OVER w AS next_word, lead(upper) OVER w AS next_upper, lead(pos) OVER w IS NULL AS last
  FROM described WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
counts AS (
  SELECT word, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(CASE WHEN kind = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS k
  FROM pieces WHERE word <> '' GROUP BY word),
t AS (SELECT SUM(n) AS pieces, SUM(k) AS stops FROM counts),
abbr AS (
  SELECT word FROM counts, t WHERE k > 0 AND regexp_matches(word, '\p{{L}}') AND NOT {bare.format("word")}
  AND {score} >= {S.ABBREVIATION}),
known AS (
  SELECT p.*, kind = 1 AND (a.word IS NOT NULL OR {bare.format("p.word")}) AS weak
  FROM pieces p LEFT JOIN abbr a ON a.word = p.word WHERE kind > 0 AND NOT last),
e AS (SELECT CAST(COUNT(*) AS DOUBLE) AS ends FROM known WHERE NOT weak),
starter AS (
  SELECT s.word FROM (
    SELECT next_word AS word, CAST(COUNT(*) AS DOUBLE) AS ab FROM known
    WHERE NOT weak AND regexp_matches(next_word, '\p{{L}}') GROUP BY next_word) s
  JOIN counts c ON c.word = s.word, t, e
  WHERE ab * t.pieces > c.n * e.ends AND {_pair_score("e.ends", "c.n", "ab", "t.pieces")} >= {S.STARTER}),
pair AS (
  SELECT s.word, s.next_word FROM (
    SELECT word, next_word, CAST(COUNT(*) AS DOUBLE) AS ab FROM known
    WHERE weak AND regexp_matches(next_word, '\p{{L}}') GROUP BY word, next_word HAVING COUNT(*) >= {S.LEAST_PAIRS}) s
  JOIN counts a ON a.word = s.word JOIN counts b ON b.word = s.next_word, t
  WHERE ab * t.pieces > a.n * b.n AND {_pair_score("a.n", "b.n", "ab", "t.pieces")} >= {S.COLLOCATION}),
ends AS (
  SELECT k.doc_id, k.pos FROM known k LEFT JOIN abbr a ON a.word = k.word
  LEFT JOIN starter s ON s.word = k.next_word LEFT JOIN pair p ON p.word = k.word AND p.next_word = k.next_word
  WHERE CASE WHEN kind = 2 THEN TRUE WHEN k.word = '' THEN next_upper
             WHEN (a.word IS NOT NULL OR {bare.format("k.word")}) AND p.word IS NOT NULL THEN FALSE
             WHEN a.word IS NOT NULL OR {bare.format("k.word")} THEN s.word IS NOT NULL AND next_upper
             ELSE TRUE END),
numbered AS (
  SELECT f.doc_id, f.pos, f.x,
         CAST(COUNT(e.pos) OVER (PARTITION BY f.doc_id ORDER BY f.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              AS INTEGER) AS sentence
  FROM flat f LEFT JOIN ends e ON e.doc_id = f.doc_id AND e.pos = f.pos)"""


def rating_ctes(p: R.Params = R.Params()) -> str:
    return f"""
plays AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item, CAST(l.l_quantity AS BIGINT) AS cnt,
         o.o_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
alias AS (
  SELECT p.p_partkey AS bad_id, g.good_id
  FROM part p JOIN (SELECT p_name, p_brand, MIN(p_partkey) AS good_id FROM part
                    GROUP BY p_name, p_brand) g
    ON p.p_name = g.p_name AND p.p_brand = g.p_brand
  WHERE p.p_partkey <> g.good_id),
ratings AS (
  SELECT pl."user", COALESCE(a.good_id, pl.item) AS item, CAST(pl.cnt AS DOUBLE) AS rating,
         md5(concat_ws('|', pl."user", COALESCE(a.good_id, pl.item), pl.o_orderkey,
                       pl.l_linenumber, pl.cnt)) AS row_key
  FROM plays pl LEFT JOIN alias a ON pl.item = a.bad_id),
qual AS (
  SELECT "user", COUNT(DISTINCT item) AS n_items FROM ratings GROUP BY "user"
  HAVING COUNT(DISTINCT item) >= {p.min_items or R.MIN_ITEMS}),
qratings AS (SELECT * FROM ratings WHERE "user" IN (SELECT "user" FROM qual)),
splitr AS (
  SELECT "user", item, rating, row_key,
         CASE WHEN ROW_NUMBER() OVER (PARTITION BY "user" ORDER BY row_key, item, rating)
                   <= GREATEST(1, FLOOR(COUNT(*) OVER (PARTITION BY "user") * CAST({p.train_fraction} AS DOUBLE)))
              THEN 'train' ELSE 'test' END AS split
  FROM qratings),
train AS (SELECT "user", item, rating, row_key FROM splitr WHERE split = 'train'),
test AS (SELECT "user", item, rating, row_key FROM splitr WHERE split = 'test'),
folds AS (
  SELECT "user", item, rating, row_key,
         CAST((ROW_NUMBER() OVER (PARTITION BY "user" ORDER BY row_key, item, rating) + "user")
              % {p.folds} AS INTEGER) AS fold
  FROM train),
pop AS (SELECT item, SUM(rating) AS total FROM train GROUP BY item),
top AS (
  SELECT rank, item, total, CAST({p.top_n} - (rank - 1) AS DOUBLE) AS score FROM (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY total DESC, item) AS INTEGER) AS rank, item, total
    FROM pop) WHERE rank <= {p.top_n}),
pal AS (
  SELECT u."user", t.item, t.score,
         CAST(CASE WHEN g."user" IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS label
  FROM (SELECT DISTINCT "user" FROM test) u CROSS JOIN top t
  LEFT JOIN (SELECT DISTINCT "user", item FROM test) g ON g."user" = u."user" AND g.item = t.item)"""


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


# Bits of the test users' items: ranges of 32,768 ids, lowest bit first.
BITS = """,
bits AS (
  SELECT DISTINCT "user", bucket, at_bit // 8 AS place, CAST(at_bit % 8 AS INTEGER) AS bit FROM (
    SELECT "user", CASE WHEN item > 0 THEN (item - 1) // 32768 + 1 ELSE item // 32768 END AS bucket,
           CASE WHEN item > 0 THEN (item - 1) % 32768 ELSE -item % 32768 END AS at_bit FROM test))"""

AUC_SELECT = """
SELECT CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0
            THEN ROUND(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 6) END AS auc
FROM (
  SELECT pos, neg,
         COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS below
  FROM (SELECT score, CAST(SUM(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
               CAST(SUM(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
        FROM pal GROUP BY score))"""

CONFUSION_SELECT = """
SELECT tp, fp, fn, tn,
       ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       ROUND(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END, 6)
         AS accuracy
FROM (
  SELECT CAST(COALESCE(SUM(CASE WHEN score > 0 AND label > 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp,
         CAST(COALESCE(SUM(CASE WHEN score > 0 AND label <= 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
         CAST(COALESCE(SUM(CASE WHEN score <= 0 AND label > 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn,
         CAST(COALESCE(SUM(CASE WHEN score <= 0 AND label <= 0.5 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn
  FROM pal)"""


def _shown(c: str, width: int) -> str:
    return (f"CASE WHEN length({c}) > {width} THEN substr({c}, 1, {width - 3}) || '...' "
            f"ELSE {c} END AS {c}")


def oracle_sql() -> dict[str, str]:
    rc = rating_ctes()
    tc = text_ctes()
    both = rc + "," + tc
    targets = ", ".join(f"'{t.lower().strip()}'" for t in TB.TARGET_NAMES)
    plot = ("SELECT CAST(doc_id AS VARCHAR) AS Title, source AS Genre, text AS Plot "
            "FROM documents")
    q = {
        # ---- sources and table basics
        "csv_infer_scan": "SELECT c_custkey, c_name AS Name, c_nationkey, c_acctbal, c_mktsegment "
                          "FROM customer",
        "sql_view_projection": "SELECT c_name AS Name FROM customer",
        "csv_multiline_scan": plot,
        "drop_null_rows": plot + " WHERE doc_id IS NOT NULL AND source IS NOT NULL AND text IS NOT NULL",
        "preview_rows": f"SELECT {_shown('Title', TB.PREVIEW_WIDTH)}, {_shown('Genre', TB.PREVIEW_WIDTH)}, "
                        f"{_shown('Plot', TB.PREVIEW_WIDTH)} FROM ({plot} WHERE doc_id IS NOT NULL AND "
                        f"source IS NOT NULL AND text IS NOT NULL) ORDER BY Title LIMIT {TB.PREVIEW_ROWS}",
        "text_lines_scan": with_ctes(rc, """SELECT concat_ws(' ', "user", item, cnt) AS value FROM plays"""),
        "parse_alias": with_ctes(rc, "SELECT bad_id, good_id FROM alias"),
        "parse_names_tolerant": f"SELECT p_partkey AS id, regexp_replace(p_name, '^{WS}+|{WS}+$', '', 'g') "
                                f"AS name FROM part",
        "parse_ratings_strict": with_ctes(rc, """SELECT "user", item, cnt AS "count" FROM plays"""),
        "stopword_table": with_ctes(tc, "SELECT word FROM stop"),
        "name_match_in_list": f"SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part "
                              f"WHERE lower(trim(p_name)) IN ({targets})",
        "new_user_rows": with_ctes(rc, f"""
            SELECT CAST({R.NEW_USER_ID} AS BIGINT) AS "user", COALESCE(a.good_id, i.item) AS item,
                   CAST({R.NEW_USER_COUNT} AS DOUBLE) AS rating,
                   md5(concat_ws('|', {R.NEW_USER_ID}, COALESCE(a.good_id, i.item), '', '',
                                 {R.NEW_USER_COUNT})) AS row_key
            FROM (SELECT CAST(unnest(range({len(R.NEW_USER_ITEMS)})) AS BIGINT) AS item) i
            LEFT JOIN alias a ON i.item = a.bad_id"""),
        "hash_sample": with_ctes(rc, f"""
            SELECT "user", item, cnt AS "count" FROM plays
            WHERE CAST(('0x' || substr(md5(concat_ws('|', "user", item, o_orderkey, l_linenumber, cnt)),
                                     1, 8)) AS BIGINT) < {int(TB.SAMPLE_FRACTION * 4294967296)}"""),
        "first_rating": with_ctes(rc, """
            SELECT "user", item, rating FROM ratings ORDER BY "user", item, rating, row_key LIMIT 1"""),
        "dataset_counts": with_ctes(both, """
            SELECT 'ratings' AS metric, COUNT(*) AS value FROM ratings
            UNION ALL SELECT 'alias_rows', COUNT(*) FROM alias
            UNION ALL SELECT 'distinct_user_items', COUNT(*) FROM (SELECT DISTINCT "user", item FROM ratings)
            UNION ALL SELECT 'qualified_users', COUNT(*) FROM qual
            UNION ALL SELECT 'train_rows', COUNT(*) FROM train
            UNION ALL SELECT 'test_rows', COUNT(*) FROM test
            UNION ALL SELECT 'documents', COUNT(*) FROM docs
            UNION ALL SELECT 'stopwords', COUNT(*) FROM stop
            UNION ALL SELECT 'tokens', COUNT(*) FROM tokens"""),
        # ---- ratings, split, folds, popularity
        "ratings_canonical": with_ctes(rc, 'SELECT "user", item, rating, row_key FROM ratings'),
        "distinct_user_items": with_ctes(rc, 'SELECT DISTINCT "user", item FROM ratings'),
        "distinct_items_per_user": with_ctes(rc, """
            SELECT "user", COUNT(DISTINCT item) AS n_items FROM ratings GROUP BY "user" """),
        "qualified_users": with_ctes(rc, 'SELECT "user", n_items FROM qual'),
        "qualified_ratings": with_ctes(rc, 'SELECT "user", item, rating, row_key FROM qratings'),
        "per_user_split": with_ctes(rc, 'SELECT "user", item, rating, row_key, split FROM splitr'),
        "split_user_parity": with_ctes(rc, """
            SELECT CAST(SUM(in_train) AS BIGINT) AS train_users, CAST(SUM(in_test) AS BIGINT) AS test_users,
                   CAST(SUM(CASE WHEN in_train <> in_test THEN 1 ELSE 0 END) AS BIGINT) AS users_in_one_side,
                   SUM(CASE WHEN in_train <> in_test THEN 1 ELSE 0 END) = 0 AS same_users
            FROM (SELECT "user", MAX(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS in_train,
                         MAX(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS in_test
                  FROM splitr GROUP BY "user")"""),
        "kfold_assign": with_ctes(rc, 'SELECT "user", item, rating, row_key, fold FROM folds'),
        "kfold_partitions": with_ctes(rc, """
            SELECT f."user", f.item, f.rating, f.row_key, f.fold, CAST(k.fold_id AS INTEGER) AS fold_id,
                   CASE WHEN f.fold = k.fold_id THEN 'val' ELSE 'train' END AS role
            FROM folds f CROSS JOIN (SELECT unnest(range(5)) AS fold_id) k"""),
        "popularity_cv_summary": with_ctes(rc, f"""
            SELECT top_n, ROUND(AVG(auc), 6) AS mean_auc, COUNT(*) AS folds FROM (
              SELECT top_n, fold, CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0
                     THEN SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)) END AS auc
              FROM (
                SELECT n.top_n, h.fold, h.pos, h.neg,
                       COALESCE(SUM(h.neg) OVER (PARTITION BY n.top_n, h.fold ORDER BY h.rank DESC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                FROM (
                  SELECT u.fold, t.rank, CAST(SUM(CASE WHEN g.item IS NULL THEN 0 ELSE 1 END) AS DOUBLE) AS pos,
                         CAST(SUM(CASE WHEN g.item IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS neg
                  FROM (SELECT DISTINCT "user", fold FROM folds) u
                  JOIN (SELECT k.fold, f.item,
                               ROW_NUMBER() OVER (PARTITION BY k.fold ORDER BY SUM(f.rating) DESC, f.item) AS rank
                        FROM folds f JOIN (SELECT unnest(range({R.FOLDS})) AS fold) k ON f.fold <> k.fold
                        GROUP BY k.fold, f.item) t ON t.fold = u.fold
                  LEFT JOIN (SELECT DISTINCT "user", fold, item FROM folds) g
                    ON g."user" = u."user" AND g.fold = u.fold AND g.item = t.item
                  WHERE t.rank <= {max(R.CV_LENGTHS)} GROUP BY u.fold, t.rank) h
                JOIN (SELECT unnest([{", ".join(map(str, R.CV_LENGTHS))}]) AS top_n) n ON h.rank <= n.top_n)
              GROUP BY top_n, fold)
            GROUP BY top_n ORDER BY AVG(auc) DESC, top_n LIMIT {R.CV_BEST}"""),
        "ground_truth_sets": with_ctes(rc, 'SELECT DISTINCT "user", item FROM test'),
        "item_popularity": with_ctes(rc, "SELECT item, total FROM pop"),
        "popularity_top_n": with_ctes(rc, "SELECT rank, item, total, score FROM top"),
        "name_lookup_default": with_ctes(rc, """
            SELECT t.rank, t.item, COALESCE(p.p_name, 'Unknown(' || CAST(t.item AS VARCHAR) || ')') AS name
            FROM top t LEFT JOIN part p ON t.item = p.p_partkey"""),
        "popularity_predictions_labels": with_ctes(rc, 'SELECT "user", item, score, label FROM pal'),
        "popularity_auc": with_ctes(rc, AUC_SELECT),
        "popularity_confusion": with_ctes(rc, CONFUSION_SELECT),
        "train_plus_new_user": with_ctes(rc, f"""
            SELECT "user", item, rating, row_key FROM train
            UNION ALL
            SELECT CAST({R.NEW_USER_ID} AS BIGINT), COALESCE(a.good_id, i.item),
                   CAST({R.NEW_USER_COUNT} AS DOUBLE),
                   md5(concat_ws('|', {R.NEW_USER_ID}, COALESCE(a.good_id, i.item), '', '',
                                 {R.NEW_USER_COUNT}))
            FROM (SELECT CAST(unnest(range({len(R.NEW_USER_ITEMS)})) AS BIGINT) AS item) i
            LEFT JOIN alias a ON i.item = a.bad_id"""),
        "global_kfold": with_ctes(rc, f"""
            SELECT *, CAST(index % {R.FOLDS} AS INTEGER) AS fold FROM (
              SELECT "user", item, rating, row_key,
                     ROW_NUMBER() OVER (ORDER BY row_key, "user", item, rating) - 1 AS index FROM train)"""),
        "ground_truth_bitmaps": with_ctes(rc + BITS, """
            SELECT "user", bucket, CAST(SUM(bit_count(byte)) AS BIGINT) AS n_items,
                   sha256(unhex(string_agg(printf('%02x', byte), '' ORDER BY place))) AS bits
            FROM (
              SELECT u."user", u.bucket, r.place, CAST(SUM(coalesce(1 << bit, 0)) AS INTEGER) AS byte
              FROM (SELECT DISTINCT "user", bucket FROM bits) u
              CROSS JOIN (SELECT unnest(range(4096)) AS place) r
              LEFT JOIN bits s ON s."user" = u."user" AND s.bucket = u.bucket AND s.place = r.place
              GROUP BY u."user", u.bucket, r.place)
            GROUP BY "user", bucket"""),
        "popularity_labels_by_bitmap": with_ctes(rc, 'SELECT "user", item, score, label FROM pal'),
        # ---- text
        "sentence_parameters": with_ctes(sentence_ctes(), """
            SELECT 'abbr' AS kind, word AS w, CAST(NULL AS VARCHAR) AS w2 FROM abbr
            UNION ALL SELECT 'starter', word, NULL FROM starter
            UNION ALL SELECT 'pair', word, next_word FROM pair"""),
        "doc_sentences": with_ctes(sentence_ctes(), """
            SELECT doc_id, sentence, MIN(pos) AS first_pos, CAST(COUNT(*) AS INTEGER) AS n_pieces,
                   string_agg(x, ' ' ORDER BY pos) AS text
            FROM numbered GROUP BY doc_id, sentence"""),
        "doc_tokens": with_ctes(tc, "SELECT doc_id, pos, token FROM tokens"),
        "lemma_tokens": with_ctes(tc, "SELECT doc_id, pos, token, lemma FROM ltok"),
        "tokens_without_stopwords": with_ctes(tc, "SELECT doc_id, pos, term FROM kept"),
        "term_freq": with_ctes(tc, "SELECT doc_id, term, cnt FROM tf"),
        "doc_lengths": with_ctes(tc, """
            SELECT d.doc_id, COALESCE(dl.n_terms, CAST(0 AS BIGINT)) AS n_terms
            FROM docs d LEFT JOIN dl ON d.doc_id = dl.doc_id"""),
        "doc_freq": with_ctes(tc, "SELECT term, df FROM dfreq"),
        "vocabulary": with_ctes(tc, "SELECT term_id, term, df FROM vocab"),
        "idf_table": with_ctes(tc, "SELECT term_id, term, df, ROUND(idf, 6) AS idf FROM idf"),
        "tfidf_coo": with_ctes(tc, "SELECT doc_id, term_id, ROUND(w, 9) AS w FROM tfidf"),
        "query_vector": with_ctes(tc, "SELECT query_id, term_id, ROUND(w, 6) AS w FROM qv"),
        "doc_metadata_lookup": with_ctes(tc, """
            SELECT t.doc_id, COALESCE(d.title, CAST(t.doc_id AS VARCHAR)) AS title,
                   COALESCE(d.genre, 'unknown') AS genre
            FROM (SELECT DISTINCT doc_id FROM tf) t LEFT JOIN docs d ON t.doc_id = d.doc_id"""),
        "matrix_shapes": with_ctes(tc, f"""
            SELECT (SELECT COUNT(*) FROM docs) AS n_docs, (SELECT COUNT(*) FROM vocab) AS n_terms,
                   CAST(LEAST({D.Params().k}, (SELECT COUNT(*) FROM vocab),
                              (SELECT COUNT(DISTINCT doc_id) FROM tfidf)) AS BIGINT) AS n_concepts"""),
    }
    return q
