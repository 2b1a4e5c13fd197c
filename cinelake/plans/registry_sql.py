"""DuckDB oracle SQL for every key of ``registry.QUERIES`` that SQL can express.

Rules that keep the two engines comparable: doubles that depend on summation order
are rounded (6 places, 2 for percentages); integer results are cast to the Spark
type (DuckDB's year() / row_number() are BIGINT, Spark's INT where noted); money
sums go through DECIMAL.  Tables are the pre-registered views of the driver.
"""

from __future__ import annotations

_CREDIT_COLS = [
    "id", "tituloPrincipal", "tituloOriginal", "anoLancamento", "tempoMinutos",
    "genero", "notaMedia", "numeroVotos", "personagem", "nomeArtista",
]
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in _CREDIT_COLS)
_TAG_LIKE = "(genero LIKE '%URGENT%' OR genero LIKE '%,F%')"
_TOKENS = "list_has_any(string_split(genero, ','), ['1-URGENT', 'F'])"
_CLASS = (
    "CASE WHEN genero LIKE '%,F%' AND NOT genero LIKE '%URGENT%' THEN 1 "
    "WHEN genero LIKE '%URGENT%' AND NOT genero LIKE '%,F%' THEN 2 "
    "WHEN genero LIKE '%,F%' AND genero LIKE '%URGENT%' THEN 3 END"
)
_LABEL = "CASE {c} WHEN 1 THEN 'Fantasy' WHEN 2 THEN 'Sci-Fi' WHEN 3 THEN 'Fantasy/Sci-Fi' END"

RAW_CREDITS = """raw_credits AS (
  SELECT l.l_orderkey AS id,
         'Order#' || CAST(l.l_orderkey AS VARCHAR) AS tituloPincipal,
         'Order#' || CAST(l.l_orderkey AS VARCHAR) AS tituloOriginal,
         CAST(year(o.o_orderdate) AS INTEGER) AS anoLancamento,
         CAST(NULLIF(l.l_linenumber, 7) AS INTEGER) AS tempoMinutos,
         concat_ws(',', o.o_orderpriority, o.o_orderstatus) AS genero,
         l.l_discount AS notaMedia,
         CAST(l.l_quantity AS INTEGER) AS numeroVotos,
         l.l_linestatus AS generoArtista,
         l.l_returnflag AS personagem,
         s.s_name AS nomeArtista,
         s.s_nationkey AS anoNascimento,
         CAST(NULL AS INTEGER) AS anoFalecimento,
         'supplier' AS profissao,
         CAST(l.l_partkey AS VARCHAR) AS titulosMaisConhecidos
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

TRUSTED_CREDITS = f"""trusted_credits AS (
  SELECT id, tituloPrincipal, tituloOriginal, anoLancamento, tempoMinutos, genero, notaMedia,
         numeroVotos, NULLIF(personagem, 'N') AS personagem, nomeArtista
  FROM (SELECT DISTINCT id, tituloPincipal AS tituloPrincipal, tituloOriginal, anoLancamento,
               tempoMinutos, genero, notaMedia, numeroVotos, personagem, nomeArtista
        FROM raw_credits WHERE {_TAG_LIKE}) d
  WHERE {_NOT_NULL} AND numeroVotos >= 30)"""

RAW_DETAILS = """raw_details AS (
  SELECT o.o_orderkey + 1000000 AS id,
         o.o_orderkey AS imdb_id,
         'Order#' || CAST(o.o_orderkey AS VARCHAR) AS title,
         strftime(o.o_orderdate, '%Y-%m-%d') AS release_date,
         a.max_disc * 100.0 AS vote_average,
         CAST(a.qty AS BIGINT) AS vote_count,
         a.max_tax AS popularity,
         CAST(floor(a.gross) AS BIGINT) AS budget,
         CAST(floor(o.o_totalprice) AS BIGINT) AS revenue,
         a.n_lines AS runtime,
         [{'id': CAST(1 AS BIGINT), 'name': o.o_orderpriority},
          {'id': CAST(2 AS BIGINT), 'name': o.o_orderstatus}] AS genres
  FROM orders o
  JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, max(l_tax) AS max_tax,
               max(l_discount) AS max_disc, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross
        FROM lineitem GROUP BY l_orderkey) a ON a.l_orderkey = o.o_orderkey)"""

TRUSTED_DETAILS = """trusted_details AS (
  SELECT id, imdb_id, title, CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) AS release_date,
         vote_average, vote_count, popularity, budget, revenue, runtime,
         DATE '2024-03-27' AS extraction_date
  FROM (SELECT DISTINCT * FROM raw_details) d
  WHERE revenue <> 0 AND budget <> 0 AND runtime <> 0 AND vote_count >= 30)"""

JOINED = f"""joined AS (
  SELECT c.*, {_CLASS.replace('genero', 'c.genero')} AS id_genre,
         d.id AS tmdb_id, d.imdb_id, d.title, d.release_date, d.vote_average, d.vote_count,
         d.popularity, d.budget, d.revenue, d.runtime, d.extraction_date
  FROM trusted_credits c JOIN trusted_details d ON c.id = d.imdb_id)"""

DIMS = f"""dim_actor AS (
  SELECT row_number() OVER (ORDER BY name) AS id, name, num_movies
  FROM (SELECT nomeArtista AS name, count(*) AS num_movies FROM trusted_credits GROUP BY nomeArtista) a),
dim_date AS (
  SELECT row_number() OVER (ORDER BY date) AS id, date,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter
  FROM (SELECT DISTINCT release_date AS date FROM trusted_details WHERE release_date IS NOT NULL) d),
dim_movie AS (
  SELECT DISTINCT id, tituloPrincipal AS main_title, tituloOriginal AS original_title,
         release_date, genero AS genres FROM joined),
fact_rows AS (
  SELECT DISTINCT id AS id_movie, nomeArtista AS artist_name, release_date, id_genre, runtime,
         revenue, budget, personagem AS actor_role, popularity, notaMedia AS imdb_rating,
         vote_average AS tmdb_rating, numeroVotos AS imdb_vote_count, vote_count AS tmdb_vote_count
  FROM joined),
fact AS (
  SELECT f.id_movie, f.id_genre, dd.id AS id_date, da.id AS id_actor, f.runtime, f.revenue,
         f.budget, f.actor_role, f.popularity, f.imdb_rating, f.tmdb_rating, f.imdb_vote_count,
         f.tmdb_vote_count
  FROM fact_rows f JOIN dim_date dd ON f.release_date = dd.date
  JOIN dim_actor da ON f.artist_name = da.name),
dim_genre AS (
  SELECT id_genre AS id, {_LABEL.format(c='id_genre')} AS genre, count(DISTINCT id_movie) AS num_movies
  FROM fact GROUP BY id_genre),
films AS (
  SELECT f.*, dd.year, dd.quarter, {_LABEL.format(c='f.id_genre')} AS genre
  FROM (SELECT DISTINCT id_movie, id_genre, id_date, runtime, revenue, budget, popularity,
               tmdb_rating, tmdb_vote_count FROM fact) f
  LEFT JOIN dim_date dd ON f.id_date = dd.id),
star_flat AS (
  SELECT f.*, m.main_title, m.original_title, m.release_date, m.genres,
         dd.date, dd.year, dd.month, dd.day, dd.quarter,
         g.genre, g.num_movies AS genre_num_movies, a.name, a.num_movies AS actor_num_movies
  FROM fact f
  LEFT JOIN dim_movie m ON f.id_movie = m.id
  LEFT JOIN dim_date dd ON f.id_date = dd.id
  LEFT JOIN dim_genre g ON f.id_genre = g.id
  LEFT JOIN dim_actor a ON f.id_actor = a.id)"""

FILMS_TAGS = "films_tags AS (SELECT o_orderkey AS id, concat_ws(',', o_orderpriority, o_orderstatus) AS genero FROM orders)"
NEAR_TAGS = (
    "films_tags AS (SELECT o_orderkey AS id, concat_ws(',', o_orderpriority, "
    "CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus || 'x' ELSE o_orderstatus END) AS genero FROM orders)"
)
CANDIDATES = f"{FILMS_TAGS},\ncand AS (SELECT DISTINCT id FROM films_tags WHERE {_TOKENS})"

STAR = "WITH " + ",\n".join([RAW_CREDITS, TRUSTED_CREDITS, RAW_DETAILS, TRUSTED_DETAILS, JOINED, DIMS]) + "\n"


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _fit(x: str, y: str, src: str, grain: str) -> str:
    return (
        f"SELECT '{grain}' AS grain, round(corr({y}, {x}), 6) AS corr, round(regr_slope({y}, {x}), 6) AS slope, "
        f"round(regr_intercept({y}, {x}), 6) AS intercept, round(regr_r2({y}, {x}), 6) AS r2, "
        f"CAST(regr_count({y}, {x}) AS BIGINT) AS n FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
    )


def _profile(col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, count({col}) AS count, round(avg({col}), 6) AS mean, "
        f"round(stddev_samp({col}), 6) AS stddev, CAST(min({col}) AS DOUBLE) AS min, "
        f"CAST(max({col}) AS DOUBLE) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM lineitem"
    )


def _text_profile(col: str, text: str) -> str:
    return (
        f"SELECT '{col}', count({col}), NULL, NULL, NULL, NULL, min({text}), max({text}) FROM lineitem"
    )


_LANDING_PATH = (
    "CASE WHEN o_orderkey % 2 = 0 THEN 'Raw/TMDB/JSON/' || strftime(o_orderdate, '%Y/%m/%d') || '/details-part-0.json' "
    "ELSE 'Raw/TMDB/JSON/' || strftime(o_orderdate, '%Y/%m/%d') || '/' END"
)
_TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]
_FACT_NOT_NULL = [
    "runtime", "revenue", "budget", "popularity", "imdb_rating", "tmdb_rating",
    "imdb_vote_count", "tmdb_vote_count", "actor_role",
]

ORACLE_SQL: dict[str, str] = {
    # 2.1 sources
    "scan_parquet": "SELECT * FROM orders",
    "landing_inventory": "SELECT make_date(year(o_orderdate), 1, 1) AS landed_on, count(*) AS n_rows FROM orders GROUP BY 1",
    "csv_round_trip": "SELECT p_partkey, p_name || '|x' AS p_name, p_brand, p_type, "
    "CASE WHEN p_size > 10 THEN p_size END AS p_size, p_retailprice FROM part",
    "json_round_trip": "SELECT * FROM customer",
    "json_file_sizes": "WITH n AS (SELECT count(*) AS n, count(*) // 100 + 1 AS f FROM customer), "
    "s AS (SELECT n // f + 1 AS records, n % f AS files FROM n UNION ALL SELECT n // f, f - n % f FROM n) "
    "SELECT CAST(records AS BIGINT) AS records, CAST(files AS BIGINT) AS files FROM s WHERE records > 0 AND files > 0",
    "partitioned_rewrite": "SELECT * FROM events",
    "id_list_round_trip": _w(CANDIDATES) + "SELECT id FROM cand",
    "land_once": "SELECT * FROM orders",
    "refined_round_trip": STAR + "SELECT * FROM fact",
    "catalogue_table": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    "schema_check": "SELECT difference, n_rows FROM (VALUES ('c_nationkey: int != bigint'), ('missing column c_phone'), "
    "('unexpected column c_acctbal')) v(difference), (SELECT count(*) AS n_rows FROM customer) c",
    "sql_view": STAR + "SELECT DISTINCT id FROM joined",
    # 2.2 projections and filters
    "drop_columns": _w(RAW_CREDITS)
    + "SELECT id, tituloPincipal, tituloOriginal, anoLancamento, tempoMinutos, genero, notaMedia, "
    "numeroVotos, personagem, nomeArtista FROM raw_credits",
    "rename_columns": "SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS release_ts, "
    "o_orderpriority FROM orders",
    "project_alias": "SELECT o_orderkey AS id, 'Order#' || CAST(o_orderkey AS VARCHAR) AS main_title, "
    "CAST(o_orderdate AS DATE) AS release_date, concat_ws(',', o_orderpriority, o_orderstatus) AS genres FROM orders",
    "reorder_columns": "SELECT l_linenumber, l_orderkey, l_shipdate, l_partkey, l_suppkey, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem",
    "filter_like_any": _w(NEAR_TAGS) + f"SELECT id, genero FROM films_tags WHERE {_TAG_LIKE}",
    "filter_tag_token": _w(NEAR_TAGS) + f"SELECT id, genero FROM films_tags WHERE {_TOKENS}",
    "dropna_any": "SELECT * FROM (SELECT l_orderkey, l_partkey, NULLIF(l_returnflag, 'N') AS flag, "
    "NULLIF(l_linenumber, 7) AS line FROM lineitem) t WHERE flag IS NOT NULL AND line IS NOT NULL",
    "filter_min_votes": "SELECT * FROM lineitem WHERE l_quantity >= 30",
    "filter_nonzero": "SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem "
    "WHERE l_discount <> 0 AND l_tax <> 0",
    "sentinel_to_null": "SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_returnflag, 'N') AS l_returnflag FROM lineitem",
    "add_literal": "SELECT *, DATE '2024-03-27' AS extraction_date FROM orders",
    "json_project_keys": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
    "json_extract_string(props, '$.missing') AS missing FROM events",
    "search_like": "SELECT * FROM part WHERE p_name LIKE '%gear%'",
    "predicate_logic": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "WHERE (l_returnflag = 'R' AND l_quantity >= 30) OR (NOT (l_linestatus = 'O') AND l_discount <> CAST(0.05 AS DOUBLE))",
    # 2.3 joins
    "join_inner": STAR + "SELECT * FROM joined",
    "lookup_date_key": STAR + "SELECT f.*, dd.id AS id_date FROM fact_rows f JOIN dim_date dd ON f.release_date = dd.date",
    "lookup_member_key": STAR + "SELECT f.*, da.id AS id_actor FROM fact_rows f JOIN dim_actor da ON f.artist_name = da.name",
    "star_flatten": STAR + "SELECT * FROM star_flat",
    "ids_found": _w(RAW_DETAILS, CANDIDATES)
    + "SELECT id FROM cand c WHERE EXISTS (SELECT 1 FROM raw_details d WHERE d.imdb_id = c.id)",
    "ids_missing": _w(RAW_DETAILS, CANDIDATES)
    + "SELECT id FROM cand c WHERE NOT EXISTS (SELECT 1 FROM raw_details d WHERE d.imdb_id = c.id)",
    # 2.4 aggregates
    "group_count": 'SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY l_suppkey',
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "count_distinct": "SELECT count(DISTINCT l_orderkey) AS n_distinct FROM lineitem",
    "count_distinct_tuple": "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t",
    "group_count_distinct": "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_distinct FROM lineitem GROUP BY l_suppkey",
    "describe_profile": " UNION ALL ".join(_profile(c) for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    + " UNION ALL " + _text_profile("l_returnflag", "l_returnflag")
    + " UNION ALL " + _text_profile("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"),
    "corr_pearson": "SELECT l_returnflag, round(corr(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END, "
    "CASE WHEN l_linenumber <> 3 THEN l_quantity END), 6) AS corr FROM lineitem GROUP BY l_returnflag",
    "regression_line": "SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, "
    "round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, "
    "round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, "
    "CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag",
    "enrichment_rate": _w(RAW_DETAILS, CANDIDATES)
    + ", m AS (SELECT c.id, (k.imdb_id IS NOT NULL) AS found FROM cand c "
    "LEFT JOIN (SELECT DISTINCT imdb_id FROM raw_details) k ON c.id = k.imdb_id) "
    "SELECT count(*) AS n_requested, CAST(count_if(found) AS BIGINT) AS n_found, "
    "CAST(count_if(NOT found) AS BIGINT) AS n_missing, "
    "round(CAST(count_if(found) AS DOUBLE) * 100.0 / count(*), 2) AS success_pct FROM m",
    # 2.5 windows
    "surrogate_key": "SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, "
    "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
    "seasonal_share": STAR
    + ", s AS (SELECT genre, quarter, sum(revenue) AS revenue, count(*) AS films FROM films "
    "WHERE quarter IS NOT NULL GROUP BY genre, quarter) "
    "SELECT genre, quarter, CAST(revenue AS BIGINT) AS revenue, films, "
    "round(CAST(revenue AS DOUBLE) * 100.0 / CAST(sum(revenue) OVER (PARTITION BY genre) AS DOUBLE), 2) AS share_pct FROM s",
    "top_n_per_group": STAR
    + "SELECT genre, id_movie, popularity, rank FROM (SELECT genre, id_movie, popularity, "
    "CAST(row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, id_movie) AS INTEGER) AS rank FROM films) t "
    "WHERE rank <= 10",
    "batch_assign": _w(CANDIDATES)
    + "SELECT id, rn, (rn - 1) // 50 + 1 AS batch FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM cand) t",
    "balanced_split": "SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn, "
    "ntile(101) OVER (ORDER BY event_id) AS part FROM events",
    # 2.6 sorts and limits
    "sort_asc": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position, * FROM orders",
    "sort_desc_count": 'SELECT row_number() OVER (ORDER BY "count" DESC, l_suppkey) AS position, * '
    'FROM (SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY l_suppkey) t',
    "top_k": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "capped_ids": _w(CANDIDATES) + "SELECT id FROM cand ORDER BY id LIMIT 500",
    # 2.7 set operations
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "drop_duplicates": _w(RAW_DETAILS)
    + "SELECT DISTINCT * FROM (SELECT * FROM raw_details UNION ALL SELECT * FROM raw_details) t",
    "distinct_ids": _w(RAW_CREDITS) + "SELECT DISTINCT id FROM raw_credits",
    # 2.8 scalar functions
    "parse_date": "SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN '' "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS release_date FROM orders",
    "date_parts": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders",
    "quarter_label": "SELECT o_orderkey, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter FROM orders",
    "filter_isin": "SELECT *, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders WHERE month(o_orderdate) IN (1, 2, 3)",
    "classify_tags": _w(FILMS_TAGS) + f"SELECT id, genero, {_CLASS} AS id_genre FROM films_tags",
    "label_codes": _w(FILMS_TAGS) + f"SELECT id, {_LABEL.format(c='(' + _CLASS + ')')} AS genre FROM films_tags",
    "date_from_path": f"SELECT o_orderkey, path, CAST(try_strptime(regexp_extract(path, '(\\d{{4}}/\\d{{2}}/\\d{{2}})', 1), "
    f"'%Y/%m/%d') AS DATE) AS extraction_date FROM (SELECT o_orderkey, {_LANDING_PATH} AS path FROM orders) t",
    "date_to_path": "SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS date_path FROM orders",
    "dataset_name": "SELECT c_custkey, 'data/' || c_mktsegment || ' Segment.csv' AS file_path, "
    "upper(substr(c_mktsegment || ' Segment', 1, 1)) || lower(substr(c_mktsegment || ' Segment', 2)) AS dataset FROM customer",
    "split_tags": _w(FILMS_TAGS) + "SELECT id, string_split(genero, ',') AS tags FROM films_tags",
    "path_basename": "SELECT o_orderkey, string_split('Raw/Local/CSV/Orders/' || strftime(o_orderdate, '%Y/%m/%d') "
    "|| '/orders-' || CAST(o_orderkey AS VARCHAR) || '.csv', '/')[-1] AS file_name FROM orders",
    "landing_path": "SELECT o_orderkey, concat_ws('/', 'Raw', 'Local', 'CSV', 'Orders', strftime(o_orderdate, '%Y/%m/%d'), "
    "'orders.csv') AS landing_path FROM orders",
    "json_nested_path": "SELECT event_id, 'lake-' || event_type AS bucket_name, 'Raw/Events/JSON/' || strftime(ts, '%Y/%m/%d') "
    "|| '/event-' || CAST(event_id AS VARCHAR) || '.json' AS object_key FROM events",
    "scale_units": "SELECT year, round(revenue / 1e6, 0) AS revenue_millions, round(revenue / 1e9, 1) AS revenue_billions "
    "FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) "
    "AS revenue FROM orders GROUP BY 1) t",
    # 2.9 streaming (stream result must equal the batch table)
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date FROM events",
    "stream_dedup": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "event_records": "WITH e AS (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'k' || CAST(event_id AS VARCHAR) END AS k FROM events) "
    "SELECT event_id, k AS first_key, CAST(p AS INTEGER) AS pos, k AS object_key FROM e, (VALUES (0), (1)) v(p) WHERE p < event_id % 3 "
    "UNION ALL SELECT event_id, NULL, NULL, NULL FROM e WHERE event_id % 3 = 0",
    "stream_trusted": _w(RAW_DETAILS, TRUSTED_DETAILS)
    + "SELECT * REPLACE (CASE WHEN imdb_id % 2 = 0 THEN DATE '2024-03-27' ELSE DATE '2024-03-28' END AS extraction_date) FROM trusted_details",
    # 2.11 data quality
    "stream_recheckpoint": _w(RAW_DETAILS, TRUSTED_DETAILS)
    + "SELECT * REPLACE (CASE WHEN imdb_id % 2 = 0 THEN DATE '2024-03-27' ELSE DATE '2024-03-28' END AS extraction_date) FROM trusted_details",
    # 2.11 data quality
    "stream_enrich": _w(RAW_DETAILS, CANDIDATES)
    + "SELECT c.id, (k.imdb_id IS NOT NULL) AS found FROM cand c "
    "LEFT JOIN (SELECT DISTINCT imdb_id FROM raw_details) k ON c.id = k.imdb_id",
    "csv_rejects": "WITH t AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_partkey % 7 = 0 THEN 'x' || p_size "
    "WHEN p_partkey % 11 = 0 THEN p_size || '|9' END AS bad FROM part) "
    "SELECT p_partkey, p_name, p_size, CAST(NULL AS VARCHAR) AS record FROM t WHERE bad IS NULL "
    "UNION ALL SELECT NULL, NULL, NULL, p_partkey || '|' || p_name || '|' || bad FROM t WHERE bad IS NOT NULL",
    "stream_dedup_window": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stage_funnel": _w(RAW_CREDITS)
    + ", r AS (SELECT id, tituloPincipal AS tituloPrincipal, tituloOriginal, anoLancamento, tempoMinutos, genero, "
    "notaMedia, numeroVotos, personagem, nomeArtista FROM raw_credits), "
    f"t AS (SELECT * FROM r WHERE {_TAG_LIKE}), c AS (SELECT DISTINCT * FROM t WHERE {_NOT_NULL}), "
    "f AS (SELECT * FROM c WHERE numeroVotos >= 30) "
    "SELECT 1 AS stage_no, 'raw' AS stage, count(*) AS n_rows FROM r UNION ALL "
    "SELECT 2, 'tag_filter', count(*) FROM t UNION ALL SELECT 3, 'dedup_dropna', count(*) FROM c UNION ALL "
    "SELECT 4, 'min_votes', count(*) FROM f",
    "distinct_sketches": "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, true AS within_bound FROM lineitem GROUP BY l_returnflag",
    "catalogue_swap": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    "stage_funnel_observed": _w(RAW_CREDITS)
    + ", r AS (SELECT id, tituloPincipal AS tituloPrincipal, tituloOriginal, anoLancamento, tempoMinutos, genero, "
    "notaMedia, numeroVotos, personagem, nomeArtista FROM raw_credits), "
    f"t AS (SELECT * FROM r WHERE {_TAG_LIKE}), c AS (SELECT DISTINCT * FROM t WHERE {_NOT_NULL}), "
    "f AS (SELECT * FROM c WHERE numeroVotos >= 30) "
    "SELECT 1 AS stage_no, 'raw' AS stage, count(*) AS n_rows FROM r UNION ALL "
    "SELECT 2, 'tag_filter', count(*) FROM t UNION ALL SELECT 3, 'dedup_dropna', count(*) FROM c UNION ALL "
    "SELECT 4, 'min_votes', count(*) FROM f",
    "audit_gate": STAR
    + "SELECT c.*, (SELECT count(*) FROM dim_actor) AS current_actors FROM ("
    + " UNION ALL ".join(
        [f"SELECT 'not null' AS check_name, '{c}' AS what, (SELECT count(*) FROM fact WHERE {c} IS NULL) AS n_violations, true AS blocks"
         for c in ("id_movie", "id_genre", "id_date", "id_actor", "runtime", "revenue", "budget")]
        + [f"SELECT 'foreign key', '{k}', (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.id = f.{k} {w})), true"
           for k, t, w in (("id_movie", "dim_movie", ""), ("id_actor", "dim_actor", "AND d.id % 5 <> 0"), ("id_date", "dim_date", ""), ("id_genre", "dim_genre", ""))]
        + ["SELECT 'primary key', 'id_movie,id_actor,id_date,id_genre,actor_role,imdb_rating,imdb_vote_count', (SELECT count(*) FROM "
           "(SELECT 1 FROM fact GROUP BY id_movie, id_actor, id_date, id_genre, actor_role, imdb_rating, imdb_vote_count HAVING count(*) > 1) g), true",
           "SELECT 'declared key', 'id_movie,id_actor,id_date,id_genre', (SELECT count(*) FROM "
           "(SELECT 1 FROM fact GROUP BY id_movie, id_actor, id_date, id_genre HAVING count(*) > 1) g), false"]
    )
    + ") c",
    "key_registry": "SELECT s_name AS name, row_number() OVER (ORDER BY s_suppkey % 3 <> 0, s_name) AS id FROM supplier",
    "rebuilt_artists": STAR
    + "SELECT row_number() OVER (ORDER BY f.name IS NULL, a.name) AS id, a.name, a.num_movies FROM dim_actor a "
    "LEFT JOIN (SELECT DISTINCT nomeArtista AS name FROM trusted_credits WHERE id % 50 = 0) f ON f.name = a.name",
    "key_consistency": _w(RAW_CREDITS, TRUSTED_CREDITS)
    + "SELECT id, count(*) AS n_versions FROM (SELECT DISTINCT id, tituloPrincipal, tituloOriginal, anoLancamento, "
    "tempoMinutos, genero, notaMedia, numeroVotos FROM trusted_credits) t GROUP BY id HAVING count(*) > 1",
    "pk_violations": STAR
    + "SELECT id_movie, id_actor, id_date, id_genre, count(*) AS n_rows FROM fact "
    "GROUP BY id_movie, id_actor, id_date, id_genre HAVING count(*) > 1",
    "fk_violations": STAR
    + "SELECT 'id_movie' AS fk_column, count(*) AS n_missing FROM fact f WHERE NOT EXISTS "
    "(SELECT 1 FROM dim_movie m WHERE m.id = f.id_movie AND m.id % 7 <> 0) UNION ALL "
    "SELECT 'id_actor', count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_actor a WHERE a.id = f.id_actor AND a.id % 5 <> 0) UNION ALL "
    "SELECT 'id_date', count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.id = f.id_date AND d.month <> 5) UNION ALL "
    "SELECT 'id_genre', count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_genre g WHERE g.id = f.id_genre)",
    "null_violations": STAR
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_nulls FROM fact" for c in _FACT_NOT_NULL
    ),
    # 2.12 pipelines
    "trusted_credits": _w(RAW_CREDITS, TRUSTED_CREDITS) + "SELECT * FROM trusted_credits",
    "trusted_details": _w(RAW_DETAILS, TRUSTED_DETAILS) + "SELECT * FROM trusted_details",
    "candidate_ids": _w(CANDIDATES) + "SELECT id FROM cand",
    "enrich_ids": _w(RAW_DETAILS, CANDIDATES)
    + "SELECT c.id, (k.imdb_id IS NOT NULL) AS found FROM cand c "
    "LEFT JOIN (SELECT DISTINCT imdb_id FROM raw_details) k ON c.id = k.imdb_id",
    "dim_actor": STAR + "SELECT * FROM dim_actor",
    "dim_date": STAR + "SELECT * FROM dim_date",
    "dim_movie": STAR + "SELECT * FROM dim_movie",
    "fact_build": STAR + "SELECT * FROM fact",
    "dim_genre": STAR + "SELECT * FROM dim_genre",
    "releases_per_year": STAR + "SELECT year, count(*) AS releases FROM films GROUP BY year",
    "snapshot_films": STAR.replace(
        "vote_count, popularity, budget, revenue, runtime,\n         DATE",
        "vote_count, CASE WHEN imdb_id % 2 = 0 THEN popularity + 1 ELSE popularity END AS popularity, budget, revenue, runtime,\n         DATE",
    )
    + "SELECT year, count(*) AS releases, round(avg(popularity), 6) AS avg_popularity FROM films GROUP BY year",
    "popularity_per_year": STAR
    + "SELECT year, count(*) AS releases, round(avg(popularity), 6) AS avg_popularity FROM films GROUP BY year",
    "budget_revenue_per_year": STAR
    + "SELECT year, count(*) AS releases, CAST(sum(budget) AS BIGINT) AS total_budget, "
    "CAST(sum(revenue) AS BIGINT) AS total_revenue, round(avg(budget), 6) AS avg_budget, "
    "round(avg(revenue), 6) AS avg_revenue FROM films WHERE year BETWEEN 1996 AND 2000 GROUP BY year",
    "mixed_genre_films": STAR
    + "SELECT year, count(*) AS releases, CAST(sum(budget) AS BIGINT) AS total_budget, "
    "CAST(sum(revenue) AS BIGINT) AS total_revenue, round(avg(budget), 6) AS avg_budget, "
    "round(avg(revenue), 6) AS avg_revenue FROM (SELECT DISTINCT id_movie, year, budget, revenue FROM films) "
    "WHERE year BETWEEN 1996 AND 2000 GROUP BY year",
    "budget_revenue_fit": STAR + _fit("budget", "revenue", "fact", "fact") + " UNION ALL " + _fit("budget", "revenue", "films", "film"),
    "rating_popularity_fit": STAR
    + "SELECT x.*, b.avg_budget FROM ("
    + _fit("tmdb_rating", "popularity", "fact", "fact")
    + " UNION ALL "
    + _fit("tmdb_rating", "popularity", "films", "film")
    + ") x LEFT JOIN (SELECT 'fact' AS g, round(avg(budget), 6) AS avg_budget FROM fact UNION ALL "
    "SELECT 'film', round(avg(budget), 6) FROM films) b ON x.grain = b.g",
    "top_artists_popularity": STAR
    + "SELECT af.id_actor, a.name, count(*) AS films, round(avg(af.popularity), 6) AS avg_popularity "
    "FROM (SELECT DISTINCT id_actor, id_movie, popularity, revenue FROM fact) af JOIN dim_actor a ON af.id_actor = a.id "
    "GROUP BY af.id_actor, a.name ORDER BY films DESC, avg_popularity DESC, a.name LIMIT 10",
    "top_artists_revenue": STAR
    + "SELECT af.id_actor, a.name, count(*) AS films, CAST(sum(af.revenue) AS BIGINT) AS total_revenue "
    "FROM (SELECT DISTINCT id_actor, id_movie, popularity, revenue FROM fact) af JOIN dim_actor a ON af.id_actor = a.id "
    "GROUP BY af.id_actor, a.name ORDER BY total_revenue DESC, a.name LIMIT 10",
    "artist_recurrence": STAR
    + "SELECT id_actor, count(*) AS films, round(count(*) / (SELECT count(DISTINCT id_movie) FROM fact), 6) AS recurrence "
    "FROM (SELECT DISTINCT id_actor, id_movie FROM fact) t GROUP BY id_actor",
    "rating_by_genre": STAR
    + "SELECT genre, count(*) AS films, round(avg(tmdb_rating), 6) AS avg_rating FROM films GROUP BY genre",
}
