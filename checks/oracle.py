"""The same queries as SQL over the given tables."""

from __future__ import annotations

from checks.queries import (
    CATALOG_FEATURES,
    DEEP,
    EMBEDDING_DIM,
    FIRST_YEAR,
    K,
    LAST_YEAR,
    RANDOM_SEED,
    SEED_ID,
    SEED_TITLE,
    SPINE_YEARS,
    TABLES,
    TOP,
)

N = len(CATALOG_FEATURES)
DIMS = range(N)


def _sum(terms) -> str:
    return " + ".join(terms)


def _select(names) -> str:
    return ", ".join(names)


FINITE = " AND ".join(f"isfinite({f})" for f in CATALOG_FEATURES)



def _average(name: str) -> str:
    hundredths = f"CAST(round({name} * 100) AS BIGINT)"
    return f"CAST(sum({hundredths}) AS DOUBLE) / (count({name}) * 100)"


CATALOG = f"""
averages AS (
  SELECT l_partkey, {_average("l_quantity")} AS q, {_average("l_extendedprice")} AS e,
         {_average("l_discount")} AS d, {_average("l_tax")} AS tax
  FROM lineitem GROUP BY l_partkey),
catalog AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         CASE WHEN p_size <> 1 THEN q END AS quantity,
         CASE WHEN p_size = 2 THEN 'nan'::DOUBLE ELSE e END AS price,
         CASE WHEN p_size = 3 THEN 'inf'::DOUBLE ELSE d END AS discount, tax
  FROM part LEFT JOIN averages ON p_partkey = l_partkey)"""

VALID = f"{CATALOG},\nvalid AS (SELECT * FROM catalog WHERE {FINITE})"

STATS = (
    f"{VALID},\nstats AS (SELECT count(*) AS n, "
    + _select(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(CATALOG_FEATURES))
    + " FROM valid)"
)

Z = (
    f"{STATS},\nz AS (SELECT valid.*, "
    + _select(
        f"({f} - m{i}) / CASE WHEN s{i} > 1e-12 THEN s{i} ELSE 1.0 END AS z{i}"
        for i, f in enumerate(CATALOG_FEATURES)
    )
    + " FROM valid, stats)"
)

CENTERS = (
    f"{Z},\ncenters AS (SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS cluster, "
    + _select(f"z{i} AS c{i}" for i in DIMS)
    + f" FROM z ORDER BY p_partkey LIMIT {K})"
)


def _assign(name: str, centers: str) -> str:
    gap = _sum(f"(z{i} - c{i}) * (z{i} - c{i})" for i in DIMS)
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT z.*, cluster, {_select(f"c{i}" for i in DIMS)},
           row_number() OVER (PARTITION BY p_partkey ORDER BY {gap}, cluster) AS place
    FROM z, {centers}) WHERE place = 1)"""


def _move(name: str, centers: str, assigned: str) -> str:
    means = _select(f"coalesce(avg(a.z{i}), any_value(o.c{i})) AS c{i}" for i in DIMS)
    return f"""
{name} AS (
  SELECT o.cluster, {means} FROM {centers} o LEFT JOIN {assigned} a ON a.cluster = o.cluster
  GROUP BY o.cluster)"""


ASSIGNED = f"{CENTERS},{_assign('assigned', 'centers')}"

SEED = (
    f"{ASSIGNED},\nseed AS (SELECT p_partkey AS seed_id, p_name AS seed_name, p_brand AS seed_brand, "
    "p_size AS seed_size, cluster AS seed_cluster, "
    + _select([f"z{i} AS y{i}, c{i} AS b{i}" for i in DIMS])
    + f" FROM assigned WHERE contains(lower(p_name), lower('{SEED_TITLE}')) ORDER BY p_partkey LIMIT 1)"
)

EUCLIDEAN = "sqrt(" + _sum(f"(z{i} - y{i}) * (z{i} - y{i})" for i in DIMS) + ")"


def _relative(value: str, center: str) -> str:
    return f"({value} / CASE WHEN abs({center}) > 1e-6 THEN {center} ELSE 1e-6 END - 1.0)"


_C = [_relative(f"y{i}", f"b{i}") for i in DIMS]
_D = [_relative(f"z{i}", f"b{i}") for i in DIMS]
_CN = "sqrt(" + _sum(f"{c} * {c}" for c in _C) + ")"
_DN = "sqrt(" + _sum(f"{d} * {d}" for d in _D) + ")"
_COS = "((" + _sum(f"{c} * {d}" for c, d in zip(_C, _D, strict=True)) + f") / {_CN} / {_DN})"
BOOK = (
    f"CASE WHEN {_CN} < 1e-6 OR {_DN} < 1e-6 THEN abs({_CN} - {_DN}) "
    f"ELSE sqrt({_COS} * {_COS} + ({_CN} - {_DN}) * ({_CN} - {_DN})) END"
)


def _similar(distance: str) -> str:
    return f"""{SEED},
best AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size, price, quantity, {distance} AS distance
  FROM assigned, seed WHERE cluster = seed_cluster AND p_partkey <> seed_id
  ORDER BY distance, p_partkey LIMIT {TOP}),
ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY distance, p_partkey) AS INTEGER) AS rank FROM best)"""


def _recommend(distance: str) -> str:
    return f"""WITH {_similar(distance)}
SELECT p_partkey, p_name, p_brand, p_type, p_size, round(price, 2) AS price,
       round(quantity, 2) AS quantity, round(distance, 6) AS distance, rank FROM ranked"""


def _orders(first: int, last: int) -> str:
    return f"""
orders_in AS (
  SELECT DISTINCT o_orderkey, o_orderpriority, o_totalprice, o_custkey,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders
  WHERE o_orderstatus <> 'P' AND year(o_orderdate) BETWEEN {first} AND {last})"""


def _top_orders(first: int, last: int) -> str:
    return f"""{_orders(first, last)},
top_orders AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY o_totalprice DESC, o_orderkey,
      o_orderpriority, o_custkey) AS INTEGER) AS rank FROM orders_in) WHERE rank <= {TOP})"""


def _documents(first: int, last: int) -> str:
    return f"""
rows_in AS (
  SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
         o_custkey, c_name, c_acctbal, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE year(o_orderdate) BETWEEN {first} AND {last}),
songs AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY price DESC, o_orderkey, o_orderpriority,
    c_name) AS rank
  FROM (SELECT DISTINCT o_orderkey, o_orderpriority, price, c_name, year FROM rows_in
        WHERE price IS NOT NULL)),
artists AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY c_acctbal DESC, o_custkey, c_name) AS rank
  FROM (SELECT DISTINCT o_custkey, c_name, c_acctbal, year FROM rows_in)),
spine AS (SELECT CAST(year AS INTEGER) AS year FROM generate_series({first}, {last}) AS t(year)),
song_lists AS (
  SELECT year, count(*) AS n,
         string_agg(o_orderkey || ':' || printf('%.4f', round(price, 4)), ';' ORDER BY rank) AS entries
  FROM songs WHERE rank <= {TOP} GROUP BY year),
artist_lists AS (
  SELECT year, count(*) AS n,
         string_agg(o_custkey || ':' || printf('%.4f', round(c_acctbal, 4)), ';' ORDER BY rank) AS entries
  FROM artists WHERE rank <= {TOP} GROUP BY year)
SELECT spine.year, CAST(coalesce(a.n, 0) AS INTEGER) AS n_artists,
       CAST(coalesce(s.n, 0) AS INTEGER) AS n_songs, coalesce(a.entries, '') AS top_artists,
       coalesce(s.entries, '') AS top_songs
FROM spine LEFT JOIN artist_lists a ON a.year = spine.year
LEFT JOIN song_lists s ON s.year = spine.year"""


def _lines() -> str:
    split = "string_split(text, chr(10))"
    return f"""
lines AS (
  SELECT doc_id, source, lang, n_chars, unnest({split}) AS line,
         generate_subscripts({split}, 1) - 1 AS pos FROM documents)"""


def _label_means(narrow: int = 2) -> str:
    means = _select(f"avg(embedding[{i + 1}]::DOUBLE) AS c{i}" for i in range(EMBEDDING_DIM))
    gap = _sum(
        f"(embedding[{i + 1}]::DOUBLE - c{i}) * (embedding[{i + 1}]::DOUBLE - c{i})"
        for i in range(EMBEDDING_DIM)
    )
    return f"""
means AS (SELECT label AS mean_label, {means} FROM embeddings GROUP BY label),
centers AS (
  SELECT *, CAST(row_number() OVER (ORDER BY mean_label) - 1 AS INTEGER) AS cluster FROM means),
nearest AS (
  SELECT * FROM (
    SELECT vec_id, label, cluster, {gap} AS cost,
           row_number() OVER (PARTITION BY vec_id ORDER BY {gap}, cluster) AS place
    FROM embeddings, centers) WHERE place = 1),
nearest_of_few AS (
  SELECT * FROM (
    SELECT vec_id, cluster, row_number() OVER (PARTITION BY vec_id ORDER BY {gap}, cluster) AS place
    FROM embeddings, centers WHERE cluster < {narrow}) WHERE place = 1)"""


def _cast_variants() -> str:
    value = "CAST(value AS VARCHAR)"
    variants = {
        "plain": value,
        "blanks": f"'  ' || {value} || ' '",
        "minus": f"'-' || {value}",
        "power": f"{value} || 'e2'",
        "tail": f"{value} || 'x'",
        "word": "event_type",
        "json": "props",
        "nan": "'nan'",
        "inf": "'-inf'",
        "empty": "''",
        "null": "NULL",
    }
    return "\nUNION ALL ".join(
        f"SELECT event_id, '{kind}' AS kind, TRY_CAST({text} AS DOUBLE) AS f FROM events"
        for kind, text in variants.items()
    )


def _catalog_values(relation: str) -> str:
    return f"SELECT p_partkey, p_name, cluster, {_select(CATALOG_FEATURES)} FROM {relation}"


def _center_rows(relation: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT cluster, {i} AS pos, round(c{i}, 6) AS value FROM {relation}" for i in DIMS
    )


def _batch(which: str, distance: str, n: int) -> str:
    return f"""WITH {ASSIGNED},
seeds AS (
  SELECT p_partkey AS seed_id, cluster AS seed_cluster, {
        _select(f"z{i} AS y{i}, c{i} AS b{i}" for i in DIMS)
    } FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY p_partkey) AS nth FROM assigned)
  {which}),
scored AS (
  SELECT seed_id, p_partkey, {distance} AS distance
  FROM assigned JOIN seeds ON cluster = seed_cluster WHERE p_partkey <> seed_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY distance, p_partkey) AS INTEGER)
    AS rank FROM scored)
SELECT seed_id, rank, p_partkey, round(distance, 6) AS distance FROM ranked WHERE rank <= {n}"""


def _thousandths(name: str) -> str:
    return f"'+' || CAST(floor({name} * 1000) AS BIGINT) || '.50'"


ORACLE = {
    "top_items_by_year": f"""WITH {_top_orders(FIRST_YEAR, LAST_YEAR)}
SELECT year, rank, o_orderkey, o_orderpriority, o_custkey, c_name,
       round(o_totalprice, 4) AS o_totalprice
FROM top_orders JOIN customer ON o_custkey = c_custkey""",
    "top_items_deep": f"""SELECT year, rank, o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY o_totalprice DESC, o_orderkey, o_orderpriority,
    o_custkey) AS INTEGER) AS rank
  FROM (SELECT DISTINCT o_orderkey, o_orderpriority, o_totalprice, o_custkey,
               CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS year
        FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) BETWEEN 1980 AND 2009))
WHERE rank <= {DEEP}""",
    "top_groups_by_year": f"""WITH active AS (
  SELECT DISTINCT c_custkey, c_name, c_acctbal, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE year(o_orderdate) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY c_acctbal DESC, c_custkey, c_name)
    AS INTEGER) AS rank FROM active)
SELECT year, rank, c_custkey, c_name, round(c_acctbal, 4) AS c_acctbal FROM ranked
WHERE rank <= {TOP}""",
    "top_by_year_spine": f"""WITH {_top_orders(*SPINE_YEARS)}
SELECT CAST(s.year AS INTEGER) AS year, rank, o_orderkey, round(o_totalprice, 4) AS o_totalprice
FROM generate_series({SPINE_YEARS[0]}, {SPINE_YEARS[1]}) AS s(year)
LEFT JOIN top_orders ON top_orders.year = s.year""",
    "top_by_year_document": f"WITH {_documents(*SPINE_YEARS)}",
    "top_by_year_json": f"WITH {_documents(*SPINE_YEARS)}",
    "display_items": """WITH years AS (
  SELECT *, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE year(o_orderdate) END AS INTEGER) AS year
  FROM orders)
SELECT o_orderkey, o_orderpriority, o_custkey, year, round(o_totalprice, 2) AS o_totalprice,
       nullif(year, 0) AS known_year FROM years""",
    "csv_roundtrip": """SELECT doc_id, translate(text, chr(10) || chr(13), '  ') AS text, lang, source
FROM documents""",
    "csv_data_rows": """SELECT kind, event_id, event_type, props, value
FROM events, (VALUES ('good'), ('long'), ('wide')) AS kinds(kind)""",
    "csv_table_roundtrip": f"""WITH {CATALOG}
SELECT p_partkey, p_name, p_brand, {
        _select(f"CASE WHEN isfinite({f}) THEN {f} END AS {f}" for f in CATALOG_FEATURES)
    } FROM catalog""",
    "safe_casts": f"""WITH floats AS ({_cast_variants()})
SELECT event_id, kind, coalesce(isfinite(f), false) AS is_number,
       CASE WHEN isfinite(f) THEN f END AS as_float,
       CASE WHEN isfinite(f) THEN coalesce(TRY_CAST(trunc(f) AS INTEGER), 0) ELSE 0 END AS as_int
FROM floats""",
    "clean_bytes": "SELECT doc_id, text FROM documents",
    "zip_records": f"""WITH {_lines()}
SELECT CAST(doc_id AS VARCHAR) AS path, CAST(pos AS BIGINT) AS pos, source AS artist_id,
       lang AS artist_name, doc_id || '-' || pos AS song_id, line AS song_name,
       CAST(length(line) AS DOUBLE) AS loudness, CAST(pos AS DOUBLE) AS tempo,
       CAST(pos + 1990 AS INTEGER) AS year, CAST(n_chars AS DOUBLE) AS artist_hotttnesss,
       CAST(len(string_split(line, ' ')) AS DOUBLE) AS duration
FROM lines""",
    "ingest_limit": f"""WITH {_lines()}
SELECT doc_id || '-' || pos AS song_id, line AS song_name,
       CAST(length(line) AS DOUBLE) AS loudness, CAST(pos + 1990 AS INTEGER) AS year
FROM lines ORDER BY CAST(doc_id AS VARCHAR), pos LIMIT 500""",
    "ingest_status": """WITH files AS (
  SELECT contains(url, '?') OR contains(url, '/de/') AS bad, len(string_split(html, '<p>')) AS n
  FROM pages)
SELECT CASE WHEN bad THEN 'failed' ELSE 'ok' END AS status, count(*) AS n_files,
       CAST(sum(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS n_records
FROM files GROUP BY 1""",
    "file_inventory": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS has_bytes, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "hidden_files": """SELECT '_x' AS folder, true AS has_bytes, count(*) AS n_files
FROM (SELECT 1 FROM nation LIMIT 1) UNION ALL SELECT '.x', true, count(*) FROM (SELECT 1 FROM region LIMIT 1)""",
    "valid_items": f"""WITH {VALID}
SELECT p_partkey, p_name, {_select(CATALOG_FEATURES)} FROM valid""",
    "feature_stats": f"WITH {VALID}\n"
    + "\nUNION ALL ".join(
        f"""SELECT {i} AS pos, '{f}' AS feature, count(*) AS n, round(avg({f}), 6) AS mean,
       round(stddev_pop({f}), 6) AS std, round(sum({f}), 2) AS total,
       round(sum({f} * {f}) / count(*), 2) AS mean_square FROM valid"""
        for i, f in enumerate(CATALOG_FEATURES)
    ),
    "zscore": f"""WITH {Z}
SELECT p_partkey, {
        _select(f"round(z{i}, 6) AS {f}_z" for i, f in enumerate(CATALOG_FEATURES))
    } FROM z""",
    "assign_nearest": f"WITH {_label_means()}\nSELECT vec_id, label, cluster FROM nearest",
    "wssse": f"WITH {_label_means()}\nSELECT round(sum(cost), 6) AS wssse FROM nearest",
    "cluster_sizes": f"""WITH {_label_means()}
SELECT cluster, count(*) AS n_items FROM nearest GROUP BY cluster""",
    "assign_items": f"WITH {ASSIGNED}\nSELECT p_partkey, p_name, cluster FROM assigned",
    "lloyd_steps": f"""WITH {ASSIGNED},{_move("moved", "centers", "assigned")},{
        _assign("assigned2", "moved")
    },{_move("moved2", "moved", "assigned2")}
{_center_rows("moved2")}""",
    "cluster_report": f"""WITH {ASSIGNED}
SELECT cluster, count(*) AS n_items, {
        " || ' ' || ".join(f"printf('%.3f', round(any_value(c{i}), 3))" for i in DIMS)
    } AS center FROM assigned GROUP BY cluster""",
    "kmeans_fit": f"""WITH {VALID}
SELECT p_partkey, true AS is_nearest, true AS centers_are_means, true AS sums_agree FROM valid""",
    "nearest_of_any_vector": f"""WITH {_label_means()}
SELECT vec_id, CASE WHEN vec_id % 7 NOT IN (1, 2, 3, 4) THEN w.cluster END AS wide,
       CASE WHEN vec_id % 7 NOT IN (1, 2, 3, 4) THEN f.cluster END AS narrow
FROM nearest w JOIN nearest_of_few f USING (vec_id)""",
    "batch_of_all": _batch("", BOOK, 3),
    "batch_of_all_near": _batch("", EUCLIDEAN, 3),
    "batch_deep": _batch("WHERE nth = 1", EUCLIDEAN, 2000),
    "renamed_batch": f"""WITH {ASSIGNED},
kinds AS (SELECT *, CASE WHEN p_size <> 5 THEN p_type END AS kind FROM assigned),
seeds AS (
  SELECT kind AS seed_id, cluster AS seed_cluster, {_select(f"z{i} AS y{i}" for i in DIMS)}
  FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY p_name, p_brand, p_partkey) AS nth FROM kinds
        WHERE kind IS NOT NULL) WHERE nth = 1),
scored AS (
  SELECT seed_id, kind, p_name, p_brand, p_partkey, {EUCLIDEAN} AS distance
  FROM kinds JOIN seeds ON cluster = seed_cluster WHERE kind IS DISTINCT FROM seed_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id
    ORDER BY distance, kind NULLS FIRST, p_name, p_brand, p_partkey) AS INTEGER) AS rank FROM scored)
SELECT seed_id, rank, kind, p_partkey, round(distance, 6) AS distance FROM ranked WHERE rank <= 4""",
    "extract_limited": f"""WITH {_lines()},
cut AS (SELECT CAST(doc_id AS VARCHAR) AS path FROM lines ORDER BY CAST(doc_id AS VARCHAR), pos LIMIT 500)
SELECT 'ok' AS status, count(*) AS n_files, (SELECT count(*) FROM cut) AS n_records
FROM documents WHERE CAST(doc_id AS VARCHAR) <= (SELECT max(path) FROM cut)""",
    "clustered_text": f"""WITH {VALID}
SELECT concat_ws(',', p_partkey, p_brand, p_partkey, p_name, {_thousandths("quantity")}, 'x',
       {_thousandths("price")}, {_thousandths("discount")}, {_thousandths("tax")}, 'about 1990', '', '-0.50') AS line
FROM valid""",
    "recommend_json": f"""WITH {SEED}
SELECT seed_id AS song_id, true AS has_artist, 3 AS n_makers FROM seed""",
    "cluster_order": f"""WITH {_label_means()},
sizes AS (SELECT cluster FROM nearest GROUP BY cluster)
SELECT row_number() OVER (ORDER BY cluster) - 1 AS place, cluster FROM sizes""",
    "model_tables": f"""WITH {CENTERS},
center_rows AS ({_center_rows("centers")})
SELECT 'center' AS entry, cluster, pos, value FROM center_rows
UNION ALL """
    + "\nUNION ALL ".join(
        f"SELECT '{entry}', -1, {i}, round({letter}{i}, 6) FROM stats"
        for entry, letter in (("mean", "m"), ("std", "s"))
        for i in DIMS
    ),
    "clustered_scan": f"""WITH {SEED}
{_catalog_values("assigned, seed WHERE cluster = seed_cluster")}""",
    "clustered_csv_seed": f"""WITH {SEED}
{_catalog_values("assigned, seed WHERE cluster = seed_cluster")}""",
    "clustered_lookup": f"""WITH {ASSIGNED}
SELECT 'id' AS how, p_partkey, cluster FROM assigned WHERE p_partkey = {SEED_ID}
UNION ALL (SELECT 'title', p_partkey, cluster FROM assigned
  WHERE contains(lower(p_name), lower('{SEED_TITLE}')) ORDER BY p_partkey LIMIT 1)
UNION ALL (SELECT 'chance', p_partkey, cluster FROM assigned
  ORDER BY md5('{RANDOM_SEED}:' || p_partkey), p_partkey LIMIT 1)""",
    "clustered_csv_scan": f"WITH {ASSIGNED}\n{_catalog_values('assigned')}",
    "title_search": f"""SELECT p_partkey, p_name FROM part
WHERE contains(lower(p_name), lower('{SEED_TITLE}'))""",
    "find_by_title": f"""SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(lower(p_name), lower('{SEED_TITLE}')) ORDER BY p_partkey LIMIT 1""",
    "find_by_id": f"SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey = {SEED_ID}",
    "find_random": f"""SELECT p_partkey, p_name, p_brand FROM part
ORDER BY md5('{RANDOM_SEED}:' || p_partkey), p_partkey LIMIT 1""",
    "recommend_euclidean": _recommend(EUCLIDEAN),
    "recommend_book": _recommend(BOOK),
    "recommend_document": f"""WITH {_similar(EUCLIDEAN)}
SELECT seed_name AS name, seed_brand AS artist, seed_id AS song_id, seed_size AS year,
       seed_cluster AS cluster, 'euclidean' AS metric,
       (SELECT string_agg(p_partkey || ':' || printf('%.6f', round(distance, 6)), ';' ORDER BY rank)
        FROM ranked) AS similar
FROM seed""",
    "item_distances": f"""WITH {SEED}
SELECT p_partkey, round({EUCLIDEAN}, 6) AS euclidean, round({BOOK}, 6) AS book
FROM assigned, seed""",
    "candidate_counts": f"""WITH {SEED}
SELECT count(*) FILTER (WHERE cluster = seed_cluster AND p_partkey <> seed_id) AS n_candidates,
       count(*) AS n_total
FROM assigned, seed""",
    "recommend_batch": f"""WITH {ASSIGNED},
seeds AS (
  SELECT p_partkey AS seed_id, cluster AS seed_cluster, {
        _select(f"z{i} AS y{i}, c{i} AS b{i}" for i in DIMS)
    } FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY p_partkey) AS nth FROM assigned)
  WHERE nth = 1),
scored AS (
  SELECT seed_id, p_partkey, p_name, price, {BOOK} AS distance
  FROM assigned JOIN seeds ON cluster = seed_cluster WHERE p_partkey <> seed_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY distance, p_partkey) AS INTEGER)
    AS rank FROM scored)
SELECT seed_id, rank, p_partkey, p_name, round(price, 2) AS price, round(distance, 6) AS distance
FROM ranked WHERE rank <= {TOP}""",
    "nearest_embeddings": f"""WITH seeds AS (
  SELECT label AS seed_label, vec_id AS seed_id, embedding AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS nth FROM embeddings)
  WHERE nth = 1),
scored AS (
  SELECT label, seed_id, vec_id, sqrt({
        _sum(
            f"(embedding[{i + 1}]::DOUBLE - s[{i + 1}]::DOUBLE)"
            f" * (embedding[{i + 1}]::DOUBLE - s[{i + 1}]::DOUBLE)"
            for i in range(EMBEDDING_DIM)
        )
    }) AS distance
  FROM embeddings JOIN seeds ON label = seed_label WHERE vec_id <> seed_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY distance, vec_id) AS INTEGER)
    AS rank FROM scored)
SELECT label, seed_id, rank, vec_id, round(distance, 6) AS distance FROM ranked
WHERE rank <= {TOP}""",
}
