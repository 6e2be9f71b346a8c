"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

RATINGS = """
ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         CAST(max(ceil(l_quantity / 10)) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey
)"""

SPLIT = (
    RATINGS
    + """,
marked AS (
  SELECT *, substr(md5(concat("user", '-', item)), 1, 1) IN ('0', '1', '2')
         OR substr(md5(concat('user-', "user")), 1, 1) = '7'
         OR substr(md5(concat('item-', item)), 1, 1) = '3' AS in_test
  FROM ratings
),
train AS (SELECT "user", item, rating FROM marked WHERE NOT in_test),
test AS (SELECT "user", item, rating FROM marked WHERE in_test),
known AS (
  SELECT * FROM test
  WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)
)"""
)

USER_PAIRS = """
user_pairs AS (
  SELECT DISTINCT k."user", t."user" AS neighbour FROM known k JOIN train t ON k.item = t.item
)"""


def _similarity(name: str, entity: str, other: str, min_sim: float) -> str:
    return f"""
{name}_moments AS (
  SELECT x.{entity} AS a, y.{entity} AS b, count(*) AS n,
         sum(x.rating) AS sa, sum(y.rating) AS sb, sum(x.rating * y.rating) AS sab,
         sum(x.rating * x.rating) AS saa, sum(y.rating * y.rating) AS sbb
  FROM train x JOIN train y ON x.{other} = y.{other}
  GROUP BY x.{entity}, y.{entity}
  HAVING count(*) > 1
),
{name} AS (
  SELECT a, b, n AS n_common,
         abs(n * sab - sa * sb) / sqrt((n * saa - sa * sa) * (n * sbb - sb * sb)) AS similarity
  FROM {name}_moments
  WHERE n * saa > sa * sa AND n * sbb > sb * sb
    AND abs(n * sab - sa * sb) / sqrt((n * saa - sa * sa) * (n * sbb - sb * sb)) >= {min_sim}
)"""


ITEM_SIM = _similarity("item_sim", "item", '"user"', 0.01)
USER_SIM = _similarity("user_sim", '"user"', "item", 0.3)


def _item_neighbours(order: str) -> str:
    return f"""
item_nb AS (
  SELECT * FROM (
    SELECT t."user", t.item AS target, r.item, r.rating, s.similarity,
           row_number() OVER (PARTITION BY t."user", t.item ORDER BY round(s.similarity, 9) {order}, r.item) AS rank
    FROM test t JOIN train r ON t."user" = r."user"
    JOIN item_sim s ON s.a = t.item AND s.b = r.item
  ) WHERE rank <= 10
)"""


USER_NB = """
user_nb_all AS (
  SELECT k."user", k.item, r."user" AS neighbour, r.rating, s.similarity,
         row_number() OVER (PARTITION BY k."user", k.item ORDER BY round(s.similarity, 9), r."user") AS rank
  FROM known k JOIN train r ON k.item = r.item
  JOIN user_sim s ON s.a = k."user" AND s.b = r."user"
),
user_nb AS (SELECT * FROM user_nb_all WHERE rank <= 10)"""

USER_TOTALS = """
user_totals AS (
  SELECT "user", count(*) AS n, sum(rating) AS total, avg(rating) AS mean FROM train GROUP BY "user"
)"""

ITEM_PRED = f"""{SPLIT}, {USER_TOTALS}, {ITEM_SIM}, {_item_neighbours('ASC')},
item_weighed AS (
  SELECT "user", target AS item, sum(rating * similarity) / sum(abs(similarity)) AS p
  FROM item_nb GROUP BY "user", target
),
pred AS (
  SELECT t."user", t.item, coalesce(w.p, m.mean) AS prediction, m.mean AS user_mean
  FROM test t JOIN user_totals m ON t."user" = m."user"
  LEFT JOIN item_weighed w ON w."user" = t."user" AND w.item = t.item
)"""

USER_PRED = f"""{SPLIT}, {USER_TOTALS}, {USER_SIM}, {USER_NB},
user_weighed AS (
  SELECT b."user", b.item, count(*) AS nb,
         sum((b.rating - (m.total - b.rating) / (m.n - 1)) * b.similarity) / sum(b.similarity) AS shift
  FROM user_nb b JOIN user_totals m ON m."user" = b.neighbour
  GROUP BY b."user", b.item
),
pred AS (
  SELECT k."user", k.item,
         m.mean + CASE WHEN w.nb >= 5 THEN w.shift ELSE 0 END AS prediction, m.mean AS user_mean
  FROM known k JOIN user_totals m ON m."user" = k."user"
  LEFT JOIN user_weighed w ON w."user" = k."user" AND w.item = k.item
)"""

SCORED = """
scored AS (
  SELECT t."user", t.item, t.rating,
         coalesce(p.prediction, m.user_mean, 2.5) AS prediction,
         abs(coalesce(p.prediction, m.user_mean, 2.5) - t.rating) AS abs_err
  FROM test t LEFT JOIN pred p ON p."user" = t."user" AND p.item = t.item
  LEFT JOIN (SELECT DISTINCT "user", user_mean FROM pred) m ON m."user" = t."user"
)"""

HISTOGRAM = """
SELECT CASE WHEN e >= 0 AND e < 1 THEN '>= 0 and < 1' WHEN e >= 1 AND e < 2 THEN '>= 1 and < 2'
            WHEN e >= 2 AND e < 3 THEN '>= 2 and < 3' WHEN e >= 3 AND e < 4 THEN '>= 3 and < 4'
            ELSE '>= 4' END AS bucket, count(*) AS n
FROM (SELECT round(abs_err, 9) AS e FROM scored) GROUP BY bucket"""

RMSE = "SELECT count(*) AS n, round(sqrt(avg(abs_err * abs_err)), 6) AS rmse FROM scored"

SCORED_OUT = (
    'SELECT "user", item, rating, round(prediction, 6) AS prediction, round(abs_err, 6) AS abs_err FROM scored'
)

ORACLES["ratings_load"] = f"WITH {RATINGS} SELECT * FROM ratings"
ORACLES["ratings_csv"] = ORACLES["ratings_load"]
ORACLES["known_test_rows"] = (
    f'WITH {SPLIT} SELECT * FROM test WHERE "user" IN (SELECT "user" FROM train)'
)
ORACLES["user_histories"] = f"""
WITH {RATINGS},
sized AS (
  SELECT *, ('0x' || substr(md5(CAST(item AS VARCHAR)), 1, 7))::BIGINT
         % CAST(ceil(count(*) OVER (PARTITION BY "user") / 20.0) AS BIGINT) AS part
  FROM ratings
)
SELECT "user", part, count(*) AS n,
       string_agg(concat(item, ':', CAST(rating AS INTEGER)), ',' ORDER BY item) AS items
FROM sized GROUP BY "user", part"""
ORACLES["user_means"] = f"""
WITH {RATINGS}
SELECT "user", count(*) AS n, round(avg(rating), 6) AS mean FROM ratings GROUP BY "user" """
ORACLES["loo_user_mean"] = f"""
WITH {RATINGS}
SELECT "user", item,
       round((sum(rating) OVER w - rating) / nullif(count(*) OVER w - 1, 0), 6) AS loo_mean
FROM ratings WINDOW w AS (PARTITION BY "user")"""
ORACLES["item_pairs"] = f"""
WITH {SPLIT}
SELECT DISTINCT x.item AS a, y.item AS b FROM train x JOIN train y ON x."user" = y."user" """
ORACLES["user_pairs"] = f"WITH {SPLIT}, {USER_PAIRS} SELECT * FROM user_pairs"
ORACLES["item_similarity"] = f"""
WITH {SPLIT}, {ITEM_SIM} SELECT a, b, n_common, round(similarity, 6) AS similarity FROM item_sim"""
ORACLES["user_similarity"] = f"""
WITH {SPLIT}, {USER_PAIRS}, {USER_SIM}
SELECT a, b, n_common, round(similarity, 6) AS similarity
FROM user_sim s JOIN user_pairs p ON p."user" = s.a AND p.neighbour = s.b"""
for _name, _order in (("cf_item_neighbours", "ASC"), ("cf_item_neighbours_desc", "DESC")):
    ORACLES[_name] = f"""
WITH {SPLIT}, {ITEM_SIM}, {_item_neighbours(_order)}
SELECT "user", target, item, rank, rating, round(similarity, 6) AS similarity FROM item_nb"""
ORACLES["cf_user_neighbours"] = f"""
WITH {SPLIT}, {USER_SIM}, {USER_NB}
SELECT "user", item, neighbour, rank, rating, round(similarity, 6) AS similarity FROM user_nb"""
ORACLES["cf_item_predictions"] = (
    f'WITH {ITEM_PRED} SELECT "user", item, round(prediction, 6) AS prediction FROM pred'
)
ORACLES["cf_user_predictions"] = f"""
WITH {USER_PRED}
SELECT "user", item, round(prediction, 6) AS prediction, round(user_mean, 6) AS user_mean FROM pred"""
ORACLES["predictions_csv"] = f"""
WITH {ITEM_PRED}, {SCORED} SELECT "user", item, round(prediction, 6) AS prediction FROM scored"""
ORACLES["cf_item_scored"] = f"WITH {ITEM_PRED}, {SCORED} {SCORED_OUT}"
ORACLES["cf_user_scored"] = f"WITH {USER_PRED}, {SCORED} {SCORED_OUT}"
ORACLES["rating_error_histogram"] = f"WITH {ITEM_PRED}, {SCORED} {HISTOGRAM}"
ORACLES["rating_error_histogram_user"] = f"WITH {USER_PRED}, {SCORED} {HISTOGRAM}"
ORACLES["rating_rmse"] = f"WITH {ITEM_PRED}, {SCORED} {RMSE}"
ORACLES["rating_rmse_user"] = f"WITH {USER_PRED}, {SCORED} {RMSE}"


# --- frequent itemsets ---

BASKETS = """
baskets AS (
  SELECT DISTINCT l_orderkey AS basket, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def _levels(share: float) -> str:
    return f"""{BASKETS},
enough AS (SELECT {share} * count(DISTINCT basket) AS s FROM baskets),
k1 AS (
  SELECT item AS a, count(*) AS support FROM baskets GROUP BY item
  HAVING count(*) >= (SELECT s FROM enough)
),
k2 AS (
  SELECT x.item AS a, y.item AS b, count(*) AS support
  FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
  GROUP BY x.item, y.item HAVING count(*) >= (SELECT s FROM enough)
),
k3 AS (
  SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS support
  FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
  JOIN baskets z ON z.basket = y.basket AND y.item < z.item
  GROUP BY x.item, y.item, z.item HAVING count(*) >= (SELECT s FROM enough)
),
k4 AS (
  SELECT x.item AS a, y.item AS b, z.item AS c, w.item AS d, count(*) AS support
  FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item
  JOIN baskets z ON z.basket = y.basket AND y.item < z.item
  JOIN baskets w ON w.basket = z.basket AND z.item < w.item
  GROUP BY x.item, y.item, z.item, w.item HAVING count(*) >= (SELECT s FROM enough)
)"""


# No basket set given here has a frequent itemset of five items at this support.
ALL_ITEMSETS = f"""{_levels(0.005)},
every AS (
  SELECT 1 AS size, a AS items, support FROM k1
  UNION ALL SELECT 2, concat(a, ',', b), support FROM k2
  UNION ALL SELECT 3, concat(a, ',', b, ',', c), support FROM k3
  UNION ALL SELECT 4, concat(a, ',', b, ',', c, ',', d), support FROM k4
)"""

ORACLES["baskets_load"] = f"WITH {BASKETS} SELECT * FROM baskets"
ORACLES["baskets_csv"] = ORACLES["baskets_load"]
ORACLES["itemset_candidates_k2"] = f"""
WITH {_levels(0.025)}
SELECT concat(x.a, ',', y.a) AS items FROM k1 x JOIN k1 y ON x.a < y.a"""
ORACLES["itemset_candidates_k3"] = f"""
WITH {_levels(0.025)}
SELECT concat(x.a, ',', x.b, ',', y.b) AS items
FROM k2 x JOIN k2 y ON x.a = y.a AND x.b < y.b JOIN k2 z ON z.a = x.b AND z.b = y.b"""
ORACLES["frequent_itemsets_k1"] = f"WITH {_levels(0.005)} SELECT a AS items, support FROM k1"
ORACLES["frequent_itemsets_k2"] = (
    f"WITH {_levels(0.025)} SELECT concat(a, ',', b) AS items, support FROM k2"
)
ORACLES["frequent_itemsets_k3"] = (
    f"WITH {_levels(0.005)} SELECT concat(a, ',', b, ',', c) AS items, support FROM k3"
)
ORACLES["frequent_itemsets_all"] = f"WITH {ALL_ITEMSETS} SELECT size, items, support FROM every"
ORACLES["son_frequent_itemsets"] = ORACLES["frequent_itemsets_all"]
ORACLES["itemset_report"] = f"""
WITH {ALL_ITEMSETS},
placed AS (
  SELECT size, items, row_number() OVER (PARTITION BY size ORDER BY string_split(items, ',')) - 1 AS p FROM every
)
SELECT size, p // 100 AS line_no,
       string_agg(concat('(', items, ')'), ',' ORDER BY string_split(items, ',')) AS line
FROM placed GROUP BY size, p // 100"""


# --- text features ---

TEXT = """
split AS (
  SELECT doc_id, CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []
                      ELSE string_split(rtrim(text, ' '), ' ') END AS tokens
  FROM documents
),
occurrences AS (SELECT doc_id, len(tokens) AS size, unnest(tokens) AS term FROM split),
counts AS (SELECT doc_id, size, term, count(*) AS n FROM occurrences GROUP BY doc_id, size, term),
idf AS (
  SELECT term, count(*) AS df, 1 + ln((SELECT count(*) FROM documents) / count(*)) AS idf
  FROM counts GROUP BY term
),
tfidf AS (SELECT doc_id, c.term, n / size * idf AS weight FROM counts c JOIN idf i ON i.term = c.term)"""

ORACLES["term_counts"] = f"WITH {TEXT} SELECT doc_id, term, n FROM counts"
ORACLES["term_frequency"] = f"WITH {TEXT} SELECT doc_id, term, round(n / size, 9) AS tf FROM counts"
ORACLES["idf"] = f"WITH {TEXT} SELECT term, df, round(idf, 6) AS idf FROM idf"
ORACLES["tfidf"] = f"WITH {TEXT} SELECT doc_id, term, round(weight, 9) AS weight FROM tfidf"
ORACLES["vocabulary"] = f"""
WITH {TEXT} SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM idf"""

# --- clustering ---


def _vectors(feature: str) -> str:
    weight = {"T": "SELECT doc_id, term, weight FROM tfidf", "W": "SELECT doc_id, term, CAST(n AS DOUBLE) AS weight FROM counts"}
    return f"""{TEXT},
vec AS MATERIALIZED ({weight[feature]}),
norms AS (SELECT doc_id, sum(weight * weight) AS s FROM vec GROUP BY doc_id),
start AS (
  SELECT CAST(row_number() OVER (ORDER BY p, doc_id) - 1 AS INTEGER) AS cluster, doc_id
  FROM (SELECT doc_id, md5(concat('42-', doc_id)) AS p FROM documents ORDER BY p, doc_id LIMIT 5)
),
c1 AS MATERIALIZED (SELECT cluster, term, weight FROM vec JOIN start USING (doc_id))"""


def _round(i: int) -> str:
    return f"""
dots{i} AS (
  SELECT doc_id, cluster, sum(v.weight * c.weight) AS dot FROM vec v JOIN c{i} c ON c.term = v.term
  GROUP BY doc_id, cluster
),
products{i} AS (
  SELECT d.doc_id, CAST(g.cluster AS INTEGER) AS cluster, coalesce(t.dot, 0) AS dot,
         coalesce(n.s, 0) AS doc_norm, coalesce(m.s, 0) AS cluster_norm
  FROM documents d CROSS JOIN range(5) g(cluster)
  LEFT JOIN dots{i} t ON t.doc_id = d.doc_id AND t.cluster = g.cluster
  LEFT JOIN norms n ON n.doc_id = d.doc_id
  LEFT JOIN (SELECT cluster, sum(weight * weight) AS s FROM c{i} GROUP BY cluster) m ON m.cluster = g.cluster
),
dist{i} AS (
  SELECT doc_id, cluster, greatest(round(doc_norm + cluster_norm - 2 * dot, 9), 0) AS sqdist FROM products{i}
),
assign{i} AS MATERIALIZED (
  SELECT doc_id, cluster, sqdist, sqrt(sqdist) AS distance FROM dist{i}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(sqrt(sqdist), 9), cluster) = 1
),
sizes{i} AS (SELECT cluster, count(*) AS size FROM assign{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT a.cluster, v.term, sum(v.weight) / any_value(s.size) AS weight
  FROM vec v JOIN assign{i} a USING (doc_id) JOIN sizes{i} s ON s.cluster = a.cluster
  GROUP BY a.cluster, v.term
  UNION ALL SELECT * FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM sizes{i})
)"""


ROUND1 = f"{_vectors('T')}, {_round(1)}"
ROUND2 = f"{ROUND1}, {_round(2)}"


def _sse(members: str) -> str:
    return f"""
sse AS (
  SELECT CAST(g.cluster AS INTEGER) AS cluster, count(a.doc_id) AS size, coalesce(sum(a.sqdist), 0) AS error
  FROM range(5) g(cluster) LEFT JOIN {members} a ON a.cluster = g.cluster GROUP BY g.cluster
)"""


def _top_terms(members: str) -> str:
    return f"""
top_terms AS (
  SELECT cluster, term, count(*) AS n_docs,
         row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, term) AS rank
  FROM vec JOIN {members} USING (doc_id) GROUP BY cluster, term
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, term) <= 10
)"""


SSE = _sse("assign2")
TERMS = _top_terms("assign2")
REPORT = """
SELECT s.cluster, s.size, round(s.error, 6) AS error,
       coalesce(string_agg(t.term, ',' ORDER BY t.rank), '') AS terms
FROM sse s LEFT JOIN top_terms t ON t.cluster = s.cluster GROUP BY s.cluster, s.size, s.error"""

ORACLES["doc_centroid_distance"] = f"""
WITH {ROUND1} SELECT doc_id, cluster, round(sqrt(sqdist), 6) AS distance FROM dist1"""
ORACLES["doc_cosine_similarity"] = f"""
WITH {ROUND1}
SELECT doc_id, cluster, round(dot / nullif(sqrt(doc_norm) * sqrt(cluster_norm), 0), 6) AS similarity
FROM products1"""
ORACLES["kmeans_init"] = f"WITH {ROUND1} SELECT cluster, doc_id FROM start"
ORACLES["kmeans_assign"] = f"""
WITH {ROUND1} SELECT doc_id, cluster, round(distance, 6) AS distance FROM assign1"""
ORACLES["kmeans_update"] = f"WITH {ROUND1} SELECT cluster, term, round(weight, 9) AS weight FROM c2"
ORACLES["kmeans_shift"] = f"""
WITH {ROUND1}
SELECT cluster, round(sum(d), 6) AS l1 FROM (
  SELECT cluster, term, abs(sum(w)) AS d FROM (
    SELECT cluster, term, -weight AS w FROM c1 UNION ALL SELECT cluster, term, weight FROM c2
  ) GROUP BY cluster, term
) GROUP BY cluster"""
ORACLES["kmeans_iter1"] = f"WITH {ROUND1} SELECT doc_id, cluster FROM assign1"
ORACLES["kmeans_iter2"] = f"WITH {ROUND2} SELECT doc_id, cluster FROM assign2"
ORACLES["kmeans_iter2_counts"] = f"""
WITH {_vectors('W')}, {_round(1)}, {_round(2)} SELECT doc_id, cluster FROM assign2"""
ORACLES["kmeans_sse"] = f"WITH {ROUND2}, {SSE} SELECT cluster, size, round(error, 6) AS error FROM sse"
ORACLES["kmeans_wsse"] = f"WITH {ROUND2} SELECT count(*) AS n, round(sum(sqdist), 6) AS wsse FROM assign2"
ORACLES["cluster_sizes"] = f"WITH {ROUND2}, {SSE} SELECT cluster, size FROM sse"
ORACLES["cluster_terms"] = f"WITH {ROUND2}, {TERMS} SELECT cluster, rank, term, n_docs FROM top_terms"
ORACLES["cluster_report"] = f"WITH {ROUND2}, {SSE}, {TERMS} {REPORT}"

# ten updates: eleven assignments
ORACLES["ml_kmeans_text"] = f"""
WITH {_vectors('T')}, {','.join(_round(i) for i in range(1, 12))},
{_sse('assign11')}, {_top_terms('assign11')} {REPORT}"""


def _half_round(level: int, i: int) -> str:
    """One assignment of the documents of cut leaves to clusters 2 * leaf and 2 * leaf + 1, and the new means."""
    at = f"{level}_{i}"
    return f"""
hd{at} AS (
  SELECT p.doc_id, h.cluster, sum(p.weight * h.weight) AS dot
  FROM part{level} p JOIN h{at} h ON h.cluster // 2 = p.leaf AND h.term = p.term GROUP BY p.doc_id, h.cluster
),
hn{at} AS (SELECT cluster, sum(weight * weight) AS s FROM h{at} GROUP BY cluster),
ha{at} AS MATERIALIZED (
  SELECT d.doc_id, 2 * d.leaf + g.side AS cluster
  FROM cut{level} d CROSS JOIN range(2) g(side)
  LEFT JOIN norms n ON n.doc_id = d.doc_id
  LEFT JOIN hd{at} t ON t.doc_id = d.doc_id AND t.cluster = 2 * d.leaf + g.side
  LEFT JOIN hn{at} m ON m.cluster = 2 * d.leaf + g.side
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY
    round(sqrt(greatest(round(coalesce(n.s, 0) + coalesce(m.s, 0) - 2 * coalesce(t.dot, 0), 9), 0)), 9), g.side) = 1
),
hs{at} AS (SELECT cluster, count(*) AS size FROM ha{at} GROUP BY cluster),
h{level}_{i + 1} AS MATERIALIZED (
  SELECT a.cluster, v.term, sum(v.weight) / any_value(s.size) AS weight
  FROM vec v JOIN ha{at} a USING (doc_id) JOIN hs{at} s ON s.cluster = a.cluster GROUP BY a.cluster, v.term
  UNION ALL SELECT * FROM h{at} WHERE cluster NOT IN (SELECT cluster FROM hs{at})
)"""


def _level(level: int, iters: int = 10) -> str:
    """One level of cuts: from leaves{level} and whole{level}, the leaves not to be cut again, to the next ones."""
    rounds = ",".join(_half_round(level, i) for i in range(1, iters + 2))
    return f"""
chosen{level} AS (
  SELECT leaf FROM leaves{level} WHERE leaf NOT IN (SELECT leaf FROM whole{level})
  GROUP BY leaf HAVING count(*) > 1
  QUALIFY row_number() OVER (ORDER BY count(*) DESC, leaf) <= 5 - (SELECT count(DISTINCT leaf) FROM leaves{level})
),
cut{level} AS MATERIALIZED (SELECT doc_id, leaf FROM leaves{level} JOIN chosen{level} USING (leaf)),
part{level} AS MATERIALIZED (SELECT doc_id, leaf, term, weight FROM vec JOIN cut{level} USING (doc_id)),
first{level} AS (
  SELECT doc_id, 2 * leaf + row_number() OVER by_hash - 1 AS cluster FROM cut{level}
  WINDOW by_hash AS (PARTITION BY leaf ORDER BY md5(concat('42-', doc_id)), doc_id)
  QUALIFY row_number() OVER by_hash <= 2
),
h{level}_1 AS MATERIALIZED (SELECT cluster, term, weight FROM vec JOIN first{level} USING (doc_id)),
{rounds},
upper{level} AS (
  SELECT cluster // 2 AS leaf,
         (SELECT count(DISTINCT leaf) FROM leaves{level}) + row_number() OVER (ORDER BY cluster // 2) - 1 AS new
  FROM ha{level}_{iters + 1} GROUP BY cluster // 2 HAVING count(DISTINCT cluster) = 2
),
leaves{level + 1} AS MATERIALIZED (
  SELECT l.doc_id, CASE WHEN a.cluster % 2 = 1 THEN coalesce(u.new, l.leaf) ELSE l.leaf END AS leaf
  FROM leaves{level} l LEFT JOIN ha{level}_{iters + 1} a ON a.doc_id = l.doc_id
  LEFT JOIN upper{level} u ON u.leaf = l.leaf
),
whole{level + 1} AS (
  SELECT leaf FROM whole{level}
  UNION ALL SELECT leaf FROM chosen{level} WHERE leaf NOT IN (SELECT leaf FROM upper{level})
)"""


# five leaves need three levels of cuts, and more where leaves stay whole; a level with nothing to cut changes nothing
LEVELS = 6
ORACLES["ml_bisecting_kmeans_text"] = f"""
WITH {_vectors('T')},
leaves1 AS (SELECT doc_id, CAST(0 AS BIGINT) AS leaf FROM documents),
whole1 AS (SELECT leaf FROM leaves1 WHERE false),
{','.join(_level(i) for i in range(1, LEVELS + 1))},
leaf_sizes AS (SELECT leaf, count(*) AS size FROM leaves{LEVELS + 1} GROUP BY leaf),
means AS (
  SELECT l.leaf, v.term, sum(v.weight) / any_value(s.size) AS weight
  FROM vec v JOIN leaves{LEVELS + 1} l USING (doc_id) JOIN leaf_sizes s ON s.leaf = l.leaf GROUP BY l.leaf, v.term
),
mean_norms AS (SELECT leaf, sum(weight * weight) AS s FROM means GROUP BY leaf),
mean_dots AS (
  SELECT v.doc_id, sum(v.weight * m.weight) AS dot
  FROM vec v JOIN leaves{LEVELS + 1} l ON l.doc_id = v.doc_id JOIN means m ON m.leaf = l.leaf AND m.term = v.term
  GROUP BY v.doc_id
),
members AS (
  SELECT l.doc_id, CAST(l.leaf AS INTEGER) AS cluster,
         greatest(round(coalesce(n.s, 0) + coalesce(m.s, 0) - 2 * coalesce(d.dot, 0), 9), 0) AS sqdist
  FROM leaves{LEVELS + 1} l LEFT JOIN norms n ON n.doc_id = l.doc_id LEFT JOIN mean_norms m ON m.leaf = l.leaf
  LEFT JOIN mean_dots d ON d.doc_id = l.doc_id
),
{_sse('members')}, {_top_terms('members')} {REPORT}"""


# --- samples and streams ---

STATUS = """
tagged AS (
  SELECT event_id, ts, user_id, event_type,
         concat('#', event_type, regexp_extract(props, '[0-9]+', 0)) AS tag FROM events
),
status AS (
  SELECT event_id, concat('u', user_id, ' ', tag, ' #', event_type) AS text FROM tagged
),
sample AS (
  SELECT event_id, text FROM status ORDER BY md5(concat('42-', event_id)), event_id LIMIT 100
)"""


def _tags(source: str) -> str:
    return f"""{STATUS},
tag_counts AS (
  SELECT replace(replace(token, chr(10), ''), ',', '') AS tag, count(*) AS n
  FROM (SELECT unnest(string_split(text, ' ')) AS token FROM {source})
  WHERE starts_with(token, '#') GROUP BY ALL
),
top_tags AS (
  SELECT row_number() OVER (ORDER BY n DESC, tag) AS rank, tag, n FROM tag_counts
  QUALIFY row_number() OVER (ORDER BY n DESC, tag) <= 5
)"""


def _bloom(width: int, num_hash: int) -> str:
    return f"""{STATUS},
seen AS (
  SELECT tag, min(seq) AS first_seq, count(*) AS n
  FROM (SELECT tag, row_number() OVER (ORDER BY ts, event_id) AS seq FROM tagged) GROUP BY tag
),
hits AS (
  SELECT tag, first_seq, n, ('0x' || substr(md5(concat(i, ':', tag)), 1, 15))::BIGINT % {width} AS bit
  FROM seen CROSS JOIN range({num_hash}) h(i)
),
first_hits AS (SELECT bit, min(first_seq) AS set_at FROM hits GROUP BY bit),
flags AS (
  SELECT tag, first_seq, n, max(set_at) < first_seq AS is_false_positive
  FROM hits JOIN first_hits USING (bit) GROUP BY tag, first_seq, n
),
quality AS (
  SELECT CAST(sum(n) AS BIGINT) AS total,
         CAST(coalesce(sum(n) FILTER (is_false_positive), 0) AS BIGINT) AS fp,
         count(*) FILTER (NOT is_false_positive) AS tn FROM flags
)"""


QUALITY_OUT = """
SELECT total, total - fp AS correct, fp AS incorrect, fp, tn, round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS fpr
FROM quality"""

ORACLES["hashtag_counts"] = f"WITH {_tags('status')} SELECT tag, n FROM tag_counts"
ORACLES["top_hashtags"] = f"WITH {_tags('status')} SELECT rank, tag, n FROM top_tags"
ORACLES["reservoir_batch"] = f"WITH {STATUS} SELECT event_id, text FROM sample"
ORACLES["sample_mean_length"] = f"""
WITH {STATUS} SELECT count(*) AS n, round(avg(length(text)), 6) AS mean_length FROM sample"""
ORACLES["sample_top_hashtags"] = f"WITH {_tags('sample')} SELECT rank, tag, n FROM top_tags"
ORACLES["bloom_flags"] = f"WITH {_bloom(4096, 6)} SELECT * FROM flags"
ORACLES["bloom_quality"] = f"WITH {_bloom(4096, 6)} {QUALITY_OUT}"
ORACLES["bloom_membership"] = f"""
WITH {_bloom(4096, 6)},
held AS (SELECT DISTINCT bit FROM hits WHERE n > (SELECT avg(n) FROM seen))
SELECT tag, bool_and(bit IN (SELECT bit FROM held)) AS maybe_seen FROM hits GROUP BY tag
"""
ORACLES["bloom_quality_one_hash"] = f"WITH {_bloom(2048, 1)} {QUALITY_OUT}"
ORACLES["stream_reservoir"] = ORACLES["reservoir_batch"]
ORACLES["stream_reservoir_report"] = f"""
WITH {_tags('sample')}
SELECT (SELECT count(*) FROM events) AS seen, count(*) AS sample_size,
       round(avg(length(text)), 6) AS mean_length,
       (SELECT string_agg(tag, ',' ORDER BY rank) FROM top_tags) AS top_tags
FROM sample"""
ORACLES["stream_bloom"] = ORACLES["bloom_quality"]

# --- files read back, other routes to the same rows, and invariants of fitted models ---

ORACLES["corpus_lines"] = """
SELECT regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g') AS text, count(*) AS n, count(*) AS n_ids
FROM documents GROUP BY 1"""
ORACLES["itemset_report_file"] = f"""
WITH report AS ({ORACLES["itemset_report"]})
SELECT line FROM report UNION ALL SELECT '' FROM (SELECT DISTINCT size FROM report)"""
ORACLES["cluster_report_file"] = f"""
WITH report AS ({ORACLES["cluster_report"]}), total AS ({ORACLES["kmeans_wsse"]})
SELECT 'K-Means' AS algorithm, wsse, cluster AS id, size, error, terms FROM report CROSS JOIN total"""
ORACLES["cf_item_scored_heavy"] = ORACLES["cf_item_scored"]
ORACLES["cf_user_scored_heavy"] = ORACLES["cf_user_scored"]
ORACLES["frequent_itemsets_heavy"] = ORACLES["frequent_itemsets_all"]
ORACLES["als_rows"] = f"""WITH {SPLIT} SELECT "user", item, rating FROM known"""


def _half_step(name: str, entity: str, other: str, start: str) -> str:
    """Three factors per entity by Cramer's rule, with 0.3 times the ratings on the diagonal."""
    cells = [(i, j) for i in range(3) for j in range(i, 3)]
    sums = ", ".join(f"sum(f{i} * f{j}) + {0.3 if i == j else 0.0} * count(*) AS a{i}{j}" for i, j in cells)
    right = ", ".join(f"sum(rating * f{i}) AS b{i}" for i in range(3))

    def det(column: int | None) -> str:
        a = [[f"a{min(i, j)}{max(i, j)}" if j != column else f"b{i}" for j in range(3)] for i in range(3)]
        minor = lambda x, y: f"({a[1][x]} * {a[2][y]} - {a[1][y]} * {a[2][x]})"
        return f"({a[0][0]} * {minor(1, 2)} - {a[0][1]} * {minor(0, 2)} + {a[0][2]} * {minor(0, 1)})"

    solved = ", ".join(f"{det(i)} / {det(None)} AS f{i}" for i in range(3))
    return f"""
{name}_sums AS (SELECT {entity}, count(*) AS n, {sums}, {right} FROM train JOIN {start} USING ({other}) GROUP BY {entity}),
{name} AS MATERIALIZED (SELECT {entity}, n, {solved} FROM {name}_sums)"""


ITEM_START = """
item_start AS MATERIALIZED (SELECT item, """ + ", ".join(
    f"CAST('0x' || substr(md5(concat('42-{i}-', item)), 1, 8) AS BIGINT) / 4294967296.0 AS f{i}" for i in range(3)
) + " FROM (SELECT DISTINCT item FROM train))"
USER_STEP = f"""{SPLIT}, {ITEM_START}, {_half_step("user_step", '"user"', "item", "item_start")}"""
ORACLES["als_half_step"] = f"""WITH {USER_STEP}
SELECT "user", n, round(f0, 6) AS f0, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM user_step"""
ORACLES["als_round"] = f"""WITH {USER_STEP}, {_half_step("item_step", "item", '"user"', "user_step")}
SELECT item, n, round(f0, 6) AS f0, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM item_step"""
ORACLES["als_fitted"] = f"""WITH {SPLIT}
SELECT count(DISTINCT "user") AS n_users, CAST(0 AS BIGINT) AS n_off FROM train"""
PROJECTED = f"""{TEXT},
dims AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS dim),
projected AS MATERIALIZED (
  SELECT d.doc_id, dim, coalesce(value, 0.0) AS value
  FROM documents d CROSS JOIN dims LEFT JOIN (
    SELECT doc_id, dim,
           sum(CASE WHEN substr(md5('42-0-' || term), dim + 1, 1) >= '8' THEN weight ELSE -weight END) / 4.0 AS value
    FROM tfidf CROSS JOIN dims GROUP BY doc_id, dim
  ) USING (doc_id, dim)
)"""
ORACLES["text_projection"] = f"WITH {PROJECTED} SELECT doc_id, dim, round(value, 6) + 0.0 AS value FROM projected"
ORACLES["ml_gmm_text_moments"] = f"""WITH {PROJECTED}
SELECT a.dim AS i, b.dim AS j, round(avg(a.value), 6) + 0.0 AS mean, round(avg(a.value * b.value), 6) + 0.0 AS moment
FROM projected a JOIN projected b USING (doc_id) GROUP BY a.dim, b.dim"""
ORACLES["ml_kmeans_totals"] = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad FROM embeddings"
ORACLES["ml_bisecting_kmeans_totals"] = ORACLES["ml_kmeans_totals"]
ORACLES["ml_gmm_moments"] = """
WITH places AS (SELECT CAST(unnest(range(max(len(embedding)))) AS INTEGER) AS p FROM embeddings)
SELECT a.p AS i, b.p AS j, round(avg(CAST(embedding[a.p + 1] AS DOUBLE)), 6) + 0.0 AS mean,
       round(avg(CAST(embedding[a.p + 1] AS DOUBLE) * CAST(embedding[b.p + 1] AS DOUBLE)), 6) + 0.0 AS moment
FROM embeddings CROSS JOIN places a CROSS JOIN places b GROUP BY a.p, b.p"""
ORACLES["stream_reservoir_batches"] = ORACLES["stream_reservoir"]
ORACLES["stream_bloom_batches"] = ORACLES["stream_bloom"]
