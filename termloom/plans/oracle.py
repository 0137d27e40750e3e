"""DuckDB SQL giving the same results as the registered queries on the same tables."""

from __future__ import annotations

from termloom.functions import text as X
from termloom.functions.hashing import MAX_HASH, PRIME, permutations
from termloom.operators.similarity import STUDY_SLOTS
from termloom.sources.html import ENTITIES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _refs(repl: str) -> str:
    return repl.replace("$", "\\")


def _spaced() -> str:
    sql = "' ' || lower(text) || ' '"
    for pattern, repl in X.TOKEN_RULES:
        sql = f"regexp_replace({sql}, {_q(pattern)}, {_q(_refs(repl))}, 'g')"
    for fused, parts in X.FUSED_WORDS * 2:
        sql = f"replace({sql}, {_q(fused)}, {_q(parts)})"
    return sql


STOP = ", ".join(_q(w) for w in X.STOP_WORDS)
ALNUM = f"regexp_matches(token, {_q(X.HAS_ALNUM)})"
TOK = f"""split_docs AS (
  SELECT doc_id, regexp_split_to_array({_spaced()}, {_q(X.SPACE)}) AS ts FROM documents),
tok AS (
  SELECT doc_id, CAST(i - 2 AS INTEGER) AS pos, token FROM (
    SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS i FROM split_docs)
  WHERE token <> '')"""
BAGS = TOK + f""",
words AS (SELECT doc_id, token AS term FROM tok WHERE {ALNUM} AND token NOT IN ({STOP})),
lens AS (SELECT doc_id, count(*) AS num_words FROM words GROUP BY doc_id),
wc AS (SELECT doc_id, term, count(*) AS cnt FROM words GROUP BY doc_id, term HAVING count(*) >= 2),
dfs AS (SELECT term, count(*) AS df FROM wc GROUP BY term),
n AS (SELECT count(*) AS n_docs FROM documents)"""
TFIDF = BAGS + """,
tfidf AS (
  SELECT doc_id, term, cnt / num_words * ln(n_docs / df) AS tfidf
  FROM wc JOIN lens USING (doc_id) JOIN dfs USING (term), n)"""
STATS = """
stats AS (
  SELECT d.doc_id, coalesce(k.c, 0) AS n_terms, coalesce(num_words, 0) AS num_words,
         coalesce(k.c / nullif(num_words, 0), 0.0) AS diversity
  FROM documents d LEFT JOIN lens USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS c FROM wc GROUP BY doc_id) k USING (doc_id))"""
MATRIX = TFIDF + "," + STATS + """,
matrix AS (
  SELECT doc_id, term AS feature, tfidf AS value FROM tfidf
  UNION ALL SELECT doc_id, '__diversity', diversity FROM stats
  UNION ALL SELECT doc_id, '__num_words', CAST(num_words AS DOUBLE) FROM stats)"""
SCALED = MATRIX + """,
norms AS (SELECT feature, sqrt(sum(value * value)) AS norm FROM matrix GROUP BY feature),
scaled AS (
  SELECT doc_id, feature, CASE WHEN norm > 0 THEN value / norm ELSE value END AS value
  FROM matrix JOIN norms USING (feature))"""

VEC = """cells AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
cnorm AS (SELECT pos, sqrt(sum(v * v)) AS norm FROM cells GROUP BY pos),
nv AS (
  SELECT vec_id, label, pos, CASE WHEN norm > 0 THEN v / norm ELSE v END AS value
  FROM cells JOIN cnorm USING (pos)),
vec AS (SELECT vec_id, any_value(label) AS label, list(value ORDER BY pos) AS x FROM nv GROUP BY vec_id)"""


def _distance(a: str, b: str, metric: str) -> str:
    if metric == "euclidean":
        return f"list_distance({a}, {b})"
    return f"1.0 - list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


def _pairs(metric: str) -> str:
    return VEC + f""",
pairs AS (
  SELECT a.vec_id AS i, b.vec_id AS j, {_distance('a.x', 'b.x', metric)} AS d
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id)"""


def _profile(metric: str) -> str:
    return f"""WITH {_pairs(metric)}
SELECT i AS vec_id, count(*) AS n_others, round(avg(d), 6) + 0.0 AS mean_d,
       round(min(d), 6) + 0.0 AS min_d, round(max(d), 6) + 0.0 AS max_d FROM pairs GROUP BY i"""


def _dbscan(pairs: str, ids: str, eps: float, m: int) -> str:
    """Ends with relation db (id, cluster, is_core). Needs pairs (i, j, d), i <> j."""
    return f"""{pairs},
near AS (SELECT i, j FROM pairs WHERE d <= {eps}),
cnt AS (SELECT p.id, 1 + count(near.j) AS n FROM ({ids}) p LEFT JOIN near ON near.i = p.id GROUP BY p.id),
core AS (SELECT id FROM cnt WHERE n >= {m}),
links AS (SELECT i, j FROM near WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)),
reach(id, root) AS (
  SELECT id, id FROM core
  UNION SELECT links.j, reach.root FROM reach JOIN links ON links.i = reach.id),
comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
num AS (SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT root FROM comp)),
cc AS (SELECT id, cluster FROM comp JOIN num USING (root)),
border AS (
  SELECT near.i AS id, min(cc.cluster) AS cluster FROM near JOIN cc ON cc.id = near.j
  WHERE near.i NOT IN (SELECT id FROM core) GROUP BY near.i),
db AS (
  SELECT cnt.id, coalesce(cc.cluster, border.cluster, -1) AS cluster, CAST(cnt.n >= {m} AS INTEGER) AS is_core
  FROM cnt LEFT JOIN cc USING (id) LEFT JOIN border USING (id))"""


def _apart(x: str, y: str, metric: str) -> str:
    """Distance of two means; 1 for cosine where one is zero."""
    if metric == "euclidean":
        return f"list_distance({x}, {y})"
    return f"(1.0 - coalesce(list_dot_product({x}, {y}) / nullif(sqrt(list_dot_product({x}, {x})) * sqrt(list_dot_product({y}, {y})), 0), 0))"


def _lloyd(start: str, metric: str) -> str:
    """Relation ll (trial, it, c, m, moved): the means of all rounds until they rest, from a
    relation (trial, c, x). A round adds its means and divides by one row more."""
    new = "list_transform(ll.m, lambda v, i: (v + coalesce(s.s[i], 0)) / (1 + coalesce(s.n, 0)))"
    return f"""ll(trial, it, c, m, moved) AS (
  SELECT trial, 0, c, x, CAST(1e300 AS DOUBLE) FROM ({start})
  UNION ALL
  SELECT trial, it, c, m, sum(d) OVER (PARTITION BY trial) FROM (
    SELECT ll.trial, ll.it + 1 AS it, ll.c, {new} AS m, {_apart('ll.m', new, metric)} AS d
    FROM ll LEFT JOIN (
      SELECT trial, c, list(s ORDER BY pos) AS s, any_value(n) AS n FROM (
        SELECT trial, c, pos, sum(x[pos]) AS s, count(*) AS n FROM (
          SELECT trial, vec_id, any_value(x) AS x, arg_min(c, (d, c)) AS c FROM (
            SELECT ll.trial, vec_id, x, ll.c, {_apart('x', 'll.m', metric)} AS d FROM ll, vec WHERE ll.moved >= 1e-6) GROUP BY trial, vec_id),
          (SELECT unnest(range(1, 65)) AS pos) GROUP BY trial, c, pos) GROUP BY trial, c) s ON s.trial = ll.trial AND s.c = ll.c
    WHERE ll.moved >= 1e-6))"""


def _assigned(means: str, metric: str) -> str:
    return f"""asg AS (
  SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT vec_id, cluster, {_apart('vec.x', 'm', metric)} AS d FROM vec, {means}) GROUP BY vec_id)"""


KM = VEC + ",\n" + _lloyd(
    "SELECT 1 AS trial, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS c, x FROM vec ORDER BY vec_id LIMIT 25", "euclidean"
) + """,
final AS (SELECT c AS cluster, m FROM ll WHERE it = (SELECT max(it) FROM ll)),
""" + _assigned("final", "euclidean") + """,
cl AS (SELECT asg.vec_id, asg.cluster, vec.label, vec.x FROM asg JOIN vec USING (vec_id))"""


def _fit(metric: str, k: int = 25) -> str:
    """Three trials, starting in the order of a digest; the one nearest to the others."""
    start = f"""SELECT * FROM (
    SELECT t AS trial, x, CAST(row_number() OVER (PARTITION BY t ORDER BY md5(t || ':' || vec_id), vec_id) - 1 AS INTEGER) AS c
    FROM vec, (SELECT unnest([1, 2, 3]) AS t)) WHERE c < {k}"""
    cost = "sum(d * d)" if metric == "euclidean" else "sum(d)"
    return f"""WITH RECURSIVE {VEC},
{_lloyd(start, metric)},
ends AS (
  SELECT trial, it, moved, m, CAST(row_number() OVER (PARTITION BY trial ORDER BY list_sum(m), c) - 1 AS INTEGER) AS cluster
  FROM ll WHERE (trial, it) IN (SELECT (trial, max(it)) FROM ll GROUP BY trial)),
pick AS (
  SELECT trial FROM (
    SELECT a.trial, sum({_apart('a.m', 'b.m', metric)}) AS d FROM ends a JOIN ends b ON a.cluster = b.cluster AND a.trial <> b.trial GROUP BY a.trial)
  ORDER BY d, trial LIMIT 1),
final AS (SELECT cluster, m, it, moved FROM ends WHERE trial = (SELECT trial FROM pick)),
{_assigned('final', metric)}
SELECT cluster, CAST(any_value(it) AS INTEGER) AS n_iter, any_value(moved) < 1e-6 AS converged, count(*) AS n, round({cost}, 6) + 0.0 AS cost
FROM asg JOIN final USING (cluster) GROUP BY cluster"""


def _report(cl: str) -> str:
    """Relations ent and var over a relation with (vec_id, cluster, label)."""
    return f"""
lab AS (SELECT cluster, coalesce(CAST(label AS VARCHAR), 'unknown label') AS label, count(*) AS n FROM {cl} GROUP BY ALL),
tot AS (SELECT cluster, count(*) AS n FROM {cl} GROUP BY cluster),
ent AS (
  SELECT cluster, -sum(lab.n / tot.n * ln(lab.n / tot.n)) AS entropy FROM lab JOIN tot USING (cluster) GROUP BY cluster),
var AS (
  SELECT cluster, CASE WHEN any_value(tot.n) < 2 THEN 0.0 ELSE var_pop(value) END AS variance
  FROM nv JOIN {cl} USING (vec_id) JOIN tot USING (cluster) GROUP BY cluster)"""


def _silhouette(cl: str) -> str:
    """Relation sil over a relation with (vec_id, cluster, x)."""
    return f"""
size AS (SELECT cluster, count(*) AS n FROM {cl} GROUP BY cluster),
tosum AS (
  SELECT a.vec_id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.x, b.x)) AS s
  FROM {cl} a, {cl} b GROUP BY ALL),
ab AS (
  SELECT vec_id, any_value(o.n) AS own_n,
         max(CASE WHEN own = other THEN s / nullif(o.n - 1, 0) END) AS a,
         min(CASE WHEN own <> other THEN s / z.n END) AS b
  FROM tosum JOIN size o ON o.cluster = own JOIN size z ON z.cluster = other GROUP BY vec_id),
sil AS (SELECT avg(CASE WHEN b IS NULL THEN NULL WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS s FROM ab)"""


DOCPAIRS = SCALED + """,
sq AS (SELECT doc_id, sum(value * value) AS s FROM scaled GROUP BY doc_id),
dots AS (
  SELECT a.doc_id AS i, b.doc_id AS j, sum(a.value * b.value) AS g
  FROM scaled a JOIN scaled b ON a.feature = b.feature AND a.doc_id <> b.doc_id
  WHERE a.value <> 0 AND b.value <> 0 GROUP BY ALL),
pairs AS (
  SELECT a.doc_id AS i, b.doc_id AS j,
         CASE WHEN a.s + b.s - 2 * coalesce(g, 0) < 1e-13 * (a.s + b.s) THEN 0.0
              ELSE sqrt(a.s + b.s - 2 * coalesce(g, 0)) END AS d
  FROM sq a JOIN sq b ON a.doc_id <> b.doc_id LEFT JOIN dots ON dots.i = a.doc_id AND dots.j = b.doc_id)"""

DOCPAIRS_COSINE = DOCPAIRS.replace("pairs AS (", "distances AS (") + """,
pairs AS (
  SELECT a.doc_id AS i, b.doc_id AS j, 1 - coalesce(g / nullif(sqrt(a.s) * sqrt(b.s), 0), 0) AS d
  FROM sq a JOIN sq b ON a.doc_id <> b.doc_id LEFT JOIN dots ON dots.i = a.doc_id AND dots.j = b.doc_id)"""

SPLIT = VEC + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY vec_id) AS rn, count(*) OVER () AS total FROM vec),
train AS (SELECT * FROM ranked WHERE rn <= floor(total * 0.6)),
test AS (SELECT * FROM ranked WHERE rn > floor(total * 0.6))"""


DOCSPLIT = DOCPAIRS + """,
ranked AS (
  SELECT doc_id AS vec_id, lang AS label, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS total FROM documents),
train AS (SELECT * FROM ranked WHERE rn <= floor(total * 0.6)),
test AS (SELECT * FROM ranked WHERE rn > floor(total * 0.6)),
nn AS (
  SELECT i AS query_id, rank, j AS vec_id, label FROM (
    SELECT i, j, t.label, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank
    FROM pairs JOIN test ON test.vec_id = i JOIN (SELECT vec_id, label FROM train) t ON t.vec_id = j)
  WHERE rank <= 25)"""


def _knn(metric: str, k: int) -> str:
    return SPLIT + f""",
nn AS (
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, d, label FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM (
      SELECT test.vec_id AS query_id, train.vec_id, train.label, {_distance('test.x', 'train.x', metric)} AS d
      FROM test, train))
  WHERE rank <= {k})"""


PRED = """,
pred AS (
  SELECT query_id, k, label AS predicted FROM (
    SELECT query_id, k, label, row_number() OVER (PARTITION BY query_id, k ORDER BY count(*) DESC, label) AS o
    FROM nn, (SELECT unnest([5, 10, 25]) AS k) WHERE rank <= k GROUP BY query_id, k, label)
  WHERE o = 1)"""


def _accuracy(neighbours: str) -> str:
    return f"""WITH {neighbours}{PRED}
SELECT CAST(k AS INTEGER) AS k, count(*) AS n_test, round(avg(CAST(predicted = label AS INTEGER)), 6) + 0.0 AS accuracy
FROM pred JOIN test ON test.vec_id = pred.query_id GROUP BY k"""


def _tree(rows: str, cells: str) -> str:
    """Relation pred (id, label, predicted) of the test rows and relation grown (depth, node, id,
    train) of a Gini tree, from ``rows`` (id, label, train) and nonzero ``cells`` (id, f, v).
    A round splits every node whose training labels differ; rows that move make the next one."""
    return f"""trows AS MATERIALIZED ({rows}),
tcells AS MATERIALIZED ({cells}),
grown(depth, node, id, label, train) AS (
  SELECT 0, '', id, label, train FROM trows
  UNION ALL (
    WITH s AS (SELECT * FROM grown),
    tot AS (SELECT node, label, count(*) AS t FROM s WHERE train GROUP BY ALL),
    big AS (SELECT node, sum(t) AS n, sum(t * t) AS t2 FROM tot GROUP BY node HAVING count(*) > 1),
    nz AS (SELECT node, f, v, label, count(*) AS c FROM s JOIN big USING (node) JOIN tcells USING (id) WHERE train GROUP BY ALL),
    ev AS (
      SELECT * FROM nz
      UNION ALL
      SELECT node, f, 0.0, label, t - coalesce(k, 0) FROM (SELECT DISTINCT node, f FROM nz) JOIN tot USING (node)
      LEFT JOIN (SELECT node, f, label, sum(c) AS k FROM nz GROUP BY ALL) USING (node, f, label) WHERE t > coalesce(k, 0)),
    cum AS (
      SELECT node, f, v, c, t, sum(c) OVER (PARTITION BY node, f, label ORDER BY v) AS l FROM ev JOIN tot USING (node, label)),
    step AS (
      SELECT node, f, v, sum(c) AS n, sum(l * l - (l - c) * (l - c)) AS dl, sum((t - l) * (t - l) - (t - l + c) * (t - l + c)) AS dr
      FROM cum GROUP BY ALL),
    walk AS (
      SELECT node, f, v, sum(n) OVER w AS nl, sum(dl) OVER w AS sl, sum(dr) OVER w AS sr, lead(v) OVER w AS nv
      FROM step WINDOW w AS (PARTITION BY node, f ORDER BY v)),
    best AS (
      SELECT node, arg_min(f, o) AS f, arg_min((v + nv) / 2, o) AS th FROM (
        SELECT node, f, v, nv, (-(CAST(sl AS DOUBLE) / nl + CAST(t2 + sr AS DOUBLE) / (n - nl)), f, v) AS o
        FROM walk JOIN big USING (node) WHERE nv - v > 1e-9 * greatest(abs(v), abs(nv))) GROUP BY node)
    SELECT depth + 1, s.node || CASE WHEN coalesce(v, 0) > th + 1e-12 * abs(th) THEN '1' ELSE '0' END, s.id, s.label, s.train
    FROM s JOIN best USING (node) LEFT JOIN tcells ON tcells.id = s.id AND tcells.f = best.f)),
ended AS (SELECT id, arg_max(node, depth) AS node, any_value(label) AS label, any_value(train) AS train FROM grown GROUP BY id),
vote AS (
  SELECT node, label AS predicted FROM (
    SELECT node, label, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) AS o FROM ended WHERE train GROUP BY node, label)
  WHERE o = 1),
pred AS (SELECT id, label, predicted FROM ended JOIN vote USING (node) WHERE NOT train)"""


VECTREE = VEC + ",\n" + _tree(
    "SELECT vec_id AS id, CAST(label AS VARCHAR) AS label, row_number() OVER (ORDER BY vec_id) <= floor(count(*) OVER () * 0.6) AS train FROM vec",
    "SELECT vec_id AS id, pos AS f, value AS v FROM nv WHERE value <> 0",
)
DOCTREE = SCALED + ",\n" + _tree(
    "SELECT doc_id AS id, lang AS label, row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.6) AS train FROM documents",
    "SELECT doc_id AS id, dense_rank() OVER (ORDER BY feature) AS f, value AS v FROM scaled WHERE value <> 0",
)
TREE_REPORT = """
SELECT (SELECT count(*) FROM trows WHERE train) AS n_train, (SELECT count(*) FROM trows WHERE NOT train) AS n_test,
       (SELECT count(DISTINCT node) FROM grown WHERE train) AS n_nodes,
       (SELECT CAST(max(depth) AS INTEGER) FROM grown WHERE train) AS depth,
       round(avg(CAST(predicted = label AS INTEGER)), 6) + 0.0 AS accuracy FROM pred"""


def _doc_lloyd(start: str) -> str:
    """Relation dl (trial, it, c, feature, m, moved), means in long form, over ``scaled``, from
    a relation (trial, c, doc_id); then asg (trial, doc_id, c) by the last means."""
    def nearest(means: str) -> str:
        return f"""SELECT trial, doc_id, arg_min(c, (q - 2 * coalesce(g, 0), c)) AS c
      FROM (SELECT DISTINCT doc_id FROM scaled) CROSS JOIN (SELECT trial, c, sum(m * m) AS q FROM {means} GROUP BY trial, c)
      LEFT JOIN (
        SELECT doc_id, trial, c, sum(value * m) AS g FROM scaled JOIN {means} USING (feature) GROUP BY doc_id, trial, c) USING (doc_id, trial, c)
      GROUP BY trial, doc_id"""

    live = "(SELECT * FROM dl WHERE moved >= 1e-6)"
    return f"""dl(trial, it, c, feature, m, moved) AS (
  SELECT trial, 0, c, feature, value, CAST(1e300 AS DOUBLE) FROM scaled JOIN ({start}) USING (doc_id)
  UNION ALL
  SELECT trial, (SELECT max(it) + 1 FROM dl), c, feature, new, sum(CASE WHEN first THEN d ELSE 0 END) OVER (PARTITION BY trial) FROM (
    SELECT *, sqrt(sum((new - m) * (new - m)) OVER (PARTITION BY trial, c)) AS d, row_number() OVER (PARTITION BY trial, c) = 1 AS first FROM (
      SELECT trial, c, feature, coalesce(m, 0) AS m, (coalesce(m, 0) + coalesce(s, 0)) / (1.0 + coalesce(n, 0)) AS new
      FROM (SELECT trial, c, feature, m FROM {live}) FULL JOIN (
        SELECT trial, c, feature, sum(value) AS s FROM scaled JOIN ({nearest(live)}) USING (doc_id) GROUP BY trial, c, feature) USING (trial, c, feature)
      LEFT JOIN (SELECT trial, c, count(*) AS n FROM ({nearest(live)}) GROUP BY trial, c) USING (trial, c)))),
lasts AS (SELECT trial, it, c, feature, m, moved FROM dl WHERE (trial, it) IN (SELECT (trial, max(it)) FROM dl GROUP BY trial)),
asg AS ({nearest('lasts')})"""


DOCKM = SCALED + ",\n" + _doc_lloyd(
    "SELECT 1 AS trial, doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER) AS c FROM documents ORDER BY doc_id LIMIT 25"
)

DOCREPORT = """lab AS (SELECT cluster, label, count(*) AS n FROM dcl GROUP BY ALL),
tot AS (SELECT cluster, count(*) AS n FROM dcl GROUP BY cluster),
ent AS (SELECT cluster, -sum(lab.n / tot.n * ln(lab.n / tot.n)) AS entropy FROM lab JOIN tot USING (cluster) GROUP BY cluster),
var AS (
  SELECT cluster, CASE WHEN any_value(n) < 2 THEN 0.0
    ELSE sum(value * value) / any_value(n * w) - pow(sum(value) / any_value(n * w), 2) END AS variance
  FROM scaled JOIN dcl ON dcl.id = doc_id JOIN tot USING (cluster), (SELECT count(DISTINCT feature) AS w FROM matrix)
  GROUP BY cluster),
tosum AS (
  SELECT a.id AS vec_id, a.cluster AS own, b.cluster AS other, sum(pairs.d) AS s
  FROM pairs JOIN dcl a ON a.id = i JOIN dcl b ON b.id = j GROUP BY ALL),
ab AS (
  SELECT vec_id, any_value(o.n) AS own_n,
         max(CASE WHEN own = other THEN s / nullif(o.n - 1, 0) END) AS a,
         min(CASE WHEN own <> other THEN s / z.n END) AS b
  FROM tosum JOIN tot o ON o.cluster = own JOIN tot z ON z.cluster = other GROUP BY vec_id),
sil AS (SELECT avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS s FROM ab)"""
DOCREPORT_COLUMNS = """cluster, tot.n, round(entropy, 6) + 0.0 AS entropy, round(variance, 9) + 0.0 AS variance,
       round((SELECT s FROM sil), 6) + 0.0 AS silhouette
FROM tot JOIN ent USING (cluster) JOIN var USING (cluster)"""

DOCKM_TRIALS = DOCPAIRS + ",\n" + _doc_lloyd("""SELECT * FROM (
    SELECT t AS trial, doc_id, CAST(row_number() OVER (PARTITION BY t ORDER BY md5(t || ':' || doc_id), doc_id) - 1 AS INTEGER) AS c
    FROM documents, (SELECT unnest([1, 2, 3]) AS t)) WHERE c < 25""") + """,
places AS (
  SELECT trial, c, CAST(row_number() OVER (PARTITION BY trial ORDER BY sum(m), c) - 1 AS INTEGER) AS cluster FROM lasts GROUP BY trial, c),
ends AS (SELECT trial, cluster, feature, m FROM lasts JOIN places USING (trial, c)),
gaps AS (
  SELECT ta, tb, cluster, sqrt(sum(d * d)) AS d FROM (
    SELECT ta, tb, cluster, feature, sum(CASE WHEN trial = ta THEN m ELSE -m END) AS d
    FROM ends, (SELECT unnest([1, 2, 3]) AS ta) a, (SELECT unnest([1, 2, 3]) AS tb) b
    WHERE ta <> tb AND trial IN (ta, tb) GROUP BY ta, tb, cluster, feature) GROUP BY ta, tb, cluster),
pick AS (SELECT ta AS trial FROM gaps GROUP BY ta ORDER BY sum(d), ta LIMIT 1),
dcl AS (
  SELECT doc_id AS id, cluster, lang AS label FROM asg JOIN places USING (trial, c) JOIN documents USING (doc_id)
  WHERE trial = (SELECT trial FROM pick))"""

HASH32 = "CAST('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) AS BIGINT)"


MD5_HASH32 = "CAST('0x' || substr(h, 1, 8) AS BIGINT)"


def _signatures(ks: tuple[int, ...], seed: int = 1, digest: str = "sha1", hash32: str = HASH32) -> str:
    """Relation sig (k, doc_id, slot, hv) for every document."""
    values = []
    for k in ks:
        a, b = permutations(k, seed)
        values += [f"({k},{s},{int(x)},{int(y)})" for s, (x, y) in enumerate(zip(a, b))]
    top, half = 1 << 64, 1 << 63
    return BAGS + f""",
perm(k, slot, a, b) AS (VALUES {','.join(values)}),
hashed AS (SELECT term, {hash32} AS hv FROM (SELECT term, {digest}(term) AS h FROM dfs)),
wrapped AS (
  SELECT k, slot, term, ((CAST(a AS HUGEINT) * hv + b + {half}) % {top}) - {half} AS w FROM hashed, perm),
ph AS (SELECT k, slot, term, CAST((((w % {PRIME}) + {PRIME}) % {PRIME}) % {MAX_HASH + 1} AS BIGINT) AS hv FROM wrapped),
got AS (SELECT k, doc_id, slot, min(hv) AS hv FROM wc JOIN ph USING (term) GROUP BY k, doc_id, slot),
sig AS (
  SELECT perm.k, documents.doc_id, CAST(perm.slot AS INTEGER) AS slot, coalesce(got.hv, {MAX_HASH}) AS hv
  FROM documents CROSS JOIN perm LEFT JOIN got
    ON got.doc_id = documents.doc_id AND got.k = perm.k AND got.slot = perm.slot)"""


JACCARD = """
sizes AS (SELECT doc_id, count(*) AS c FROM wc GROUP BY doc_id),
inter AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS x FROM wc a JOIN wc b ON a.term = b.term AND a.doc_id < b.doc_id
  GROUP BY ALL),
jac AS (
  SELECT i, j, x / (p.c + q.c - x) AS v FROM inter JOIN sizes p ON p.doc_id = i JOIN sizes q ON q.doc_id = j)"""


def _estimates(ks: tuple[int, ...]) -> str:
    """Relation est (k, i, j, v), i < j, pairs with at least one equal slot."""
    return _signatures(ks) + """,
est AS (
  SELECT a.k, a.doc_id AS i, b.doc_id AS j, count(*) / a.k AS v
  FROM sig a JOIN sig b ON a.k = b.k AND a.slot = b.slot AND a.hv = b.hv AND a.doc_id < b.doc_id
  GROUP BY a.k, a.doc_id, b.doc_id)"""


def _both_ways(rel: str, total: str, top: str, where: str = "true") -> str:
    return f"""
SELECT doc_id, count(v) AS n_similar, round(coalesce(sum(v), 0), 6) + 0.0 AS {total},
       round(coalesce(max(v), 0), 6) + 0.0 AS {top}
FROM documents LEFT JOIN (
  SELECT i AS doc_id, v FROM {rel} WHERE {where} UNION ALL SELECT j, v FROM {rel} WHERE {where}) USING (doc_id)
GROUP BY doc_id"""


def _decoded(sql: str) -> str:
    for entity, char in ENTITIES:
        sql = f"replace({sql}, {_q(entity)}, {_q(char)})"
    return sql


def _elements(src: str, tag: str) -> str:
    return rf"regexp_extract_all({src}, '(?is)<{tag}(?:[ \t\n\r][^>]*)?>(.*?)</{tag}>', 1)"


def _lines(entries: str, joined: str) -> str:
    return f"""
SELECT doc_id, CAST(doc_id AS VARCHAR) || ':' || chr(9) || '(title,)(topics,' || lang || ')(places,' || source || ')'
       || coalesce({entries}, '') AS line FROM documents LEFT JOIN ({joined}) USING (doc_id)"""


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["corpus_scan"] = "SELECT doc_id, lang AS topics, source AS places, '' AS title, CAST(length(text) AS BIGINT) AS n_chars FROM documents"
    sql["corpus_first_n_sources"] = """SELECT doc_id, source FROM documents
WHERE source IN (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 6)"""
    sql["corpus_sample"] = """SELECT doc_id, source, text FROM documents
WHERE source = (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 1 OFFSET 1) ORDER BY doc_id LIMIT 20"""
    sql["tagged_record_scan"] = "SELECT doc_id, lang AS topics, source AS places, '' AS title, md5(text) AS body_md5 FROM documents"
    sql["wordcount_vector_lines"] = f"WITH {BAGS} " + _lines(
        "entries", "SELECT doc_id, string_agg('(' || term || ',' || cnt || ')', '' ORDER BY term) AS entries FROM wc GROUP BY doc_id")
    sql["tfidf_vector_lines"] = f"WITH {TFIDF} " + _lines(
        "entries", "SELECT doc_id, string_agg('(' || term || ',' || printf('%.6f', round(tfidf, 6) + 0.0) || ')', '' ORDER BY term) AS entries FROM tfidf GROUP BY doc_id")
    sql["corpus_summary"] = f"""WITH {BAGS}
SELECT n_docs AS n_vectors, (SELECT count(*) + 2 FROM dfs) AS n_features,
       CAST(floor(n_docs * 0.6) AS BIGINT) AS n_train, n_docs - CAST(floor(n_docs * 0.6) AS BIGINT) AS n_test FROM n"""

    sql["html_field_extract"] = rf"""
SELECT page_id, nullif(regexp_extract(html, '(?is)<html[ \t\n\r][^>]*?lang="([^"]*)"', 1), '') AS lang,
       coalesce({_decoded(_elements('html', 'title') + '[1]')}, '') AS title,
       md5({_decoded(_elements('html', 'article') + '[1]')}) AS article_md5,
       {_elements('html', 'body')}[1] IS NULL AS no_body FROM pages"""
    sql["html_multi_extract"] = f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, item FROM (
  SELECT page_id, unnest(li) AS item, generate_subscripts(li, 1) AS i FROM (
    SELECT page_id, {_elements('html', 'li')} AS li FROM pages))"""
    sql["primary_label"] = f"SELECT page_id, {_elements(_elements('html', 'nav') + '[1]', 'a')}[1] AS label FROM pages"
    sql["tokenize"] = f"WITH {TOK} SELECT doc_id, pos, token FROM tok"
    sql["stopword_filter"] = f"WITH {TOK} SELECT doc_id, token, count(*) AS n FROM tok WHERE token NOT IN ({STOP}) GROUP BY ALL"
    sql["alnum_token_filter"] = f"WITH {TOK} SELECT doc_id, token, count(*) AS n FROM tok WHERE {ALNUM} GROUP BY ALL"
    sql["labelled_docs"] = """SELECT doc_id, quality, CAST(length(text) AS BIGINT) AS n_chars
FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND text IS NOT NULL"""
    sql["sha1_term_hash"] = f"WITH {BAGS} SELECT term, {HASH32} AS hash32 FROM (SELECT term, sha1(term) AS h FROM dfs)"

    sql["word_counts"] = f"WITH {BAGS} SELECT doc_id, term, cnt FROM wc"
    sql["doc_length"] = f"WITH {BAGS} SELECT doc_id, coalesce(num_words, 0) AS num_words FROM documents LEFT JOIN lens USING (doc_id) WHERE text IS NOT NULL"
    sql["lexical_diversity"] = f"WITH {BAGS},{STATS} SELECT doc_id, n_terms, num_words, round(diversity, 9) + 0.0 AS diversity FROM stats"
    sql["term_frequency"] = f"WITH {BAGS} SELECT doc_id, term, round(cnt / num_words, 9) + 0.0 AS tf FROM wc JOIN lens USING (doc_id)"
    sql["document_frequency"] = f"WITH {BAGS} SELECT term, df FROM dfs"
    sql["idf"] = f"WITH {BAGS} SELECT term, df, round(ln(n_docs / df), 9) + 0.0 AS idf FROM dfs, n"
    sql["tfidf"] = f"WITH {TFIDF} SELECT doc_id, term, round(tfidf, 9) + 0.0 AS tfidf FROM tfidf"
    sql["feature_matrix"] = f"WITH {MATRIX} SELECT doc_id, feature, round(value, 9) + 0.0 AS value FROM matrix"
    sql["tfidf_l2_normalize"] = f"WITH {SCALED} SELECT doc_id, feature, round(value, 9) + 0.0 AS value FROM scaled"
    sql["feature_l2_normalize"] = f"WITH {VEC} SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(value, 9) + 0.0 AS value FROM nv"
    sql["dedupe_by_id"] = """SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1"""

    sql["pairwise_euclidean"] = _profile("euclidean")
    sql["pairwise_cosine"] = _profile("cosine")
    vec_ids = "SELECT vec_id AS id FROM vec"
    db = _dbscan(_pairs("euclidean"), vec_ids, 0.40, 3)
    sql["eps_neighbors"] = f"WITH RECURSIVE {db} SELECT id AS vec_id, n AS n_neighbors, CAST(n >= 3 AS INTEGER) AS is_core FROM cnt"

    sql["jaccard_exact"] = f"WITH {BAGS},{JACCARD}" + _both_ways("jac", "sum_jaccard", "max_jaccard")
    sql["minhash_jaccard"] = f"WITH {_estimates((128,))}" + _both_ways("est", "sum_estimate", "max_estimate")
    sql["minhash_mse"] = f"""WITH {_estimates(STUDY_SLOTS)},{JACCARD},
diff AS (
  SELECT k, est.v - coalesce(jac.v, 0) AS e FROM est LEFT JOIN jac USING (i, j)
  UNION ALL
  SELECT ks.k, -jac.v FROM jac CROSS JOIN (SELECT DISTINCT k FROM perm) ks
  LEFT JOIN est ON est.i = jac.i AND est.j = jac.j AND est.k = ks.k WHERE est.i IS NULL)
SELECT CAST(k AS INTEGER) AS k, CAST(n_docs * (n_docs - 1) // 2 AS BIGINT) AS n_pairs,
       round(sum(e * e) / (n_docs * (n_docs - 1) / 2), 9) + 0.0 AS mse
FROM diff, n GROUP BY k, n_docs"""
    sig = _signatures((128,))
    sql["minhash_signature"] = f"WITH {sig} SELECT doc_id, slot, hv FROM sig"
    sql["minhash_signature_md5"] = f"WITH {_signatures((128,), digest='md5', hash32=MD5_HASH32)} SELECT doc_id, slot, hv FROM sig"
    sql["minhash_merge"] = f"WITH {sig} SELECT lang AS label, slot, min(hv) AS hv FROM sig JOIN documents USING (doc_id) GROUP BY lang, slot"
    sql["minhash_union"] = f"""WITH {sig} SELECT source, count(*) AS n_inputs, slot, min(hv) AS hv
FROM sig JOIN documents USING (doc_id) GROUP BY source, slot HAVING count(*) >= 2"""
    sql["minhash_count"] = f"WITH {sig} SELECT doc_id, round(128 / sum(hv / 4294967295.0::DOUBLE) - 1, 6) + 0.0 AS n_est FROM sig GROUP BY doc_id"
    sql["minhash_empty"] = f"WITH {sig} SELECT doc_id, CAST(min(hv) = {MAX_HASH} AS INTEGER) AS is_empty FROM sig GROUP BY doc_id"
    sql["minhash_equal_groups"] = f"""WITH {sig}, whole AS (SELECT doc_id, list(hv ORDER BY slot) AS s FROM sig GROUP BY doc_id)
SELECT min(doc_id) AS first_id, count(*) AS n_docs FROM whole GROUP BY s"""
    sql["minhash_table_roundtrip"] = f"WITH {sig} SELECT doc_id, 1 AS seed, 128 AS num_perm, slot, hv FROM sig"

    sql["kmeans_assign"] = f"WITH RECURSIVE {KM} SELECT vec_id, cluster, round(d, 6) + 0.0 AS d FROM asg"
    sql["kmeans_documents_assign"] = f"""WITH RECURSIVE {DOCKM}
SELECT doc_id, c AS cluster, CAST((SELECT max(it) FROM lasts) AS INTEGER) AS n_iter, (SELECT max(moved) FROM lasts) < 1e-6 AS converged FROM asg"""
    sql["kmeans_documents"] = f"""WITH RECURSIVE {DOCKM_TRIALS},
{DOCREPORT},
ended AS (SELECT max(it) AS it, max(moved) AS moved FROM lasts WHERE trial = (SELECT trial FROM pick))
SELECT 25 AS n_clusters, CAST((SELECT it FROM ended) AS INTEGER) AS n_iter, (SELECT moved FROM ended) < 1e-6 AS converged,
       {DOCREPORT_COLUMNS}"""
    sql["kmeans_sweep"] = " UNION ALL ".join(
        f"SELECT {k} AS n_clusters, cluster, n_iter, n, cost FROM ({_fit('euclidean', k)})" for k in (10, 25))
    sql["dbscan_sweep"] = " UNION ALL ".join(
        f"""SELECT CAST({e} AS DOUBLE) AS eps, {m} AS min_samples, * FROM (
WITH RECURSIVE {_dbscan(_pairs('euclidean'), vec_ids, e, m)} SELECT id AS vec_id, cluster, is_core FROM db)"""
        for e in (0.38, 0.42) for m in (3, 5))
    sql["kmeans_fit"] = _fit("euclidean")
    sql["kmeans_fit_cosine"] = _fit("cosine")
    sql["cluster_sizes"] = f"WITH RECURSIVE {KM} SELECT cluster, count(*) AS n FROM cl GROUP BY cluster"
    report = KM + "," + _report("cl")
    sql["cluster_label_counts"] = f"WITH RECURSIVE {report} SELECT cluster, label, n FROM lab"
    sql["cluster_entropy"] = f"WITH RECURSIVE {report} SELECT cluster, round(entropy, 6) + 0.0 AS entropy FROM ent"
    sql["cluster_variance"] = f"WITH RECURSIVE {report} SELECT cluster, round(variance, 9) + 0.0 AS variance FROM var"
    whole = "SELECT cluster, tot.n, round(entropy, 6) + 0.0 AS entropy, round(variance, 9) + 0.0 AS variance"
    tables = "FROM tot JOIN ent USING (cluster) JOIN var USING (cluster)"
    sql["cluster_report"] = f"WITH RECURSIVE {report} {whole} {tables}"
    sql["silhouette"] = f"""WITH RECURSIVE {KM},{_silhouette('cl')}
SELECT (SELECT count(*) FROM size) AS n_clusters, round(s, 6) + 0.0 AS silhouette FROM sil"""

    sql["dbscan"] = f"WITH RECURSIVE {db} SELECT id AS vec_id, cluster, is_core FROM db"
    sql["dbscan_cosine"] = f"WITH RECURSIVE {_dbscan(_pairs('cosine'), vec_ids, 0.30, 3)} SELECT id AS vec_id, cluster, is_core FROM db"
    sql["dbscan_documents"] = f"""WITH RECURSIVE {_dbscan(DOCPAIRS, 'SELECT doc_id AS id FROM documents', 0.2, 3)}
SELECT id AS doc_id, cluster, is_core FROM db"""
    doc_ids = "SELECT doc_id AS id FROM documents"
    sql["dbscan_documents_cosine"] = f"""WITH RECURSIVE {_dbscan(DOCPAIRS_COSINE, doc_ids, 0.2, 3)}
SELECT id AS doc_id, cluster, is_core FROM db"""
    sql["eps_neighbors_documents"] = f"""WITH RECURSIVE {_dbscan(DOCPAIRS, doc_ids, 0.2, 3)}
SELECT id AS doc_id, n AS n_neighbors, CAST(n >= 3 AS INTEGER) AS is_core FROM cnt"""
    sql["dbscan_documents_report"] = f"""WITH RECURSIVE {_dbscan(DOCPAIRS, 'SELECT doc_id AS id FROM documents', 0.2, 3)},
dcl AS (SELECT id, cluster, lang AS label FROM db JOIN documents ON doc_id = id),
{DOCREPORT}
SELECT {DOCREPORT_COLUMNS}"""
    dcl = "dcl AS (SELECT vec_id, cluster, label, x FROM db JOIN vec ON vec.vec_id = db.id)"
    sql["dbscan_report"] = f"""WITH RECURSIVE {db},{dcl},{_report('dcl')},{_silhouette('dcl')}
{whole}, round((SELECT s FROM sil), 6) + 0.0 AS silhouette {tables}"""

    sql["train_test_split"] = """SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.6) AS INTEGER) AS is_train
FROM documents"""
    sql["knn_neighbors"] = f"WITH {_knn('euclidean', 5)} SELECT query_id, rank, vec_id, round(d, 6) + 0.0 AS d FROM nn"
    sql["knn_classify"] = f"WITH {_knn('euclidean', 25)}{PRED} SELECT query_id AS vec_id, CAST(k AS INTEGER) AS k, predicted FROM pred"
    sql["knn_accuracy"] = _accuracy(_knn("euclidean", 25))
    sql["knn_accuracy_cosine"] = _accuracy(_knn("cosine", 25))
    sql["knn_documents"] = _accuracy(DOCSPLIT)
    sql["tagged_knn"] = sql["knn_documents"]
    sql["dtree_classify"] = f"WITH RECURSIVE {VECTREE}{TREE_REPORT}"
    sql["dtree_predict"] = f"WITH RECURSIVE {VECTREE} SELECT id AS vec_id, predicted FROM pred"
    sql["dtree_documents"] = f"WITH RECURSIVE {DOCTREE}{TREE_REPORT}"
    sql["tagged_similarity_study"] = sql["minhash_mse"]
    return sql
