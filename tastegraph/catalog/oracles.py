"""Plain SQL for every deterministic query, written for DuckDB and independent of the operators'
plans: no prefixes, no copy groups, no blocks."""

from __future__ import annotations

from tastegraph.catalog import inputs, queries
from tastegraph.functions.hashing import LARGE_PRIME, SMALL_PRIME, hash_params
from tastegraph.operators.lsh import most_apart, sign_shape
from tastegraph.operators.onehash import rotation_step
from tastegraph.operators.permuted import BITS, NEIGHBOURS, PERMUTATIONS, permutations

IMPUTE_PASSES = 10


def tidy(value: str, digits: int = 6) -> str:
    return f"(CASE WHEN round({value}, {digits}) = 0 THEN 0.0 ELSE round({value}, {digits}) END)"


SPLIT = f"""
base AS (
  SELECT o_custkey AS u, l_partkey AS i, (1 + floor((l_quantity - 1) / 10))::DOUBLE AS r, o_orderdate AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (SELECT u, i, max(r) AS r FROM base GROUP BY u, i),
test AS (SELECT u, i, max(r) AS r FROM base WHERE d >= TIMESTAMP '{inputs.TEST_FROM:%Y-%m-%d}' GROUP BY u, i),
train AS (SELECT u, i, r FROM ratings WHERE NOT EXISTS
  (SELECT 1 FROM test WHERE test.u = ratings.u AND test.i = ratings.i))"""

LEAKY = """
leaky AS (SELECT u, i, max(r) AS r FROM (SELECT * FROM ratings UNION ALL SELECT * FROM test) GROUP BY u, i)"""


def pearson(name: str, source: str, by: str, support: int = 2, restrict: str = "TRUE", zero: bool = False) -> str:
    key = "i" if by == "u" else "u"
    vx, vy = "(sxx - sx * sx / n)", "(syy - sy * sy / n)"
    return f"""
{name}_sums AS (
  SELECT x.{by} AS a, y.{by} AS b, count(*) AS n, sum(x.r) AS sx, sum(y.r) AS sy,
         sum(x.r * x.r) AS sxx, sum(y.r * y.r) AS syy, sum(x.r * y.r) AS sxy
  FROM {source} x JOIN {source} y ON x.{key} = y.{key} AND x.{by} < y.{by}
  WHERE {restrict}
  GROUP BY 1, 2 HAVING count(*) >= {support}),
{name} AS (
  SELECT a, b, n, s FROM (
    SELECT a, b, n, CASE WHEN {vx} < 1e-12 OR {vy} < 1e-12 THEN 0
      ELSE (sxy - sx * sy / n) / sqrt({vx} * {vy}) END AS s FROM {name}_sums)
  WHERE s <> 0 OR {zero}),
{name}_both AS (SELECT a AS id, b AS nb, s AS w FROM {name} UNION ALL SELECT b, a, s FROM {name})"""


def ratio(up: str, down: str, default: str) -> str:
    return (
        f"CASE WHEN {up} IS NULL OR abs({up}) < 1e-12 OR abs({down}) < 1e-12 THEN {default} ELSE {up} / {down} END"
    )


def user_knn(weights: str, source: str = "train", k: int | None = None, cut: float = 0.0, exclude=False) -> str:
    rank = f"WHERE k <= {k}" if k else ""
    mean = "CASE WHEN m.n > 1 THEN (m.total - t.r) / (m.n - 1) ELSE t.r END" if exclude else "m.mean"
    if exclude:  # a zero sum of the other ratings cannot occur: ratings are at least 1
        mean = f"({mean})"
    return f"""
means AS (SELECT u, avg(r) AS mean, sum(r) AS total, count(*) AS n FROM {source} GROUP BY u),
voters AS (
  SELECT q.u, q.i, w.w, t.r - {mean} AS off,
         row_number() OVER (PARTITION BY q.u, q.i ORDER BY abs(w.w) DESC, w.nb) AS k
  FROM test q JOIN {weights} w ON w.id = q.u JOIN {source} t ON t.u = w.nb AND t.i = q.i
  JOIN means m ON m.u = w.nb),
votes AS (SELECT u, i, sum(w * off) AS up, sum(abs(w)) AS down
  FROM (SELECT * FROM voters {rank}) WHERE abs(w) > {cut} GROUP BY u, i),
predicted AS (
  SELECT q.u, q.i, least(5.0, greatest(1.0, coalesce(m.mean, 3.0) + {ratio('v.up', 'v.down', '0')})) AS p
  FROM test q LEFT JOIN means m ON m.u = q.u LEFT JOIN votes v ON v.u = q.u AND v.i = q.i)"""


def strongest(k: int) -> str:
    return f"""
w_top AS (SELECT id, nb, w FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(w) DESC, nb) AS k FROM w_both) WHERE k <= {k})"""


def item_knn(weights: str, source: str = "train", k: int | None = None, how: str = "minmax") -> str:
    rank = f"WHERE k <= {k}" if k else ""
    scaled = (
        "least(5.0, greatest(1.0, p))"
        if how == "clamp"
        else "p"
        if how == "none"
        else """CASE WHEN (SELECT max(p) - min(p) FROM raw) > 0
    THEN (p - (SELECT min(p) FROM raw)) * 5.0 / (SELECT max(p) - min(p) FROM raw) ELSE p END"""
    )
    return f"""
voters AS (
  SELECT q.u, q.i, w.w, t.r, row_number() OVER (PARTITION BY q.u, q.i ORDER BY abs(w.w) DESC, w.nb) AS k
  FROM test q JOIN {weights} w ON w.id = q.i JOIN {source} t ON t.i = w.nb AND t.u = q.u),
votes AS (SELECT u, i, sum(w * r) AS up, sum(abs(w)) AS down FROM (SELECT * FROM voters {rank}) GROUP BY u, i),
raw AS (SELECT q.u, q.i, {ratio('v.up', 'v.down', '3.0')} AS p
  FROM test q LEFT JOIN votes v ON v.u = q.u AND v.i = q.i),
predicted AS (SELECT u, i, {scaled} AS p FROM raw)"""


PREDICTED = f'SELECT u AS "user", i AS item, {tidy("p")} AS prediction FROM predicted'

SCORED = """
scored AS (SELECT q.u, q.i, q.r, p.p, abs(q.r - p.p) AS e FROM test q JOIN predicted p ON p.u = q.u AND p.i = q.i)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def hash_values(count: int) -> str:
    return "p(n, a, b) AS (VALUES " + ", ".join(f"({n}, {a}::BIGINT, {b}::BIGINT)" for n, a, b in hash_params(count)) + ")"


WORDS = """
el AS (
  SELECT DISTINCT id, ('0x' || substr(md5(w), 1, 12))::BIGINT AS x
  FROM (SELECT doc_id AS id, unnest(string_split(text, ' ')) AS w FROM documents)),
sizes AS (SELECT id, count(*) AS n FROM el GROUP BY id)"""


def minhash(rows: int, prime: int, universe: str = "") -> str:
    return f"""
mh AS (SELECT id, n, min((a * x + b) % {prime}{universe}) AS h FROM el, p GROUP BY id, n),""" + bands_met(rows)


def bands_met(rows: int) -> str:
    return f"""
band AS (SELECT id, n // {rows} AS g, string_agg(h::VARCHAR, ' ' ORDER BY n) AS k FROM mh GROUP BY 1, 2),
cand AS (SELECT DISTINCT x.id AS a, y.id AS b FROM band x JOIN band y ON x.g = y.g AND x.k = y.k AND x.id < y.id)"""


def one_hash(bins: int) -> str:
    """Bin minima of single hashes; an empty bin takes the next filled one to the right, moved by the distance."""
    return f"""
filled AS (SELECT id, x % {bins} AS bin, min(x // {bins}) AS v FROM el GROUP BY 1, 2),
mh AS (
  SELECT id, n, min_by(v + ((bin - n + {bins}) % {bins}) * {rotation_step(bins)}, (bin - n + {bins}) % {bins}) AS h
  FROM filled, range({bins}) r(n) GROUP BY id, n)"""


def tiled(size: int) -> str:
    """All cells of the tiles that have a rating."""
    return f"""
rn AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS n FROM (SELECT DISTINCT i FROM ratings)),
cn AS (SELECT u, row_number() OVER (ORDER BY u) - 1 AS n FROM (SELECT DISTINCT u FROM ratings)),
placed AS (SELECT rn.n AS y, cn.n AS x, r FROM ratings JOIN rn USING (i) JOIN cn USING (u)),
tile AS (SELECT DISTINCT y // {size} AS row_tile, x // {size} AS column_tile FROM placed),
cell AS (SELECT row_tile, column_tile, k, row_tile * {size} + k // {size} AS y, column_tile * {size} + k % {size} AS x
  FROM tile, range({size * size}) g(k))"""


ALL_PAIRS = "cand AS (SELECT DISTINCT x.id AS a, y.id AS b FROM el x JOIN el y ON x.x = y.x AND x.id < y.id)"


def checked(measure: str, threshold: float) -> str:
    value = {"jaccard": "c / (na.n + nb.n - c)", "cosine": "c / sqrt(na.n::DOUBLE * nb.n)"}[measure]
    return f"""
common AS (SELECT a, b, count(*)::DOUBLE AS c FROM cand JOIN el x ON x.id = a JOIN el y ON y.id = b AND y.x = x.x
  GROUP BY a, b),
pairs AS (SELECT a, b, {value} AS s FROM common JOIN sizes na ON na.id = a JOIN sizes nb ON nb.id = b
  WHERE {value} >= {threshold})"""


def direct(measure: str, threshold: float) -> str:
    """All pairs with a common element, counted straight from the self-join."""
    value = {"jaccard": "c / (na.n + nb.n - c)", "cosine": "c / sqrt(na.n::DOUBLE * nb.n)"}[measure]
    return f"""
shared AS (SELECT x.id AS a, y.id AS b, count(*)::DOUBLE AS c FROM el x JOIN el y ON x.x = y.x AND x.id < y.id
  GROUP BY 1, 2),
exact AS (SELECT a, b, {value} AS s FROM shared JOIN sizes na ON na.id = a JOIN sizes nb ON nb.id = b
  WHERE {value} >= {threshold})"""


SIGN_CANDIDATES = """
band AS (SELECT id, n // rows AS g, string_agg(CASE WHEN s >= 0 THEN '1' ELSE '0' END, '' ORDER BY n) AS k
  FROM sums, shape WHERE n < bands * rows GROUP BY 1, 2),
signature AS (SELECT id, string_agg(k, '' ORDER BY g) AS sig FROM band GROUP BY id),
met AS (SELECT DISTINCT x.id AS a, y.id AS b FROM band x JOIN band y ON x.g = y.g AND x.k = y.k AND x.id < y.id),
cand AS (
  SELECT a, b FROM met JOIN signature s ON s.id = a JOIN signature t ON t.id = b, shape
  WHERE hamming(s.sig, t.sig) <= apart)"""


def signs(threshold: float) -> str:
    rows, bands = sign_shape(threshold)
    return f"""{hash_values(rows * bands)},
sums AS (SELECT id, n, sum(1 - 2 * (((a * x + b) % {LARGE_PRIME}) % 2)) AS s FROM el, p GROUP BY id, n),
shape AS (SELECT {rows} AS rows, {bands} AS bands, {most_apart(threshold, rows * bands)} AS apart),{SIGN_CANDIDATES}"""


def permuted_pairs(threshold: float) -> str:
    """Neighbours in sorted permutations of the signatures of distinct sets, checked, and their copies."""
    orders = ", ".join(
        f"({p}, {n}, {at})" for p, order in enumerate(permutations(PERMUTATIONS, BITS)) for at, n in enumerate(order)
    )
    return f"""{hash_values(BITS)}, perm(p, n, place) AS (VALUES {orders}),
member AS (SELECT id, min(id) OVER (PARTITION BY elements) AS rep FROM (SELECT id, list(x ORDER BY x) AS elements FROM el GROUP BY id)),
own AS (SELECT id, x FROM el JOIN member USING (id) WHERE id = rep),
bit AS (
  SELECT id, n, CASE WHEN sum(1 - 2 * (((a * x + b) % {LARGE_PRIME}) % 2)) >= 0 THEN '1' ELSE '0' END AS v
  FROM own, p GROUP BY id, n),
signature AS (SELECT id, string_agg(v, '' ORDER BY n) AS sig FROM bit GROUP BY id),
placed AS (
  SELECT p, id, row_number() OVER (PARTITION BY p ORDER BY k, id) AS at FROM (
    SELECT p, id, string_agg(v, '' ORDER BY place) AS k FROM bit JOIN perm USING (n) GROUP BY p, id)),
near AS (
  SELECT DISTINCT least(x.id, y.id) AS a, greatest(x.id, y.id) AS b FROM placed x JOIN placed y
  ON x.p = y.p AND y.at > x.at AND y.at <= x.at + {NEIGHBOURS}),
cand AS (
  SELECT a, b FROM near JOIN signature s ON s.id = a JOIN signature t ON t.id = b
  WHERE hamming(s.sig, t.sig) <= {most_apart(threshold, BITS)}),
{checked("cosine", threshold).replace("pairs AS", "rep_pairs AS").strip()},
pairs AS (
  SELECT least(m.id, o.id) AS a, greatest(m.id, o.id) AS b, s FROM rep_pairs r JOIN member m ON m.rep = r.a JOIN member o ON o.rep = r.b
  UNION ALL SELECT m.id, o.id, 1.0 FROM member m JOIN member o ON m.rep = o.rep AND m.id < o.id)"""


def vectors(threshold: float) -> str:
    return f"""
vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE len(embedding) = {inputs.EMBEDDING_DIMS}),
cosines AS (
  SELECT x.id AS a, y.id AS b, list_inner_product(x.v, y.v)
    / (sqrt(list_inner_product(x.v, x.v)) * sqrt(list_inner_product(y.v, y.v))) AS s
  FROM vec x JOIN vec y ON x.id < y.id),
pairs AS (SELECT a, b, s FROM cosines WHERE s >= {threshold})"""


PAIRS = f"SELECT a, b, {tidy('s')} AS similarity FROM pairs"
EXACT = f"SELECT a, b, {tidy('s')} AS similarity FROM exact"


def parts(by: str, other: str) -> str:
    return f"""
deg AS (SELECT {by} AS id, count(*) AS n FROM ratings GROUP BY 1),
cells AS (SELECT {by} AS id, {other} AS e, r,
    ('0x' || substr(md5({other}::VARCHAR), 1, 12))::BIGINT % ceil(n / 16.0)::BIGINT AS part
  FROM ratings JOIN deg ON deg.id = {by})"""


def iterative_pass(number: int, table: str, numerator: int, denominator: int, impute: bool) -> str:
    """One pass: reads ``table`` and ``state<number-1>``, leaves ``table<number>`` and ``state<number>``."""
    w = f"w{number}"

    def value(votes: str) -> str:
        return f"""coalesce(o.mean, 3.0) + CASE WHEN o.total IS NULL OR abs(o.total) < 1e-12 THEN 0
      ELSE (o.base + coalesce({votes}, 0)) / o.total END"""

    source = f"(SELECT t.* FROM {table} t WHERE u IN (SELECT u FROM test))"
    text = f"""
near{number} AS {source},{pearson(w, f'near{number}', 'u', 3)},
stats{number} AS (SELECT u, avg(r) AS mean, count(*) AS n FROM {table} GROUP BY u),
own{number} AS (
  SELECT k.u, s.mean, coalesce(s.n, 0) AS d, v.total, v.base
  FROM (SELECT DISTINCT u FROM test) k LEFT JOIN stats{number} s ON s.u = k.u
  LEFT JOIN (SELECT id, sum(w) AS total, sum(w * (3.0 - m.mean)) AS base
    FROM {w}_both JOIN stats{number} m ON m.u = nb GROUP BY id) v ON v.id = k.u)"""
    if impute:
        text += f""",
gamma{number} AS (SELECT {numerator} * (m + n - 1) * (SELECT count(*) FROM {table}) // ({denominator} * m * n) AS g
  FROM (SELECT count(DISTINCT u) AS m, count(DISTINCT i) AS n FROM train)),
cell{number} AS (
  SELECT o.u, c.i FROM own{number} o,
    (SELECT k.i, count(t.u) AS c FROM (SELECT DISTINCT i FROM test) k LEFT JOIN train t ON t.i = k.i GROUP BY k.i) c
  WHERE o.d + c.c > (SELECT g FROM gamma{number})
    AND NOT EXISTS (SELECT 1 FROM {table} t WHERE t.u = o.u AND t.i = c.i)),
fill{number} AS (
  SELECT c.u, c.i, {value('v.x')} AS r FROM cell{number} c JOIN own{number} o ON o.u = c.u
  LEFT JOIN (SELECT c.u, c.i, sum(w * (t.r - 3.0)) AS x FROM cell{number} c JOIN {w}_both ON id = c.u
    JOIN {table} t ON t.u = nb AND t.i = c.i GROUP BY 1, 2) v ON v.u = c.u AND v.i = c.i),
table{number} AS (SELECT u, i, r FROM {table} UNION ALL SELECT u, i, r FROM fill{number})"""
    else:
        text += f",\ntable{number} AS (SELECT u, i, r FROM {table})"
    before = f"state{number - 1}" if number > 1 else "(SELECT u, i, 4.0::DOUBLE AS p, FALSE AS done FROM test)"
    return (
        text
        + f""",
guess{number} AS (
  SELECT q.u, q.i, {value('v.x')} AS p FROM test q JOIN own{number} o ON o.u = q.u
  LEFT JOIN (SELECT q.u, q.i, sum(w * (t.r - 3.0)) AS x FROM test q JOIN {w}_both ON id = q.u
    JOIN table{number} t ON t.u = nb AND t.i = q.i GROUP BY 1, 2) v ON v.u = q.u AND v.i = q.i),
state{number} AS (
  SELECT s.u, s.i, CASE WHEN s.done THEN s.p ELSE g.p END AS p, s.done OR abs(g.p - s.p) <= 0.01 AS done
  FROM {before} s JOIN guess{number} g ON g.u = s.u AND g.i = s.i)"""
    )


def _oracles() -> dict[str, str]:
    q = queries
    user_lsh = q.USER_LSH
    count_lsh = user_lsh["bands"] * user_lsh["rows"]
    train_users = pearson("w", "train", "u")
    train_items = pearson("w", "train", "i")
    triple = 'SELECT u AS "user", i AS item, r AS rating FROM '
    user_plain = (SPLIT, train_users, user_knn("w_both"))
    item_plain = (SPLIT, train_items, item_knn("w_both"))

    def sets(by, other, source, mixed=False):
        value = f"('0x' || substr(md5({other}::VARCHAR), 1, 12))::BIGINT" if mixed else other
        return f"""
el AS (SELECT DISTINCT {by} AS id, {value} AS x FROM {source}), sizes AS (SELECT id, count(*) AS n FROM el GROUP BY id)"""

    def chosen(by):
        return f"""{pearson("w", "train", by)},
c_both AS (SELECT w_both.* FROM w_both JOIN cand ON cand.a = least(id, nb) AND cand.b = greatest(id, nb))"""

    ratings_hash = (
        SPLIT, sets("i", "u", "ratings"), hash_values(165),
        minhash(5, SMALL_PRIME, " % (SELECT count(DISTINCT u) FROM ratings)"),
    )
    report = f"""SELECT 'pairs' AS metric, count(*)::DOUBLE AS value FROM scored
UNION ALL SELECT 'rmse', {tidy('sqrt(avg(e * e))')} FROM scored
UNION ALL SELECT CASE WHEN k = 4 THEN 'error_4_up' ELSE 'error_' || k END, count(e)::DOUBLE
FROM range(5) r(k) LEFT JOIN scored ON least(floor(e), 4)::BIGINT = k GROUP BY k"""
    lsh_pairs = (WORDS, hash_values(165), minhash(5, LARGE_PRIME), checked("jaccard", 0.5))
    return {
        "ratings_dedup": with_(SPLIT, select=triple + "ratings"),
        "holdout_train": with_(SPLIT, select=triple + "train"),
        "holdout_triple": with_(
            SPLIT,
            select=triple + """ratings WHERE NOT EXISTS (SELECT 1 FROM test
  WHERE test.u = ratings.u AND test.i = ratings.i AND test.r = ratings.r)""",
        ),
        "train_test_union": with_(SPLIT, select=triple + "train UNION ALL " + triple + "test"),
        "user_means": with_(
            SPLIT,
            select=f'SELECT u AS "user", {tidy("avg(r)")} AS mean, sum(r) AS total, count(*) AS n FROM train GROUP BY u',
        ),
        "mean_centered": with_(
            SPLIT,
            "m AS (SELECT u, avg(r) AS mean FROM train GROUP BY u)",
            select=f"""SELECT u AS "user", i AS item, r AS rating, {tidy("mean")} AS mean,
  {tidy("r - mean")} AS centered FROM train JOIN m USING (u)""",
        ),
        "presence_flags": with_(
            SPLIT,
            select="""SELECT u AS "user", i AS item, CASE WHEN EXISTS (SELECT 1 FROM test
  WHERE ratings.u = test.u AND ratings.i = test.i) THEN 1.0 ELSE 0.0 END::DOUBLE AS present
FROM ratings""",
        ),
        "user_degrees": with_(SPLIT, select='SELECT u AS "user", count(*) AS degree FROM train GROUP BY u'),
        "item_degrees": with_(SPLIT, select="SELECT i AS item, count(*) AS degree FROM train GROUP BY i"),
        "density_gamma": with_(
            SPLIT,
            select="""SELECT users, items, ratings, 3 * (users + items - 1) * ratings // (users * items) AS gamma
FROM (SELECT count(DISTINCT u) AS users, count(DISTINCT i) AS items, count(*) AS ratings FROM train)""",
        ),
        "user_rating_lists": with_(
            SPLIT,
            parts("u", "i"),
            select="""SELECT id, part, string_agg(e::VARCHAR, ' ' ORDER BY e) AS elements,
  string_agg(r::BIGINT::VARCHAR, ' ' ORDER BY e) AS ratings FROM cells GROUP BY id, part""",
        ),
        "item_rating_maps": with_(
            SPLIT,
            parts("i", "u"),
            select="""SELECT id, part, string_agg(e::VARCHAR, ' ' ORDER BY e) AS users,
  sum(r)::BIGINT AS total FROM cells GROUP BY id, part""",
        ),
        "pearson_users": with_(
            SPLIT, pearson("w", "ratings", "u"), select=f"SELECT a, b, n, {tidy('s')} AS similarity FROM w"
        ),
        "pearson_items": with_(
            SPLIT, pearson("w", "ratings", "i"), select=f"SELECT a, b, n, {tidy('s')} AS similarity FROM w"
        ),
        "pearson_users_support3": with_(
            SPLIT, pearson("w", "ratings", "u", 3), select=f"SELECT a, b, n, {tidy('s')} AS similarity FROM w"
        ),
        "pearson_users_all": with_(
            SPLIT, pearson("w", "ratings", "u", 1, zero=True), select=f"SELECT a, b, n, {tidy('s')} AS similarity FROM w"
        ),
        "topk_neighbors": with_(
            SPLIT,
            train_users,
            select=f"""SELECT id, nb AS neighbor, {tidy("w")} AS weight, k AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(w) DESC, nb)::INT AS k FROM w_both)
WHERE k <= {q.NEIGHBORS}""",
        ),
        "user_knn": with_(*user_plain, select=PREDICTED),
        "user_knn_topk": with_(
            SPLIT, train_users, user_knn("w_both", k=3, cut=0.05, exclude=True), select=PREDICTED
        ),
        "user_knn_global": with_(SPLIT, train_users, strongest(q.NEIGHBORS), user_knn("w_top"), select=PREDICTED),
        "item_knn_global": with_(
            SPLIT, train_items, strongest(q.NEIGHBORS), item_knn("w_top", how="none"), select=PREDICTED
        ),
        "user_knn_leaky": with_(
            SPLIT, LEAKY, pearson("w", "leaky", "u"), user_knn("w_both", "leaky"), select=PREDICTED
        ),
        "item_knn": with_(*item_plain, select=PREDICTED),
        "item_knn_leaky": with_(
            SPLIT, LEAKY, pearson("w", "leaky", "i"), item_knn("w_both", "leaky"), select=PREDICTED
        ),
        "item_knn_clamped": with_(SPLIT, train_items, item_knn("w_both", k=5, how="clamp"), select=PREDICTED),
        "user_knn_candidates": with_(
            SPLIT, sets("u", "i", "train", mixed=True), hash_values(count_lsh), minhash(user_lsh["rows"], LARGE_PRIME),
            chosen("u"), user_knn("c_both"), select=PREDICTED,
        ),
        "item_knn_candidates": with_(
            SPLIT, sets("i", "u", "train", mixed=True), hash_values(count_lsh), minhash(user_lsh["rows"], LARGE_PRIME),
            chosen("i"), item_knn("c_both"), select=PREDICTED,
        ),
        "user_knn_scored": with_(
            *user_plain,
            SCORED,
            select=f"""SELECT u AS "user", i AS item, r AS rating, {tidy("p")} AS prediction,
  {tidy("e")} AS abs_error FROM scored""",
        ),
        "user_knn_error_hist": with_(
            *user_plain,
            SCORED,
            select="""SELECT k AS bucket, count(e) AS n FROM range(5) r(k)
LEFT JOIN scored ON least(floor(e), 4)::BIGINT = k GROUP BY k""",
        ),
        "user_knn_rmse": with_(
            *user_plain, SCORED, select=f"SELECT count(*) AS n, {tidy('sqrt(avg(e * e))')} AS rmse FROM scored"
        ),
        "item_knn_quality": with_(*item_plain, SCORED, select=report),
        "written_quality": with_(*user_plain, SCORED, select=report),
        "predictions_sink_order": with_(
            *user_plain,
            select=PREDICTED.replace(" FROM", ', row_number() OVER (ORDER BY u, i) - 1 AS line FROM'),
        ),
        "one_hash_signatures": with_(
            SPLIT, sets("i", "u", "ratings", mixed=True), one_hash(q.ONE_HASH_BINS),
            select="SELECT id, string_agg(h::VARCHAR, ' ' ORDER BY n) AS signature FROM mh GROUP BY id",
        ),
        "jaccard_one_hash_join": with_(
            WORDS, one_hash(165), bands_met(5), checked("jaccard", 0.5), select=PAIRS,
        ),
        "item_vector_tiles": with_(
            SPLIT, tiled(q.TILE),
            select="""SELECT row_tile, column_tile, string_agg(coalesce(r, 0)::BIGINT::VARCHAR, ' ' ORDER BY k) AS cells
FROM cell LEFT JOIN placed USING (y, x) GROUP BY 1, 2""",
        ),
        "minhash_signature_rows": with_(*ratings_hash, select="SELECT id, n, h FROM mh"),
        "minhash_signatures": with_(
            *ratings_hash,
            select="SELECT id, string_agg(h::VARCHAR, ' ' ORDER BY n) AS signature FROM mh GROUP BY id",
        ),
        "minhash_rows_without_modulus": with_(
            SPLIT, sets("i", "u", "ratings"), hash_values(165),
            select="""SELECT id, n, min((a * x + b) % (SELECT count(DISTINCT u) FROM ratings)) AS h
FROM el, p GROUP BY id, n""",
        ),
        "lsh_candidates": with_(WORDS, hash_values(165), minhash(5, LARGE_PRIME), select="SELECT a, b FROM cand"),
        "lsh_candidates_small_prime": with_(
            WORDS, hash_values(165), minhash(5, SMALL_PRIME), select="SELECT a, b FROM cand"
        ),
        "jaccard_lsh_join": with_(*lsh_pairs, select=PAIRS),
        "jaccard_exact": with_(WORDS, direct("jaccard", 0.5), select=EXACT),
        "lsh_pair_quality": with_(
            *lsh_pairs,
            direct("jaccard", 0.5),
            select=f"""SELECT tp, fp, fn, {tidy("tp::DOUBLE / nullif(tp + fp, 0)")} AS precision,
  {tidy("tp::DOUBLE / nullif(tp + fn, 0)")} AS recall
FROM (SELECT count(*) FILTER (f AND t) AS tp, count(*) FILTER (f AND NOT t) AS fp, count(*) FILTER (t AND NOT f) AS fn
  FROM (SELECT pairs.a IS NOT NULL AS f, exact.a IS NOT NULL AS t
    FROM pairs FULL JOIN exact ON pairs.a = exact.a AND pairs.b = exact.b))""",
        ),
        "cosine_sets": with_(
            SPLIT, sets("i", "u", "ratings"), direct("cosine", q.SET_COSINE), select=EXACT
        ),
        "cosine_words": with_(WORDS, direct("cosine", q.WORD_COSINE), select=EXACT),
        "cosine_lsh_sets": with_(
            WORDS, signs(q.WORD_COSINE), checked("cosine", q.WORD_COSINE), select=PAIRS
        ),
        "cosine_permuted_sets": with_(WORDS, permuted_pairs(q.WORD_COSINE), select=PAIRS),
        "cosine_permuted_quality": with_(
            WORDS, permuted_pairs(q.WORD_COSINE), direct("cosine", q.WORD_COSINE),
            select=f"""SELECT tp, total - tp AS fn, 1.0::DOUBLE AS precision, {tidy('tp::DOUBLE / total')} AS recall
FROM (SELECT count(*) AS tp FROM pairs), (SELECT count(*) AS total FROM exact)""",
        ),
        "row_numbers": with_(
            SPLIT,
            select="""SELECT u AS "user", i AS item, r AS rating, row_number() OVER (ORDER BY u, i) - 1 AS number,
row_number() OVER (PARTITION BY u ORDER BY i) - 1 AS place, count(*) OVER (PARTITION BY u) AS items FROM ratings""",
        ),
        "pairs_relabelled": with_(
            WORDS, direct("cosine", q.WORD_COSINE),
            select=f"""SELECT least('doc-' || a, 'doc-' || b) AS a, greatest('doc-' || a, 'doc-' || b) AS b,
{tidy('s')} AS similarity FROM exact""",
        ),
        "cosine_set_quality": with_(
            WORDS,
            direct("cosine", q.WORD_COSINE),
            select="SELECT count(*) AS pairs, TRUE AS recall_met, 1.0::DOUBLE AS precision FROM exact",
        ),
        "cosine_vectors": with_(
            vectors(0.47), select=PAIRS
        ),
        "cosine_vector_quality": with_(
            vectors(0.47), select="SELECT count(*) AS pairs, TRUE AS recall_met, 1.0::DOUBLE AS precision FROM pairs"
        ),
        # nothing reaches the density cut at factor 3, so the second pass repeats the first
        "iterative_cf": with_(
            SPLIT,
            iterative_pass(1, "train", 3, 1, True),
            iterative_pass(2, "table1", 3, 1, False),
            select=f'SELECT u AS "user", i AS item, {tidy("p")} AS prediction FROM state2',
        ),
        # all pairs are frozen after eight passes at the checked size; a further pass changes nothing
        "iterative_cf_imputed": with_(
            SPLIT,
            *[
                iterative_pass(n, f"table{n - 1}" if n > 1 else "train", *q.IMPUTE_FACTOR, True)
                for n in range(1, IMPUTE_PASSES + 1)
            ],
            select=f"""SELECT u AS "user", i AS item,
  {tidy("least(5.0, greatest(1.0, p))", 3)} AS prediction FROM state{IMPUTE_PASSES}""",
        ),
        "als_scored_pairs": with_(
            SPLIT,
            select="""SELECT u AS "user", i AS item FROM test
WHERE u IN (SELECT u FROM train) AND i IN (SELECT i FROM train)""",
        ),
        "als_range": "SELECT 1.0::DOUBLE AS low, 5.0::DOUBLE AS high",
        "als_dropped": with_(
            SPLIT,
            select="""SELECT u AS "user", i AS item FROM test
WHERE u NOT IN (SELECT u FROM train) OR i NOT IN (SELECT i FROM train)""",
        ),
        "ratings_csv_roundtrip": with_(SPLIT, select=triple + "ratings"),
        "interactions_roundtrip": with_(SPLIT, select='SELECT u AS "user", i AS item FROM ratings'),
        "predictions_csv_roundtrip": with_(*user_plain, select=PREDICTED),
        "pairs_csv_similarity": with_(WORDS, direct("jaccard", 0.5), select=EXACT),
        "text_interactions_roundtrip": with_(
            SPLIT, select='SELECT u::VARCHAR AS "user", i::VARCHAR AS item FROM ratings'
        ),
        "pairs_sink_roundtrip": with_(WORDS, direct("jaccard", 0.5), select="SELECT a, b FROM exact"),
        "predictions_sink_roundtrip": with_(*user_plain, select=PREDICTED),
        "count_not_matching": "SELECT count(*) AS n FROM events WHERE event_type <> 'view'",
        "count_per_group": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
        "mean_per_group": f"""SELECT user_id, {tidy("avg(value)")} AS mean_value FROM events
WHERE event_type = 'purchase' GROUP BY user_id""",
    }


ORACLES = _oracles()
